"""Quality rules per document, and per host with an empirical beta prior.

Each document is measured and held to the base rules.  Rule failures are counted by host;
a host's failure rate of a rule is shrunk towards all hosts by a beta prior that is fitted to
the hosts' rates (method of moments), and a host whose shrunk rate of any rule exceeds
``reject`` takes all its documents with it.

Null and empty texts have no words and fail the base rules.  A null host has no verdict: its
documents stand for themselves.  Repeated rows count as often as they occur.  Lines and
windows are compared exactly and by 64-bit hash within one text, respectively.  Empty input
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, sealed, unused, written
from rillet.llm.textscan import SPACE, U, Hasher, Slice, covered, mix, slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: Characters that count as symbols, words of a repeated window.
SYMBOLS = b"#*$%&|<>"
WINDOW = 8

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[list(SYMBOLS)] = True
_STARTS = np.ones(256, dtype=bool)
_STARTS[0x80:0xC0] = False  # bytes that go on with a code point

#: Rules by name, over the measures: the base rules first.
RULES = {
    "short": "n_words < 20",
    "repeats": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
}
BASE = ("short", "repeats")


def _per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]


def _dup_lines(text: bytes) -> int:
    lines = text.split(b"\n")
    if len(set(lines)) == len(lines):
        return 0
    seen, found = set(), 0
    for line in lines:
        if line in seen:
            found += bool(line.split())
        seen.add(line)
    return found


def _repeats(part: Slice) -> np.ndarray:
    """Flags of the words in windows that occur twice or more in their text."""
    starts = part.whole(WINDOW)
    key = mix(Hasher(part.hashes).windows(WINDOW)[starts] + part.doc[starts].astype(U) * U(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    same = key[order[1:]] == key[order[:-1]]
    twice = np.zeros(len(starts), dtype=bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    return covered(starts[twice], WINDOW, len(part.doc))


def measure(docs: DataFrame, *, text: str = "text", carry_text: bool = True) -> DataFrame:
    """``docs`` (without ``text`` if not ``carry_text``) with the measures, all long:
    n_words; word_chars, code points in words; n_symbols; n_dup_lines, lines with a word that
    equal an earlier line; n_repeat_words, words in windows of 8 found twice or more."""
    inner, outer = sealed(docs, MEASURES if carry_text else (*MEASURES, text))
    source = docs.select(*inner, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    n = len(inner)
    names = [*source.columns[:n], *MEASURES]
    schema = source.select(*source.columns[:n], *[F.lit(0).cast("long").alias(m) for m in MEASURES]).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(n)):
                solid = ~SPACE[part.bytes]
                out = [np.diff(part.bounds), _per_text(solid & _STARTS[part.bytes], part.offsets), _per_text(_SYMBOL[part.bytes], part.offsets),
                       np.array([_dup_lines(part.text(i)) for i in range(len(part))]), _per_text(_repeats(part), part.bounds)]
                own = [c.slice(part.first, len(part)) for c in batch.columns[:n]]
                yield pa.RecordBatch.from_arrays([*own, *[pa.array(v.astype(np.int64)) for v in out]], names)

    return map_arrow(source, work, schema).select(*outer, *MEASURES)


def _failed(rule: str) -> Column:
    return F.expr(RULES[rule])


def base_failed() -> Column:
    return _failed(BASE[0]) | _failed(BASE[1])


#: Prior documents that a host's rate is shrunk by at least, so that one or two don't decide.
LEAST_PRIOR = 2.0


def host_verdicts(measured: DataFrame, *, host: str = "source", reject: float = 0.5) -> DataFrame:
    """(host, n, <rule>_rate..., host_rejected) of every host that isn't null.

    The prior of a rule is Beta(m s, (1 - m) s): m is the share of all documents that fail, and
    s = 1 / r - 1 with r the correlation of two documents of a host, from the hosts' spread less what
    samples of their sizes spread by chance (beta-binomial moments), ``LEAST_PRIOR`` at least.  Hosts that
    spread no more than by chance are shrunk as if all documents were prior ones.
    """
    sums = [F.sum(_failed(r).cast("long")).alias(f"{r}_failed") for r in RULES]
    hosts = written(measured.where(F.col(f"`{host}`").isNotNull()).groupBy(F.col(f"`{host}`").alias("host"))
                    .agg(F.count(F.lit(1)).alias("n"), *sums), "hosts")
    k = lambda r: F.col(f"{r}_failed")
    total = hosts.agg(F.count(F.lit(1)).alias("hosts"), F.sum("n").cast("double").alias("n"), F.sum(F.col("n") * F.col("n").cast("double")).alias("nn"),
                      *[F.sum(k(r)).cast("double").alias(f"k_{r}") for r in RULES], *[F.sum(k(r) * k(r).cast("double") / F.col("n")).alias(f"kk_{r}") for r in RULES]).first()
    shrunk = []
    for r in RULES:
        m, s = _prior(total["hosts"], total["n"] or 0.0, total["nn"] or 0.0, total[f"k_{r}"] or 0.0, total[f"kk_{r}"] or 0.0)
        shrunk.append(((k(r) + F.lit(m * s)) / (F.col("n") + F.lit(s))).alias(f"{r}_rate"))
    rates = hosts.select("host", "n", *shrunk)
    return rates.withColumn("host_rejected", F.greatest(*[F.col(f"{r}_rate") for r in RULES]) > reject)


def _prior(hosts: int, n: float, nn: float, k: float, kk: float) -> tuple[float, float]:
    """Mean and strength from the number of hosts, their documents' sum and sum of squares, the
    failures' sum and the sum of failures squared by documents."""
    if not n:
        return 0.0, 0.0
    m = k / n
    spread = kk - k * k / n          # sum of n (rate - m) squared
    free = n - nn / n - (hosts - 1)  # of two documents of one host, beyond chance
    r = (spread / (m * (1 - m)) - (hosts - 1)) / free if 0 < m < 1 and free > 0 else 0.0
    return m, (max(1 / r - 1, LEAST_PRIOR) if r > 0 else n)


def judge(docs: DataFrame, *, text: str = "text", host: str = "source", reject: float = 0.5, carry_text: bool = True) -> DataFrame:
    """``docs`` with the measures, base_failed and kept.  Without the text the measures are
    written once and read for both the hosts and the documents; with it they are taken
    twice, which spares a copy of the corpus."""
    small = measure(docs, text=text, carry_text=False)
    if not carry_text:
        small = written(small, "measures")
    measured = measure(docs, text=text) if carry_text else small
    measured = measured.withColumn("base_failed", base_failed()).drop("kept")
    name, rejected = unused(measured, "_host", "_rejected")
    verdicts = host_verdicts(small, host=host, reject=reject).select(F.col("host").alias(name), F.col("host_rejected").alias(rejected))
    kept = ~F.col("base_failed") & ~F.coalesce(rejected, F.lit(False))
    return measured.join(verdicts, F.col(f"`{host}`") == F.col(name), "left").withColumn("kept", kept).drop(name, rejected)
