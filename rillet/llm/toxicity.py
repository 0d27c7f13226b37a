"""Toxicity by weak supervision.

Voters.  From a bounded sample of labelled rows come many voters that say "toxic" or
abstain: lexicon voters (a word) and pattern voters (a word's beginning), each of which
occurs, often enough, in far more toxic than other texts.

Label model.  How often the voters vote, alone and in pairs, is counted over all documents.
With p the share of toxic labels and a_i, b_i the rates at which voter i votes on toxic and
other texts, voters that are independent given the class have the covariances
``p (1 - p) (a_i - b_i) (a_j - b_j)``; fitting this outer product to the pairs gives each
voter's accuracy, and pairs that deviate from it are correlated: pairs that share too little
(voters of different languages) drop out of the fit, pairs that share too much (a word and
its own beginning) divide their evidence.  The posterior of a text follows from its votes.

Classifier.  A logistic regression on how often each voter occurs in a text is trained on
the posteriors, and scores every text.  Labels reach the scores through the choice of voters
and through p alone; language, source and id never.

Null and empty texts have no votes and get a score like others.  Labels that are null don't
count, of repeated labels of one id the largest counts.  Without toxic labels there are no
voters and every score is p (0 without labels).  A null id is not held out.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, sealed, written

#: At most so many labelled rows are learned from, those of the smallest hash.
SAMPLE = 20_000
#: At most so many voters.
VOTERS = 96
#: Lengths of the word beginnings that may become pattern voters, and how often one may have
#: to occur in a text before its voter votes.
PREFIXES, TIMES = (4, 5, 6, 7, 8), (1, 2, 3)
#: A voter votes on so many toxic texts at least, and on this share of them; so many of the
#: texts that it votes on are toxic.
SUPPORT, SHARE, PURITY = 8, 0.02, 0.8
_WORD = re.compile(r"[^\W\d_]+")
_FLOOR = 1e-4


def held_out(id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string").cast("binary")), F.lit(3)) == 1, F.lit(False))


def _words(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def learning_rows(docs: DataFrame, labels: DataFrame, *, id: str, text: str, label: str, sample: int) -> DataFrame:
    """(text, y) of the distinct texts of at most ``sample`` labelled ids that are not held
    out, as a table."""
    marked = (labels.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{label}`").cast("int").alias("y")).where("_id is not null and y is not null")
              .where(~held_out(F.col("_id"))).groupBy("_id").agg(F.max("y").alias("y")))
    chosen = marked.orderBy(F.xxhash64("_id"), "_id").limit(sample)  # two numbers a row, ``sample`` rows: safe to broadcast
    rows = docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("text")).join(F.broadcast(chosen), "_id")
    return written(rows.groupBy(F.xxhash64("text"), "text").agg(F.max("y").alias("y")).select("text", "y"), "labelled")


def _stems(text: str | None) -> Counter:
    """Occurrences of a text's words and word beginnings, as (kind, stem)."""
    out: Counter = Counter()
    for w, n in Counter(_words(text)).items():
        if len(w) > 2:
            out["word", w] += n
        for size in PREFIXES:
            if len(w) >= size:
                out["prefix", w[:size]] += n
    return out


def _stem_counts(rows: DataFrame) -> DataFrame:
    """(kind, stem, least, other, toxic): in how many texts of either label a stem occurs
    ``least`` times or more."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, Counter] = {0: Counter(), 1: Counter()}
            for text, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[int(y > 0)].update([(*k, t) for k, n in _stems(text).items() for t in TIMES if n >= t])
            keys = list(found[0].keys() | found[1].keys())
            yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
                                              pa.array([k[2] for k in keys], pa.int32()), pa.array([found[0][k] for k in keys], pa.int64()),
                                              pa.array([found[1][k] for k in keys], pa.int64())], ["kind", "stem", "least", "other", "toxic"])

    parts = map_arrow(rows.select("text", "y"), work, "kind string, stem string, least int, other long, toxic long")
    return parts.groupBy("kind", "stem", "least").agg(F.sum("other").alias("other"), F.sum("toxic").alias("toxic"))


@dataclass(frozen=True)
class Voters:
    """(kind, stem, least): a voter votes on texts with ``least`` occurrences of its stem.
    ``doubt``: the share of other texts it votes on in the sample."""

    rules: tuple[tuple[str, str, int], ...]
    doubt: tuple[float, ...]

    def __len__(self) -> int:
        return len(self.rules)

    @property
    def least(self) -> np.ndarray:
        return np.array([r[2] for r in self.rules])

    def counter(self):
        """A function that gives a text's hits as {voter: occurrences of its stem}."""
        by_stem: dict[tuple[str, str], list[int]] = {}
        for i, (kind, stem, _) in enumerate(self.rules):
            by_stem.setdefault((kind, stem), []).append(i)
        sizes = sorted({len(stem) for kind, stem, _ in self.rules if kind == "prefix"})
        known: dict[str, tuple[int, ...]] = {}

        def of(word: str) -> tuple[int, ...]:
            begins = [i for n in sizes if len(word) >= n for i in by_stem.get(("prefix", word[:n]), ())]
            return (*by_stem.get(("word", word), ()), *begins)

        def count(text: str | None) -> dict[int, int]:
            hits: dict[int, int] = {}
            if len(known) > 300_000:
                known.clear()
            for w, times in Counter(_words(text)).items():
                voters = known.get(w)
                if voters is None:
                    voters = known[w] = of(w)
                for i in voters:
                    hits[i] = hits.get(i, 0) + times
            return hits

        return count


#: A text wrongly voted on weighs as much as so many toxic ones in the choice of voters.
PRICE = 4


def pick(found: list[tuple[str, str, int, int, int]], voters: int) -> tuple[tuple[str, str, int, int], ...]:
    """Of (kind, stem, least, toxic, other), the voters (kind, stem, least, other) that vote
    best.  A stem comes once, with the occurrences that serve it best; not if a beginning of it
    is there that needs no more occurrences, or a longer stem that covers most of its texts."""
    chosen: dict[tuple[str, str], tuple[int, int, int]] = {}
    for kind, stem, least, toxic, other in sorted(found, key=lambda f: (PRICE * f[4] - f[3], len(f[1]), f[0], f[1], f[2])):
        shorter = [chosen[k][0] for n in PREFIXES if n < len(stem) and (k := ("prefix", stem[:n])) in chosen]
        longer = any(k[1].startswith(stem) and c[1] >= 0.8 * toxic for k, c in chosen.items())
        if len(chosen) < voters and (kind, stem) not in chosen and least < min(shorter, default=9) and not longer:
            chosen[kind, stem] = least, toxic, other
    return tuple((*k, least, other) for k, (least, _, other) in chosen.items())


def choose_voters(rows: DataFrame, *, voters: int = VOTERS) -> tuple[Voters, float]:
    """The voters and the share of toxic labels."""
    n, toxic = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.col("y").cast("long")), F.lit(0))).first()
    if not n or not toxic:
        return Voters((), ()), 0.0
    good = _stem_counts(rows).where((F.col("toxic") >= max(SUPPORT, SHARE * toxic)) & (F.col("toxic") >= PURITY * (F.col("toxic") + F.col("other") + 1)))
    best = good.orderBy(F.col("other") * PRICE - F.col("toxic"), F.length("stem"), "kind", "stem", "least").limit(64 * voters)
    rules = pick([(r["kind"], r["stem"], r["least"], r["toxic"], r["other"]) for r in best.collect()], voters)
    return Voters(tuple(r[:3] for r in rules), tuple((r[3] + 0.5) / (n - toxic + 1) for r in rules)), toxic / n


def vote_moments(docs: DataFrame, voters: Voters, *, text: str) -> tuple[int, np.ndarray]:
    """Number of documents, and in how many voters i and j vote together, over all documents."""
    k = len(voters)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, least, total, rows = voters.counter(), voters.least, np.zeros((k + 1, k + 1), dtype=np.int64), 0
        for batch in batches:
            for t in batch.column(0).to_pylist():
                rows += 1
                if at := [i for i, times in count(t).items() if times >= least[i]]:
                    total[np.ix_(at, at)] += 1
        total[k, k] = rows
        i, j = np.nonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total[i, j])], ["i", "j", "n"])

    out = np.zeros((k + 1, k + 1))
    for r in map_arrow(docs.select(F.col(f"`{text}`")), work, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n")).collect():
        out[r["i"], r["j"]] = r["n"]
    return int(out[k, k]), out[:k, :k]


@dataclass(frozen=True)
class LabelModel:
    """Rates at which voters vote on toxic (a) and other (b) texts, and the part of its
    evidence that each voter keeps beside the voters correlated with it."""

    prior: float
    a: np.ndarray
    b: np.ndarray
    share: np.ndarray

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        """Of each row of 0/1 votes; a voter that abstains says nothing."""
        logit = np.log(self.prior / (1 - self.prior)) + votes @ (self.share * np.log(self.a / self.b))
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def fit_label_model(n: int, together: np.ndarray, prior: float, doubt: Sequence[float], rounds: int = 50) -> LabelModel:
    """Rates from the pair counts; no b is taken to be below what the sample showed (doubt)."""
    prior = min(max(prior, 1e-3), 0.5)
    rate = np.diag(together) / max(n, 1)
    cov = together / max(n, 1) - np.outer(rate, rate)
    scale = prior * (1 - prior)
    highest = np.minimum(rate / prior, 1.0)  # b_i >= 0 and a_i <= 1
    d = highest.copy()
    off = ~np.eye(len(rate), dtype=bool)
    fits = off & (cov > 0)
    for _ in range(rounds):  # masked rank-one fit, one coordinate step for all
        weight = (fits * d[None, :] ** 2).sum(axis=1)
        new = np.divide((fits * cov / scale * d[None, :]).sum(axis=1), weight, out=d.copy(), where=weight > 0)
        d = np.clip(0.5 * d + 0.5 * new, 0.0, highest)
        fits = off & (cov > 0.1 * scale * np.outer(d, d))
    b = np.clip(np.maximum(rate - prior * d, doubt), _FLOOR, 1 - _FLOOR)
    a = np.clip(rate + (1 - prior) * d, 2 * _FLOOR, 1 - _FLOOR)
    a = np.maximum(a, b)
    # correlation within the toxic class beyond what the class explains
    both = together / max(n, 1) / prior
    excess = both - np.outer(a, a)
    spread = np.sqrt(np.outer(a * (1 - a), a * (1 - a)))
    rho = np.where(off, np.clip(excess / np.maximum(spread, 1e-9), 0.0, 1.0), 0.0)
    rho[rho < 0.5] = 0.0  # what is left after a class of several languages
    return LabelModel(prior, a, b, 1 / (1 + rho.sum(axis=1)))


def _features(hits: dict[int, int], least: np.ndarray) -> np.ndarray:
    """Occurrences by voter in logarithms, the votes together, and the constant."""
    k = len(least)
    x = np.zeros(k + 2)
    for i, times in hits.items():
        x[i] = np.log1p(times)
        x[k] += times >= least[i]
    x[k] = np.log1p(x[k])
    x[k + 1] = 1.0
    return x


def fit_classifier(x: np.ndarray, target: np.ndarray, times: np.ndarray, ridge: float = 0.02, steps: int = 30) -> np.ndarray:
    """Weights of a logistic regression on soft targets, by Newton steps; a row counts ``times``
    often, and the last column of x, the constant, is not shrunk."""
    w = np.zeros(x.shape[1])
    shrink = np.full(x.shape[1], ridge)
    shrink[-1] = 1e-6
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        grad = x.T @ (times * (p - target)) + shrink * w
        step = np.linalg.solve((x * (times * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(shrink), grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass(frozen=True)
class Model:
    voters: Voters
    prior: float
    weights: np.ndarray


def fit(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE,
        voters: int = VOTERS) -> Model:
    """Choose voters, estimate the label model over all ``docs``, train the classifier on the
    posteriors of the sampled texts."""
    rows = learning_rows(docs, labels, id=id, text=text, label=label, sample=sample)
    chosen, prior = choose_voters(rows, voters=voters)
    k = len(chosen)
    if not k:
        return Model(chosen, prior, np.zeros(2))  # no voters: the share of toxic labels
    n, together = vote_moments(docs, chosen, text=text)
    model = fit_label_model(n, together, prior, chosen.doubt)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = chosen.counter()
        for batch in batches:
            hits = [count(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array([list(h) for h in hits], pa.list_(pa.int32())),
                                              pa.array([list(h.values()) for h in hits], pa.list_(pa.int32()))], ["voters", "times"])

    # texts without votes are alike, so they come as one number
    hits = map_arrow(rows.select("text"), work, "voters array<int>, times array<int>")
    seen = [dict(zip(r["voters"], r["times"], strict=True)) for r in hits.where(F.size("voters") > 0).orderBy(F.xxhash64("voters", "times")).collect()]
    silent = hits.where(F.size("voters") == 0).count()
    least = chosen.least
    x = np.array([_features(h, least) for h in seen]).reshape(-1, k + 2)
    votes = x[:, :k] >= np.log1p(least) - 1e-9
    target = np.where(votes.any(axis=1), model.posterior(votes.astype(float)), _FLOOR)
    # what the votes leave of the toxic share is spread over the silent texts
    left = (prior * (len(seen) + silent) - target.sum()) / max(silent, 1)
    # all silent texts are one row that counts as often as there are such texts
    return Model(chosen, prior, fit_classifier(np.vstack([x, _features({}, least)]), np.append(target, min(max(left, _FLOOR), prior)),
                                               np.append(np.ones(len(x)), float(silent))))


def score(docs: DataFrame, model: Model, *, text: str = "text", carry_text: bool = True) -> DataFrame:
    """``docs`` with score, the probability that a text is toxic; a column of that name is
    replaced, ``text`` goes if not ``carry_text``."""
    inner, outer = sealed(docs, ("score",) if carry_text else ("score", text))
    source = docs.select(*inner, F.col(f"`{text}`").alias("_text"))
    n, k, own = len(inner), len(model.voters), source.columns[:len(inner)]
    schema = source.select(*own, F.lit(0.0).alias("score")).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, least = model.voters.counter(), model.voters.least
        silent = 1 / (1 + np.exp(-model.weights[-1])) if k else model.prior
        for batch in batches:
            out = np.full(batch.num_rows, silent)
            if k:
                for i, t in enumerate(batch.column(n).to_pylist()):
                    if hits := count(t):
                        out[i] = 1 / (1 + np.exp(-np.clip(_features(hits, least) @ model.weights, -30, 30)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out)], [*own, "score"])

    return map_arrow(source, work, schema).select(*outer, "score")
