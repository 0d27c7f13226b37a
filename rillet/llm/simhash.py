"""SimHash near-duplicates, linked through pigeonring filtering.

A fingerprint is cut into segments that form a ring.  When two fingerprints differ in at
most ``max_bits`` bits, some segment starts a chain of which every prefix of l segments
differs in at most ``l * max_bits / segments`` bits.  The first budget is below one, so the
chain's first segment is an exact join key; the longer prefixes prune before the full check.

Nulls and empty texts have no words and the fingerprint zero, which links like any other.
Repeated rows and equal texts share a fingerprint and thus a component.  A null id is never
the name of a component that has another id.  Empty input gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, text_id, unused, written

BITS = 64
#: Fingerprints compared at once; a larger bucket is dealt to pairs of its parts.
PART = 4096
_ROWS = 1 << 14


def _fingerprint(text: bytes, shingle: int, seed: int) -> int:
    words = text.lower().split()
    n = len(words) - shingle + 1
    if not words:
        return 0
    line = b" ".join(words)
    if n <= 1:
        hashes = [xxhash.xxh64_intdigest(line, seed)]
        n = 1
    else:
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
        begins = np.concatenate(([0], ends[:n - 1] + 1))
        digest = xxhash.xxh64_intdigest
        hashes = [digest(line[a:b], seed) for a, b in zip(begins.tolist(), ends[shingle - 1:].tolist(), strict=True)]
    ones = np.zeros(BITS, dtype=np.int64)
    for at in range(0, n, _ROWS):
        part = np.array(hashes[at:at + _ROWS], dtype=">u8")
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, *, text: str = "text", shingle: int = 3, seed: int = 42,
                 name: str = "fingerprint") -> DataFrame:
    """``docs`` without ``text`` and with ``name``: the fingerprint as a signed long.

    Shingles are ``shingle`` lower-cased (A-Z) words joined by one space, repeats included;
    a shorter text is one shingle.  A bit is one if set in over half of the XXH64 values.
    An input column called ``name`` is replaced.
    """
    rest = [c for c in docs.columns if c not in (text, name)]
    schema = docs.select(*[F.col(f"`{c}`") for c in rest], F.lit(0).cast("long").alias(name)).schema

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(len(rest))
            values = [_fingerprint((t or "").encode(), shingle, seed) for t in texts.to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(rest)], pa.array(values, pa.int64())], [*rest, name])

    return map_arrow(docs.select(*[F.col(f"`{c}`") for c in rest], F.col(f"`{text}`").alias(unused(docs, "_text")[0])), work, schema)


def _segments(max_bits: int) -> list[tuple[int, int]]:
    """(offset, width) of max_bits + 1 segments: the first chain budget is 0 bits."""
    n = max_bits + 1
    cuts = [BITS * i // n for i in range(n + 1)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _near(x: np.ndarray, y: np.ndarray, ring: np.ndarray, max_bits: int, layout: list[tuple[int, int]]) -> np.ndarray:
    """Indexes of the pairs within max_bits, of pairs that agree in the segment ``ring``
    names: the chain from there is followed and every prefix held to its budget."""
    masks = np.array([((1 << w) - 1) << a for a, w in layout], dtype=np.uint64)
    n = len(layout)
    differ = x ^ y
    alive = np.arange(len(x))
    total = np.zeros(len(x), dtype=np.int64)
    for length in range(2, n + 1):
        segment = (ring[alive] + length - 1) % n
        total = total + np.bitwise_count(differ[alive] & masks[segment])
        fits = total * n <= length * max_bits
        alive, total = alive[fits], total[fits]
    return alive


def _forest(group: np.ndarray, ring: np.ndarray, value: np.ndarray, max_bits: int,
            layout: list[tuple[int, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the near pairs of each group; rows are sorted by group.

    Neighbours at distance 1, 2, ... are compared as whole arrays; a pair whose ends are
    linked already is passed over, so a group of n gives at most n - 1 links.
    """
    parent = np.arange(len(value))
    alive, out = parent[:-1], []
    step = 1

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    while len(alive):
        alive = alive[alive + step < len(value)]
        alive = alive[group[alive] == group[alive + step]]
        pairs = alive[parent[alive] != parent[alive + step]]
        if len(pairs):
            joined = False
            for i in pairs[_near(value[pairs], value[pairs + step], ring[pairs], max_bits, layout)].tolist():
                a, b = find(i), find(i + step)
                if a != b:
                    parent[max(a, b)] = min(a, b)
                    out.append((i, i + step))
                    joined = True
            while joined and (parent[parent] != parent).any():
                parent = parent[parent]
        step += 1
    links = np.array(out, dtype=np.int64).reshape(-1, 2)
    return value[links[:, 0]], value[links[:, 1]]


def near_links(prints: DataFrame, *, max_bits: int = 3, part: int = PART) -> DataFrame:
    """Links (x, y) whose components are those of all pairs within ``max_bits`` bits.

    ``prints``: one distinct long column ``value``.  Every bucket of equal segments is
    compared whole; one of over ``part`` fingerprints is cut into parts and every pair of
    parts is compared in its own task, so that no task holds more than two parts.
    """
    layout = _segments(max_bits)
    keyed = prints.select("value", F.explode(F.array(*[
        F.struct(F.lit(i).alias("ring"), F.shiftrightunsigned(F.col("value"), a).bitwiseAND((1 << w) - 1).alias("bits"))
        for i, (a, w) in enumerate(layout)])).alias("k")).select("value", "k.ring", "k.bits")
    sizes = (keyed.groupBy("ring", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
             .select("ring", "bits", F.ceil(F.col("n") / F.lit(part)).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64(F.lit(1), "value"), F.col("parts")).cast("int")
    dealt = (keyed.join(sizes, ["ring", "bits"]).withColumn("own", own)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
             .select("ring", "value", F.xxhash64("ring", "bits", F.least("own", "other"), F.greatest("own", "other")).alias("block"), "bits"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def links(rows: np.ndarray) -> pa.RecordBatch:
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:, :3] != rows[:-1, :3]).any(axis=1)
            x, y = _forest(np.cumsum(new), rows[:, 1], rows[:, 3].view(np.uint64), max_bits, layout)
            return pa.RecordBatch.from_arrays([pa.array(v.view(np.int64)) for v in (x, y)], ["x", "y"])

        for batch in batches:
            if batch.num_rows == 0:
                continue
            held.append(np.column_stack([np.asarray(batch.column(c).cast(pa.int64())) for c in ("block", "ring", "bits", "value")]))
            rows = np.concatenate(held)
            last = (rows[:, :3] == rows[-1, :3]).all(axis=1)
            cut = int(np.argmax(last))  # the group that may go on in the next batch waits
            if cut:
                yield links(np.ascontiguousarray(rows[:cut]))
            held = [rows[cut:]]
        if held:
            yield links(np.ascontiguousarray(np.concatenate(held)))

    return map_arrow(dealt.repartition("block").sortWithinPartitions("block", "ring", "bits", "value"), work, "x long, y long")


def components(links: DataFrame, *, max_rounds: int = 60) -> DataFrame:
    """(node, root) of every node of the links (x, y): alternating large-star and small-star
    steps until the links no longer change; each round is a table in the shared folder."""
    low, high = F.least("x", "y"), F.greatest("x", "y")
    edges = written(links.where("x <> y").select(high.alias("x"), low.alias("y")).distinct(), "links")
    state = None
    for _ in range(max_rounds):
        both = edges.select("x", "y").union(edges.select(F.col("y").alias("x"), F.col("x").alias("y")))
        root = both.groupBy("x").agg(F.min("y").alias("m")).select("x", F.least("x", "m").alias("m"))
        large = both.where("y > x").join(root, "x").select(F.col("y").alias("x"), F.col("m").alias("y"))
        large = large.where("x <> y").distinct()
        least = large.groupBy("x").agg(F.min("y").alias("m"))
        small = large.join(least, "x").select(F.explode(F.array(
            F.struct(F.col("x"), F.col("m").alias("y")), F.struct(F.col("y").alias("x"), F.col("m").alias("y")))).alias("e"))
        edges = written(small.select("e.x", "e.y").where("x <> y").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("x", "y").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy("x").agg(F.min("y").alias("root")).withColumnRenamed("x", "node")
        state = now
    raise RuntimeError(f"components did not settle in {max_rounds} rounds")


def simhash_components(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3,
                       max_bits: int = 3, seed: int = 42, part: int = PART) -> DataFrame:
    """One row per document: ``id``, ``fingerprint`` (long) and ``component``, the smallest
    id of the documents reachable over links of at most ``max_bits`` differing bits.

    Equal fingerprints are one node, so a group of copies of any size is a single node.
    """
    rows = written(fingerprints(docs.select(F.col(f"`{id}`").alias("_id"), F.col(f"`{text}`").alias("_text")),
                                text="_text", shingle=shingle, seed=seed), "prints")
    nodes = rows.groupBy(F.col("fingerprint").alias("value")).agg(F.min("_id").alias("least"))
    roots = components(near_links(nodes.select("value"), max_bits=max_bits, part=part))
    named = (nodes.join(roots, nodes["value"] == roots["node"], "left")
             .select("value", "least", F.coalesce("root", "value").alias("root")))
    names = named.groupBy("root").agg(F.min("least").alias("component"))
    member = named.join(names, "root").select("value", "component")
    return (rows.join(member, rows["fingerprint"] == member["value"])
            .select(F.col("_id").alias(id), "fingerprint", "component"))


def hex_digits(value: Column) -> Column:
    """16 lowercase hex digits of a long."""
    return F.lower(F.lpad(F.hex(value), 16, "0"))


def near_dedup(docs: DataFrame, *, id: str = "doc_id", text: str = "text", shingle: int = 3, max_bits: int = 3,
               seed: int = 42) -> DataFrame:
    """``docs`` with one document of each component left: the one with the smallest id (null
    last), among rows that repeat that id the one with the smallest text hash, and one of
    rows that repeat both.  Columns and values of the kept rows are unchanged.
    """
    key = ["_id", "_a", "_b"]
    t = text_id(F.col(f"`{text}`"))
    source = docs.select(F.col(f"`{id}`").alias("_id"), t["a"].alias("_a"), t["b"].alias("_b"), F.col(f"`{text}`").alias("_text"))
    rows = written(fingerprints(source, text="_text", shingle=shingle, seed=seed), "prints")
    roots = components(near_links(rows.select(F.col("fingerprint").alias("value")).distinct(), max_bits=max_bits))
    first = F.min(F.struct(F.col("_id").isNull().alias("late"), *key)).alias("first")
    lead = rows.groupBy("fingerprint").agg(first)
    lead = lead.join(roots, lead["fingerprint"] == roots["node"], "left")
    lead = lead.groupBy(F.coalesce("root", "fingerprint").alias("root")).agg(F.min("first").alias("first")).select("first.*")
    same = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    on = lambda x, y: x["_id"].eqNullSafe(y["_id"]) & (x["_a"] == y["_a"]) & (x["_b"] == y["_b"])
    stay = lead.join(same, on(lead, same)).select(*[lead[c] for c in key], "_n")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"), F.col(f"`{id}`").alias("_id"),
                        t["a"].alias("_a"), t["b"].alias("_b"))
    found = keyed.join(stay, on(keyed, stay)).select("_row", *[keyed[c] for c in key], "_n")
    turn = F.row_number().over(Window.partitionBy(*key).orderBy(F.xxhash64("_row")))
    once = found.where("_n = 1").select("_row.*")
    more = found.where("_n > 1").withColumn("_turn", turn).where("_turn = 1").select("_row.*")
    return once.unionByName(more)
