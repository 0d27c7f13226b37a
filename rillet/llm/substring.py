"""Substring dedup by relative Lempel-Ziv parsing.

Every word run of ``window`` words that also starts elsewhere marks its words.  The corpus
is its own reference: each block of the index (a hash range of seeds) names one reference
occurrence for every seed that occurs twice or more.  Seeds are q-grams chosen by content
(the smallest hash of each window), so equal windows choose equal seeds.

A text is parsed greedily into factors: runs of seeds that continue the same copy of the
reference, where the words between two seeds are equal by hash.  A factor of at least
``window`` words is a duplicate span, in the text and in the reference.  At factor
boundaries, and where a text itself holds the reference occurrence, the windows that lie in
no such factor are counted by hash over all texts; both ways lead to the same decision for
equal windows, because a window's seed, and whether its words equal the reference, follow
from its words alone.  Equal texts are parsed once; all their windows occur twice.

Null and empty texts have no words.  Repeated rows count as copies of each other.  Windows
are judged on the input alone.  Word runs are compared by 128-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, sealed, text_id, written
from rillet.llm.textscan import LONGEST, Hasher, Slice, covered, slices

#: Words of a seed.
SEED = 8


def _smallest(values: np.ndarray, size: int) -> np.ndarray:
    """Index of the smallest of values[i:i + size], the leftmost of equals, for every i."""
    index, reach = np.arange(len(values)), 1
    while reach < size and len(index):
        step = min(reach, size - reach)
        left, right = index[:-step], index[step:]
        index = np.where(values[right] < values[left], right, left)
        reach += step
    return index


class _Seeds:
    """Seeds and windows of a slice. window_seed: for each whole window its seed."""

    def __init__(self, part: Slice, window: int) -> None:
        q = min(SEED, window)
        self.hasher = Hasher(part.hashes)
        self.windows = part.whole(window)
        grams = self.hasher.windows(q)
        if len(self.windows):
            chosen = _smallest(grams, window - q + 1)[self.windows]
            self.at, self.window_seed = np.unique(chosen, return_inverse=True)
        else:
            self.at = self.window_seed = np.zeros(0, dtype=np.int64)
        self.hash = grams[self.at]
        self.doc = part.doc[self.at]
        self.pos = self.at - part.bounds[self.doc]
        self.link = np.zeros(len(self.at), dtype=np.uint64)
        self.chain = np.zeros(len(self.at), dtype=bool)  # the next seed is of the same text
        if len(self.at) > 1:
            self.chain[:-1] = self.doc[1:] == self.doc[:-1]
            i = np.flatnonzero(self.chain)
            self.link[i] = self.hasher.spans(self.at[i], self.at[i + 1] + q)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64), pa.int64())


def _seeds(texts: DataFrame, window: int) -> DataFrame:
    """Per text and seed its first place, the link from there, and how often the text has it: a
    text that repeats one word has a single row for it."""
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                s = _Seeds(part, window)
                order = np.lexsort((s.pos, s.hash, s.doc))
                doc, hash_ = s.doc[order], s.hash[order]
                first = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (hash_[1:] != hash_[:-1]))[:len(order)]))
                at = order[first]
                row = s.doc[at] + part.first
                yield pa.RecordBatch.from_arrays([_long(s.hash[at]), pa.array(a[row]), pa.array(b[row]), pa.array(s.pos[at], pa.int32()), _long(s.link[at]),
                                                  pa.array(np.diff(np.append(first, len(order))), pa.int32())], ["seed", "a", "b", "pos", "link", "n"])

    return map_arrow(texts.select("a", "b", "text"), work, "seed long, a long, b long, pos int, link long, n int")


class _Pointers:
    """References of the seeds of a batch, by text and seed."""

    def __init__(self, column: pa.Array) -> None:
        bounds = np.asarray(column.offsets) - column.offsets[0].as_py()
        flat = column.flatten()
        seed, self.at, self.link = (np.asarray(flat.field(c)) for c in ("seed", "at", "link"))
        self.a, self.b = (np.asarray(flat.field(c)) for c in ("ra", "rb"))
        row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
        self.seeds, code = np.unique(seed, return_inverse=True)
        key = (row << 32) | code
        self.order = np.argsort(key, kind="stable")
        self.key = key[self.order]

    def of(self, row: np.ndarray, seed: np.ndarray) -> np.ndarray:
        """Index of the reference of each seed, -1 if it occurs once."""
        if len(self.key) == 0:
            return np.full(len(row), -1)
        seed = seed.view(np.int64)
        code = np.minimum(np.searchsorted(self.seeds, seed), len(self.seeds) - 1)
        key = (row.astype(np.int64) << 32) | code
        i = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.seeds[code] == seed) & (self.key[i] == key), self.order[i], -1)


def _parse(texts: DataFrame, window: int) -> DataFrame:
    """Factors of at least ``window`` words, as spans of the text and of the reference (size
    > 0), and the windows to count (size 0 or below, with their two hashes)."""
    q = min(SEED, window)
    names = ["a", "b", "pos", "size", "h1", "h2"]

    def rows(a, b, pos, size, h1=None, h2=None) -> pa.RecordBatch:
        none = np.zeros(len(pos), dtype=np.uint64)
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(pos, pa.int32()), pa.array(size, pa.int32()),
                                           _long(none if h1 is None else h1), _long(none if h2 is None else h2)], names)

    def loose(a, b, part: Slice, s: _Seeds, start: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Windows to count.  Those that repeat within the slice are spans at once, and one of
        each stands for them in the count, with the size -1 for "twice or more"."""
        second = Hasher(part.hashes, second=True)
        h1, h2 = s.hasher.spans(start, start + window), second.spans(start, start + window)
        order = np.lexsort((start, h2, h1))
        same = (h1[order[1:]] == h1[order[:-1]]) & (h2[order[1:]] == h2[order[:-1]])
        first = np.ones(len(start), dtype=bool)
        first[order[1:]] = ~same
        twice = np.zeros(len(start), dtype=bool)
        twice[order[1:][same]] = twice[order[:-1][same]] = True
        doc = part.doc[start]
        yield rows(a[doc[first] + part.first], b[doc[first] + part.first], (start - part.bounds[doc])[first],
                   np.where(twice, -1, 0)[first].astype(np.int32), h1[first], h2[first])
        at = start[twice]
        if len(at):
            joint = (np.diff(at) == 1) & (part.doc[at[1:]] == part.doc[at[:-1]])
            begin = at[np.concatenate(([True], ~joint))]
            size = at[np.concatenate((~joint, [True]))] - begin + window
            doc = part.doc[begin]
            yield rows(a[doc + part.first], b[doc + part.first], begin - part.bounds[doc], size)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows == 0:
                continue
            a, b = (np.asarray(batch.column(c)) for c in ("a", "b"))
            pointers = _Pointers(batch.column(batch.schema.get_field_index("refs")))
            for part in slices(batch.column(batch.schema.get_field_index("text"))):
                s = _Seeds(part, window)
                if len(s.at) == 0:
                    continue
                row = s.doc + part.first
                ref = pointers.of(row, s.hash)
                known = ref >= 0
                ra, rb, rpos = pointers.a[ref], pointers.b[ref], pointers.at[ref]
                away = known & ~((ra == a[row]) & (rb == b[row]) & (rpos == s.pos))
                # a factor goes on to the next seed if that continues the same copy over equal words
                on = s.chain & away
                on[:-1] &= away[1:] & (ra[1:] == ra[:-1]) & (rb[1:] == rb[:-1]) & (rpos[1:] - rpos[:-1] == s.pos[1:] - s.pos[:-1])
                on &= pointers.link[ref] == s.link.view(np.int64)
                begin = np.flatnonzero(on & ~np.concatenate(([False], on[:-1])))
                end = np.flatnonzero(on & ~np.concatenate((on[1:], [False]))) + 1
                size = s.at[end] + q - s.at[begin]
                begin, size = begin[size >= window], size[size >= window]
                yield rows(a[row[begin]], b[row[begin]], s.pos[begin], size)
                yield rows(ra[begin], rb[begin], rpos[begin], size)
                # whole windows in a factor: those that start from its begin to its end - window
                inside = covered(s.at[begin], size - window + 1, len(part.doc))
                open_ = ~inside[s.windows] & known[s.window_seed]
                yield from loose(a, b, part, s, s.windows[open_])

    return map_arrow(texts.select("a", "b", "text", "refs"), work, "a long, b long, pos int, size int, h1 long, h2 long")


def duplicate_spans(texts: DataFrame, window: int) -> DataFrame:
    """(a, b, pos, size): spans of whole duplicate windows of the distinct texts (a, b, text)."""
    seeds = _seeds(texts, window)
    repeated = written(seeds.join(seeds.groupBy("seed").agg(F.sum("n").alias("all")).where("all > 1").select("seed"), "seed"), "seeds")
    reference = (repeated.groupBy("seed").agg(F.min(F.struct("a", "b", "pos", "link")).alias("r"))
                 .select("seed", F.col("r.a").alias("ra"), F.col("r.b").alias("rb"), F.col("r.pos").alias("at"), F.col("r.link").alias("rlink")))
    refs = (repeated.join(reference, "seed").groupBy("a", "b")
            .agg(F.collect_list(F.struct("seed", "ra", "rb", "at", F.col("rlink").alias("link"))).alias("refs")))
    parsed = written(_parse(texts.join(refs, ["a", "b"]), window), "factors")
    loose = parsed.where("size <= 0")
    twice = loose.groupBy("h1", "h2").agg(F.sum(1 - F.col("size")).alias("n")).where("n > 1").select("h1", "h2")
    return (parsed.where("size > 0").select("a", "b", "pos", "size").distinct()
            .unionByName(loose.join(twice, ["h1", "h2"]).select("a", "b", "pos", F.lit(window).cast("int").alias("size"))))


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """Per distinct text: n_words, n_removed, the kept words and their digest."""
    schema = "a long, b long, n_words long, n_removed long, kept string, kept_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            copies = batch.column(batch.schema.get_field_index("copies")).to_pylist()
            spans = batch.column(batch.schema.get_field_index("spans"))
            column = batch.column(batch.schema.get_field_index("text"))
            total, gone, kept, digest = [], [], [], []
            for i, text in enumerate(column.to_pylist()):
                raw = (text or "").encode().split()
                n = len(raw)
                if copies[i] > 1 and n >= window:
                    left = []
                elif (own := spans[i]).is_valid:
                    flat = own.values
                    out = covered(np.asarray(flat.field("pos")).astype(np.int64), np.asarray(flat.field("size")).astype(np.int64), n)
                    left = [w for w, o in zip(raw, out.tolist(), strict=True) if not o]
                else:
                    left = raw
                line = b" ".join(left)
                total.append(n)
                gone.append(n - len(left))
                kept.append(line.decode())
                digest.append(hashlib.sha256(line).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(total, pa.int64()), pa.array(gone, pa.int64()),
                                              pa.array(kept, pa.string()), pa.array(digest, pa.string())],
                                             ["a", "b", "n_words", "n_removed", "kept", "kept_sha256"])

    return map_arrow(texts.select("a", "b", "text", "copies", "spans"), work, schema)


def dedup_substrings(docs: DataFrame, *, text: str = "text", window: int = 35) -> DataFrame:
    """``docs`` with n_words, n_removed, kept (the kept words joined by one space) and
    kept_sha256; columns of these names are replaced.  A word goes if a window of ``window``
    words that covers it also starts anywhere else, the same document included."""
    if not 0 < window <= LONGEST - SEED:
        raise ValueError(f"windows of 1 to {LONGEST - SEED} words can be compared by hash")
    inner, outer = sealed(docs, ("n_words", "n_removed", "kept", "kept_sha256"))
    t = text_id(F.col(f"`{text}`"))
    rows = docs.select(*inner, t["a"].alias("a"), t["b"].alias("b"))
    texts = (docs.select(t["a"].alias("a"), t["b"].alias("b"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
             .groupBy("a", "b").agg(F.first("text").alias("text"), F.count(F.lit(1)).alias("copies")))
    spans = duplicate_spans(texts, window).groupBy("a", "b").agg(F.collect_list(F.struct("pos", "size")).alias("spans"))
    cut = _cut(texts.join(spans, ["a", "b"], "left"), window)
    return rows.join(cut, ["a", "b"]).select(*outer, "n_words", "n_removed", "kept", "kept_sha256")
