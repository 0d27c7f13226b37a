"""Best-fit packing with certified bin counts.

``token_pieces`` encodes documents and cuts those longer than the capacity.  ``pack`` deals the
pieces, as (place, size) alone, to partitions of some ten thousands; each is packed by best-fit
decreasing.  Dual feasible functions map sizes so that no bin can hold more than one; the
largest sum over several families of them bounds the number of bins from below.  Where a
partition has as many bins as its sums demand, its packing is final, and so is every full
bin.  The documents of all other bins are exchanged between partitions and packed again, and
the new packing replaces theirs if it needs fewer bins, until the bound of all that is open is
met or a number of rounds is over.  Only sizes move in the rounds; a piece's other columns wait in a table.

Null and empty texts have the closing token alone.  Repeated rows are pieces of their own.  A row
without a size, or with one below 1 or above the capacity, gets no sequence (null).  Empty
tables give no rows.  The ids of a text are those of the ``tokenizers`` library.
"""

from __future__ import annotations

import json
import math
import unicodedata
from bisect import bisect_left, insort
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, sealed, written

#: Pieces of a partition, rounds at most, and rounds in a row that may save nothing.
PART, ROUNDS, IDLE = 32_768, 12, 3

#: Fixed value: how the tokenizer file's pre-tokenizer splits a text.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Ids:
    """Token ids as the ``tokenizers`` library gives them, without added special tokens.

    For a plain byte-level BPE file, texts go through the quicker ``tiktoken`` with the same
    merges.  The libraries may differ in code points that were assigned or changed class since
    Unicode 3.2, and treat the strings of added tokens differently: such texts, and files of
    another kind, go through ``tokenizers``.
    """

    def __init__(self, file: str) -> None:
        from tokenizers import Tokenizer

        self.exact = Tokenizer.from_str(file)
        self.quick = self._quick(json.loads(file))

    def _quick(self, file: dict):
        import tiktoken

        model, split = file["model"], file["pre_tokenizer"] or {}
        plain = (file["normalizer"] is None and model["type"] == "BPE" and split.get("type") == "ByteLevel" and split.get("use_regex")
                 and not split.get("add_prefix_space") and not any(model.get(x) for x in (
                     "dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")))
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model.get("merges", [])] if plain else []
        made = [model["vocab"].get(a + b, -1) for a, b in pairs]
        if not plain or any(a >= b for a, b in zip(made, made[1:], strict=False)):  # ids must rise with the merges' ranks
            return None
        added = [t["content"] for t in file.get("added_tokens", [])]
        # printable bytes stand for themselves, the others for U+0100 and on
        shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
        byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
        ranks = {bytes(byte_of[c] for c in token): i for token, i in model["vocab"].items() if token not in added}
        then, now = unicodedata.ucd_3_2_0.category, unicodedata.category
        self.steady = np.array([then(chr(c)) == now(chr(c)) != "Cn" for c in range(1 << 16)] + [False])
        self.added = added
        return tiktoken.Encoding("file", pat_str=BYTE_LEVEL, mergeable_ranks=ranks, special_tokens={}).encode_to_numpy

    def plain(self, text: str) -> bool:
        """Whether both libraries must split ``text`` alike."""
        if any(t in text for t in self.added):
            return False
        return text.isascii() or bool(self.steady[np.minimum(np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32), 1 << 16)].all())

    def of(self, text: str) -> np.ndarray:
        if self.quick is not None and self.plain(text):
            return self.quick(text, disallowed_special=())
        return np.array(self.exact.encode(text, add_special_tokens=False).ids, dtype=np.uint32)


@lru_cache(maxsize=2)
def _ids(file: str) -> Ids:
    return Ids(file)


def token_pieces(docs: DataFrame, *, tokenizer: str, capacity: int, end: int, text: str = "text") -> DataFrame:
    """For each piece of each document: the columns of ``docs`` besides ``text``, piece (from 0), start (ids before it),
    length and ids (binary, little-endian unsigned 32-bit).

    A document's ids are those of the file ``tokenizer``, then ``end``.  More than ``capacity`` are cut so that
    only the first piece is shorter.  Columns of these names are replaced.
    """
    names = ["piece", "start", "length", "ids"]
    inner, outer = sealed(docs, (*names, text))
    source = docs.select(*inner, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    n, own = len(inner), source.columns[:len(inner)]
    kinds = {"piece": "int", "start": "long", "length": "long", "ids": "binary"}
    schema = source.select(*own, *[F.lit(None).cast(k).alias(x) for x, k in kinds.items()]).schema
    with open(tokenizer, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())

    def cut(batch: pa.RecordBatch, rows: list[int], made: list[np.ndarray]) -> pa.RecordBatch:
        sizes = np.array([len(m) for m in made])
        pieces = -(-sizes // capacity)
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        short = np.repeat(sizes - (pieces - 1) * capacity, pieces)   # ids of the first piece
        start = np.where(piece == 0, 0, short + (piece - 1) * capacity)
        length = np.where(piece == 0, short, capacity)
        flat = np.concatenate(made).astype("<u4").tobytes()
        ids = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(length), [None, pa.py_buffer(4 * np.concatenate(([0], np.cumsum(length)))), pa.py_buffer(flat)])
        of = pa.array(np.repeat(rows, pieces))
        return pa.RecordBatch.from_arrays([*[batch.column(i).take(of) for i in range(n)], pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                                           pa.array(length, pa.int64()), ids.cast(pa.binary())], [*own, *names])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _ids(file.value)
        closing = np.array([end], dtype=np.uint32)
        for batch in batches:
            rows, made, size = [], [], 0
            for i in range(len(batch)):
                ids = np.concatenate((coder.of(batch.column(n)[i].as_py()), closing))
                rows.append(i)
                made.append(ids)
                size += len(ids)
                if size > 1 << 22:
                    yield cut(batch, rows, made)
                    rows, made, size = [], [], 0
            if rows:
                yield cut(batch, rows, made)

    return map_arrow(source, work, schema).select(*outer, *names)


def best_fit(sizes: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Best-fit decreasing: bin and offset of each size in 1..capacity."""
    order = np.argsort(-sizes, kind="stable")
    bins, offsets = np.empty(len(sizes), dtype=np.int64), np.empty(len(sizes), dtype=np.int64)
    room: dict[int, list[int]] = {}   # bins by the space they have left
    spaces: list[int] = []            # those spaces, ascending
    made = 0
    falling = sizes[order]
    cuts = np.flatnonzero(np.diff(falling, prepend=-1, append=-1)).tolist()
    for low, high in zip(cuts, cuts[1:], strict=False):
        size, at = int(falling[low]), low
        while at < high:
            i = bisect_left(spaces, size)
            if i < len(spaces):
                space = spaces[i]
                bin_ = room[space].pop()
                if not room[space]:
                    del room[space], spaces[i]
            else:
                space, bin_, made = capacity, made, made + 1
            # after one of its size the bin fits best again, as long as it has space
            n = min(space // size, high - at)
            items = order[at:at + n]
            bins[items] = bin_
            offsets[items] = capacity - space + size * np.arange(n)
            at += n
            space -= n * size
            if space:
                if space not in room:
                    room[space] = []
                    insort(spaces, space)
                room[space].append(bin_)
    return bins, offsets


def needed(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> tuple[int, int]:
    """The largest sum that a dual feasible function gives ``counts`` of ``sizes``, as a fraction (above, below)."""
    best = (int((sizes * counts).sum()), capacity)

    def offer(above: int, below: int) -> None:
        nonlocal best
        if above * best[1] > best[0] * below:
            best = (above, below)

    for k in range(1, 33):   # multiples of 1/k, sizes that are multiples of 1/(k+1) by themselves
        whole = (k + 1) * sizes % capacity == 0
        offer(int((sizes * counts)[whole].sum()) * k + int(((k + 1) * sizes // capacity * counts)[~whole].sum()) * capacity, capacity * k)
    for e in np.unique(sizes[2 * sizes <= capacity]).tolist():
        # what leaves less than e beside it takes a bin, less than e takes nothing
        large, small = sizes > capacity - e, sizes < e
        offer(int(counts[large].sum()) * capacity + int((sizes * counts)[~large & ~small].sum()), capacity)
        # at most capacity // e of e or more share a bin; above the half, what they can't use
        most = capacity // e
        over = 2 * sizes > capacity
        offer(int(((most - (capacity - sizes) // e) * counts)[over].sum()) + int(counts[~over & ~small].sum()), most)
    return best


def _bound(sizes: np.ndarray, counts: np.ndarray, capacity: int) -> int:
    above, below = needed(sizes, counts, capacity)
    return -(-above // below)


def _packed(table: pa.Table, capacity: int) -> pa.Table:
    """One partition: its bins, and whether each is final."""
    at, sizes = (table[c].to_numpy() for c in ("at", "n"))
    order = np.argsort(at)   # whatever order the rows arrive in
    at, sizes = at[order], sizes[order]
    bins, offsets = best_fit(sizes, capacity)
    fill = np.bincount(bins, weights=sizes).astype(np.int64)
    first = np.full(len(fill), np.iinfo(np.int64).max)
    np.minimum.at(first, bins, at)
    above, below = needed(*np.unique(sizes, return_counts=True), capacity)
    final = (fill == capacity) | (len(fill) * below <= above)
    return pa.table({"at": at, "n": sizes, "sequence": first[bins], "offset": offsets, "final": final[bins]})


def pack(pieces: DataFrame, *, capacity: int, size: str = "length", part: int = PART, rounds: int = ROUNDS) -> DataFrame:
    """``pieces`` with sequence_id (long) and offset (long): no sequence holds more than ``capacity``,
    its pieces stand one after another from 0.  Columns of these names are replaced.

    ``part``: pieces of a partition; ``rounds``: how often those of open bins are exchanged at most.
    """
    names = ("sequence_id", "offset")
    inner, outer = sealed(pieces, names)
    rows = written(pieces.select(*inner, F.col(f"`{size}`").cast("long").alias("n")).withColumn("at", F.monotonically_increasing_id()), "pieces")
    place = "at long, n long, sequence long, offset long, final boolean"
    fits = rows.where(F.col("n").between(1, capacity)).select("at", "n")
    done = [fits.where(F.col("n") == capacity).select("at", F.col("at").alias("sequence"), F.lit(0).cast("long").alias("offset"))]
    open_, bins, best, idle = fits.where(F.col("n") < capacity), None, 0, 0   # open_ has a place once bins is known
    for round_ in range(max(rounds, 1)):
        parts = max(1, math.ceil(open_.count() / part))
        dealt = open_.select("at", "n", F.pmod(F.xxhash64("at", F.lit(round_)), F.lit(parts)).alias("part"))
        made = written(dealt.groupBy("part").applyInArrow(lambda t: _packed(t, capacity), place), "packed")
        count = made.where("offset = 0").agg(F.count("*"), F.coalesce(F.sum(F.col("final").cast("long")), F.lit(0))).first()
        idle += 1
        if bins is None or count[0] < bins:
            idle = 0
            done.append(made.where("final").select("at", "sequence", "offset"))
            open_, bins = made.where("NOT final"), count[0] - count[1]
            sizes = open_.groupBy("n").count().collect()   # at most one row for each size below the capacity
            best = _bound(np.array([r[0] for r in sizes], dtype=np.int64), np.array([r[1] for r in sizes], dtype=np.int64), capacity) if sizes else 0
        if bins <= best or parts == 1 or idle == IDLE:
            break
    done.append(open_.select("at", "sequence", "offset"))
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    return rows.join(placed, "at", "left").select(*outer, F.col("sequence").alias("sequence_id"), F.col("offset"))


def certificate(packed: DataFrame, *, capacity: int, size: str = "length") -> tuple[int, int]:
    """Sequences of a packing, and the least number that any packing of its sizes can have by the bound."""
    placed = packed.where("sequence_id IS NOT NULL")
    sizes = placed.groupBy(F.col(f"`{size}`").cast("long").alias("n")).count().collect()
    sequences = placed.where("offset = 0").count()
    return sequences, _bound(np.array([r[0] for r in sizes], dtype=np.int64), np.array([r[1] for r in sizes], dtype=np.int64), capacity) if sizes else 0


def sequences(packed: DataFrame, *, ids: str = "ids") -> DataFrame:
    """One row per sequence: sequence_id, length (ids) and ids, its pieces' ids in place."""
    piece = F.struct(F.col("offset").alias("o"), F.col(f"`{ids}`").alias("ids"))
    held = packed.where("sequence_id IS NOT NULL").groupBy("sequence_id").agg(F.sort_array(F.collect_list(piece)).alias("p"))
    joined = held.select("sequence_id", F.aggregate("p", F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
    return joined.select("sequence_id", (F.octet_length("ids") / 4).cast("long").alias("length"), "ids")
