"""Training-order materialisation: fixed-stride shards of token sequences in permuted order.

Texts become token sequences (byte-level ids, cut at ``length`` tokens).  The sequences are
numbered through the scan: a first pass counts them by partition, a second numbers them.  A
keyed Feistel network over the next even number of bits, walked until it falls below the
number of sequences, is a permutation of these numbers and gives every sequence its global
slot.  A shard holds ``per_shard`` consecutive slots, each a record of the same size, so slot
s is record ``s % per_shard`` of shard ``s // per_shard`` and a reader resumes anywhere.

A record is id (int64), sequence (int32), number of tokens (int32), all little-endian, and
``length`` ids of one byte, the rest zero.  Records of a shard are stored in order, in
blocks of ``BLOCK`` records, one row each.

Both passes must see the same partitions in the same order, which a scan of files or tables
gives; a task that meets another number of sequences than was counted fails.  For other
inputs set ``write_first``.  Null and empty texts have no sequence; a null id is stored as
the least int64; repeated rows have sequences of their own; empty input gives no shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, shared_path, written
from rillet.llm.textscan import U, mix, text_buffers

BLOCK = 256
HEAD = np.dtype([("id", "<i8"), ("seq", "<i4"), ("n", "<i4")])
_NO_ID = -(1 << 63)


@dataclass(frozen=True)
class Permutation:
    """A keyed permutation of range(n)."""

    n: int
    key: int
    rounds: int = 6

    @property
    def half(self) -> int:
        return max(1, ((self.n - 1).bit_length() + 1) // 2)

    def _once(self, x: np.ndarray, back: bool = False) -> np.ndarray:
        half, mask = U(self.half), U((1 << self.half) - 1)
        left, right = x >> half, x & mask
        for r in reversed(range(self.rounds)) if back else range(self.rounds):
            key = mix(np.array([self.key * self.rounds + r + 1], dtype=U))[0]
            if back:
                left, right = right ^ (mix(left + key) & mask), left
            else:
                left, right = right, left ^ (mix(right + key) & mask)
        return left << half | right

    def _walk(self, x: np.ndarray, back: bool) -> np.ndarray:
        x = self._once(x.astype(U), back)
        while len(out := np.flatnonzero(x >= U(self.n))):
            x[out] = self._once(x[out], back)
        return x.astype(np.int64)

    def slots(self, numbers: np.ndarray) -> np.ndarray:
        return self._walk(numbers, False)

    def numbers(self, slots: np.ndarray) -> np.ndarray:
        return self._walk(slots, True)


@dataclass(frozen=True)
class Shards:
    """Written shards: the table's path and what is needed to find a slot."""

    path: str
    n: int
    length: int
    per_shard: int

    @property
    def stride(self) -> int:
        return HEAD.itemsize + self.length

    def blocks(self, spark: SparkSession, start: int = 0, end: int | None = None) -> DataFrame:
        """The blocks that hold slots from ``start`` to before ``end``: (shard, slot, records, payload)."""
        rows = spark.read.schema("shard int, slot long, records int, payload binary").parquet(self.path)
        rows = rows.where(F.col("slot") > start - BLOCK)
        return rows if end is None else rows.where(F.col("slot") < end)


def materialise(docs: DataFrame, *, id: str = "doc_id", text: str = "text", length: int = 1024, key: int = 42,
                per_shard: int = 1 << 14, path: str | None = None, write_first: bool = False) -> Shards:
    """Write the shards of ``docs`` to ``path`` (default: a new table in the shared folder)."""
    spark = docs.sparkSession
    rows = docs.select(F.col(f"`{id}`").cast("long").alias("id"), F.col(f"`{text}`").alias("text"))
    if write_first:
        rows = written(rows, "sequences")
    sequences = F.ceil(F.coalesce(F.octet_length("text"), F.lit(0)) / F.lit(length))
    # one row per partition of the scan
    counted = {r["p"]: r["n"] for r in rows.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(sequences).cast("long").alias("n")).collect()}
    starts, n = {}, 0
    for p in sorted(counted):
        starts[p] = n
        n += counted[p]
    order = Permutation(max(n, 1), key)
    shards = Shards(path or shared_path(spark, "shards"), n, length, per_shard)
    stride = shards.stride

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition = TaskContext.get().partitionId()
        start, at = starts.get(partition, 0), 0
        for batch in batches:
            ids = batch.column(0).fill_null(_NO_ID).to_numpy(zero_copy_only=False)
            data, offsets = text_buffers(batch.column(1))
            pieces = -(-np.diff(offsets) // length)
            doc = np.repeat(np.arange(len(pieces)), pieces)
            seq = np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            slot = order.slots(start + at + np.arange(len(doc)))
            at += len(doc)
            low = offsets[doc] + seq * length
            size = np.minimum(offsets[doc + 1] - low, length)
            for a in range(0, len(doc), 4096):
                part = slice(a, a + 4096)
                out = np.zeros((len(slot[part]), stride), dtype=np.uint8)
                head = np.zeros(len(out), dtype=HEAD)
                head["id"], head["seq"], head["n"] = ids[doc[part]], seq[part], size[part]
                out[:, :HEAD.itemsize] = head.view(np.uint8).reshape(len(out), -1)
                for i, (b, s) in enumerate(zip(low[part].tolist(), size[part].tolist(), strict=True)):
                    out[i, HEAD.itemsize:HEAD.itemsize + s] = data[b:b + s]
                cuts = np.arange(len(out) + 1, dtype=np.int32) * stride
                column = pa.BinaryArray.from_buffers(pa.binary(), len(out), [None, pa.py_buffer(cuts), pa.py_buffer(out)])
                yield pa.RecordBatch.from_arrays([pa.array(slot[part] // per_shard, pa.int32()), pa.array(slot[part]), column], ["shard", "slot", "record"])
        if at != counted.get(partition, 0):
            raise RuntimeError(f"partition {partition} held {counted.get(partition, 0)} sequences and now {at}: the input is no stable scan")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[bytes] = []
        first = 0

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([first // per_shard], pa.int32()), pa.array([first], pa.int64()),
                                               pa.array([len(held)], pa.int32()), pa.array([b"".join(held)], pa.binary())],
                                              ["shard", "slot", "records", "payload"])

        for batch in batches:
            for slot, record in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if held and (slot % BLOCK == 0 or slot % per_shard == 0):
                    yield row()
                    held.clear()
                if not held:
                    first = slot
                held.append(record)
        if held:
            yield row()

    dealt = map_arrow(rows, records, "shard int, slot long, record binary").repartitionById(max(1, -(-n // per_shard)), F.col("shard"))
    done = map_arrow(dealt.sortWithinPartitions("slot").select("slot", "record"), blocks, "shard int, slot long, records int, payload binary")
    done.write.parquet(shards.path)
    return shards


def read_back(spark: SparkSession, shards: Shards, start: int = 0, end: int | None = None) -> DataFrame:
    """One row per slot from ``start`` to before ``end``: slot, shard, byte_offset (in its
    shard), id, seq, n_tokens, tokens (binary) and tokens_sha256."""
    stride = shards.stride
    names = ["slot", "shard", "byte_offset", "id", "seq", "n_tokens", "tokens", "tokens_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard, slot, records, payload in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                raw = np.frombuffer(payload, dtype=np.uint8).reshape(records, stride)
                head = np.ascontiguousarray(raw[:, :HEAD.itemsize]).view(HEAD).reshape(-1)
                slots = slot + np.arange(records)
                tokens = [r[HEAD.itemsize:HEAD.itemsize + n].tobytes() for r, n in zip(raw, head["n"].tolist(), strict=True)]
                none = pa.array(head["id"] == _NO_ID)
                ids = pa.array(head["id"].astype(np.int64), mask=np.asarray(none))
                yield pa.RecordBatch.from_arrays([
                    pa.array(slots), pa.array(np.full(records, shard), pa.int32()), pa.array(slots % shards.per_shard * stride), ids,
                    pa.array(head["seq"].astype(np.int32)), pa.array(head["n"].astype(np.int32)), pa.array(tokens, pa.binary()),
                    pa.array([hashlib.sha256(t).hexdigest() for t in tokens])], names)

    out = map_arrow(shards.blocks(spark, start, end), work, "slot long, shard int, byte_offset long, id long, seq int, n_tokens int, "
                                                           "tokens binary, tokens_sha256 string")
    out = out.where(F.col("slot") >= start)
    return out if end is None else out.where(F.col("slot") < end)
