"""Byte-level BPE by replaying merges over a stretch of the corpus.

The distinct matches ("words") of a bounded stretch of texts are laid out as one linked list
of symbols.  An inverted index leads from the rank of a pair to all its positions; ranks are
taken in order from a heap, every merge of a rank is applied wherever it stands, and only
the pairs with the merged neighbours are looked up anew.  A merge that makes a pair of a
lower rank lets that one go first, as encoding each word by itself would.

Words seen in earlier stretches are kept in a dictionary of bounded size, so a stretch pays
for new words alone.  Null and empty texts have no tokens.  Rank files are data: their path
is a parameter, the driver reads the file (some 0.8 MB) and broadcasts it.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.llm.shared import map_arrow, sealed

#: Characters of texts encoded together, and words kept between stretches.
STRETCH = 1 << 21
KEPT = 1 << 18


class Vocabulary:
    """Ranks of a file of lines ``base64(token) rank``."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        pairs = (line.split() for line in ranks.splitlines() if line.strip())
        self.ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.decimal = {rank: str(rank) for rank in self.tokens}
        self.find = regex.compile(pattern).findall
        self.of_byte = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        #: Rank of the pair (a, b), by a << 20 | b.
        self.merged: dict[int, int] = {}
        for token, rank in self.ranks.items():
            for cut in range(1, len(token)):
                a, b = self.ranks.get(token[:cut]), self.ranks.get(token[cut:])
                if a is not None and b is not None:
                    self.merged[a << 20 | b] = rank
        #: Rank of each pair of bytes, -1 for none.
        self.of_bytes = np.full((256, 256), -1, dtype=np.int64)
        for token, rank in self.ranks.items():
            if len(token) == 2:
                self.of_bytes[token[0], token[1]] = rank

    def replay(self, words: list[bytes]) -> list[list[int]]:
        """Token ids of each word."""
        ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)))
        flat = np.frombuffer(b"".join(words), dtype=np.uint8)
        if len(flat) == 0:
            return [[] for _ in words]
        size = len(flat)
        after = np.arange(1, size + 1)
        after[ends[ends > 0] - 1] = size      # position ``size`` stands for no neighbour
        before = np.arange(-1, size - 1)
        begins = np.concatenate(([0], ends[:-1]))
        before[begins[begins < size]] = size
        pair = np.full(size + 1, -1, dtype=np.int64)  # rank of the pair that begins here
        pair[:size - 1] = self.of_bytes[flat[:-1], flat[1:]]
        pair[:size][after == size] = -1
        at = np.flatnonzero(pair >= 0)
        at = at[np.argsort(pair[at], kind="stable")]
        ranks, cuts = np.unique(pair[at], return_index=True)
        index = {r: where.tolist() for r, where in zip(ranks.tolist(), np.split(at, cuts[1:]), strict=False)} if len(at) else {}
        symbols, pair, after, before = [*self.of_byte[flat].tolist(), -1], pair.tolist(), [*after.tolist(), size], [*before.tolist(), size]
        heap = list(index)
        heapq.heapify(heap)
        rank_of = self.merged.get
        while heap:
            rank = heapq.heappop(heap)
            where = sorted(index.pop(rank))
            for k, p in enumerate(where):
                if pair[p] != rank:  # merged meanwhile
                    continue
                gone = after[p]
                follow, lead = after[gone], before[p]
                symbols[p], symbols[gone], pair[gone], after[p] = rank, -1, -1, follow
                first = second = -1
                if follow != size:
                    before[follow] = p
                    first = rank_of(rank << 20 | symbols[follow], -1)
                    if first >= 0:
                        if first in index:
                            index[first].append(p)
                        else:
                            index[first] = [p]
                            heapq.heappush(heap, first)
                pair[p] = first
                if lead != size:
                    second = pair[lead] = rank_of(symbols[lead] << 20 | rank, -1)
                    if second >= 0:
                        if second in index:
                            index[second].append(lead)
                        else:
                            index[second] = [lead]
                            heapq.heappush(heap, second)
                if (0 <= first < rank or 0 <= second < rank) and k + 1 < len(where):
                    if rank in index:
                        index[rank].extend(where[k + 1:])
                    else:
                        index[rank] = where[k + 1:]
                        heapq.heappush(heap, rank)
                    break
        out, low = [], 0
        for high in ends.tolist():
            out.append([s for s in symbols[low:high] if s >= 0])
            low = high
        return out


@lru_cache(maxsize=4)
def _vocabulary(ranks: bytes, pattern: str) -> Vocabulary:
    return Vocabulary(ranks, pattern)


class Coder:
    """Encodes texts, keeping up to about KEPT words with their ids and decoded bytes."""

    def __init__(self, ranks: bytes, pattern: str) -> None:
        self.vocabulary = _vocabulary(ranks, pattern)
        self.ids: dict[str, str] = {}         # by word: its ids in decimal
        self.decoded: dict[str, bytes] = {}   # by word: the bytes of its ids
        self.again: set[str] = set()          # words that were met again

    def encode(self, texts: list[str]) -> Iterator[tuple[str, bytes]]:
        """For each text its ids in decimal, joined by one space, and the bytes decoded from them."""
        split = [self.vocabulary.find(t) for t in texts]
        here = set().union(*split)
        new = list(here.difference(self.ids))
        self.again.update(here.intersection(self.ids))
        if len(self.ids) + len(new) > KEPT:
            stay = self.again if len(self.again) <= KEPT // 2 else here.intersection(self.ids)
            self.ids = {w: self.ids[w] for w in stay}
            self.decoded = {w: self.decoded[w] for w in stay}
            self.again = set()
        decimal, tokens = self.vocabulary.decimal, self.vocabulary.tokens
        for w, ids in zip(new, self.vocabulary.replay([w.encode() for w in new]), strict=True):
            self.ids[w] = " ".join([decimal[i] for i in ids])
            self.decoded[w] = b"".join([tokens[i] for i in ids])
        of_ids, of_bytes = self.ids.__getitem__, self.decoded.__getitem__
        return ((" ".join(map(of_ids, words)), b"".join(map(of_bytes, words))) for words in split)


def _stretches(texts: list[str]) -> Iterator[list[str]]:
    held, size = [], 0
    for t in texts:
        if held and size + len(t) > STRETCH:
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t)
    if held:
        yield held


def read_ranks(path: str) -> bytes:
    with open(path, "rb") as f:
        return f.read()


def encode(docs: DataFrame, *, ranks: str, pattern: str, text: str = "text", carry_text: bool = True, ids: bool = True) -> DataFrame:
    """``docs`` with n_tokens, ids (array<int>, if ``ids``), ids_sha256 (of the decimal ids
    joined by one space) and decoded_sha256 (of the bytes decoded from the ids); columns of
    these names are replaced, ``text`` goes if not ``carry_text``.

    ``ranks``: path of the rank file; each match of ``pattern`` is encoded by itself.
    """
    names = ["n_tokens", *["ids"] * ids, "ids_sha256", "decoded_sha256"]
    inner, outer = sealed(docs, names if carry_text else (*names, text))
    source = docs.select(*inner, F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("_text"))
    n, own = len(inner), source.columns[:len(inner)]
    kinds = {"n_tokens": "long", "ids": "array<int>", "ids_sha256": "string", "decoded_sha256": "string"}
    schema = source.select(*own, *[F.lit(None).cast(kinds[x]).alias(x) for x in names]).schema
    data = docs.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = Coder(data.value, pattern)
        for batch in batches:
            first = 0
            for stretch in _stretches(batch.column(n).to_pylist()):
                count, flat, coded, decoded = [], [np.zeros(0, dtype=np.int32)], [], []
                for line, raw in coder.encode(stretch):
                    count.append(line.count(" ") + 1 if line else 0)
                    coded.append(hashlib.sha256(line.encode()).hexdigest())
                    decoded.append(hashlib.sha256(raw).hexdigest())
                    if ids:
                        flat.append(np.array(line.split(), dtype=np.int32))
                out = [pa.array(count, pa.int64()), pa.array(coded), pa.array(decoded)]
                if ids:
                    out.insert(1, pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(count))), pa.int32()), pa.array(np.concatenate(flat))))
                yield pa.RecordBatch.from_arrays([*[c.slice(first, len(stretch)) for c in batch.columns[:n]], *out], [*own, *names])
                first += len(stretch)

    return map_arrow(source, work, schema).select(*outer, *names)


def decode(coded: DataFrame, *, ranks: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``coded`` with ``name``, the bytes of ``ids``; null ids give null."""
    inner, outer = sealed(coded, (name,))
    source = coded.select(*inner, F.col(f"`{ids}`").alias("_ids"))
    n, own = len(inner), source.columns[:len(inner)]
    schema = source.select(*own, F.lit(None).cast("binary").alias(name)).schema
    data = coded.sparkSession.sparkContext.broadcast(read_ranks(ranks))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = _vocabulary(data.value, "").tokens
        for batch in batches:
            out = [None if v is None else b"".join([tokens[i] for i in v]) for v in batch.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], pa.array(out, pa.binary())], [*own, name])

    return map_arrow(source, work, schema).select(*outer, name)
