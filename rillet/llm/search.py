"""Ranked lexical search: best-first document intervals bounded by range maxima.

``build_index`` cuts the documents into shards as the scan delivers them (nothing is
shuffled) and writes, for each shard and term, the documents that hold it and how often.  A
search looks up its terms' weights and deals, for every shard and block of queries, the
posting lists of the block's terms to one group.  There each list gets a sparse table of range
maxima of its impacts.  A query starts from the interval of all documents; the bound of an
interval is the sum of its terms' range maxima.  The best intervals are taken first, each is
split at the document of its largest impact, which is scored exactly, and an interval goes when
its bound (on equal scores: its smallest id) can't reach the k best any more.

Two rounds: the first searches about FIRST_SHARDS shards, and the k-th best score found there is
a floor for the others, whose intervals below it are never opened.  Results are exact.

Terms are maximal runs of ``[0-9A-Za-z]`` and characters from U+0080 on, with A-Z lower-cased.
Null and empty texts, and texts without a term, have no terms: they are in no result and
don't count in N.  Equal rows are documents of their own; queries that are equal in id and
text are one query.  Equal scores rank by ascending id (null first).  An empty table on either
side gives no rows.  A task holds one shard's lists of one block's terms; a document of any
length is read in chunks.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from rillet.llm.shared import map_arrow, written
from rillet.llm.textscan import text_buffers

#: A shard ends after so many bytes of text or documents.
SHARD_BYTES, SHARD_DOCS = 1 << 25, 1 << 14
#: Bytes of text that are looked at together.
CHUNK = 1 << 22
#: Query terms up to so many bytes go to the tasks that index; more are joined afterwards.
SENT_BYTES = 1 << 24
#: Bytes of query terms in a block, intervals taken at once, and shards of the first round.
BLOCK_BYTES, WAVE, FIRST_SHARDS = 1 << 22, 64, 8
#: Parts that the groups of queries are copied to, so that no join key holds all shards.
COPIES = 32

_TERM = np.ones(256, dtype=bool)
for _low, _high in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _TERM[_low:_high + 1] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A"):ord("Z") + 1] += 32


def _chunks(data: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about CHUNK bytes that cut no term."""
    low = 0
    while low < len(data):
        high = low + CHUNK
        while high < len(data):
            gap = np.flatnonzero(~_TERM[data[high:high + CHUNK]])
            if len(gap):
                high += int(gap[0])
                break
            high += CHUNK
        high = min(high, len(data))
        yield low, high
        low = high


def _terms(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> tuple[pa.Array, np.ndarray]:
    """The terms in bytes [low, high) and the document of each."""
    part = data[low:high]
    solid = _TERM[part]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    cut = offsets[(offsets > low) & (offsets < high)] - low
    begins[cut] = solid[cut]
    at = np.flatnonzero(begins)
    before = np.zeros(len(part) + 1, dtype=np.int32)
    np.cumsum(solid, out=before[1:])
    flat = _LOWER[part[solid]]
    ends = np.append(before[at], before[-1])
    words = pa.StringArray.from_buffers(len(at), pa.py_buffer(ends), pa.py_buffer(flat))
    return words, np.searchsorted(offsets, at + low, side="right") - 1


def text_terms(text: str | None) -> list[str]:
    """The terms of one text, in order."""
    data, offsets = text_buffers(pa.array([text], pa.string()))
    return [w for low, high in _chunks(data) for w in _terms(data, offsets, low, high)[0].to_pylist()]


def _shard(texts: pa.Array, only: pa.Array | None) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms, where each one's list begins, documents, occurrences; terms of each document."""
    data, offsets = text_buffers(texts)
    sizes = np.zeros(len(texts), dtype=np.int64)
    dictionaries, keys, counts = [], [], []
    for low, high in _chunks(data):
        words, doc = _terms(data, offsets, low, high)
        sizes += np.bincount(doc, minlength=len(texts))
        coded = words.dictionary_encode()
        codes, names = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), coded.dictionary
        if only is not None:
            wanted = pc.is_in(names, only).to_numpy(zero_copy_only=False)
            new = np.cumsum(wanted) - 1
            held = wanted[codes]
            codes, doc, names = new[codes[held]], doc[held], names.filter(pa.array(wanted))
        key, n = np.unique(codes << 32 | doc, return_counts=True)
        dictionaries.append(names)
        keys.append(key)
        counts.append(n)
    if not dictionaries:
        return pa.array([], pa.string()), np.zeros(1, dtype=np.int64), *[np.zeros(0, dtype=np.int64)] * 2, sizes
    together = pa.concat_arrays(dictionaries).dictionary_encode()
    of = together.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    first = np.cumsum([0, *map(len, dictionaries)])
    key = np.concatenate([of[first[i] + (k >> 32)] << 32 | k & 0xFFFFFFFF for i, k in enumerate(keys)])
    key, place = np.unique(key, return_inverse=True)
    n = np.bincount(place, weights=np.concatenate(counts), minlength=len(key)).astype(np.int64)
    begins = np.searchsorted(key >> 32, np.arange(len(together.dictionary) + 1))
    return together.dictionary, begins, key & 0xFFFFFFFF, n, sizes


def _lists(values: np.ndarray, begins: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(values, pa.int32()))


def build_index(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", only: DataFrame | None = None) -> DataFrame:
    """The index of ``docs``, written to the shared folder: shard, term, docs and counts (of each
    document that holds the term: its place in the shard, occurrences), and for each shard one row without a
    term with the ids of its documents, ascending, and their numbers of terms as counts.

    ``only``: a column of terms; if they have at most SENT_BYTES bytes no others are indexed.
    """
    spark = docs.sparkSession
    kept = None
    if only is not None:
        word = only.columns[0]
        only = only.select(F.col(f"`{word}`").alias("w")).distinct()
        if (only.agg(F.sum(F.octet_length("w") + 16)).first()[0] or 0) <= SENT_BYTES:
            kept = spark.sparkContext.broadcast([r.w for r in only.collect()])
    source = docs.select(F.col(f"`{doc_id}`").alias("id"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        wanted = None if kept is None else pa.array(kept.value, pa.string())
        made, held, size, rows = 0, [], 0, 0

        def done() -> Iterator[pa.RecordBatch]:
            nonlocal made, held, size, rows
            ids, texts = (pa.chunked_array([b.column(i) for b in held]).combine_chunks() for i in (0, 1))
            order = pc.array_sort_indices(ids, null_placement="at_start")
            ids, texts = ids.take(order), texts.take(order)
            terms, begins, places, counts, sizes = _shard(texts, wanted)
            number = TaskContext.get().partitionId() << 24 | made
            made, held, size, rows = made + 1, [], 0, 0
            for a in range(0, len(terms), 50_000):
                b = min(a + 50_000, len(terms))
                low, high = begins[a], begins[b]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.full(b - a, number), pa.int64()), terms.slice(a, b - a), _lists(places[low:high], begins[a:b + 1] - low),
                    _lists(counts[low:high], begins[a:b + 1] - low), pa.nulls(b - a, pa.list_(ids.type))], names)
            whole = np.array([0, len(ids)])
            yield pa.RecordBatch.from_arrays([
                pa.array([number], pa.int64()), pa.nulls(1, pa.string()), pa.nulls(1, pa.list_(pa.int32())), _lists(sizes, whole),
                pa.ListArray.from_arrays(pa.array(whole, pa.int32()), ids)], names)

        names = ["shard", "term", "docs", "counts", "ids"]
        for batch in batches:
            lengths = np.diff(text_buffers(batch.column(1))[1])
            first = 0
            for i, n in enumerate(lengths.tolist()):
                if rows and (size + n > SHARD_BYTES or rows == SHARD_DOCS):
                    if i > first:
                        held.append(batch.slice(first, i - first))
                    yield from done()
                    first = i
                size, rows = size + n, rows + 1
            held.append(batch.slice(first))
        if rows:
            yield from done()

    return written(map_arrow(source, work, f"shard long, term string, docs array<int>, counts array<int>, ids array<{kind}>"), "index")


class _Shard:
    """Posting lists of a shard, by term one after another, with their range maxima."""

    def __init__(self, begins: np.ndarray, docs: np.ndarray, impacts: np.ndarray, n_docs: int) -> None:
        self.begins, self.docs, self.impacts, self.n_docs = begins, docs, impacts, n_docs
        # a place in the lists, by term and document
        self.keys = np.repeat(np.arange(len(begins) - 1), np.diff(begins)) * (n_docs + 1) + docs
        # best[j][i]: place of the largest impact among 2**j places from i on
        self.best = [np.arange(len(docs), dtype=np.int32)]
        longest = int(np.diff(begins).max(initial=0))
        while 2 << (len(self.best) - 1) <= longest:
            last, step = self.best[-1], 1 << (len(self.best) - 1)
            a, b = last[:-step], last[step:]
            self.best.append(np.where(impacts[a] >= impacts[b], a, b))

    def maxima(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Places of the largest impacts in [low, high), none of them empty."""
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), dtype=np.int64)
        for j in np.unique(level).tolist():
            at = np.flatnonzero(level == j)
            a, b = self.best[j][low[at]], self.best[j][high[at] - (1 << j)]
            out[at] = np.where(self.impacts[a] >= self.impacts[b], a, b)
        return out

    def search(self, terms: np.ndarray, times: np.ndarray, k: int, floor: int) -> list[tuple[int, int]]:
        """(score, document) of the k best with a score of ``floor`` (above 0) or more."""
        found: list[tuple[int, int]] = []   # heap of (score, -document)
        # intervals: [start, end), bound; their terms as ragged rows (term, times, places low to high)
        open_ = [self._bounded(np.zeros(1, dtype=np.int64), np.array([self.n_docs]), np.zeros(len(terms), dtype=np.int64),
                               terms, times, self.begins[terms], self.begins[terms + 1])]
        order: list[tuple[int, int, int, int]] = []   # heap of (-bound, start, group, row)

        def push(g: int) -> None:
            for row, (bound, start) in enumerate(zip(open_[g]["bound"].tolist(), open_[g]["start"].tolist(), strict=True)):
                if bound > 0 and reaches(bound, start):
                    heapq.heappush(order, (-bound, start, g, row))

        def reaches(bound: int, start: int) -> bool:
            if bound < floor:
                return False
            return len(found) < k or (bound, -start) > found[0]

        push(0)
        while order:
            taken = []
            while order and len(taken) < WAVE:
                bound, start, g, row = heapq.heappop(order)
                if not reaches(-bound, start):
                    if -bound < floor or -bound < found[0][0]:
                        order = []
                    continue
                taken.append((g, row))
            if not taken:
                break
            start, end, of, t, c, low, high, peak = self._take(open_, taken)
            gain = c * self.impacts[peak]
            cuts = np.flatnonzero(np.diff(of, prepend=-1))
            top = np.maximum.reduceat(gain, cuts)
            leads = np.flatnonzero(gain == top[of])
            split = self.docs[peak[leads[np.searchsorted(of[leads], np.arange(len(start)))]]]
            # where the document is, or would be, in each list
            at = np.searchsorted(self.keys, t * (self.n_docs + 1) + split[of])
            held = (at < high) & (self.docs[np.minimum(at, len(self.docs) - 1)] == split[of])
            total = np.zeros(len(start), dtype=np.int64)
            np.add.at(total, of[held], c[held] * self.impacts[at[held]])
            for s, d in zip(total.tolist(), split.tolist(), strict=True):
                if s >= floor:
                    if len(found) < k:
                        heapq.heappush(found, (s, -d))
                    elif (s, -d) > found[0]:
                        heapq.heapreplace(found, (s, -d))
            m = len(start)
            g = len(open_)
            open_.append(self._bounded(np.concatenate((start, split + 1)), np.concatenate((split, end)), np.concatenate((of, of + m)),
                                       np.concatenate((t, t)), np.concatenate((c, c)), np.concatenate((low, at + held)), np.concatenate((at, high))))
            push(g)
        return [(s, -d) for s, d in found]

    def _bounded(self, start, end, of, t, c, low, high) -> dict[str, np.ndarray]:
        """A group of intervals with their bounds; terms without a place in an interval go."""
        full = np.flatnonzero(low < high)
        of, t, c, low, high = (x[full] for x in (of, t, c, low, high))
        peak = self.maxima(low, high)
        bound = np.zeros(len(start), dtype=np.int64)
        np.add.at(bound, of, c * self.impacts[peak])
        return {"start": start, "end": end, "bound": bound, "first": np.searchsorted(of, np.arange(len(start) + 1)),
                "t": t, "c": c, "low": low, "high": high, "peak": peak}

    @staticmethod
    def _take(groups: list[dict[str, np.ndarray]], taken: list[tuple[int, int]]) -> list[np.ndarray]:
        """The intervals of ``taken`` side by side."""
        out: list[list[np.ndarray]] = [[] for _ in range(8)]
        seen = 0
        by_group: dict[int, list[int]] = {}
        for g, row in taken:
            by_group.setdefault(g, []).append(row)
        for g, rows in by_group.items():
            x, at = groups[g], np.array(sorted(rows))
            first, size = x["first"][at], x["first"][at + 1] - x["first"][at]
            of = np.repeat(np.arange(len(at)), size)
            place = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(first, size)
            for held, values in zip(out, (x["start"][at], x["end"][at], of + seen, *[x[n][place] for n in ("t", "c", "low", "high", "peak")]), strict=True):
                held.append(values)
            seen += len(at)
        return [np.concatenate(x) for x in out]


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Values and bounds of a column of lists."""
    lists = column.combine_chunks()
    lists = pa.concat_arrays(lists.chunks) if isinstance(lists, pa.ChunkedArray) else lists
    sizes = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.concatenate(([0], np.cumsum(sizes))).astype(np.int64)


def _queries(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """item, terms (repeats included) and bytes of every query."""
    source = items.select(F.col(f"`{item_id}`").alias("item"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text")).distinct()
    kind = source.schema["item"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([text_terms(t) for t in b.column(1).to_pylist()], pa.list_(pa.string()))], ["item", "terms"])

    return written(map_arrow(source, work, f"item {kind}, terms array<string>"), "queries")


def search(index: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """item, rank, id, score of the ``k`` best documents of each query."""
    shards = index.where("term IS NULL")
    n, total = shards.select(F.explode("counts").alias("n")).agg(F.coalesce(F.sum((F.col("n") > 0).cast("long")), F.lit(0)),
                                                                 F.coalesce(F.sum(F.col("n").cast("long")), F.lit(1))).first()
    weight = F.floor(1000 * F.log((F.lit(2 * n + 2)).cast("double") / (2 * F.col("df") + 1).cast("double")))
    bytes_ = queries.agg(F.sum(F.aggregate("terms", F.lit(0).cast("long"), lambda a, t: a + F.octet_length(t) + 8))).first()[0] or 0
    blocks = 1 + int(bytes_ // BLOCK_BYTES)
    queries = queries.withColumn("block", F.pmod(F.xxhash64("item", "terms"), F.lit(blocks)).cast("int"))
    words = queries.select("block", F.explode("terms").alias("term")).distinct()
    weights = index.where("term IS NOT NULL").join(words.select("term").distinct(), "term", "left_semi") \
        .groupBy("term").agg(F.sum(F.size("docs")).alias("df")).select("term", weight.alias("weight"))
    weights = written(words.join(weights, "term"), "weights")
    lists = index.where("term IS NOT NULL").join(weights, "term").select("shard", "block", "term", "weight", "docs", "counts")
    groups = queries.groupBy("block").agg(F.collect_list(F.struct("item", "terms")).alias("asked")) \
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    whole = shards.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))) \
        .withColumn("copy", _copy()) \
        .join(groups, ["block", "copy"]).select("shard", "block", "counts", "ids", "asked")
    rows = written(lists.unionByName(whole, allowMissingColumns=True), "postings")
    empty = index.select(F.explode("ids").alias("id"))
    schema = StructType([*queries.select("item", "terms").schema, empty.schema[0], StructField("score", LongType())])
    best = Window.partitionBy("item", "terms").orderBy(F.desc("score"), F.asc_nulls_first("id"))

    def top(found: DataFrame) -> DataFrame:
        return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)

    def searched(rows: DataFrame) -> DataFrame:
        arrow = to_arrow_schema(schema)
        return rows.groupBy("shard", "block").applyInArrow(lambda table: _group(table, k, n, total, arrow), schema)

    early = F.pmod(F.xxhash64("shard"), F.lit(max(1, shards.count() // FIRST_SHARDS))) == 0
    first = written(top(searched(rows.where(early))).drop("rank"), "first")
    floors = top(first).where(F.col("rank") == k).select("item", "terms", F.col("score").alias("floor"))
    floors = queries.join(floors, queries["item"].eqNullSafe(floors["item"]) & (queries["terms"] == floors["terms"])) \
        .groupBy("block").agg(F.collect_list(F.struct(queries["item"], queries["terms"], "floor")).alias("floors")) \
        .withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(COPIES - 1))))
    late = rows.where(~early)
    late = late.unionByName(late.where("ids IS NOT NULL").select("shard", "block", _copy().alias("copy"))
                            .join(written(floors, "floors"), ["block", "copy"]).select("shard", "block", "floors"), allowMissingColumns=True)
    return top(first.unionByName(searched(late))).select("item", "rank", "id", "score")


def _copy():
    return F.pmod(F.xxhash64("shard"), F.lit(COPIES)).cast("int")


def _group(table: pa.Table, k: int, n: int, total: int, schema: pa.Schema) -> pa.Table:
    """The best documents of one shard for the queries of one block."""
    is_list = pc.is_valid(table["term"])
    lists, whole = table.filter(is_list), table.filter(pc.is_valid(table["ids"]))
    terms = {t: i for i, t in enumerate(lists["term"].to_pylist())}
    docs, begins = _flat(lists["docs"])
    counts = _flat(lists["counts"])[0]
    sizes = _flat(whole["counts"])[0]
    ids = whole["ids"].combine_chunks().flatten() if len(whole) else pa.array([], schema.field("id").type)
    m = 75 + (25 * sizes * n) // total
    weight = np.repeat(lists["weight"].to_numpy().astype(np.int64), np.diff(begins))
    shard = _Shard(begins, docs, weight * ((1_000_000_000 * counts) // (1_000 * counts + 12 * m[docs])), len(sizes))
    floors = {}
    if "floors" in table.column_names:
        floors = {(q["item"], tuple(q["terms"])): q["floor"] for row in table["floors"].drop_null().to_pylist() for q in row}
    out: dict[str, list] = {"item": [], "terms": [], "place": [], "score": []}
    for q in (q for row in whole["asked"].to_pylist() for q in row):
        times: dict[int, int] = {}
        for t in q["terms"]:
            if t in terms:
                times[terms[t]] = times.get(terms[t], 0) + 1
        if not times:
            continue
        held = np.array(sorted(times), dtype=np.int64)
        for score, d in shard.search(held, np.array([times[t] for t in held.tolist()], dtype=np.int64), k,
                                      floors.get((q["item"], tuple(q["terms"])), 1)):
            out["item"].append(q["item"])
            out["terms"].append(q["terms"])
            out["place"].append(d)
            out["score"].append(score)
    ident = ids.take(pa.array(out["place"], pa.int64()))
    return pa.Table.from_arrays([pa.array(out["item"], schema.field("item").type), pa.array(out["terms"], schema.field("terms").type),
                                 ident.cast(schema.field("id").type), pa.array(out["score"], pa.int64())], schema=schema)


def rank_documents(docs: DataFrame, items: DataFrame, *, k: int = 20, doc_id: str = "doc_id", text: str = "text",
                   item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The ``k`` best documents of each item: its id, rank (from 1), the document's id, score.
    Other columns of either side play no part."""
    queries = _queries(items, item_id, item_text)
    index = build_index(docs, doc_id=doc_id, text=text, only=queries.select(F.explode("terms").alias("term")))
    found = search(index, queries, k)
    return found.select(F.col("item").alias(item_id), "rank", F.col("id").alias(doc_id), "score")
