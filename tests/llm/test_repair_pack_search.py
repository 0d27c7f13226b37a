"""Conversation repair, packing and ranked search against brute force."""

import heapq
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import __spark_entry__ as entry
from rillet.llm import packing, repair, search
from rillet.llm.queries import damaged

SF = "/root/testdata/sf0.001"
JSON = public_tokenizers.path("byte_bpe_50k.json")


# ------------------------------------------------------------------ conversation repair
def cheapest(rows):
    """Uniform-cost search over whole audits."""
    seen, faults = set(), []
    for r in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", r["text"])
        faults.append("gone" if not solid or (r["role"], r["text"]) in seen else "cut" if solid[-1] not in ".!?" else "")
        seen.add((r["role"], r["text"]))
    moves = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
    heap = [(0, "", 0, 0, ())]
    while heap:
        cost, audit, i, q, out = heapq.heappop(heap)
        if i == len(rows) and q in (0, 3):
            return cost, audit, [{"role": a, "text": b} for a, b in out]
        if not audit.endswith("III"):
            for r in ("user", "assistant"):
                if r[0] in moves[q]:
                    heapq.heappush(heap, (cost + 5, audit + "I", i, moves[q][r[0]], (*out, (r, ""))))
        if i < len(rows):
            heapq.heappush(heap, (cost + 2, audit + "D", i + 1, q, out))
            if faults[i] != "gone":
                extra, role, text = 5 * (faults[i] == "cut"), rows[i]["role"], rows[i]["text"]
                if role[:1] in moves[q]:
                    heapq.heappush(heap, (cost + extra, audit + "K", i + 1, moves[q][role[:1]], (*out, (role, text))))
                for r in ("user", "assistant"):
                    if r[0] in moves[q]:
                        heapq.heappush(heap, (cost + extra + 1, audit + "R", i + 1, moves[q][r[0]], (*out, (r, text))))
    raise AssertionError


def random_rows(rnd, n):
    return [{"turn": rnd.choice([None, *range(4)]), "role": rnd.choice(["user", "assistant", "system", "tool", " ", ""]),
             "text": rnd.choice(["a.", "b!", "c", " ", "", "d? \n", "e\x1f."])} for _ in range(n)]


def test_repair_equals_exhaustive_search():
    rnd = random.Random(1)
    chats = [random_rows(rnd, rnd.randrange(0, 7)) for _ in range(400)]
    for rows, got in zip(chats, repair.repair_all(chats), strict=True):
        assert (got["cost"], got["audit"], got["repaired"]) == cheapest(rows)
    assert repair.repair_all([]) == []


def test_ranks_choose_between_arcs_of_one_label():
    """With roles that share a label, only what follows tells which Rerole is least."""
    grammar = repair.Grammar(({"x": 1, "y": 2}, {"k": 3}, {"z": 3, "k": 4}, {}, {"k": 3}), frozenset({1, 2, 3, 4}), ("x1", "y1", "z1", "k1"))
    rows = [{"turn": i, "role": r, "text": f"{i}."} for i, r in enumerate(["q", "k", "k"])]
    got = repair.repair_all([rows], grammar)[0]
    assert (got["cost"], got["audit"]) == (1, "RKK") and [r["role"] for r in got["repaired"]] == ["y1", "k", "k"]
    with pytest.raises(ValueError):
        repair.Grammar(({"s": 1}, {}), frozenset({0}), ("user",))


def test_a_long_conversation_beside_short_ones():
    rnd = random.Random(2)
    long = [{"turn": i, "role": ["user", "assistant"][i % 2], "text": f"{i}{rnd.choice('.!x')}"} for i in range(5_000)]
    a, b = repair.repair_all([long, random_rows(rnd, 5)])
    assert len(a["audit"]) >= 5_000 and a["gaps"] == 0 and a["illegal"] == 0
    assert [r["role"][0] for r in a["repaired"]] == ["u", "a"] * (len(a["repaired"]) // 2)
    assert b["cost"] >= 0


def test_repair_of_nulls_ties_and_foreign_columns(spark):
    rows = [(1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (1, 2, "assistant", "Yes."), (None, 5, "user", "cut"), (2, 1, "user", "gone.")]
    chats = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumns(
        {"gaps": F.lit("x"), "_rows": F.lit(1), "audit": F.lit(2), "off": F.col("conv_id").eqNullSafe(2)})
    got = {r["conv_id"]: r for r in repair.repair(chats, gone="off").collect()}
    assert set(got) == {1, None, 2}
    assert tuple(got[1][:7])[1:] == (1, 1, 1, 0, 2, 4) and got[1]["audit"] == "DKDK"
    assert got[2]["audit"] == "" and got[2]["cost"] == 0 and got[2]["repaired"] == []
    assert got[None]["truncated"] == 1 and got[None]["audit"] == "D"
    assert repair.repair(chats.limit(0)).count() == 0


def test_registered_repair_equals_brute_force(spark):
    turns = [r.asDict() for r in damaged(spark.read.parquet(f"{SF}/conversations.parquet")).collect()]
    got = {r["conv_id"]: r for r in entry.queries()["op11_conversation_repair"](spark, SF).collect()}
    assert set(got) == {t["conv_id"] for t in turns}
    for conv, r in got.items():
        rows = sorted((t for t in turns if t["conv_id"] == conv and not t["gone"]), key=lambda t: (t["turn"], t["role"], t["text"]))
        assert (r["cost"], r["audit"]) == cheapest(rows)[:2]


def test_damage_follows_the_checksum(spark):
    out = Counter()
    for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn").collect():
        out[zlib.crc32(f"{r[0]}:{r[1]}".encode()) % 20] += 1
    rows = damaged(spark.read.parquet(f"{SF}/conversations.parquet"))
    assert rows.where("gone").count() == out[0] and rows.count() == sum(out.values()) + out[3]


# ------------------------------------------------------------------ packing
def fewest(sizes, capacity):
    best = len(sizes)

    def put(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(sizes):
            best = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + sizes[i] <= capacity:
                bins[k] += sizes[i]
                put(i + 1, bins)
                bins[k] -= sizes[i]
        put(i + 1, [*bins, sizes[i]])

    put(0, [])
    return best


def test_bound_and_best_fit_enclose_the_optimum():
    rnd = np.random.default_rng(1)
    for _ in range(300):
        capacity = int(rnd.integers(5, 40))
        sizes = np.sort(rnd.integers(1, capacity + 1, rnd.integers(1, 9)))[::-1]
        least = fewest([int(x) for x in sizes], capacity)
        bins, offsets = packing.best_fit(sizes, capacity)
        assert packing._bound(*np.unique(sizes, return_counts=True), capacity) <= least <= bins.max() + 1
        for k in range(bins.max() + 1):
            at = np.flatnonzero(bins == k)
            at = at[np.argsort(offsets[at])]
            assert offsets[at].tolist() == np.concatenate(([0], np.cumsum(sizes[at])[:-1])).tolist() and sizes[at].sum() <= capacity


def test_best_fit_places_each_size_where_it_fits_best():
    rnd = random.Random(3)
    for _ in range(50):
        sizes = [rnd.randrange(1, 100) for _ in range(60)]
        spaces = []
        for s in sorted(sizes, reverse=True):
            fits = [x for x in spaces if x >= s]
            if fits:
                spaces.remove(min(fits))
                spaces.append(min(fits) - s)
            else:
                spaces.append(100 - s)
        bins, _ = packing.best_fit(np.array(sizes), 100)
        assert sorted(spaces) == sorted((100 - np.bincount(bins, weights=sizes)).astype(int).tolist())


def check_packing(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:i]) for i in range(len(parts))]
        assert sum(n for _, n in parts) <= capacity
    return len(by)


def test_exchange_saves_bins_and_meets_the_bound(spark):
    rnd = random.Random(4)
    rows = [(i, rnd.choice([rnd.randrange(1, 1025), rnd.randrange(1, 200)])) for i in range(3_000)]
    pieces = spark.createDataFrame(rows, "id long, length long").repartition(7)
    once, more = (packing.pack(pieces, capacity=1024, part=512, rounds=r).cache() for r in (1, 12))
    assert sorted((r["id"], r["length"]) for r in more.collect()) == rows
    a, b = check_packing(once.collect(), 1024), check_packing(more.collect(), 1024)
    assert packing.certificate(more, capacity=1024) == (b, packing.certificate(once, capacity=1024)[1])
    assert packing.certificate(more, capacity=1024)[1] <= b <= packing.certificate(more, capacity=1024)[1] + 2 and b < a


def test_packing_of_odd_sizes_and_foreign_columns(spark):
    rows = [(1, 5, "a"), (1, 5, "a"), (2, None, "b"), (3, 0, "c"), (4, 11, "d"), (None, 10, None), (6, -1, "e")]
    out = packing.pack(spark.createDataFrame(rows, "id long, length int, at string").withColumn("offset", F.lit("x")).withColumn("n", F.lit(2)), capacity=10)
    assert out.columns == ["id", "length", "at", "n", "sequence_id", "offset"]
    got = out.collect()
    assert sorted((str(r["id"]), r["offset"]) for r in got if r["sequence_id"] is not None) == [("1", 0), ("1", 5), ("None", 0)]
    assert {r["id"] for r in got if r["sequence_id"] is None} == {2, 3, 4, 6}
    assert packing.pack(out.limit(0), capacity=10).count() == 0
    with_zero = packing.certificate(packing.pack(out.limit(0), capacity=10), capacity=10)
    assert with_zero == (0, 0)


TEXTS = [None, "", " ", "a b  c\n\n d", "naïve Zürich 東京 😀 ½ ⅷ", "x" * 9_000, " " * 3_000 + "end", "<|endoftext|> in a text", "it's we'll I'D",
         "ำ \U0001d7d8 \U0001f0a1 ᲀ ꟱", "word " * 5_000, "<s>\x00\x1f\x85 "]


def test_ids_are_the_librarys():
    with open(JSON, encoding="utf-8") as f:
        ids = packing.Ids(f.read())
    exact = Tokenizer.from_file(JSON)
    rnd = random.Random(1)
    texts = [t or "" for t in TEXTS] + ["".join(chr(rnd.choice([rnd.randrange(32, 127), rnd.randrange(160, 0xD800), rnd.randrange(0xE000, 0x10FFFF)]))
                                                for _ in range(30)) for _ in range(800)]
    assert ids.quick is not None and not ids.plain(TEXTS[7]) and ids.plain("naïve Zürich 東京")
    for t in texts:
        assert ids.of(t).tolist() == exact.encode(t, add_special_tokens=False).ids, t


def test_pieces_and_sequences_hold_all_ids(spark):
    exact = Tokenizer.from_file(JSON)
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").withColumn("piece", F.lit("x")).withColumn("_text", F.lit(1)).repartition(3)
    pieces = packing.token_pieces(docs, tokenizer=JSON, capacity=1024, end=2)
    assert pieces.columns == ["doc_id", "_text", "piece", "start", "length", "ids"]
    packed = packing.pack(pieces, capacity=1024).cache()
    rows = packed.collect()
    for d, text in enumerate(TEXTS):
        want = [*exact.encode(text or "", add_special_tokens=False).ids, 2]
        own = sorted((r for r in rows if r["doc_id"] == d), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert [x for r in own for x in np.frombuffer(r["ids"], "<u4").tolist()] == want
        assert [r["start"] for r in own] == [sum(r["length"] for r in own[:i]) for i in range(len(own))]
        assert all(r["length"] == 1024 for r in own[1:]) and 0 < own[0]["length"] <= 1024
    check_packing(rows, 1024)
    whole = {r["sequence_id"]: r for r in packing.sequences(packed).collect()}
    for r in rows:
        s = whole[r["sequence_id"]]
        assert bytes(s["ids"])[4 * r["offset"]:4 * (r["offset"] + r["length"])] == bytes(r["ids"]) and s["length"] * 4 == len(s["ids"])


def test_registered_packing(spark):
    exact = Tokenizer.from_file(JSON)
    rows = entry.queries()["op12_best_fit_packing"](spark, SF).collect()
    docs = {r["doc_id"]: [*exact.encode(r["text"] or "", add_special_tokens=False).ids, 2] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert {r["doc_id"] for r in rows} == set(docs)
    for r in rows:
        part = docs[r["doc_id"]][r["start"]:r["start"] + r["length"]]
        assert r["ids_crc32"] == zlib.crc32(np.array(part, dtype="<u4").tobytes()) and len(part) == r["length"]
    sequences = check_packing(rows, 1024)
    sizes = np.array([r["length"] for r in rows])
    assert sequences <= packing._bound(*np.unique(sizes, return_counts=True), 1024) + 1


# ------------------------------------------------------------------ ranked search
def plain_terms(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def ranked(docs, items, k):
    lists = [(d, Counter(plain_terms(t))) for d, t in docs]
    lists = [(d, c, sum(c.values())) for d, c in lists if c]
    n, total = len(lists), sum(x[2] for x in lists)
    out = []
    for item, text in dict.fromkeys(items):
        scores = []
        asked = Counter(plain_terms(text))
        w = {t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(t in c for _, c, _ in lists) + 1))) for t in asked}
        for d, c, size in lists:
            m = 75 + (25 * size * n) // total
            s = sum(times * w[t] * ((10**9 * c[t]) // (1000 * c[t] + 12 * m)) for t, times in asked.items() if c[t])
            if s > 0:
                scores.append((-s, d is not None, d, s))
        out += [(item, i + 1, d, s) for i, (_, _, d, s) in enumerate(sorted(scores)[:k])]
    return sorted(out, key=str)


def test_terms_are_the_maximal_matches(monkeypatch):
    texts = [None, "", "...", "Ab-cD_9é ÀZ\x7fz", "x" * 50, "a b" * 30, "É" * 9 + " É"]
    for chunk in (1 << 22, 1, 7):
        monkeypatch.setattr(search, "CHUNK", chunk)
        assert [search.text_terms(t) for t in texts] == [plain_terms(t) for t in texts]


@pytest.mark.parametrize(("shard", "chunk", "first"), [(1 << 25, 1 << 22, 8), (300, 64, 2), (1, 7, 1)])
def test_search_equals_brute_force(spark, monkeypatch, shard, chunk, first):
    for name, value in {"SHARD_BYTES": shard, "CHUNK": chunk, "FIRST_SHARDS": first, "WAVE": 3}.items():
        monkeypatch.setattr(search, name, value)
    rnd = random.Random(shard)
    words = [f"w{i}" for i in range(40)] + ["É", "the", "the", "the", "THE"]
    docs = [(i if i % 17 else None, " ".join(rnd.choice(words) for _ in range(rnd.choice([0, 1, 3, 30, 200])))) for i in range(90)]
    docs += [(200 + i, "same words again the") for i in range(60)] + [(500, None), (501, "--"), (7, docs[7][1])]
    items = [(i, " ".join(rnd.choice([*words, "absent"]) for _ in range(rnd.choice([1, 2, 9])))) for i in range(8)]
    items += [(8, "same words the the"), (8, "same words the the"), (9, None), (10, "absent"), (None, "w1 w2")]
    table = spark.createDataFrame(docs, "doc_id long, text string").withColumns({"term": F.lit("x"), "shard": F.lit("y"), "score": F.lit(0)}).repartition(3)
    asked = spark.createDataFrame(items, "item_id long, text string").withColumn("rank", F.lit("z"))
    got = search.rank_documents(table, asked, k=5)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted([tuple(r) for r in got.collect()], key=str) == ranked(docs, items, 5)


def test_search_of_whole_index_and_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(search, "SENT_BYTES", 0)     # index all terms, join the queries' later
    monkeypatch.setattr(search, "BLOCK_BYTES", 40)
    docs = [(i, f"alpha w{i % 7} w{i % 5} beta" * (1 + i % 3)) for i in range(70)]
    items = [(i, f"w{i % 7} alpha w{i % 5}") for i in range(9)]
    got = search.rank_documents(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), k=4)
    assert sorted([tuple(r) for r in got.collect()], key=str) == ranked(docs, items, 4)


def test_search_of_empty_tables(spark):
    docs, items = (spark.createDataFrame([], f"{i} long, text string") for i in ("doc_id", "item_id"))
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    for d, q in ((docs, items), (one, items), (docs, one.withColumnRenamed("doc_id", "item_id"))):
        assert search.rank_documents(d, q).count() == 0


def test_interval_search_opens_few_documents():
    """Best-first: documents far below the best are never scored."""
    rnd = np.random.default_rng(2)
    n = 20_000
    lists = [np.sort(rnd.choice(n, size, replace=False)) for size in (10, 200, 4_000)]
    begins = np.concatenate(([0], np.cumsum([len(x) for x in lists])))
    impacts = np.concatenate([np.full(len(x), v) for x, v in zip(lists, (9_000, 400, 10), strict=True)]) + rnd.integers(0, 5, begins[-1])
    shard = search._Shard(begins, np.concatenate(lists), impacts, n)
    calls = []
    whole = shard._bounded
    shard._bounded = lambda start, *rest: calls.append(len(start)) or whole(start, *rest)
    got = sorted(((-s, d) for s, d in shard.search(np.arange(3), np.ones(3, dtype=np.int64), 5, 1)))
    score = np.zeros(n, dtype=np.int64)
    for i, x in enumerate(lists):
        score[x] += impacts[begins[i]:begins[i + 1]]
    assert got == sorted((-int(s), d) for d, s in enumerate(score) if s)[:5]
    assert sum(calls) < 1_000
