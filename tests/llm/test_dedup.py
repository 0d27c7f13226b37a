"""SimHash components and substring dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from rillet.llm import simhash, substring, textscan


def words_of(text):
    return [w for w in re.split(rb"[\x20\x09-\x0d]+", (text or "").encode()) if w]


def fingerprint(text):
    words = [w.lower() for w in words_of(text)]
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(rows):
    prints = [fingerprint(t) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, f"{prints[i]:016x}", least.get(find(i))) for i, (d, _) in enumerate(rows)]


def near_copies(seed=2):
    rng = random.Random(seed)
    rows = [(i, " ".join(f"{rng.choice('abcdefg')}{rng.randrange(40)}" for _ in range(rng.choice([1, 2, 3, 40, 120])))) for i in range(120)]
    for k in (100, 110):
        words = rows[k][1].split() * 3
        for m in range(80):
            copy = list(words)
            copy[rng.randrange(len(copy))] = f"q{rng.randrange(5)}"
            rows.append((1000 * k + m, " ".join(copy)))
    return rows + [(-5, None), (5000, ""), (None, "  \n"), (None, "a b"), (3, "A  b"), (3, "A  b"), (7777, "É ß ž Z"), (8, "w" * 50_000)]


@pytest.mark.parametrize("part", [4096, 8])
def test_components_equal_brute_force(spark, part):
    rows = near_copies()
    found = simhash.simhash_components(spark.createDataFrame(rows, "doc_id long, text string"), part=part)
    got = [tuple(r) for r in found.select("doc_id", simhash.hex_digits("fingerprint"), "component").collect()]
    assert sorted(got, key=str) == sorted(components(rows), key=str)


def test_pigeonring_keeps_every_near_pair():
    rng = np.random.default_rng(1)
    layout = simhash._segments(3)
    for _ in range(300):
        x = int(rng.integers(0, 1 << 63))
        y = x
        for b in rng.choice(64, size=int(rng.integers(0, 6)), replace=False).tolist():
            y ^= 1 << b
        a, b = (np.full(4, v, dtype=np.uint64) for v in (x, y))
        same = np.array([(x ^ y) >> o & ((1 << w) - 1) == 0 for o, w in layout])
        ring = np.arange(4)
        near = simhash._near(a[same], b[same], ring[same], 3, layout)
        assert (len(near) > 0) == ((x ^ y).bit_count() <= 3)


def test_near_dedup_keeps_one_of_each_component(spark):
    rows = [(1, "a b c d", 5, "x"), (2, "a b c d", 6, None), (None, "a b c d", 7, "y"), (3, "other words here now", 8, "z"),
            (3, "other words here now", 9, "z"), (4, None, 1, None), (5, "", 2, None), (None, "only without an id", 3, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _n int, value string")
    out = simhash.near_dedup(docs)
    assert out.columns == docs.columns
    kept = sorted([(r["doc_id"], r["text"]) for r in out.collect()], key=str)
    assert kept == sorted([(1, "a b c d"), (3, "other words here now"), (4, None), (None, "only without an id")], key=str)
    assert simhash.near_dedup(docs.limit(0)).count() == 0


def cut(rows, window):
    texts = [words_of(t) for _, t in rows]
    seen = collections.Counter(tuple(w[i:i + window]) for w in texts for i in range(len(w) - window + 1))
    out = []
    for (d, _), w in zip(rows, texts, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - window + 1):
            if seen[tuple(w[i:i + window])] > 1:
                gone[i:i + window] = [True] * window
        kept = b" ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out.append((d, len(w), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("letters", [2, 12, 3000])
def test_substring_dedup_equals_brute_force(spark, letters):
    rng = random.Random(letters)
    vocabulary = [f"w{i}" for i in range(letters)]
    passages = [[rng.choice(vocabulary) for _ in range(rng.randint(30, 90))] for _ in range(5)]
    rows = []
    for i in range(60):
        words = [rng.choice(vocabulary) for _ in range(rng.choice([0, 1, 34, 35, 36, 100, 300]))]
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(words))
            words[at:at] = rng.choice(passages)[rng.randint(0, 10):]
        rows.append((i if i % 9 else None, "\t".join(words)))
    rows += [(100, rows[3][1]), (101, None), (102, ""), (103, "  \n"), (3, rows[3][1]), (104, " é x y " * 50), (105, "z " * 30_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS n_words", "'a' AS pos").repartition(4)
    out = substring.dedup_substrings(docs)
    assert out.columns == ["doc_id", "text", "pos", "n_words", "n_removed", "kept", "kept_sha256"]
    got = sorted([tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=str)
    assert got == cut(rows, 35)


def test_words_that_collide_under_polynomials_stay_distinct(spark):
    """Thue-Morse words and their complements are equal under any polynomial modulo 2**64."""
    rng = random.Random(1)
    rows = []
    for i, n in enumerate((1024, 2048, 4096)):
        word = "".join("ab"[j.bit_count() & 1] for j in range(n))
        around = [f"x{rng.randrange(10**6)}" for _ in range(34)]
        rows += [(2 * i, " ".join([*around, word])), (2 * i + 1, " ".join([*around, word.translate(str.maketrans("ab", "ba"))]))]
    out = substring.dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string"))
    got = sorted([tuple(r) for r in out.select("doc_id", "n_words", "n_removed", "kept_sha256").collect()], key=str)
    assert got == cut(rows, 35) and all(r[2] == 0 for r in got)
    with pytest.raises(ValueError):
        substring.dedup_substrings(out, window=1000)


def test_a_text_has_one_row_for_a_seed(spark):
    texts = spark.createDataFrame([(1, 2, "z " * 5_000 + "a b c " * 100)], "a long, b long, text string")
    seeds = substring._seeds(texts, 35).collect()
    assert len(seeds) == len({r["seed"] for r in seeds}) < 20 and sum(r["n"] for r in seeds) > 4_000


def test_substring_dedup_of_nothing(spark):
    assert substring.dedup_substrings(spark.createDataFrame([], "doc_id long, text string")).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="ab é\n\t\x0b\x1c\xa0", max_size=40)), max_size=8))
def test_slices_know_the_words(texts):
    import pyarrow as pa

    got = []
    for part in textscan.slices(pa.array(texts, pa.string())):
        for i in range(len(part)):
            lo, hi = part.bounds[i], part.bounds[i + 1]
            got.append([part.bytes[s:e].tobytes() for s, e in zip(part.starts[lo:hi], part.ends[lo:hi], strict=True)])
    assert got == [words_of(t) for t in texts]
