"""Registered queries without SQL, run whole and held against brute force or held-out labels."""

import base64
import hashlib
import zlib

import numpy as np
import public_tokenizers
import tiktoken

import __spark_entry__ as entry
from tests.llm.test_dedup import components

SF = "/root/testdata/sf0.001"


def rows(spark, name, sf=SF):
    return entry.queries()[name](spark, sf).collect()


def documents(spark, sf=SF):
    return {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}


def test_op1_equals_brute_force(spark):
    docs = documents(spark)
    assert sorted(tuple(r)[:3] for r in rows(spark, "op1_simhash")) == sorted(components(list(docs.items())))


def test_op3_slots_are_a_permutation_and_records_hold_the_bytes(spark):
    docs, got = documents(spark), rows(spark, "op3_training_order")
    pieces = {(d, i): text.encode()[i * 1024:(i + 1) * 1024] for d, text in docs.items() for i in range(-(-len(text.encode()) // 1024))}
    assert sorted(r["slot"] for r in got) == list(range(len(pieces)))
    assert {(r["doc_id"], r["seq"]): (r["n_tokens"], r["tokens_sha256"]) for r in got} == {k: (len(v), hashlib.sha256(v).hexdigest()) for k, v in pieces.items()}
    assert [r["slot"] for r in sorted(got, key=lambda r: (r["doc_id"], r["seq"]))] != sorted(r["slot"] for r in got)


def test_op6_ranks_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    got = {r["doc_id"]: r for r in rows(spark, "op6_toxicity", sf)}
    assert all(r["held_out"] == (zlib.crc32(str(d).encode()) % 3 == 1) and 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for d, r in got.items())
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    toxic, clean = ([got[d]["score"] for d, t in labels.items() if got[d]["held_out"] and t == k] for k in (1, 0))
    wins = sum((a > b) + 0.5 * (a == b) for a in toxic for b in clean) / (len(toxic) * len(clean))
    assert len(toxic) > 100 and wins >= 0.95
    assert sum(s >= 0.7 for s in toxic) >= 0.9 * len(toxic) and sum(s >= 0.7 for s in clean) <= 0.01 * len(clean)


def test_op7_equals_the_library(spark):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    got = {r["doc_id"]: r for r in rows(spark, "op7_byte_bpe")}
    for d, text in documents(spark).items():
        ids = plain.encode_ordinary(text)
        assert got[d]["n_tokens"] == len(ids) and got[d]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert got[d]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()


def test_op10_finds_the_nearest(spark):
    vectors = {r["vec_id"]: np.array(r["embedding"], dtype=np.float64) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()
               if r["embedding"] and None not in r["embedding"]}
    vectors = {i: v for i, v in vectors.items() if np.isfinite(v).all() and v.any()}
    got = {}
    for r in rows(spark, "op10_nearest"):
        got.setdefault(r["query_id"], []).append(r)
    assert set(got) == {i for i in vectors if i % 20 == 0}
    hits = total = 0
    for q, found in got.items():
        best = sorted(((-float(vectors[q] @ v), i) for i, v in vectors.items() if i != q))[:20]
        found.sort(key=lambda r: r["rank"])
        assert [r["rank"] for r in found] == list(range(1, len(best) + 1))
        assert all(abs(r["score"] - float(vectors[q] @ vectors[r["vec_id"]])) < 1e-9 for r in found)
        assert [(-r["score"], r["vec_id"]) for r in found] == sorted((-r["score"], r["vec_id"]) for r in found)
        hits += len({r["vec_id"] for r in found} & {i for _, i in best})
        total += len(best)
    assert hits >= 0.9 * total
