"""Queries against their SQL, and the pipeline against its stages by brute force."""

import hashlib
import math

import duckdb
import pytest

import corpus_pipeline
from rillet.llm import queries
from tests.llm.test_dedup import components, cut, words_of

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def plain(rows):
    return sorted(tuple(f"{v:.9g}" if isinstance(v, float) else str(v) for v in r) for r in rows)


@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    out = queries.QUERIES[name](spark, SF)
    want = con.execute(f"SELECT {', '.join(out.columns)} FROM ({queries.ORACLE[name]})").fetchall()
    assert plain(out.collect()) == plain(want)


def test_every_operator_has_a_query(spark):
    import __spark_entry__

    names = set(__spark_entry__.queries())
    assert "pipeline" in names and all(any(n.startswith(f"op{i}_") for n in names) for i in range(1, 11))
    assert [f.__module__ for _, f in corpus_pipeline.STAGES] == ["corpus_pipeline"] * 5


def test_pipeline_stages_by_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        if k < 4:
            assert out.columns == docs.columns
        out.write.parquet(str(tmp_path / str(k)))
        rows, docs = docs.collect(), spark.read.parquet(str(tmp_path / str(k)))
        kept.append((rows, docs.collect()))
    # 1: the base rules' failures are gone; all hosts of this table are fine
    before, after = kept[0]

    def repeats(words):
        seen, hit = {}, set()
        for i in range(len(words) - 7):
            seen.setdefault(tuple(words[i:i + 8]), []).append(i)
        for at in seen.values():
            if len(at) > 1:
                hit.update(p for i in at for p in range(i, i + 8))
        return len(hit)

    fine = {r["doc_id"] for r in before if len(w := words_of(r["text"])) >= 20 and 100 * repeats(w) <= 30 * len(w)}
    assert {r["doc_id"] for r in after} == fine
    # 2: one document of each component
    before, after = kept[1]
    assert {r["doc_id"] for r in after} == {c for _, _, c in components([(r["doc_id"], r["text"]) for r in before])}
    # 3: kept words
    before, after = kept[2]
    want = {d: s for d, _, _, s in cut([(r["doc_id"], r["text"]) for r in before], 35)}
    assert {r["doc_id"]: hashlib.sha256(r["text"].encode()).hexdigest() for r in after} == want
    assert all(r["n_chars"] == len(r["text"]) for r in after)
    # 4: copies of whole documents, at most three of each
    before, after = kept[3]
    count = {}
    for r in after:
        count[r["doc_id"], r["text"]] = count.get((r["doc_id"], r["text"]), 0) + 1
    assert set(count) <= {(r["doc_id"], r["text"]) for r in before} and max(count.values()) <= 3
    total = sum(len(words_of(r["text"])) for r in before)
    assert math.isclose(sum(len(words_of(r["text"])) for r in after), total, rel_tol=0.25)
    # 5: the decoded bytes are the texts
    before, after = kept[4]
    texts = sorted(hashlib.sha256(r["text"].encode()).hexdigest() for r in before)
    assert sorted(r["decoded_sha256"] for r in after) == texts
    assert all(hashlib.sha256(" ".join(map(str, r["ids"])).encode()).hexdigest() == r["ids_sha256"] for r in after)
