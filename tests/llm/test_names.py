"""Every operator and stage with input columns that bear the names used inside, nulls, repeats and empty tables."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from rillet.llm import bpe, mixing, packing, quality, shared, simhash, substring, toxicity
from rillet.llm.queries import tokenizer

ROWS = [(1, "a b c " * 30, "en", "s", 5), (1, "a b c " * 30, "en", "s", 5), (2, None, None, None, None), (3, "", "de", "s", 0), (None, "words " * 3, "en", "t", 18),
        (4, " ".join(f"w{i}" for i in range(60)), "en", "t", 200), (5, " ".join(f"x{i}" for i in range(50)), None, None, 200)]
NAMES = ["_text", "_host", "_rejected", "_copy", "_n", "_c0", "_c1", "_id", "_row", "_source", "_size", "_words", "_kept_0", "kept", "n_words", "size", "copies", "target",
         "host", "n", "a", "b", "pos", "seed", "value", "at", "term", "shard", "score", "ids", "piece", "fingerprint", "component", "spans", "base_failed", "copy", "r", "rank", "TEXTS"]
USED = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark, names=NAMES):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, source string, n_chars long")
    return docs.select("*", *[F.concat_ws("/", F.lit(n), F.col("doc_id")).alias(n) for n in names])


def passed(out, names):
    """Whether each column still has its own value."""
    wrong = [F.count_if(~F.col(n).eqNullSafe(F.concat_ws("/", F.lit(n), F.col("doc_id")))).alias(n) for n in names]
    return {n for n, k in out.agg(F.lit(0).alias("none"), *wrong).first().asDict().items() if k} == set()


OPERATORS = {
    "simhash": (lambda d: simhash.near_dedup(d), ()),
    "quality": (lambda d: quality.judge(d), (*quality.MEASURES, "base_failed", "kept")),
    "substring": (lambda d: substring.dedup_substrings(d), ("n_words", "n_removed", "kept", "kept_sha256")),
    "mixing": (lambda d: mixing.materialise(mixing.mix(d)), ("size", "source_size", "target", "copies")),
    "bpe": (lambda d: bpe.encode(d, **tokenizer()), ("n_tokens", "ids", "ids_sha256", "decoded_sha256")),
    "toxicity": (lambda d: toxicity.score(d, _model(d)), ("score",)),
    "packing": (lambda d: packing.pack(packing.token_pieces(d, tokenizer=packing_file(), capacity=64, end=2), capacity=64),
                ("piece", "start", "length", "ids", "sequence_id", "offset")),
}


def _model(docs):
    labels = docs.select("doc_id", F.lit(1).alias("quality"), (F.col("doc_id") % 2).cast("int").alias("toxic"))
    return toxicity.fit(docs, labels)


def packing_file():
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@pytest.mark.parametrize("name", OPERATORS)
def test_operator_keeps_foreign_columns(spark, name):
    run, results = OPERATORS[name]
    docs = table(spark)
    out = run(docs).cache()
    assert set(docs.columns) <= set(out.columns) | {"text"} and out.count() > 0
    assert passed(out, [n for n in NAMES if n not in results])
    assert run(docs.limit(0)).count() == 0


@pytest.mark.parametrize("stage", corpus_pipeline.STAGES[:4], ids=lambda s: s[0])
def test_stage_keeps_foreign_columns(spark, stage):
    docs = table(spark)
    out = stage[1](spark, docs, "")
    assert out.columns == docs.columns and out.schema["doc_id"].dataType == docs.schema["doc_id"].dataType
    assert passed(out, NAMES)
    assert stage[1](spark, docs.limit(0), "").count() == 0
    assert stage[1](spark, docs.drop("n_chars"), "").columns == docs.drop("n_chars").columns


def test_stages_on_nulls_repeats_and_short_texts(spark):
    docs = table(spark, [])
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda df: sorted((r["doc_id"] for r in df.collect()), key=str)
    assert ids(stages["quality rules"](spark, docs, "")) == [4, 5]          # nulls, short and repetitive texts go
    assert ids(stages["simhash near-dedup"](spark, docs, "")) == sorted([1, 2, 4, 5, None], key=str)
    cut = {r["doc_id"]: r["text"] for r in stages["substring dedup"](spark, docs, "").collect()}
    assert cut[1] == "" and cut[2] == "" and len(cut[4].split()) == 60
    assert stages["mix sources"](spark, docs, "").where("source IS NULL").count() > 0
    coded = stages["byte-level bpe"](spark, docs, "").collect()
    assert len(coded) == len(ROWS) and {r["n_tokens"] for r in coded if r["doc_id"] in (2, 3)} == {0}


def test_batches_are_bounded_and_tables_go(spark):
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    substring.dedup_substrings(table(spark, [])).count()
    assert int(spark.conf.get(name)) <= shared.BATCH_ROWS
    paths = list(shared._WRITTEN[spark.sparkContext.applicationId])
    exists = lambda p: spark._jvm.org.apache.hadoop.fs.Path(p).getFileSystem(spark._jsc.hadoopConfiguration()).exists(spark._jvm.org.apache.hadoop.fs.Path(p))
    assert any(exists(p) for p in paths)
    shared.cleanup(spark)
    assert not any(exists(p) for p in paths)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace

    from rillet.session import checkpoint_dir

    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        session = SimpleNamespace(sparkContext=SimpleNamespace(applicationId="none", master=master), conf=SimpleNamespace(get=lambda *a: None))
        with pytest.raises(RuntimeError):
            checkpoint_dir(session)


def test_hosts_are_shrunk_by_their_sizes():
    """Two documents that fail don't reject a host among hosts that hardly fail, two hundred do."""
    sizes, failed = [500, 500, 500, 2, 200], [5, 4, 6, 2, 190]
    n, nn = sum(sizes), sum(s * s for s in sizes)
    m, s = quality._prior(5, n, nn, sum(failed), sum(k * k / x for k, x in zip(failed, sizes, strict=True)))
    rate = [(k + m * s) / (x + s) for k, x in zip(failed, sizes, strict=True)]
    assert s == 2.0 and rate[4] > 0.9 and rate[0] < 0.05 and rate[3] < 0.6
    even = quality._prior(4, 400.0, 40_000.0, 40.0, 4 * 100.0 / 100)
    assert even == (0.1, 400.0)
