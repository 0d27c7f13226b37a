"""A training-data pipeline: quality rules, near-duplicates, repeated passages, mixing, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept.  All but
the last return the columns of ``docs``, and columns that a stage doesn't use pass through it whatever
their names.  Null texts count as empty ones; they and texts under 20 words go in the first stage.
Repeated rows are near-duplicates: one stays, of equal ids whichever the operator orders first.  A null
source is a source, and belongs to no host.  Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm import bpe, mixing, quality, simhash, substring
from rillet.llm.queries import table, tokenizer
from rillet.llm.shared import written


def _apart(docs: DataFrame, *used: str) -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """``docs`` with all columns but ``used`` under names that no operator has, and the way back."""
    names = {c: c if c in used else f"_kept_{i}" for i, c in enumerate(docs.columns)}
    hidden = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in names.items()])
    return hidden, lambda out: out.select(*[F.col(n).alias(c) for c, n in names.items()])


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor their host's verdict reject."""
    hidden, back = _apart(docs, "text", "source")
    return back(quality.judge(hidden).where("kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.near_dedup(docs, shingle=3, max_bits=3)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without repeated passages; n_chars, where there is one, follows the text."""
    hidden, back = _apart(docs, "text", "n_chars")
    cut = substring.dedup_substrings(hidden, window=35).withColumn("text", F.col("kept"))
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return back(cut)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them."""
    hidden, back = _apart(docs, "doc_id", "text", "source")
    return back(mixing.materialise(mixing.mix(hidden, weights=(1, 2, 3), limit=3.0)))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with digests of the ids and of the decoded bytes."""
    coded = bpe.encode(docs, **tokenizer(), carry_text=False)
    return coded.select("doc_id", "lang", "source", "n_tokens", "ids", "ids_sha256", "decoded_sha256")


STAGES = [
    ("quality rules", quality_rules),
    ("simhash near-dedup", near_dedup),
    ("substring dedup", substring_dedup),
    ("mix sources", mix_sources),
    ("byte-level bpe", byte_bpe),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows over ``documents``; every other stage's rows are written to the
    shared folder and read again, so a lost executor costs one stage at most."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)


#: SQL lacks XXH64 and BPE; tests hold the stages against a brute-force version.
ORACLE_SQL = None
