"""Helpers shared by the operators: the cluster's shared folder and intermediate tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.session import remove_path, scratch_path, ship_package


#: Rows of an Arrow batch: texts run to many kilobytes, and a batch is in memory several times.
BATCH_ROWS = 2_000


def map_arrow(df: DataFrame, work, schema) -> DataFrame:
    """``mapInArrow`` whose function may live in this package on any executor, with batches
    of at most BATCH_ROWS rows unless the session asks for fewer.  Spark reads that bound when the
    query runs, so the session keeps it; a bound inside the function comes after the batch is in memory."""
    spark = df.sparkSession
    ship_package(spark)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    asked = int(spark.conf.get(name, "10000"))
    if not 0 < asked <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))
    return df.mapInArrow(work, schema)


#: Tables written by this driver, by application.
_WRITTEN: dict[str, list[str]] = {}


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path below ``spark.checkpoint.dir``, which driver and executors share."""
    path = scratch_path(spark, name)
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read back: cuts the lineage and
    survives the loss of any executor.  :func:`cleanup` removes it."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cleanup(spark: SparkSession) -> None:
    """Remove all tables that operators of this application have written; results that read them
    must be stored before."""
    for path in _WRITTEN.pop(spark.sparkContext.applicationId, ()):
        remove_path(spark, path)


def unused(df: DataFrame, *names: str) -> list[str]:
    """``names``, each with underscores before it until it is no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        out.append(name)
    return out


def text_id(col: Column) -> Column:
    """128-bit identity of a text as struct<a: long, b: long> of two differently seeded
    XXH64; null counts as the empty text."""
    t = F.coalesce(col, F.lit(""))
    return F.struct(F.xxhash64(t).alias("a"), F.xxhash64(F.lit(7), t).alias("b"))


def sealed(docs: DataFrame, replaced: Sequence[str] = ()) -> tuple[list[Column], list[Column]]:
    """Two projections that keep the columns of ``docs`` out of the way of an operator's own:
    the first renames them to _c0, _c1, ..., the second back.  Columns in ``replaced`` go."""
    own = [c for c in docs.columns if c not in replaced]
    return ([F.col(f"`{c}`").alias(f"_c{i}") for i, c in enumerate(own)],
            [F.col(f"_c{i}").alias(c) for i, c in enumerate(own)])
