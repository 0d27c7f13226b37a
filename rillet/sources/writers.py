"""Creating and filling tables (S9-S11, S15): thin forms of Spark's writers with the checks
that a statement makes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def create_table_as(df: DataFrame, name: str, *, path: str | None = None, buckets: int | None = None,
                    bucket_cols: Sequence[str] = (), mode: str = "error") -> DataFrame:
    """CTAS, the schema inferred from the query; rows are dealt to ``buckets`` by
    ``bucket_cols``, so that later joins and aggregates on these columns need no shuffle."""
    writer = df.write.mode(mode).format("parquet")
    if path:
        writer = writer.option("path", path)
    if buckets:
        writer = writer.bucketBy(buckets, *bucket_cols).sortBy(*bucket_cols)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def _checked(df: DataFrame, name: str) -> DataFrame:
    target = df.sparkSession.table(name).schema
    if sorted(df.columns) != sorted(target.names):
        raise ValueError(f"column count mismatch: {name} has {target.names}, the query {df.columns}")
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])


def insert_select(df: DataFrame, name: str) -> None:
    """INSERT INTO .. SELECT, columns matched by name."""
    _checked(df, name).write.insertInto(name)


def insert_values(spark: SparkSession, name: str, rows: Sequence[tuple]) -> None:
    """INSERT INTO .. VALUES; a row of another length or a value of another type fails."""
    schema = spark.table(name).schema
    for row in rows:
        if len(row) != len(schema):
            raise ValueError(f"column count mismatch: {name} has {len(schema)}, the row {len(row)}")
    spark.createDataFrame(list(rows), schema).write.insertInto(name)


def stream_into(df: DataFrame, name: str, checkpoint: str, *, path: str | None = None):
    """S9/S10 on a stream: a continuous copy into a table (at ``path``), from the start of the source."""
    writer = df.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return (writer.option("path", path) if path else writer).toTable(name)
