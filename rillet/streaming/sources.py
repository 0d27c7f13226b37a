"""Stream fixtures: the workshop tables read as file streams with watermarks.

Table opening (S5-S7) lives in :mod:`rillet.sources.tables` and the
generators (S1-S4) in :mod:`rillet.sources.generators`; both are re-exported
here for convenience.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.sources import fixtures as fx
from rillet.sources.generators import (customer_emails_generator, customer_queries_generator,  # noqa: F401
                                       customers_generator, transactions_generator)
from rillet.sources.tables import open_table  # noqa: F401


def events_stream(spark: SparkSession, path: str, *, max_files_per_trigger: int = 1) -> DataFrame:
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"
    return (spark.readStream.format("parquet").schema(schema)
            .option("maxFilesPerTrigger", max_files_per_trigger).load(path))


def transactions_stream(spark: SparkSession, path: str, *, delay: str | None = "5 seconds",
                        max_files_per_trigger: int = 1) -> DataFrame:
    """The transactions table as a stream with its watermark (timestamp - delay;
    ``delay=None``: no watermark, for operators that declare their own)."""
    t = fx.transactions_from_events(events_stream(spark, path, max_files_per_trigger=max_files_per_trigger))
    t = t.withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    return t if delay is None else t.withWatermark("timestamp", delay)


def customers_stream(spark: SparkSession, path: str, sf_dir: str, *, delay: str | None = "5 seconds",
                     max_files_per_trigger: int = 1) -> DataFrame:
    """Customer versions as a stream (stream-static join to customer and nation)."""
    c = fx.customers_from_events(events_stream(spark, path, max_files_per_trigger=max_files_per_trigger),
                                 spark, sf_dir)
    c = c.withColumn("created_at", F.col("created_at").cast("timestamp"))
    return c if delay is None else c.withWatermark("created_at", delay)
