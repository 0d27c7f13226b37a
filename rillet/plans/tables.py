"""Statements that create, fill, check and unnest tables, over the whole given tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.functions.table import unnest
from rillet.operators import changelog as C
from rillet.plans import params as P
from rillet.session import scratch_path
from rillet.sources import fixtures as fx
from rillet.sources import writers
from rillet.sources.tables import open_table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _name(kind: str) -> str:
    return f"{kind}_{uuid.uuid4().hex[:12]}"


@query
def filled_table(spark: SparkSession, sf: str) -> DataFrame:
    """A bucketed table created from a query, filled by a second one and by values, and summed by its bucket column."""
    t = fx.transactions(spark, sf).select("account_number", "txn_id", "amount")
    name = _name("filled")
    writers.create_table_as(t.where(F.col("amount") > P.LARGE_AMOUNT), name, path=scratch_path(spark, name), buckets=8, bucket_cols=["account_number"])
    writers.insert_select(t.where(F.col("amount") <= P.LARGE_AMOUNT).select("amount", "txn_id", "account_number"), name)
    writers.insert_values(spark, name, P.INSERTED)
    spark.catalog.refreshTable(name)
    return spark.table(name).groupBy("account_number").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").cast("double").alias("total"))


@query
def validated_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows whose text doesn't fit the target's types or that lack a required column are rejected with a reason."""
    t = fx.transactions(spark, sf)
    shown = F.when(F.pmod(F.col("txn_id").cast("bigint"), F.lit(31)) == 4, F.lit("n/a")).otherwise(F.col("amount").cast("string"))
    good, bad = C.validated_insert(t.select("txn_id", shown.alias("amount"), "merchant"), {"txn_id": "bigint", "amount": "decimal(10,2)", "merchant": "string"},
                                   not_null=["merchant"])
    accepted = good.select("txn_id", F.col("amount").cast("double").alias("amount"), "merchant", F.lit(None).cast("string").alias("error_reason"))
    return accepted.unionByName(bad.select(F.col("_raw_txn_id").cast("bigint").alias("txn_id"), F.lit(None).cast("double").alias("amount"), "merchant", "error_reason"))


@query
def unnested_emails(spark: SparkSession, sf: str) -> DataFrame:
    """a row per element of an array column, customers without an address kept."""
    c = fx.customer_emails_json(spark, sf).select("customer_id", F.from_json("emails", "array<string>").alias("emails"))
    return unnest(c, "emails", "email", outer=True).select("customer_id", "email")


@query
def first_changes(spark: SparkSession, sf: str) -> DataFrame:
    """The first 20 records of the customers' changelog; the limit is the feature."""
    log = C.changelog_view(fx.customers(spark, sf).select("account_number", "customer_name", "created_at"), key="account_number",
                           order_cols=["created_at", "customer_name"], time_col="created_at")
    shown = C.first_changes(log, order_cols=["change_created_at", "account_number", "change_customer_name", "change_seq"], n=20)
    return shown.select("op", "account_number", "customer_name", "created_at", "change_seq")


@query
def table_modes(spark: SparkSession, sf: str) -> DataFrame:
    """One table read in append mode (every version) and in upsert mode (the current one)."""
    c = fx.customers(spark, sf).select("account_number", "customer_name", "created_at")
    rows = C.as_table(c, mode="append").groupBy("account_number").agg(F.count(F.lit(1)).alias("versions"))
    now = C.as_table(c, mode="upsert", key="account_number", order_cols=["created_at", "customer_name"])
    return rows.join(now, "account_number").select("account_number", "versions", "customer_name", "created_at")


@query
def table_from_time(spark: SparkSession, sf: str) -> DataFrame:
    """A snapshot of a table from a start time on, with its records' places in their files."""
    t = open_table(spark, f"{sf.rstrip('/')}/events.parquet", start_time=P.START_TIME, time_col="ts", with_metadata=True)
    placed = F.col("record_file").isNotNull() & (F.col("record_offset") >= 0) & F.col("record_timestamp").isNotNull()
    return t.groupBy("event_type").agg(F.count(F.lit(1)).alias("rows"), F.min("ts").alias("first"), F.bool_and(placed).alias("placed"),
                                       (F.count_distinct("record_file", "record_offset") == F.count(F.lit(1))).alias("distinct_places"))
