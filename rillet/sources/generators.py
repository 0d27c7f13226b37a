"""Generators of the workshop's synthetic streams.

Bounded (``spark.range``) or unbounded (``rate`` source); every column is a
hashed pick from the reference's option lists, so rows are reproducible.
Used for demos and load tests; the registered queries read the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.sources import fixtures as fx


def _gen(id_col, seed: int, options: list[str]):
    return fx.pick(options, F.pmod(F.xxhash64(id_col, F.lit(seed)), F.lit(len(options))))


def transactions_generator(spark: SparkSession, *, rows: int | None = None, rows_per_second: int = 3,
                           seed: int = 42) -> DataFrame:
    """The transaction generator, bounded (``spark.range(rows)``) or a ``rate`` stream.

    Weights as the reference's option lists: type payment 3 : refund 1 :
    withdrawal 1, status Successful 2 : Failed 1, accounts ACC1000000..ACC1000010.
    """
    if rows is not None:
        base = spark.range(rows).select(F.col("id"), F.current_timestamp().alias("ts"))
    else:
        base = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
                .select(F.col("value").alias("id"), F.col("timestamp").alias("ts")))
    i = F.col("id")
    h = F.xxhash64(i, F.lit(seed))
    return base.select(
        F.sha2(F.concat(i.cast("string"), F.lit(str(seed))), 256).substr(1, 36).alias("txn_id"),
        F.concat(F.lit("ACC"), (F.lit(1000000) + F.pmod(h, F.lit(11))).cast("string")).alias("account_number"),
        F.col("ts").alias("timestamp"),
        (F.lit(10) + F.pmod(F.xxhash64(i, F.lit(seed + 1)), F.lit(990))).cast("decimal(10,2)").alias("amount"),
        _gen(i, seed + 2, fx.CURRENCIES).alias("currency"),
        _gen(i, seed + 3, fx.MERCHANTS).alias("merchant"),
        _gen(i, seed + 4, fx.LOCATIONS).alias("location"),
        _gen(i, seed + 5, ["Successful", "Successful", "Failed"]).alias("status"),
        _gen(i, seed + 6, ["payment", "payment", "payment", "refund", "withdrawal"]).alias("transaction_type"),
    )


def customer_queries_generator(spark: SparkSession, *, rows: int | None = None, rows_per_second: int = 1,
                               seed: int = 7) -> DataFrame:
    """S3: support questions naming accounts ACC1000001..ACC1000005."""
    if rows is not None:
        base = spark.range(rows).select(F.col("id"), F.current_timestamp().alias("ts"))
    else:
        base = (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
                .select(F.col("value").alias("id"), F.col("timestamp").alias("ts")))
    i = F.col("id")
    acct = F.concat(F.lit("ACC"), (F.lit(1000001) + F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(5))).cast("string"))
    q = F.pmod(F.xxhash64(i, F.lit(seed + 1)), F.lit(5))
    text = F.concat(fx.pick([s.split("{}")[0] for s in fx.SUPPORT_QUESTIONS], q), acct,
                    fx.pick([s.split("{}")[1] for s in fx.SUPPORT_QUESTIONS], q))
    return base.select(F.expr("uuid()").alias("query_id"), acct.alias("account_number"), text.alias("query_text"),
                       F.col("ts").alias("timestamp"))


def _base(spark: SparkSession, rows: int | None, rows_per_second: int) -> DataFrame:
    if rows is not None:
        return spark.range(rows).select(F.col("id"), F.current_timestamp().alias("ts"))
    return (spark.readStream.format("rate").option("rowsPerSecond", rows_per_second).load()
            .select(F.col("value").alias("id"), F.col("timestamp").alias("ts")))


def customers_generator(spark: SparkSession, *, rows: int | None = None, rows_per_second: int = 1,
                        seed: int = 11) -> DataFrame:
    """Customer versions over the same 11-account domain as S1, so an account
    recurs as new versions (the input of the upsert table and temporal join)."""
    b = _base(spark, rows, rows_per_second)
    i = F.col("id")
    h = F.xxhash64(i, F.lit(seed))
    acct = F.concat(F.lit("ACC"), (F.lit(1000000) + F.pmod(h, F.lit(11))).cast("string"))
    return b.select(
        acct.alias("account_number"),
        F.concat(F.lit("Customer "), i.cast("string")).alias("customer_name"),
        F.concat(F.lit("customer"), i.cast("string"), F.lit("@example.com")).alias("email"),
        F.concat(F.lit("+1-555-"), F.lpad(F.pmod(h, F.lit(10000000)).cast("string"), 7, "0")).alias("phone_number"),
        F.make_timestamp_ntz(F.lit(1975) + F.pmod(h, F.lit(32)).cast("int"), F.lit(1), F.lit(1), F.lit(0), F.lit(0),
                             F.lit(0)).alias("date_of_birth"),
        _gen(i, seed + 1, fx.LOCATIONS).alias("city"),
        F.col("ts").alias("created_at"))


def customer_emails_generator(spark: SparkSession, *, rows: int | None = None, rows_per_second: int = 10,
                              seed: int = 13) -> DataFrame:
    """An ARRAY<STRING> of exactly three addresses plus the desired count 0..3."""
    b = _base(spark, rows, rows_per_second)
    i = F.col("id")
    emails = F.transform(F.sequence(F.lit(1), F.lit(3)),
                         lambda k: F.concat(F.lit("user"), k.cast("string"), F.lit("."), i.cast("string"),
                                            F.lit("@mail.test")))
    return b.select(i.cast("int").alias("customer_id"), F.concat(F.lit("Customer "), i.cast("string")).alias("name"),
                    emails.alias("emails"),
                    F.pmod(F.xxhash64(i, F.lit(seed)), F.lit(4)).cast("int").alias("desired_email_count"))
