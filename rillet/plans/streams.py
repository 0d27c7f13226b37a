"""The workshop's continuous queries, run as streams over the whole tables.

A table is replayed: written to the shared folder as some files in order of time and read
back as a file stream, so a query sees several micro-batches, with changes of earlier results in the later ones.
The stream runs to its end, and the rows that its changelog adds up to are returned; the
oracle is the SQL of the batch query of the same tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.plans import params as P
from rillet.session import scratch_path
from rillet.sources import fixtures as fx
from rillet.sources import writers
from rillet.sources.tables import open_table
from rillet.streaming import operators as S
from rillet.streaming import retract as R
from rillet.streaming.sinks import UpsertSink, read_latest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

#: Micro-batches of a replay.
STEPS = 3


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


class Replay:
    """A session for streams and the folder of its files; state partitions follow the cluster's cores."""

    def __init__(self, spark: SparkSession, steps: int = STEPS) -> None:
        self.user, self.steps = spark, steps
        self.session = spark.newSession()
        for name, value in {"spark.sql.session.timeZone": "UTC", "spark.sql.shuffle.partitions": str(spark.sparkContext.defaultParallelism),
                            "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
                            # state and offsets are in the shared folder; executors keep only working copies
                            # counting rows reads a list's earlier entries before each that is added
                            "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
                            "spark.sql.streaming.multipleWatermarkPolicy": "min"}.items():
            self.session.conf.set(name, value)
        self.folder = scratch_path(spark, "replay")

    def stream(self, table: DataFrame, name: str, time_col: str, *, watermark: bool = False) -> DataFrame:
        """``table`` as a stream of ``steps`` parts by time; with a watermark, a last row without
        values moves the clock past all others."""
        at = F.unix_micros(F.col(time_col).cast("timestamp"))
        cuts = table.select(F.percentile_approx(at, [i / self.steps for i in range(1, self.steps)])).first()[0]
        part = F.lit(0)
        for c in cuts:
            part = part + F.coalesce(at > c, F.lit(False)).cast("int")
        path, files = f"{self.folder}/{name}", self.user.sparkContext.defaultParallelism
        for i in range(self.steps):
            table.where(part == i).repartition(files).write.mode("append").parquet(path)
            for _ in range((i + 1) * files - len(self.user.read.schema(table.schema).parquet(path).inputFiles())):   # parts of few rows
                table.limit(0).coalesce(1).write.mode("append").parquet(path)
        if watermark:
            end = table.select((F.max(F.col(time_col).cast("timestamp")) + F.expr("INTERVAL 1 DAY")).alias("t")).select(
                *[(F.col("t") if c == time_col else F.lit(None)).cast(table.schema[c].dataType).alias(c) for c in table.columns])
            end.write.mode("append").parquet(path)
        # a micro-batch is one part, whole: rows of a part that came a batch late might be below the watermark
        read = self.session.readStream.schema(table.schema).option("maxFilesPerTrigger", files).parquet(path)
        return read.withColumn(time_col, F.col(time_col).cast("timestamp"))

    def run(self, changes: DataFrame) -> DataFrame:
        """Everything that the stream ``changes`` emits, as a table of the user's session."""
        out = f"{self.folder}/out"
        running = changes.writeStream.outputMode("append").format("parquet").option("path", out) \
            .option("checkpointLocation", f"{self.folder}/checkpoint").trigger(availableNow=True).start()
        running.awaitTermination()
        return self.user.read.schema(changes.schema).parquet(out)


def _transactions(replay: Replay, sf: str, *cols: str) -> DataFrame:
    return replay.stream(fx.transactions(replay.user, sf).select("account_number", "txn_id", "timestamp", "amount", *cols), "transactions", "timestamp")


def _customers(replay: Replay, sf: str) -> DataFrame:
    """The changelog of the upsert table of customers."""
    versions = replay.stream(fx.customers(replay.user, sf), "customers", "created_at")
    return R.upsert_changes(versions, key="account_number", order_cols=["created_at", "customer_name"])


def _ntz(rows: DataFrame, *cols: str) -> DataFrame:
    for c in cols:
        rows = rows.withColumn(c, F.col(c).cast("timestamp_ntz"))
    return rows


@query
def stream_regular_join(spark: SparkSession, sf: str) -> DataFrame:
    """Every transaction with its customer's current row, taken back and sent anew when the customer changes."""
    replay = Replay(spark)
    c = _customers(replay, sf).select(R.OP, "account_number", "customer_name", "email", "city", "created_at")
    joined = R.join_changes(R.inserts(_transactions(replay, sf, "currency", "merchant")), c, key="account_number", salts=2)
    rows = _ntz(R.current_rows(replay.run(joined)), "timestamp", "created_at")
    return rows.select("account_number", "txn_id", F.col("amount").cast("double").alias("amount"), "currency", "merchant", "timestamp",
                       "customer_name", "email", "city", "created_at")


@query
def stream_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    """Large transactions and customers of some cities, each with or without the other; padded rows are taken back."""
    replay = Replay(spark)
    t = _transactions(replay, sf).where(F.col("amount") > P.LARGE_AMOUNT)
    c = _customers(replay, sf).where(F.col("city") >= "J").select(R.OP, "account_number", "customer_name", "city")
    rows = _ntz(R.current_rows(replay.run(R.join_changes(R.inserts(t), c, key="account_number", how="full"))), "timestamp")
    return rows.select("account_number", "txn_id", F.col("amount").cast("double").alias("amount"), "timestamp", "customer_name", "city")


def _spend(replay: Replay, sf: str, *keys: str) -> DataFrame:
    joined = R.join_changes(R.inserts(_transactions(replay, sf)), _customers(replay, sf).select(R.OP, "account_number", "email", "city"), key="account_number")
    return R.aggregate_changes(joined, keys=keys, sums={"total_spent": F.col("amount")}, counts={"transaction_count": F.col("txn_id")}, salts=2)


@query
def stream_spend_by_segment(spark: SparkSession, sf: str) -> DataFrame:
    """Spend and transactions per city; a customer that moves takes its spend along."""
    replay = Replay(spark)
    rows = R.current_rows(replay.run(_spend(replay, sf, "city")))
    return rows.select("city", F.col("total_spent").cast("double").alias("total_spent"), "transaction_count")


@query
def stream_high_spenders(spark: SparkSession, sf: str) -> DataFrame:
    """Customers above a spend, counted per city; two aggregates chained, HAVING between them."""
    replay = Replay(spark)
    high = _spend(replay, sf, "email", "city").where(F.col("total_spent") > P.HIGH_SPENDER_THRESHOLD)
    return R.current_rows(replay.run(R.aggregate_changes(high, keys="city", counts={"high_spender_count": F.col("email")})))


@query
def stream_sink_correction(spark: SparkSession, sf: str) -> DataFrame:
    """Spend per city in a sink whose primary key is the number of transactions."""
    replay = Replay(spark)
    spend = _spend(replay, sf, "city").select(R.OP, "transaction_count", "city")
    return R.current_rows(replay.run(R.sink_changes(spend, sink_key="transaction_count", order_cols=["city"])))


@query
def stream_temporal_join(spark: SparkSession, sf: str) -> DataFrame:
    """Each transaction with the customer version valid at its time, by the lesser of two clocks."""
    replay = Replay(spark)
    t = replay.stream(fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp"), "transactions", "timestamp", watermark=True)
    c = replay.stream(fx.customers(spark, sf).select("account_number", "customer_name", "created_at"), "customers", "created_at", watermark=True)
    joined = R.versioned_join(t.withWatermark("timestamp", "5 seconds"), c.withWatermark("created_at", "5 seconds"), key="account_number",
                              left_time="timestamp", version_time="created_at", version_cols=["customer_name", "created_at"])
    rows = _ntz(replay.run(joined), "timestamp", "created_at")
    return rows.select("txn_id", F.col("amount").cast("double").alias("amount"), F.col("timestamp").alias("txn_time"), "customer_name",
                       F.col("created_at").alias("signup_time"))


@query
def stream_tumble_count(spark: SparkSession, sf: str) -> DataFrame:
    """Failed payments per merchant and window, each once its window has closed; a filter above the
    watermark, and a last row that only moves the clock."""
    replay = Replay(spark)
    t = replay.stream(fx.transactions(spark, sf), "transactions", "timestamp", watermark=True).withWatermark("timestamp", "5 seconds")
    out = S.tumbling_count_stream(t, time_col="timestamp", size=P.TUMBLE_SIZE, keys="merchant", alias="total_tx_failed",
                                  where=(F.col("transaction_type") == "payment") & (F.col("status") == "Failed"))
    return _ntz(replay.run(out), "window_start", "window_end")


@query
def stream_session_count(spark: SparkSession, sf: str) -> DataFrame:
    """A6 on a stream: sessions per merchant, each once the clock has passed its gap."""
    replay = Replay(spark)
    t = replay.stream(fx.transactions(spark, sf), "transactions", "timestamp", watermark=True).withWatermark("timestamp", "5 seconds")
    out = S.session_count_stream(t.where(S.keep_above_watermark(F.col("txn_id").isNotNull(), "timestamp")), time_col="timestamp", gap=P.SESSION_GAP, keys="merchant")
    return _ntz(replay.run(out), "window_start", "window_end")


@query
def stream_copy(spark: SparkSession, sf: str) -> DataFrame:
    """S9, S10 on a stream, S16: a continuous copy into a table, read as a batch."""
    replay = Replay(spark)
    t = replay.stream(fx.transactions(spark, sf).select("txn_id", "account_number", "amount", "timestamp"), "transactions", "timestamp")
    name = f"copied_{replay.folder.rpartition('-')[2]}"
    writers.stream_into(t, name, f"{replay.folder}/checkpoint", path=f"{replay.folder}/{name}").awaitTermination()
    return spark.read.schema(t.schema).parquet(f"{replay.folder}/{name}").select("txn_id", "account_number", F.col("amount").cast("double").alias("amount"))


@query
def stream_upsert_table(spark: SparkSession, sf: str) -> DataFrame:
    """Spend per city, updated with every micro-batch, upserted into a table by its primary key."""
    replay = Replay(spark)
    t = _transactions(replay, sf)
    c = replay.session.read.schema(_city_of(spark, sf).schema).parquet(_stored(_city_of(spark, sf), f"{replay.folder}/city-of"))
    spend = t.join(c, "account_number").groupBy("city").agg(F.sum("amount").cast("double").alias("total_spent"), F.count("txn_id").alias("transaction_count"))
    sink = UpsertSink(f"{replay.folder}/table", pk=["city"], order_cols=[])
    spend.writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{replay.folder}/checkpoint") \
        .trigger(availableNow=True).start().awaitTermination()
    return read_latest(spark, sink.base).select("city", "total_spent", "transaction_count")


def _city_of(spark: SparkSession, sf: str) -> DataFrame:
    from rillet.plans.catalog import materialize_latest

    return materialize_latest(spark, sf).select("account_number", "city")


def _stored(df: DataFrame, path: str) -> str:
    df.write.parquet(path)
    return path


@query
def stream_from_latest(spark: SparkSession, sf: str) -> DataFrame:
    """A stream that starts behind the files that are there: the odd events come after its start."""
    replay = Replay(spark)
    events = fx.read_table(spark, sf, "events").select("event_id", "event_type", "value")
    path = f"{replay.folder}/events"
    events.where("event_id % 2 = 0").write.parquet(path)
    stream = open_table(replay.session, path, stream=True, schema=events.schema, startup="latest-offset", latest_from=f"{replay.folder}/present")
    events.where("event_id % 2 = 1").write.mode("append").parquet(path)
    return replay.run(stream)
