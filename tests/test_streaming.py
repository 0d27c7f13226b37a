"""Batch-vs-stream: the same events written as time-ordered files, read one
file per micro-batch, with a final heartbeat event that moves the watermark
past everything; the stream's output must equal the batch form."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rillet.plans import catalog as C
from rillet.sources import fixtures as fx
from rillet.streaming import operators as S
from rillet.streaming import retract as R
from rillet.streaming import sources as src
from rillet.streaming.sinks import UpsertSink, read_latest

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stream_dir(spark):
    d = tempfile.mkdtemp(prefix="rillet-stream-", dir="/tmp")
    ev = spark.read.parquet(f"{SF}/events.parquet")
    days = [r[0] for r in ev.select(F.to_date("ts").alias("d")).distinct().orderBy("d").collect()]
    for i, day in enumerate(days):
        ev.where(F.to_date("ts") == F.lit(day)).coalesce(1).write.parquet(f"{d}/in/part-{i:03d}")
    hb = spark.createDataFrame([(10**9, "2030-01-01 00:00:00", 10**6, "view", 1.0, "{}")],
                               "event_id bigint, ts string, user_id bigint, event_type string, value double, "
                               "props string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    hb.coalesce(1).write.parquet(f"{d}/in/part-999")
    return d


def run_to_end(df, name, mode="append", outdir=None):
    spark = df.sparkSession
    q = (df.writeStream.format("memory").queryName(name).outputMode(mode)
         .option("checkpointLocation", f"{outdir}/ckpt-{name}").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def files_glob(d):
    return f"{d}/in/*"


def test_tumbling_stream_equals_batch(spark, stream_dir):
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    out = S.tumbling_count_stream(t, time_col="timestamp", size="1 day", keys="merchant", alias="total_tx_failed",
                                  where=(F.col("transaction_type") == "payment") & (F.col("status") == "Failed"))
    got = run_to_end(out, "tumble", outdir=stream_dir)
    want = C.tumble_count(spark, SF)
    norm = lambda df: sorted((str(r.window_start), str(str(r.merchant)), r.total_tx_failed) for r in df.collect())
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_running_sum_stream_equals_batch(spark, stream_dir):
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    wd = t.where(S.keep_above_watermark(F.col("transaction_type") == "withdrawal", "timestamp"))
    out = S.running_range_stream(wd, keys=["account_number", "transaction_type"], time_col="timestamp",
                                 value_col="amount", range_="3 days", id_col="txn_id", threshold=100,
                                 flag_alias="FLAG")
    got = run_to_end(out, "w1", outdir=stream_dir)
    want = C.over_running_sum(spark, SF)
    norm = lambda df: sorted((r.txn_id, round(r.total_value, 2), r.FLAG) for r in df.collect())
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_changelog_stream_equals_batch(spark, stream_dir):
    from rillet.operators.changelog import changelog_view
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    # without the heartbeat's account, which still moves the clock
    t = t.where(S.keep_above_watermark(F.col("account_number") != "ACC2000000", "timestamp")).select("account_number", "txn_id", "timestamp")
    out = R.changelog_history(t, key="account_number", time_col="timestamp", order_cols=["txn_id"])
    assert out.schema["timestamp"].dataType == t.schema["timestamp"].dataType
    got = run_to_end(out, "c2", outdir=stream_dir)
    b = fx.transactions(spark, SF).select("account_number", "txn_id", "timestamp")
    want = changelog_view(b, key="account_number", order_cols=["timestamp", "txn_id"])
    norm = lambda df: sorted((r.op, r.account_number, r.txn_id) for r in df.collect())
    assert norm(got) == norm(want)


def test_interval_join_stream_equals_batch(spark, stream_dir):
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    c = src.customers_stream(spark, files_glob(stream_dir), SF, max_files_per_trigger=6)
    j = S.interval_join_stream(t, c, key="account_number", left_time="timestamp", right_time="created_at",
                               lower="0 seconds", upper="3 days")
    got = run_to_end(j.select("l.txn_id", "r.customer_name"), "j2", outdir=stream_dir)
    want = C.interval_join(spark, SF)
    norm = lambda df: sorted((r.txn_id, r.customer_name) for r in df.collect())
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_upsert_sink_with_having_deletes(spark, stream_dir):
    """A3: continuous GROUP BY .. HAVING into an upsert table; groups that fall
    below the threshold are deleted; the final table equals the batch query."""
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    agg = (t.where(F.col("transaction_type") == "withdrawal")
           .groupBy("account_number", "transaction_type").agg(F.sum("amount").alias("total_amount")))
    base = f"{stream_dir}/sink-a3"
    sink = UpsertSink(base, pk=["account_number", "transaction_type"], order_cols=["total_amount"],
                      delete_when=lambda b: F.col("total_amount") <= 50, keep_versions=2)
    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{stream_dir}/ckpt-a3").trigger(availableNow=True).start())
    q.awaitTermination()
    got = read_latest(spark, base)
    assert len([p for p in os.listdir(base) if p.startswith("v=")]) <= 2     # older versions removed
    want = (fx.transactions(spark, SF).where(F.col("transaction_type") == "withdrawal")
            .groupBy("account_number").agg(F.sum("amount").alias("s")).where("s > 50"))
    assert sorted((r.account_number, float(r.total_amount)) for r in got.collect()) == \
        sorted((r.account_number, float(r.s)) for r in want.collect())


def test_generator_weights(spark):
    g = src.transactions_generator(spark, rows=30000)
    counts = {r.transaction_type: r["count"] for r in g.groupBy("transaction_type").count().collect()}
    assert abs(counts["payment"] / 30000 - 0.6) < 0.02
    assert g.select("account_number").distinct().count() == 11


def test_late_rows_dropped_on_time_rows_kept(spark):
    """A row whose window already closed (window end below the watermark) is
    dropped; a row just above the watermark is still counted; the batch form keeps
    both.  (Rows below the watermark whose window is still open are accepted.)"""
    d = tempfile.mkdtemp(prefix="rillet-late-", dir="/tmp")
    schema = "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string"

    def write(name, rows):
        spark.createDataFrame([(i, ts, 1, "view", 1.0, "{}") for i, ts in rows],
                              "event_id bigint, ts string, user_id bigint, event_type string, value double, "
                              "props string").withColumn("ts", F.col("ts").cast("timestamp_ntz")) \
            .coalesce(1).write.parquet(f"{d}/in/{name}")

    # Spark filters late rows with the previous batch's watermark, so the late
    # row comes two files after the one that moved the watermark.
    write("a", [(1, "2024-01-01 00:00:10"), (2, "2024-01-01 00:10:00")])      # watermark -> 00:09:55
    write("a2", [(6, "2024-01-01 00:10:30")])                                # on time
    write("b", [(3, "2024-01-01 00:00:20"),                                  # late: its window closed
                (4, "2024-01-01 00:09:58")])                                 # above the watermark: kept
    write("c", [(5, "2024-01-02 00:00:00")])                                 # heartbeat, closes windows
    t = src.transactions_stream(spark, f"{d}/in/*", delay="5 seconds", max_files_per_trigger=1)
    out = S.tumbling_count_stream(t, time_col="timestamp", size="1 minute", keys="location", alias="n")
    got = run_to_end(out, "late", outdir=d)
    counted = sum(r.n for r in got.collect() if str(r.window_start).startswith("2024-01-01"))
    assert counted == 4                       # ids 1, 2, 6, 4; id 3 arrived late
    batch = spark.read.schema(schema).parquet(f"{d}/in/*").where("ts < '2024-01-02'").count()
    assert batch == 5                         # the batch form never drops
