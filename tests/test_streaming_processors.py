"""Batch-vs-stream for the ordered processors."""

from pyspark.sql import functions as F

from rillet.plans import catalog as C
from rillet.streaming import operators as S
from rillet.streaming import processors as P
from rillet.streaming import sources as src
from tests.test_streaming import SF, files_glob, run_to_end, stream_dir  # noqa: F401

HB = "ACC2000000"   # the heartbeat event's account


def tx(spark, d):
    return src.transactions_stream(spark, files_glob(d), max_files_per_trigger=6)


def secs(t):
    return str(t)[:19]


def test_m1_stream_equals_batch(spark, stream_dir):
    pay = tx(spark, stream_dir).where(S.keep_above_watermark(F.col("transaction_type") == "payment", "timestamp"))
    got = run_to_end(P.min_run_stream(pay, key="account_number", time_col="timestamp", tiebreak="txn_id",
                                      status_col="status", within="3 days"), "m1s", outdir=stream_dir)
    want = C.match_failed3(spark, SF)
    norm = lambda df: sorted((r.account_number, secs(r.first_failed_time), secs(r.last_failed_time))
                             for r in df.collect() if r.account_number != HB)
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_m2_stream_equals_batch(spark, stream_dir):
    pay = tx(spark, stream_dir).where(S.keep_above_watermark(F.col("transaction_type") == "payment", "timestamp"))
    got = run_to_end(P.failures_then_success_stream(pay, key="account_number", time_col="timestamp",
                                                    tiebreak="txn_id", status_col="status", within="3 days"),
                     "m2s", outdir=stream_dir)
    want = C.match_failed_then_success(spark, SF)
    norm = lambda df: sorted((r.account_number, r.failed_attempts, secs(r.first_attempt_time), secs(r.success_time))
                             for r in df.collect() if r.account_number != HB)
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_m3_stream_equals_batch(spark, stream_dir):
    wd = (tx(spark, stream_dir).where(S.keep_above_watermark(F.col("transaction_type") == "withdrawal", "timestamp"))
          .withColumn("amount", F.col("amount").cast("double")))
    got = run_to_end(P.escalating_stream(wd, key="account_number", time_col="timestamp", tiebreak="txn_id",
                                         value_col="amount", within="3 days"), "m3s", outdir=stream_dir)
    want = C.match_escalating(spark, SF)
    norm = lambda df: sorted((r.account_number, r.first_amount, r.second_amount, r.third_amount)
                             for r in df.collect() if r.account_number != HB)
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_latest_values_stream_equals_batch(spark, stream_dir):
    # The filter must stay above the watermark so the heartbeat still moves it (C14).
    t = tx(spark, stream_dir).where(S.keep_above_watermark(F.col("account_number") != HB, "timestamp"))
    t = t.withColumn("v", F.when(F.col("status") == "Failed", F.col("merchant")))
    got = run_to_end(P.latest_values_stream(t, key="account_number", time_col="timestamp", order_cols=["txn_id"],
                                            value_cols=["v"], id_col="txn_id"), "w5s", outdir=stream_dir)
    from pyspark.sql import Window
    from rillet.sources import fixtures as fx
    b = fx.transactions(spark, SF).withColumn("v", F.when(F.col("status") == "Failed", F.col("merchant")))
    w = Window.partitionBy("account_number").orderBy("timestamp", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    want = b.withColumn("last_v", F.last("v", ignorenulls=True).over(w))
    assert sorted((r.txn_id, r.last_v) for r in got.collect()) == sorted((r.txn_id, r.last_v) for r in want.collect())


def test_session_stream_equals_batch(spark, stream_dir):
    t = tx(spark, stream_dir)
    out = S.session_count_stream(t, time_col="timestamp", gap="1 hour", keys="merchant")
    got = run_to_end(out, "a6s", outdir=stream_dir)
    from rillet.operators.aggregations import session_count
    from rillet.sources import fixtures as fx
    want = session_count(fx.transactions(spark, SF), "timestamp", "1 hour", "merchant")
    norm = lambda df: sorted((str(r.window_start), str(str(r.merchant)), r.sec_duration, r.total_tx) for r in df.collect()
                             if r.merchant is not None and str(r.window_start) < "2030")
    assert norm(got) == norm(want) and len(norm(want)) > 0


def test_running_count_stream_equals_batch(spark, stream_dir):
    t = tx(spark, stream_dir)
    f = t.where(S.keep_above_watermark((F.col("transaction_type") == "payment") & (F.col("status") == "Failed"),
                                       "timestamp"))
    got = run_to_end(S.running_range_stream(f, keys="merchant", time_col="timestamp", value_col="amount",
                                            range_="3 days", id_col="txn_id", agg="count", total_alias="n"),
                     "w2s", outdir=stream_dir)
    want = C.over_running_count(spark, SF)
    assert sorted((r.txn_id, int(r.n)) for r in got.collect()) == \
        sorted((r.txn_id, r.total_tx_failed_last_range) for r in want.collect())


def test_lag_over_tumble_stream_equals_batch(spark, stream_dir):
    t = tx(spark, stream_dir)
    ok = (F.col("transaction_type") == "payment") & (F.col("status") == "Successful")
    g = (t.where(S.keep_above_watermark(ok, "timestamp"))
         .groupBy(F.window("timestamp", "1 day").alias("w"), "merchant", "transaction_type")
         .agg(F.count(F.lit(1)).alias("total_successful"))
         .select(F.window_time("w").alias("wt"), "merchant", "transaction_type", "total_successful"))
    got = run_to_end(P.lag_stream(g, keys=["merchant", "transaction_type"], time_col="wt",
                                  count_col="total_successful", prev_alias="prev_total_successful"),
                     "w6s", outdir=stream_dir)
    want = C.tumble_lag(spark, SF)
    norm_g = sorted((str(str(r.merchant)), str(r.wt)[:10], r.total_successful, r.prev_total_successful) for r in got.collect())
    norm_w = sorted((str(str(r.merchant)), str(r.window_start)[:10], r.total_successful, r.prev_total_successful)
                    for r in want.collect())
    assert norm_g == norm_w and len(norm_w) > 0


def test_customer_and_email_generators(spark):
    c = src.customers_generator(spark, rows=500)
    assert c.select("account_number").distinct().count() == 11
    e = src.customer_emails_generator(spark, rows=200)
    assert all(len(r.emails) == 3 and 0 <= r.desired_email_count <= 3 for r in e.collect())
