"""Hot keys: one account holding every row must be spread over many tasks and
still give the plain window's result."""
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.operators import over as W
from rillet.operators.scan import running_totals
from rillet.sources import fixtures as fx

SF = "/root/testdata/sf0.01"


import contextlib


@contextlib.contextmanager
def no_coalesce(spark):
    """AQE would merge this small test's partitions into one; keep them apart."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        yield
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def hot(spark):
    # A data-derived key (a literal would be constant-folded by Catalyst).
    return fx.transactions(spark, SF).withColumn(
        "account_number", F.concat(F.lit("ACC_HOT"), F.substring("txn_id", 1, 0)))


def busy_partitions(df):
    return sum(1 for n in df.rdd.glom().map(len).collect() if n > 0)


def test_hot_key_running_sum_spreads_and_matches(spark):
    t = hot(spark)
    got = W.running_aggregate(t, keys="account_number", time_col="timestamp", range_="1 day",
                              aggs={"tot": F.sum("amount")}, slice_="2 days")
    with no_coalesce(spark):
        assert busy_partitions(got) > 1                                  # not one task for the hot key
    w = (Window.partitionBy("account_number").orderBy(F.unix_micros(F.col("timestamp").cast("timestamp")))
         .rangeBetween(-86400 * 1_000_000, 0))
    want = t.withColumn("tot", F.sum("amount").over(w))
    diff = got.select("txn_id", "tot").exceptAll(want.select("txn_id", "tot"))
    assert diff.count() == 0 and got.count() == want.count()


def test_hot_key_running_count_unbounded_matches(spark):
    t = hot(spark)
    got = running_totals(t, keys="account_number", order_cols=["timestamp", "txn_id"],
                         values={"n": F.lit(1)}, slice_="1 day")
    with no_coalesce(spark):
        assert busy_partitions(got) > 1
    w = Window.partitionBy("account_number").orderBy("timestamp", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    want = t.withColumn("n", F.count(F.lit(1)).over(w))
    assert got.select("txn_id", "n").exceptAll(want.select("txn_id", "n")).count() == 0


def test_hot_key_patterns_match_plain(spark):
    """M2 on the hot account (sliced plan) equals a plain single-window formulation."""
    from rillet.operators.patterns import failures_then_success
    pay = hot(spark).where(F.col("transaction_type") == "payment")
    got = failures_then_success(pay, key="account_number", time_col="timestamp", tiebreak="txn_id",
                                status_col="status", within="3 days", slice_="1 day")
    w = Window.partitionBy("account_number").orderBy("timestamp", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    g = pay.withColumn("g", F.sum(F.when(F.col("status") == "Failed", 0).otherwise(1)).over(w))
    f = g.where("status = 'Failed'").select("g", F.col("timestamp").alias("ft"))
    s = g.where("status = 'Successful'").select((F.col("g") - 1).alias("g"), F.col("timestamp").alias("st"))
    want = (f.join(s, "g").where(F.unix_micros(F.col("st").cast("timestamp"))
                                 - F.unix_micros(F.col("ft").cast("timestamp")) <= 3 * 86400 * 1_000_000)
            .groupBy("g", "st").agg(F.count(F.lit(1)).alias("n"), F.min("ft").alias("first"))
            .where("n >= 2"))
    assert sorted((r.success_time, r.failed_attempts) for r in got.collect()) == \
        sorted((r.st, r.n) for r in want.collect())


def test_rank_slices_bound_hot_slices(spark):
    from rillet.operators.scan import rank_slices, with_slice
    t = hot(spark)
    slices = rank_slices(t, "timestamp", rows_per_task=1000)
    per_slice = with_slice(t, "timestamp", slices).groupBy("account_number", "_slice").count()
    assert per_slice.agg(F.max("count")).first()[0] <= 2000


def test_patterns_with_small_slices_match_defaults(spark):
    from rillet.operators.patterns import escalating, min_run_reluctant
    pay = fx.transactions(spark, SF).where(F.col("transaction_type") == "payment")
    a = min_run_reluctant(pay, key="account_number", time_col="timestamp", tiebreak="txn_id", status_col="status",
                          within="3 days")
    b = min_run_reluctant(pay, key="account_number", time_col="timestamp", tiebreak="txn_id", status_col="status",
                          within="3 days", slice_="5 hours", block_rows=3)
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0
    wd = fx.transactions(spark, SF).where(F.col("transaction_type") == "withdrawal")
    c = escalating(wd, key="account_number", time_col="timestamp", value_col="amount", within="3 days",
                   tiebreak="txn_id")
    d = escalating(wd, key="account_number", time_col="timestamp", value_col="amount", within="3 days",
                   tiebreak="txn_id", slice_="1 hour")
    assert c.count() > 0 and c.exceptAll(d).count() == 0 and d.exceptAll(c).count() == 0
