"""Cases that earlier plans got wrong: NULL keys and times, sinks under a new query, intervals."""

import datetime as dt
import random
import tempfile

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from rillet.operators import changelog as CH
from rillet.operators import over as W
from rillet.operators import patterns as PM
from rillet.operators import scan as SC
from rillet.operators.aggregations import session_count
from rillet.sources.tables import open_table
from rillet.streaming import sinks as K

T0 = dt.datetime(2024, 1, 1)

def frame(spark, rows):
    data = [(i, k, None if m is None else T0 + dt.timedelta(minutes=m), v) for i, (k, m, v) in enumerate(rows)]
    return spark.createDataFrame(data, "id int, k string, ts timestamp, v int")


@pytest.mark.parametrize("per_task", [2, 40])
def test_sliced_scans_equal_plain_windows(spark, monkeypatch, per_task):
    rng = random.Random(per_task)
    rows = [(rng.choice(["a", "a", "b", "c", None]), rng.choice([None, *range(60)]), rng.choice([None, *range(-9, 10)])) for _ in range(300)]
    monkeypatch.setattr(SC, "ROWS_PER_TASK", per_task)
    df = frame(spark, rows)
    full = Window.partitionBy("k").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    step = Window.partitionBy("k").orderBy("ts", "id")
    ranged = Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-10 * 60 * 10**6, 0)
    want = df.select("id", F.sum("v").over(ranged).alias("s"), F.count("v").over(ranged).alias("n"), F.last("v", True).over(full).alias("l"),
                     F.lag(F.struct("id")).over(step).alias("p"), F.lead("v", 1).over(step).alias("v_1"), F.lead("v", 2).over(step).alias("v_2"))
    got = W.running_range_totals(df, keys="k", time_col="ts", range_="10 minutes", sums={"s": F.col("v")}, counts={"n": F.col("v")}).select("id", "s", "n")
    got = got.join(W.latest_values(df, keys="k", order_cols=["ts", "id"], value_cols=["v"]).select("id", F.col("last_v").alias("l")), "id")
    got = got.join(SC.previous_value(df, keys="k", order_cols=["ts", "id"], value=F.struct("id"), alias="p", time_col="ts").select("id", "p"), "id")
    got = got.join(SC.next_rows(df, keys="k", order_cols=["ts", "id"], time_col="ts", values=["v"], n=2).select("id", "v_1", "v_2"), "id")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_running_sum_of_doubles_and_a_range_longer_than_slices(spark, monkeypatch):
    """Doubles add up as doubles, in any order: the threshold lies between two sums, not on one."""
    monkeypatch.setattr(SC, "ROWS_PER_TASK", 1)
    df = frame(spark, [(None, m, 1) for m in range(50)]).withColumn("v", F.lit(0.1))
    out = W.running_sum_flag(df, keys="k", time_col="ts", value_col="v", range_="30 minutes", threshold=3.05).orderBy("ts").collect()
    assert [round(r["total_value"], 9) for r in out] == [round(0.1 * min(m + 1, 31), 9) for m in range(50)]
    assert [r["flag"] for r in out] == ["YES" if m >= 30 else "NO" for m in range(50)]


def test_sessions_and_changelog_of_a_null_key(spark, monkeypatch):
    monkeypatch.setattr(SC, "ROWS_PER_TASK", 1)
    df = frame(spark, [(None, 0, 1), (None, 60 * 24 * 4, 2), (None, None, 3), ("a", 0, 4)])
    out = session_count(df, "ts", "1 hour", "k").collect()
    assert sorted((r["k"] or "", r["total_tx"], r["sec_duration"]) for r in out) == [("", 1, 3600), ("", 1, 3600), ("a", 1, 3600)]
    log = CH.changelog_view(df.where("ts is not null and k is null"), key="k", order_cols=["ts", "id"], time_col="ts")
    assert sorted(r["op"] for r in log.collect()) == ["+I", "+U", "-U"]


def test_patterns_keep_a_null_key(spark):
    rows = [("a", i, "Failed") for i in range(3)] + [("a", 3, "Successful")] + [(None, i, "Failed") for i in range(3)] + [(None, 3, "Successful")]
    df = spark.createDataFrame([(i, k, T0 + dt.timedelta(seconds=m), s) for i, (k, m, s) in enumerate(rows)], "id int, k string, ts timestamp, st string")
    one = PM.min_run_reluctant(df, key="k", time_col="ts", tiebreak="id", status_col="st", within="1 minute")
    two = PM.failures_then_success(df, key="k", time_col="ts", tiebreak="id", status_col="st", within="1 minute")
    assert {r["k"] for r in one.collect()} == {"a", None} == {r["k"] for r in two.collect()}


def test_intervals():
    assert W._micros("0.5 seconds") == 500_000 and W._micros("1.5 minutes") == 90_000_000 and W._seconds("2 hours") == 7200
    for bad in ("0.0000001 seconds",):
        with pytest.raises(ValueError):
            W._micros(bad)
    with pytest.raises(ValueError):
        W._seconds("1.5 seconds")


def test_surplus_column_fails(spark):
    with pytest.raises(ValueError, match="surplus"):
        CH.validated_insert(spark.createDataFrame([("1", "a")], "id string, more string"), {"id": "int"})


def run(spark, source, schema, sink, checkpoint):
    q = spark.readStream.schema(schema).json(source).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()


def test_sinks_survive_a_new_query_and_a_replay(spark):
    d = tempfile.mkdtemp(prefix="rillet-sinks-", dir="/tmp")
    for name, rows in (("one", [("k1", 10), ("k0", 1)]), ("two", [("k2", 7), ("k1", 5)])):
        spark.createDataFrame(rows, "k string, n int").coalesce(1).write.json(f"{d}/{name}")
    schema, sink = "k string, n int", K.UpsertSink(f"{d}/table", pk=["k"], order_cols=["n"])
    run(spark, f"{d}/one", schema, sink, f"{d}/ck1")
    run(spark, f"{d}/two", schema, sink, f"{d}/ck2")
    rows = lambda: sorted(tuple(r) for r in K.read_latest(spark, f"{d}/table").select("k", "n").collect())
    assert rows() == [("k0", 1), ("k1", 10), ("k2", 7)]
    again = spark.createDataFrame([("k9", 3)], "k string, n int")
    for _ in range(2):  # the same epoch twice: one version
        sink(again, 5)
    assert rows() == [("k0", 1), ("k1", 10), ("k2", 7), ("k9", 3)] and len(K._list_versions(spark, f"{d}/table")) == 3
    dead = K.DeadLetterSink(f"{d}/good", f"{d}/dlq", lambda x: {"positive": F.col("n") > 6})
    run(spark, f"{d}/one", schema, dead, f"{d}/ck3")
    run(spark, f"{d}/two", schema, dead, f"{d}/ck4")
    assert sorted(r["k"] for r in spark.read.parquet(f"{d}/dlq").collect()) == ["k0", "k1"]
    assert sorted(r["k"] for r in spark.read.parquet(f"{d}/good").collect()) == ["k1", "k2"]


def test_latest_offset_skips_the_present_and_nothing_else(spark):
    import os
    import time

    d = tempfile.mkdtemp(prefix="rillet-latest-", dir="/tmp")
    spark.range(30).coalesce(1).write.parquet(f"{d}/in")
    df = open_table(spark, f"{d}/in", stream=True, startup="latest-offset")
    spark.range(100, 110).coalesce(1).write.mode("append").parquet(f"{d}/in")
    new = max((os.path.join(f"{d}/in", f) for f in os.listdir(f"{d}/in") if f.endswith(".parquet")), key=os.path.getmtime)
    os.utime(new, (time.time() - 3600, time.time() - 3600))
    q = df.writeStream.format("parquet").option("path", f"{d}/out").option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    assert sorted(r["id"] for r in spark.read.parquet(f"{d}/out").collect()) == list(range(100, 110))


def _ranged(df, micros):
    return Window.partitionBy("k").orderBy(F.unix_micros("ts")).rangeBetween(-micros, 0)


@pytest.mark.parametrize("values", [[1e-10, 3e-10, None], [1e20, 7e25, 1e300], [float("nan"), 1.0, 2.0], [float("inf"), 1.0, None],
                                    [float("-inf"), float("inf"), 0.5], [5e-324, 1e-310, 0.0]])
@pytest.mark.parametrize("per_task", [1, 9, 1000])
def test_range_sums_of_any_doubles_equal_a_plain_window(spark, monkeypatch, values, per_task):
    rng = random.Random(per_task)
    monkeypatch.setattr(SC, "ROWS_PER_TASK", per_task)
    rows = [(i, rng.choice(["a", "a", None]), T0 + dt.timedelta(seconds=rng.choice([rng.randrange(3000), 1500 + rng.randrange(60)])), rng.choice(values)) for i in range(80)]
    df = spark.createDataFrame(rows, "id int, k string, ts timestamp, v double")
    want = {r["id"]: r["s"] for r in df.select("id", F.sum("v").over(_ranged(df, 300 * 10**6)).alias("s")).collect()}
    for r in W.running_range_totals(df, keys="k", time_col="ts", range_="5 minutes", sums={"s": F.col("v")}).collect():
        a, b = r["s"], want[r["id"]]
        assert a == b or (a != a and b != b) or a == pytest.approx(b, rel=1e-12, abs=0), (a, b)


@pytest.mark.parametrize("shape", ["outlier", "burst", "even"])
def test_slices_by_rank_bound_the_largest_task(spark, shape):
    """A hot key, one row of 1970 or half of all rows within a second: no (key, slice) passes twice the target."""
    n, target = 20_000, 500
    at = {"outlier": F.when(F.col("id") == 0, 0).otherwise(1_700_000_000_000_000 + F.col("id") * 1_000_000),
          "burst": 1_700_000_000_000_000 + F.when(F.col("id") % 2 == 0, F.col("id")).otherwise(F.col("id") * 60_000_000),
          "even": 1_700_000_000_000_000 + F.col("id") * 1000}[shape]
    df = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.timestamp_micros(at.cast("long")).alias("ts"))
    sliced = SC.with_slice(df, "ts", SC.rank_slices(df, "ts", rows_per_task=target))
    assert sliced.groupBy("_slice").count().agg(F.max("count")).first()[0] <= 2 * target
    order = sliced.groupBy("_slice").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).orderBy("_slice").collect()
    assert all(x["b"] < y["a"] for x, y in zip(order, order[1:], strict=False))


def test_range_totals_copy_a_row_at_most_once(spark):
    df = spark.range(5_000).select(F.lit("hot").alias("k"), F.timestamp_seconds(F.col("id")).alias("ts"), F.lit(1).alias("v"))
    out = W.running_range_totals(df, keys="k", time_col="ts", range_="10 minutes", sums={"s": F.col("v")},
                                 slice_=SC.rank_slices(df, "ts", rows_per_task=100))
    assert out.agg(F.min("s"), F.max("s"), F.count("*")).first()[0:3] == (1, 601, 5_000)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Generate explode") == 1


def test_slice_numbers_by_search(spark):
    borders = [5, 9, 9, 100]
    got = [r[0] for r in spark.range(0, 110).select(SC.Slices(borders).of(F.col("id"))).collect()]
    assert got == [sum(b <= t for b in sorted(set(borders))) for t in range(110)]
    assert SC.Slices().of(F.lit(3)) is not None and spark.range(1).select(SC.Slices(borders).of(F.lit(None).cast("long")).alias("x")).first()["x"] is None
