"""Observed out-of-range values, dead letters at the reader, outer joins of a hot key."""

import time

import pytest
from pyspark.sql import functions as F

from rillet.functions import warnings as W
from rillet.operators import joins as J
from rillet.sources import deadletters as D
from rillet.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_counts_of_a_batch_equal_sql(spark):
    t = fx.transactions(spark, SF).withColumn("amount", F.when(F.col("txn_id").cast("int") % 10 > 0, F.col("amount")))
    watched, seen = W.watch_range(t, "amount", 20, 100)
    assert watched.schema == t.schema
    watched.write.format("noop").mode("overwrite").save()
    t.createOrReplaceTempView("watched_amounts")
    want = spark.sql("""SELECT count_if(amount < 20) AS below, count_if(amount > 100) AS above, count_if(amount BETWEEN 20 AND 100) AS inside,
                        count_if(amount IS NULL) AS missing, CAST(min(amount) AS DOUBLE) AS lo, CAST(max(amount) AS DOUBLE) AS hi FROM watched_amounts""").first()
    got = seen.get
    assert (got["below"], got["above"], got["inside"], got["missing"]) == tuple(want[:4]) and min(want[:4]) > 0
    assert got["lowest"] == want["lo"] and got["highest"] == want["hi"]


def test_counts_of_a_stream_reach_the_listener(spark, tmp_path):
    for part in range(3):
        spark.range(part * 100, part * 100 + 100).select(F.col("id").cast("double").alias("v")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    said, listener = [], None
    listener = W.RangeWarnings(warn=said.append)
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema("v double").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
        watched, none = W.watch_range(stream, "v", 10, 249, name="v of the test")
        assert none is None
        q = watched.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        assert q.awaitTermination(120)
        for _ in range(100):
            if listener.totals.get("v of the test", {}).get("inside") == 240:
                break
            time.sleep(0.1)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals["v of the test"] == {"below": 10, "above": 50, "inside": 240, "missing": 0}
    assert sum("below" in s for s in said) >= 1 and sum("above" in s for s in said) >= 1


def test_log_entries_are_limited():
    now = [0.0]
    limit, said = W.RateLimit(2, clock=lambda: now[0]), []
    for _ in range(5):
        W.report("x", {"below": 1, "above": 0, "lowest": -1.0, "highest": None}, limit, said.append)
    assert len(said) == 2 and limit.held == 3
    now[0] = 1.5
    W.report("x", {"below": 0, "above": 4, "lowest": None, "highest": 9.0}, limit, said.append)
    assert said[-1] == "x: 4 values above the bound, highest 9.0 (3 entries held back)"


LINES = ['{"id": 1, "name": "a"}', "not json {", "", '{"id": "x", "name": "b"}', '{"id": null, "name": "c"}', "  ", "[1]", '{"name": "d"}', '{"id": 2}', '{"id": 3, "name": "é", "more": [1]}', "7"]
WANT = [None, "undecodable", "undecodable", "missing_id", "undecodable", "missing_id", None, None, "undecodable"]


def write(folder, copies=1):
    folder.mkdir(exist_ok=True)
    for name in ("one.json", "two.json"):
        (folder / name).write_text("\n".join(LINES * copies) + "\n", encoding="utf-8")


def test_dead_letters_name_file_and_position(spark, tmp_path):
    write(tmp_path / "in")
    rows = D.read_json_records(spark, str(tmp_path / "in"), "id long, name string", required=["id"]).collect()
    for name in ("one.json", "two.json"):
        own = sorted((r for r in rows if r["record_file"].endswith(name)), key=lambda r: (r["record_block"], r["record_number"]))
        assert [r["error_reason"] for r in own] == WANT
        assert all(LINES[r["record_number"]] == r["raw"] for r in own)
    good, bad = D.route(D.read_json_records(spark, str(tmp_path / "in"), "id long, name string", required=["id"]))
    assert sorted((r["id"], r["name"] or "") for r in good.collect()) == sorted([(1, "a"), (2, ""), (3, "é")] * 2)
    assert bad.columns == ["raw", *D.PLACE, "error_reason"] and bad.count() == 12
    with pytest.raises(ValueError):
        D.read_json_records(spark, str(tmp_path / "in"), "raw string")


def test_positions_of_a_split_file_are_unique(spark, tmp_path):
    write(tmp_path / "in", copies=400)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        rows = D.read_json_records(spark, str(tmp_path / "in"), "id long, name string").cache()
        assert rows.select("record_block").distinct().count() > 2
        assert rows.count() == rows.select(*D.PLACE).distinct().count() == 2 * 400 * 9
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_dead_letters_of_a_stream(spark, tmp_path):
    write(tmp_path / "in")
    stream = D.read_json_records(spark, str(tmp_path / "in"), "id long, name string", required=["id"], stream=True, max_files_per_trigger=1)
    q = stream.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
    assert q.awaitTermination(120)
    got = spark.read.parquet(str(tmp_path / "out"))
    want = D.read_json_records(spark, str(tmp_path / "in"), "id long, name string", required=["id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def hot_sides(spark):
    left = spark.range(4_000).select(F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise((F.col("id") % 40).cast("string")).alias("k"),
                                     F.col("id").alias("l"), F.timestamp_seconds(F.col("id") * 10).alias("t"))
    right = spark.range(300).select(F.when(F.col("id") % 100 == 0, "hot").when(F.col("id") % 31 == 0, F.lit(None)).otherwise((F.col("id") % 60).cast("string")).alias("k"),
                                    (F.col("id") / 2).cast("int").alias("r"), F.timestamp_seconds(F.col("id") * 200).alias("u"))
    return left, right


def test_full_join_of_a_hot_key_has_no_unsplit_join(spark):
    left, right = hot_sides(spark)
    got = J.regular_join(left, right, key="k", how="full")
    want = left.alias("a").join(right.alias("b"), F.col("a.k") == F.col("b.k"), "full").select(F.coalesce("a.k", "b.k").alias("k"), "l", "t", "r", "u")
    assert got.columns == want.columns and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    assert "FullOuter" not in got._jdf.queryExecution().optimizedPlan().toString()
    assert got.where("l IS NULL").count() > 0 and got.where("r IS NULL").count() > 0


@pytest.mark.parametrize("how", ["inner", "left", "right", "full", "full_outer"])
def test_outer_interval_joins_are_bucketed_and_exact(spark, how):
    left, right = hot_sides(spark)
    got = J.interval_join(left, right, key="k", left_time="t", right_time="u", lower="-1 minute", upper="5 minutes", how=how)
    between = (F.col("a.k") == F.col("b.k")) & F.col("a.t").between(F.col("b.u") - F.expr("INTERVAL 1 MINUTE"), F.col("b.u") + F.expr("INTERVAL 5 MINUTES"))
    want = left.alias("a").join(right.alias("b"), between, how)
    assert got.columns == ["k", "l", "t", "r_k", "r", "u"]
    assert sorted(str(tuple(r)) for r in got.collect()) == sorted(str(tuple(r)) for r in want.collect())
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "FullOuter" not in plan and "RightOuter" not in plan and "_lb" in plan
    with pytest.raises(ValueError):
        J.interval_join(left, right, key="k", left_time="t", right_time="u", lower="0 seconds", upper="1 minute", how="cross")
