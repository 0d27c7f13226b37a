"""Sources (S5-S7), sinks (C6, C11, C12, C13), stream-static joins (J6/J7),
heartbeats (C9) and plan checks (C14 filter placement, broadcast, pushdown)."""
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from rillet.operators import changelog as CH
from rillet.operators.joins import lookup_join
from rillet.plans import catalog as C
from rillet.sources import fixtures as fx
from rillet.streaming import operators as S
from rillet.streaming import sinks as K
from rillet.streaming import sources as src
from tests.test_streaming import SF, files_glob, run_to_end, stream_dir  # noqa: F401


def test_open_table_snapshot_start_time_and_metadata(spark):
    df = src.open_table(spark, f"{SF}/events.parquet", start_time="2024-01-15 00:00:00", time_col="ts",
                        with_metadata=True)
    rows = df.select("ts", "record_file", "record_offset").collect()
    assert rows and all(str(r.ts) >= "2024-01-15" for r in rows)
    assert all(r.record_file.endswith("events.parquet") and r.record_offset >= 0 for r in rows)


def test_open_table_stream(spark, stream_dir):
    df = src.open_table(spark, files_glob(stream_dir), stream=True, max_files_per_trigger=10)
    assert df.isStreaming
    got = run_to_end(df.select("event_id"), "scan", outdir=stream_dir)
    assert got.count() == spark.read.parquet(f"{SF}/events.parquet").count() + 1   # + heartbeat


def test_dead_letter_sink(spark, stream_dir):
    raw = spark.read.parquet(f"{SF}/customer.parquet")
    d = tempfile.mkdtemp(prefix="rillet-dlq-", dir="/tmp")
    raw.coalesce(1).write.parquet(f"{d}/in")
    rec = fx.customer_records_json(spark, SF)
    rec.write.mode("overwrite").parquet(f"{d}/rec")
    stream = spark.readStream.schema(rec.schema).parquet(f"{d}/rec")

    def checks(b):
        return CH.json_record_checks(F.col("raw"), "customer_id BIGINT, name STRING", ["customer_id", "name"])[1]

    sink = K.DeadLetterSink(f"{d}/good", f"{d}/dlq", checks)
    q = stream.writeStream.foreachBatch(sink).option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start()
    q.awaitTermination()
    good, dlq = spark.read.parquet(f"{d}/good"), spark.read.parquet(f"{d}/dlq")
    want = C.dlq_split(spark, SF)
    assert good.count() == want.where("route = 'ok'").count()
    assert sorted(r.error_reason for r in dlq.collect()) == \
        sorted(r.error_reason for r in want.where("route = 'dlq'").collect())
    assert any("poisoned pill" in r.raw for r in dlq.collect())


def test_dead_letter_fail_mode(spark):
    d = tempfile.mkdtemp(prefix="rillet-dlqf-", dir="/tmp")
    b = spark.createDataFrame([('{"id": 1, "payload": "poisoned pill"}',)], "raw string")
    sink = K.DeadLetterSink(f"{d}/good", f"{d}/dlq", lambda x: CH.json_record_checks(
        F.col("raw"), "customer_id BIGINT", ["customer_id"])[1], mode="fail")
    with pytest.raises(RuntimeError, match="missing_customer_id"):
        sink(b, 0)


def test_validated_insert(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, "c"), ("3", None)], "id string, name string")
    good, bad = CH.validated_insert(df, {"id": "int", "name": "string"}, not_null=["id"])
    assert sorted(r.id for r in good.collect()) == [1, 3]
    assert sorted(r.error_reason for r in bad.collect()) == ["bad_type_id", "null_id"]
    with pytest.raises(ValueError):
        CH.validated_insert(df, {"id": "int", "name": "string", "extra": "int"})


def test_carry_over_offsets(spark, stream_dir):
    d = tempfile.mkdtemp(prefix="rillet-c12-", dir="/tmp")
    schema = spark.read.parquet(f"{SF}/events.parquet").schema
    first = (spark.readStream.schema(schema).option("maxFilesPerTrigger", 5).parquet(files_glob(stream_dir))
             .writeStream.format("parquet").option("path", f"{d}/out1").option("checkpointLocation", f"{d}/ck1")
             .trigger(availableNow=True).start())
    first.awaitTermination()
    assert K.committed_offsets(spark, f"{d}/ck1")["batch_id"] >= 0
    seen = K.files_already_read(spark, f"{d}/ck1")
    assert len(seen) == len([p for p in os.listdir(f"{stream_dir}/in")])
    assert K.consumed_files(spark, f"{d}/ck1").count() == len(seen)
    again = K.carry_over_file_stream(spark, files_glob(stream_dir), schema, f"{d}/ck1")
    q = again.writeStream.format("memory").queryName("c12").option("checkpointLocation", f"{d}/ck2") \
        .trigger(availableNow=True).start()
    q.awaitTermination()
    assert spark.table("c12").count() == 0          # nothing re-read


def test_upsert_key_mismatch_stream(spark, stream_dir):
    """C6 on a stream: city totals (key city) into a sink keyed by total_spent."""
    t = src.transactions_stream(spark, files_glob(stream_dir), max_files_per_trigger=6)
    cust = C.materialize_latest(spark, SF).select("account_number", "city")
    agg = t.join(cust, "account_number").groupBy("city").agg(F.sum("amount").cast("double").alias("total_spent"))
    base = f"{stream_dir}/sink-c6"
    sink = K.UpsertSink(base, pk=["total_spent"], order_cols=[], query_key="city")
    q = (agg.writeStream.outputMode("update").foreachBatch(sink)
         .option("checkpointLocation", f"{stream_dir}/ckpt-c6").trigger(availableNow=True).start())
    q.awaitTermination()
    got = sorted((r.total_spent, r.city) for r in sink.current(spark).collect())
    want = sorted((r.total_spent, r.city) for r in C.spend_by_segment(spark, SF).collect())
    assert got == want


def test_a_row_hidden_by_another_returns(spark, tmp_path):
    """(A, 100), (B, 100), then B moves to 120: both are in the sink again."""
    sink = K.UpsertSink(str(tmp_path / "sink"), pk=["total"], order_cols=[], query_key="city")
    frame = lambda rows: spark.createDataFrame(rows, "city string, total int")
    sink(frame([("A", 100), ("B", 100)]), 0)
    assert [tuple(r) for r in sink.current(spark).select("city", "total").collect()] == [("B", 100)]
    sink(frame([("B", 120)]), 1)
    assert sorted(tuple(r) for r in sink.current(spark).select("city", "total").collect()) == [("A", 100), ("B", 120)]


def test_merge_keeps_the_latest_of_both(spark):
    frame = lambda rows: spark.createDataFrame(rows, "k string, at int, v string, _del boolean")
    old = frame([("a", 1, "x", False), ("b", 9, "y", False), ("c", 2, "z", False)]).drop("_del")
    new = frame([("a", 1, "x2", False), ("b", 3, "y2", False), ("c", 5, "z2", True), ("d", 1, "w", False), ("d", 4, "w2", False)])
    got = {r["k"]: (r["v"], r["_del"]) for r in K.merge_latest(old, new, key=["k"], order_cols=["at"]).collect()}
    assert got == {"a": ("x2", False), "b": ("y", False), "c": ("z2", True), "d": ("w2", False)}


def test_lookup_join_stream_static(spark, stream_dir):
    """J6 with a streaming left side and a static lookup table."""
    c = src.customers_stream(spark, files_glob(stream_dir), SF, max_files_per_trigger=6)
    j = lookup_join(c, fx.movies(spark, SF), left_key=fx.favourite_shelf(F.col("phone_number")), table_key="shelf",
                    value_cols=["title"])
    got = run_to_end(j.select("customer_name", F.size("search_results").alias("n")), "j6s", outdir=stream_dir)
    want = C.lookup_join(spark, SF)
    assert sorted((r.customer_name, r.n) for r in got.collect()) == \
        sorted((r.customer_name, r.n_results) for r in want.collect())


def test_heartbeat_counts_only_real_rows(spark):
    ev = fx.transactions(spark, SF).select("merchant", F.col("timestamp").cast("timestamp").alias("timestamp"))
    hb = spark.createDataFrame([("hb", "2030-01-01 00:00:00")], "merchant string, timestamp string") \
        .withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    u = S.with_heartbeat(ev, hb, time_col="timestamp")
    out = u.groupBy("merchant").agg(S.count_real().alias("n")).where("n > 0")
    assert out.where("merchant = 'hb'").count() == 0
    assert out.agg(F.sum("n")).first()[0] == ev.count()


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_filter_stays_above_watermark(spark, stream_dir):
    t = src.transactions_stream(spark, files_glob(stream_dir))
    plain = t.where(F.col("transaction_type") == "payment")
    kept = t.where(S.keep_above_watermark(F.col("transaction_type") == "payment", "timestamp"))

    def filter_above_watermark(df):
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            df.explain(True)
        text = buf.getvalue()
        opt = text.split("== Optimized Logical Plan ==")[1].split("== Physical Plan ==")[0]
        lines = opt.splitlines()
        wm = next(i for i, ln in enumerate(lines) if "EventTimeWatermark" in ln)
        return any("Filter" in ln and "payment" in ln for ln in lines[:wm])
    assert not filter_above_watermark(plain)      # Catalyst pushes a plain filter below it
    assert filter_above_watermark(kept)



def test_scan_prunes_columns_and_pushes_filters(spark):
    df = fx.customers(spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,signup)" in plan
    assert "props" not in plan                     # unused column never read
