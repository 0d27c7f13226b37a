"""Property tests: pattern, as-of, changelog and sliced-window operators against
brute-force Python loops on small random sequences (equal times, exact-W gaps,
tiny slices and blocks so the carry logic is exercised)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from rillet.operators import over as W
from rillet.operators.joins import temporal_join
from rillet.operators.patterns import escalating, failures_then_success, min_run_reluctant
from rillet.operators.changelog import changelog_view

BASE = dt.datetime(2024, 1, 1)
WIN_S = 3 * 3600

events = st.lists(st.tuples(st.sampled_from(["A", "B"]),
                             st.integers(0, 40),                     # time in 30-minute steps
                             st.sampled_from(["Failed", "Successful", None]),
                             st.integers(1, 9)), min_size=1, max_size=40)
SET = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    data = [(f"{i:04d}", a, BASE + dt.timedelta(minutes=30 * t), s, float(v))
            for i, (a, t, s, v) in enumerate(rows)]
    return spark.createDataFrame(data, "txn_id string, acct string, ts timestamp_ntz, status string, amount double")


def ordered(rows):
    by = {}
    for i, (a, t, s, v) in enumerate(rows):
        by.setdefault(a, []).append((t * 1800, f"{i:04d}", s, v))
    return {a: sorted(x) for a, x in by.items()}


def brute_m1(rows):
    out = []
    for a, seq in ordered(rows).items():
        i = 0
        while i + 2 < len(seq):
            run = seq[i:i + 3]
            if all(r[2] == "Failed" for r in run) and run[2][0] - run[0][0] <= WIN_S:
                out.append((a, run[0][0], run[2][0]))
                i += 3
            else:
                i += 1
    return sorted(out)


def brute_m2(rows):
    out = []
    for a, seq in ordered(rows).items():
        for j, s in enumerate(seq):
            if s[2] != "Successful":
                continue
            k = j - 1
            fails = []
            while k >= 0 and seq[k][2] == "Failed":
                fails.append(seq[k])
                k -= 1
            inside = [f for f in fails if s[0] - f[0] <= WIN_S]
            if len(inside) >= 2:
                out.append((a, len(inside), min(f[0] for f in inside), s[0]))
    return sorted(out)


def brute_m3(rows):
    out = []
    for a, seq in ordered(rows).items():
        for i in range(len(seq) - 2):
            x, y, z = seq[i:i + 3]
            if y[3] > x[3] and z[3] > y[3] and z[0] - x[0] <= WIN_S:
                out.append((a, x[3], y[3], z[3]))
    return sorted(out)


def secs(ts):
    return int((ts - BASE).total_seconds())


@SET
@given(events)
def test_m1_matches_brute_force(spark, rows):
    df = frame(spark, rows)
    got = min_run_reluctant(df, key="acct", time_col="ts", tiebreak="txn_id", status_col="status",
                            within="3 hours", block_rows=2, slice_="4 hours").collect()
    assert sorted((r.acct, secs(r.first_failed_time), secs(r.last_failed_time)) for r in got) == brute_m1(rows)


@SET
@given(events)
def test_m2_matches_brute_force(spark, rows):
    df = frame(spark, rows)
    got = failures_then_success(df, key="acct", time_col="ts", tiebreak="txn_id", status_col="status",
                                within="3 hours", slice_="2 hours").collect()
    assert sorted((r.acct, r.failed_attempts, secs(r.first_attempt_time), secs(r.success_time))
                  for r in got) == brute_m2(rows)


@SET
@given(events)
def test_m3_matches_brute_force(spark, rows):
    df = frame(spark, rows)
    got = escalating(df, key="acct", time_col="ts", value_col="amount", within="3 hours",
                     tiebreak="txn_id", slice_="3 hours").collect()
    assert sorted((r.acct, r.first_amount, r.second_amount, r.third_amount) for r in got) == brute_m3(rows)


@SET
@given(events, events)
def test_temporal_join_matches_brute_force(spark, left_rows, version_rows):
    left = frame(spark, left_rows).select("txn_id", "acct", "ts")
    vers = frame(spark, version_rows).select("acct", F.col("ts").alias("vt"), F.col("txn_id").alias("ver"))
    got = temporal_join(left, vers, key="acct", left_time="ts", version_time="vt", version_cols=["ver"],
                        tiebreak="txn_id", slice_="2 hours").collect()
    want = []
    vo = ordered(version_rows)
    for i, (a, t, _, _) in enumerate(left_rows):
        cands = [v for v in vo.get(a, []) if v[0] <= t * 1800]
        if cands:
            want.append((f"{i:04d}", max(cands)[1]))
    assert sorted((r.txn_id, r.ver) for r in got) == sorted(want)


@SET
@given(events)
def test_changelog_view_matches_brute_force(spark, rows):
    df = frame(spark, rows).select("acct", "ts", "txn_id")
    got = changelog_view(df, key="acct", order_cols=["ts", "txn_id"], time_col="ts", slice_="2 hours").collect()
    want = []
    for a, seq in ordered(rows).items():
        prev = None
        for t, tid, _, _ in seq:
            if prev is None:
                want.append(("+I", a, tid))
            else:
                want += [("-U", a, prev), ("+U", a, tid)]
            prev = tid
    assert sorted((r.op, r.acct, r.txn_id) for r in got) == sorted(want)


@SET
@given(events)
def test_sliced_running_sum_matches_plain_window(spark, rows):
    df = frame(spark, rows)
    got = W.running_aggregate(df, keys="acct", time_col="ts", range_="3 hours",
                              aggs={"tot": F.sum("amount")}, slice_="4 hours")
    from pyspark.sql import Window
    w = (Window.partitionBy("acct").orderBy(F.unix_micros(F.col("ts").cast("timestamp")))
         .rangeBetween(-WIN_S * 1_000_000, 0))
    want = df.withColumn("tot", F.sum("amount").over(w))
    assert sorted((r.txn_id, r.tot) for r in got.collect()) == sorted((r.txn_id, r.tot) for r in want.collect())


@SET
@given(events)
def test_sliced_last_value_matches_plain_window(spark, rows):
    df = frame(spark, rows).withColumn("v", F.when(F.col("status") == "Failed", F.col("txn_id")))
    got = W.latest_values(df, keys="acct", order_cols=["ts", "txn_id"], value_cols=["v"], slice_="2 hours")
    from pyspark.sql import Window
    w = Window.partitionBy("acct").orderBy("ts", "txn_id").rowsBetween(Window.unboundedPreceding, 0)
    want = df.withColumn("last_v", F.last("v", ignorenulls=True).over(w))
    assert sorted((r.txn_id, r.last_v) for r in got.collect()) == sorted((r.txn_id, r.last_v) for r in want.collect())


@SET
@given(events, events, st.integers(-6, 6), st.integers(0, 8))
def test_interval_join_matches_brute_force(spark, left_rows, right_rows, lo_steps, width_steps):
    """J2/J4/J5 with random signed bounds (30-minute steps), exact edges included."""
    from rillet.operators.joins import interval_join
    lo, hi = lo_steps * 1800, (lo_steps + width_steps) * 1800
    left = frame(spark, left_rows).select("txn_id", "acct", "ts")
    right = frame(spark, right_rows).select(F.col("txn_id").alias("rid"), "acct", F.col("ts").alias("rt"))
    fmt = lambda s: f"-{-s} seconds" if s < 0 else f"{s} seconds"
    got = interval_join(left, right, key="acct", left_time="ts", right_time="rt", lower=fmt(lo), upper=fmt(hi))
    want = [(f"{i:04d}", f"{j:04d}") for i, (a, t, _, _) in enumerate(left_rows)
            for j, (b, u, _, _) in enumerate(right_rows) if a == b and u * 1800 + lo <= t * 1800 <= u * 1800 + hi]
    assert sorted((r.txn_id, r.rid) for r in got.collect()) == sorted(want)


@settings(max_examples=3, deadline=None, suppress_health_check=list(HealthCheck))
@given(events)
def test_m1_hierarchical_fold_matches_brute_force(spark, rows):
    """Force the 3-level prefix composition with a fan-out of 2 and 1-row blocks."""
    import rillet.operators.patterns as PM
    old = PM.FOLD_FANOUT
    PM.FOLD_FANOUT = 2
    try:
        df = frame(spark, rows)
        got = PM.min_run_reluctant(df, key="acct", time_col="ts", tiebreak="txn_id", status_col="status",
                                   within="3 hours", block_rows=1, slice_="4 hours").collect()
    finally:
        PM.FOLD_FANOUT = old
    assert sorted((r.acct, secs(r.first_failed_time), secs(r.last_failed_time)) for r in got) == brute_m1(rows)


@SET
@given(events, events, st.sampled_from(["left", "full"]))
def test_outer_interval_join_matches_brute_force(spark, left_rows, right_rows, how):
    """Outer forms keep every unmatched row exactly once."""
    from rillet.operators.joins import interval_join
    lo, hi = 0, 3 * 1800
    left = frame(spark, left_rows).select("txn_id", "acct", "ts")
    right = frame(spark, right_rows).select(F.col("txn_id").alias("rid"), "acct", F.col("ts").alias("rt"))
    got = interval_join(left, right, key="acct", left_time="ts", right_time="rt", lower="0 seconds",
                        upper=f"{hi} seconds", how=how)
    pairs = [(f"{i:04d}", f"{j:04d}") for i, (a, t, _, _) in enumerate(left_rows)
             for j, (b, u, _, _) in enumerate(right_rows) if a == b and u * 1800 + lo <= t * 1800 <= u * 1800 + hi]
    want = pairs + [(f"{i:04d}", None) for i in range(len(left_rows)) if all(p[0] != f"{i:04d}" for p in pairs)]
    if how == "full":
        want += [(None, f"{j:04d}") for j in range(len(right_rows)) if all(p[1] != f"{j:04d}" for p in pairs)]
    key = lambda x: (x[0] or "", x[1] or "")
    assert sorted(((r.txn_id, r.rid) for r in got.collect()), key=key) == sorted(want, key=key)


@SET
@given(events, events, st.sampled_from(["inner", "left", "right", "full"]))
def test_pair_counts_match_materialised_join(spark, left_rows, right_rows, how):
    from rillet.operators.joins import per_key_pair_counts
    l = frame(spark, left_rows).select("acct")
    r = frame(spark, right_rows).select("acct")
    got = {r_.acct: r_.pair_count for r_ in per_key_pair_counts(l, r, key="acct", how=how).collect()}
    j = l.alias("a").join(r.alias("b"), F.col("a.acct") == F.col("b.acct"), how)
    want = {k: n for k, n in j.groupBy(F.coalesce("a.acct", "b.acct").alias("k")).count().collect()}
    assert got == want


@SET
@given(events, st.sampled_from(["30 minutes", "1 hour", "90 minutes"]))
def test_sliced_sessions_match_session_window(spark, rows, gap):
    """Gaps-and-islands over sliced scans equals Spark's session_window
    (gaps exactly equal to the session gap merge; larger ones split)."""
    from rillet.operators.aggregations import session_count
    df = frame(spark, rows)
    got = session_count(df, "ts", gap, "acct", slice_="2 hours")
    w = (df.groupBy(F.session_window("ts", gap).alias("w"), "acct").agg(F.count(F.lit(1)).alias("n"))
         .select(F.col("w.start").alias("s"), F.col("w.end").alias("e"), "acct", "n"))
    assert sorted((r.window_start, r.window_end, r.acct, r.total_tx) for r in got.collect()) == \
        sorted((r.s, r.e, r.acct, r.n) for r in w.collect())


@SET
@given(events)
def test_latest_per_key_matches_pandas(spark, rows):
    """The current row per key (max_by of the ordering) equals a pandas sort/last."""
    from rillet.operators.joins import latest_per_key
    df = frame(spark, rows).select("acct", "ts", "txn_id", "amount")
    got = sorted((r.acct, r.txn_id) for r in latest_per_key(df, key="acct", order_cols=["ts", "txn_id"]).collect())
    pdf = df.toPandas().sort_values(["ts", "txn_id"])
    want = sorted((a, g.iloc[-1]["txn_id"]) for a, g in pdf.groupby("acct"))
    assert got == want
