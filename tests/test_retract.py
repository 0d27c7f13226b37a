"""Changelog streams: processors against brute force on in-memory state, queries against batch."""

from __future__ import annotations

import datetime as dt
import json
import random
import time
from collections import Counter
from fractions import Fraction

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rillet.operators import joins as J
from rillet.streaming import retract as R


class _Value:
    def __init__(self):
        self.v = None

    def get(self):
        return self.v

    def update(self, v):
        self.v = v

    def exists(self):
        return self.v is not None

    def clear(self):
        self.v = None


class _List:
    def __init__(self):
        self.v = []

    def get(self):
        return iter(list(self.v))

    def put(self, v):
        self.v = list(v)

    def appendList(self, v):
        self.v += v

    def clear(self):
        self.v = []


class _Handle:
    def __init__(self):
        self.timers = []

    def getValueState(self, *_):
        return _Value()

    def getListState(self, *_):
        return _List()

    def registerTimer(self, at):
        self.timers.append(at)


class _Clock:
    def __init__(self, ms):
        self.ms = ms

    def getCurrentWatermarkInMs(self):
        return self.ms


def _fed(processor, batches, key=("k",)):
    """Signed rows that the processor emits, batch by batch."""
    processor.init(_Handle())
    for pdf in batches:
        out = Counter()
        for got in processor.handleInputRows(key, iter([pdf]), _Clock(0)):
            for op, *row in got.itertuples(index=False):
                out[tuple(tuple(x) if isinstance(x, list) else x for x in row)] += -1 if op[0] == "-" else 1
        yield out


def _signed_batches(rnd, rows, sides, n=12):
    """Random batches of signed changes in which no row is taken away more often than it is there."""
    held = [Counter() for _ in range(sides)]
    for _ in range(n):
        batch = []
        for _ in range(rnd.randrange(0, 6)):
            side = rnd.randrange(sides)
            here = list(held[side].elements())
            gone = bool(here) and rnd.random() < 0.45
            row = rnd.choice(here) if gone else rnd.choice(rows)
            held[side][row] += -1 if gone else 1
            batch.append((side, -1 if gone else 1, row))
        rnd.shuffle(batch)   # order within a batch means nothing
        yield batch, [Counter({r: n for r, n in h.items() if n}) for h in held]


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_join_equals_brute_force_after_every_batch(how):
    for seed in range(60):
        rnd = random.Random(seed)
        steps = list(_signed_batches(rnd, ["a", "b", "c"], 2))
        frames = [pd.DataFrame(b, columns=["side", "n", "row_json"]) for b, _ in steps]
        total = Counter()
        for out, (_, (left, right)) in zip(_fed(R._Join(how in ("left", "full"), how in ("right", "full"), (None, None)), frames), steps, strict=True):
            total.update(out)
            want = Counter({(l, r): n * m for l, n in left.items() for r, m in right.items()})
            if how in ("left", "full") and not right:
                want.update({(l, None): n for l, n in left.items()})
            if how in ("right", "full") and not left:
                want.update({(None, r): n for r, n in right.items()})
            assert +total == want and not -total, (how, seed)


def test_aggregate_is_exact_and_takes_groups_back():
    values = ["1.0E-10", "1.0E20", "0.1", "NaN", "Infinity", "-Infinity", None, "-2.5"]
    for seed in range(60):
        rnd = random.Random(seed)
        steps = list(_signed_batches(rnd, values, 1))
        frames = [pd.DataFrame({"n": [n for _, n, _ in b], "counts": [[1, int(v is not None)] for _, _, v in b], "sums": [[v] for _, _, v in b]})
                  for b, _ in steps]
        total = Counter()
        for out, (_, (held,)) in zip(_fed(R._Aggregate([None], 1, False, True), frames), steps, strict=True):
            total.update(out)
            rows = list(held.elements())
            known = [float(v) for v in rows if v is not None]
            if not known:
                want = None
            elif any(v != v for v in known) or {float("inf"), -float("inf")} <= set(known):
                want = "NaN"
            elif any(abs(v) == float("inf") for v in known):
                want = "Infinity" if float("inf") in known else "-Infinity"
            else:
                want = repr(float(sum(map(Fraction, known), Fraction(0))))
            shown = [k for k, n in total.items() if n]
            assert (shown == [("k", (len(rows), len(known)), (want,))]) if rows else not shown, (seed, shown, want)


def test_partial_sums_merge_to_the_same_result():
    one = R._Sum()
    for v in ("1.0E20", "1.0E-10", "0.1"):
        one.add(v, 1, True)
    two = R._Sum()
    two.merge(one.text(), 1)
    two.add("1.0E20", -1, True)
    assert float(two.result(None)) == float(Fraction(1e-10) + Fraction(0.1))
    money = R._Sum()
    for v in ("10.25", "-0.05"):
        money.add(v, 2, False)
    assert money.result(2) == "20.40" and money.result(0) == "20"


def test_sink_shows_the_largest_candidate_after_every_batch():
    rows = [f'{{"v":{i},"x":"{x}"}}' for i in range(3) for x in "pq"]

    def order(row):
        return (row,)

    for seed in range(80):
        rnd = random.Random(seed)
        steps = list(_signed_batches(rnd, rows, 1))
        frames = [pd.DataFrame([(n, r) for _, n, r in b], columns=["n", "row_json"]) for b, _ in steps]
        total = Counter()
        for out, (_, (held,)) in zip(_fed(R._Winner(order), frames), steps, strict=True):
            total.update(out)
            assert +total == Counter({(max(held),): 1} if held else {}) and not -total


def test_log_of_rows_is_rewritten():
    rows = R._Rows(_Handle(), "x")
    for i in range(200):
        rows.add({f"r{i % 3}": 1 if i % 2 == 0 else -1})
    net = rows.all()
    assert len(rows.state.v) == len(net) <= 3


def test_versions_and_rows_are_released_by_the_clock():
    rnd = random.Random(5)
    p, h = R._Versioned(), _Handle()
    p.init(h)
    versions = [(t, f"v{t}") for t in range(0, 300_000, 7_000)]
    left = [(rnd.randrange(300_000), f"l{i}") for i in range(200)]
    out = []
    # rows arrive first, versions lag; the clock follows the versions
    todo = [("l", left[:100], 0), ("v", versions[:10], 0), ("l", left[100:], 0), ("v", versions[10:30], 60), ("v", versions[30:], 200), ("v", [], 400)]
    for kind, entries, clock in todo:
        pdf = pd.DataFrame([(1 if kind == "l" else 0, t, r) for t, r in entries], columns=["side", "t", "row_json"])
        late = [t for t, _ in entries if t <= clock * 1000 - 1] if kind == "v" and clock else []
        if late:
            continue
        for got in p.handleInputRows(("k",), iter([pdf]), _Clock(clock)):
            out += list(got.itertuples(index=False, name=None))
        assert len(p.versions.v) <= 2 * max(1, sum(t > clock * 1000 for t, _ in p.versions.v) + 1) + 1
    assert h.timers


# ------------------------------------------------------------------ on Spark
def _streams(spark, folder, parts, schema):
    """A stream that reads one file a trigger."""
    path = str(folder)
    for rows in parts:
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(path)
        time.sleep(0.02)
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def _run(changes, folder, **options):
    def keep(batch, epoch):
        batch.withColumn("epoch", F.lit(epoch)).write.mode("append").parquet(f"{folder}/out")

    q = changes.writeStream.outputMode("append").foreachBatch(keep).option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start()
    assert q.awaitTermination(240)


T = "account string, txn long, amount decimal(10,2)"
C = "account string, city string, version int, at timestamp"


def _data(seed):
    rnd = random.Random(seed)
    from decimal import Decimal
    t = [(rnd.choice(["a", "b", "c", None]), i, Decimal(rnd.randrange(1, 9999)) / 100) for i in range(60)]
    c = [(rnd.choice(["a", "b", "d", None]), rnd.choice(["x", "y"]), v, dt.datetime(2024, 1, 1, 0, 0, 0, v * 1001)) for v in range(1, 13)]
    rnd.shuffle(c)   # versions arrive out of order
    return t, c


def _cut(rows, sizes):
    at, out = 0, []
    for n in sizes:
        out.append(rows[at:at + n])
        at += n
    return [*out[:-1], out[-1] + rows[at:]]


def _table(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("splits", [((60,), (12,)), ((7, 20, 33), (3, 1, 8))])
def test_join_aggregate_and_sink_equal_batch_after_every_epoch(spark, tmp_path, splits):
    """Transactions joined with changing customers, summed per city, HAVING, and a sink on the count."""
    t_rows, c_rows = _data(3)
    t_parts, c_parts = _cut(t_rows, splits[0]), _cut(c_rows, splits[1])
    t = R.inserts(_streams(spark, tmp_path / "t", t_parts, T))
    c = R.upsert_changes(_streams(spark, tmp_path / "c", c_parts, C), key="account", order_cols=["version"])
    joined = R.join_changes(t, c.select(R.OP, "account", "city"), key="account", salts=2)
    spend = R.aggregate_changes(joined, keys="city", sums={"spent": F.col("amount")}, counts={"n": F.col("txn")}, salts=2)
    _run(spend.where("spent > 200"), tmp_path)
    out = spark.read.parquet(f"{tmp_path}/out")
    for epoch in range(len(t_parts)):
        tb = spark.createDataFrame([r for p in t_parts[:epoch + 1] for r in p], T)
        cb = J.latest_per_key(spark.createDataFrame([r for p in c_parts[:epoch + 1] for r in p], C), key="account", order_cols=["version"])
        want = tb.join(cb, "account").groupBy("city").agg(F.sum("amount").alias("spent"), F.count("txn").alias("n")).where("spent > 200")
        assert _table(R.current_rows(out.where(F.col("epoch") <= epoch).drop("epoch")).select("city", "spent", "n")) == _table(want)
        shown = R.current_rows(out.where(F.col("epoch") <= epoch).drop("epoch"))
        assert shown.schema["spent"].dataType == want.schema["spent"].dataType


def test_full_join_equals_batch_with_null_keys_and_microseconds(spark, tmp_path):
    t_rows, c_rows = _data(4)
    t_parts, c_parts = _cut(t_rows, (5, 30, 25)), _cut(c_rows, (4, 4, 4))
    t = R.inserts(_streams(spark, tmp_path / "t", t_parts, T)).where("amount > 40")
    c = R.upsert_changes(_streams(spark, tmp_path / "c", c_parts, C), key="account", order_cols=["at"])
    _run(R.join_changes(t, c, key="account", how="full"), tmp_path)
    got = R.current_rows(spark.read.parquet(f"{tmp_path}/out").drop("epoch"))
    cb = J.latest_per_key(spark.createDataFrame(c_rows, C), key="account", order_cols=["at"])
    want = J.regular_join(spark.createDataFrame(t_rows, T).where("amount > 40"), cb, key="account", how="full")
    assert _table(got.select(want.columns)) == _table(want)


def test_versioned_join_waits_for_the_slower_side(spark, tmp_path):
    """Versions lag by several files; the result is the batch join's, NULL keys and last rows included."""
    at = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s, microseconds=s)
    rnd = random.Random(9)
    left = [(rnd.choice(["a", "b", None]), i, at(rnd.randrange(i * 10, i * 10 + 10))) for i in range(60)]
    versions = [(k, f"{k}{s}", at(s)) for k in ("a", "b") for s in range(0, 600, 45)]
    versions.sort(key=lambda r: r[2])
    ls, vs = "k string, id long, t timestamp", "k string, name string, since timestamp"
    end = [(None, None, at(100_000))]
    t = _streams(spark, tmp_path / "l", [left[:30], left[30:], [], end, []], ls).withWatermark("t", "1 second")
    c = _streams(spark, tmp_path / "v", [versions[:3], [], versions[3:9], versions[9:], end], vs).withWatermark("since", "1 second")
    _run(R.versioned_join(t, c, key="k", left_time="t", version_time="since", version_cols=["name", "since"]), tmp_path)
    got = spark.read.parquet(f"{tmp_path}/out").drop("epoch")
    want = J.temporal_join(spark.createDataFrame(left, ls).where("k IS NOT NULL"), spark.createDataFrame(versions, vs), key="k", left_time="t",
                           version_time="since", version_cols=["name", "since"], tiebreak="id")
    assert _table(got.select(want.columns)) == _table(want)
    assert got.schema["since"].dataType == want.schema["since"].dataType


def test_rows_of_a_join_expire(spark, tmp_path):
    """The left row is gone from state when its partner comes after the TTL, and still there before."""
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    try:
        for name, ttl, want in (("short", "1 second", 0), ("long", "10 minutes", 1)):
            folder = tmp_path / name
            t = _streams(spark, folder / "t", [[("a", 1, None)], [("z", 2, None)]], T)
            c = _streams(spark, folder / "c", [[("z", "q", 1, None)]], C)
            joined = R.join_changes(R.inserts(t), R.inserts(c.select("account", "city")), key="account", ttl=ttl, right_ttl=ttl)
            _run(joined, folder)
            time.sleep(1.5)
            spark.createDataFrame([("a", "x", 1, None)], C).coalesce(1).write.mode("append").parquet(str(folder / "c"))
            _run(joined, folder)
            assert spark.read.parquet(f"{folder}/out").where("account = 'a'").count() == want
    finally:
        spark.conf.unset("spark.sql.streaming.noDataMicroBatches.enabled")


def test_what_a_join_refuses(spark):
    left, right = spark.createDataFrame([("a", 1, "+I")], "k string, x int, op string"), spark.createDataFrame([("a", 1, "+I")], "k string, y int, op string")
    for bad in ({"how": "full", "salts": 2}, {"how": "left", "ttl": "1 hour"}, {"how": "cross"}):
        with pytest.raises(ValueError):
            R.join_changes(left, right, key="k", **bad)
    with pytest.raises(ValueError):
        R.join_changes(left, left, key="k")


# ------------------------------------------------------------------ buckets of keys
class _CountedList(_List):
    def __init__(self, calls):
        super().__init__()
        self.calls = calls

    def get(self):
        self.calls.append("get")
        return super().get()

    def appendList(self, v):
        self.calls.append("append")
        super().appendList(v)


class _CountingHandle(_Handle):
    def __init__(self):
        super().__init__()
        self.calls = []

    def getListState(self, *_):
        return _CountedList(self.calls)


def _bucket(one):
    bucket, handle = R._Bucket(one), _CountingHandle()
    bucket.init(handle)
    return bucket, handle


def test_a_bucket_joins_like_its_keys_alone():
    for seed in range(20):
        rnd = random.Random(seed)
        keys = [f"k{i}" for i in range(30)]
        bucket, handle = _bucket(R._Join(True, True, (None, None)))
        held = {k: (Counter(), Counter()) for k in keys}
        total = Counter()
        for _ in range(8):
            batch = []
            for k in rnd.sample(keys, 15):
                for _ in range(rnd.randrange(1, 5)):
                    side = rnd.randrange(2)
                    here = list(held[k][side].elements())
                    gone = bool(here) and rnd.random() < 0.45
                    row = rnd.choice(here) if gone else k + rnd.choice("abc")
                    held[k][side][row] += -1 if gone else 1
                    batch.append((k, side, -1 if gone else 1, row))
            rnd.shuffle(batch)
            pdf = pd.DataFrame(batch, columns=["key_json", "side", "n", "row_json"])
            handle.calls.clear()
            for got in bucket.handleInputRows((0,), iter([pdf[:10], pdf[10:]]), _Clock(0)):
                for op, *row in got.itertuples(index=False):
                    total[tuple(row)] += -1 if op[0] == "-" else 1
            assert len(handle.calls) <= 6   # whatever the number of keys: a read and a write for each of three states
            want = Counter()
            for left, right in held.values():
                left, right = +left, +right
                want.update({(l, r): n * m for l, n in left.items() for r, m in right.items()})
                want.update({(l, None): n for l, n in left.items()} if not right else {})
                want.update({(None, r): n for r, n in right.items()} if not left else {})
            assert +total == want and not -total, seed


def test_state_of_a_bucket_is_cut_rewritten_and_taken_away(monkeypatch):
    monkeypatch.setattr(R, "PIECE", 200)
    bucket, handle = _bucket(R._Aggregate([2], 1, False, True))
    log = bucket.logs[0].state
    for i in range(60):
        pdf = pd.DataFrame([(f'k"{k}', n, [1, 1], ["2.25"]) for k in range(20) for n in [1 if i < 59 else -1]], columns=["key_json", "n", "counts", "sums"])
        out = [r for f in bucket.handleInputRows((0,), iter([pdf]), _Clock(0)) for r in f.itertuples(index=False)]
        assert len({r.key_json for r in out}) == 20
    assert {(r[2][0], r[3][0]) for r in out if r[0] == "+U"} == {(58, "130.50")}
    assert 1 < len(log.v) and sum(len(p) for p, in log.v) < 3 * 20 * 100
    pdf = pd.DataFrame([(f'k"{k}', -1, [1, 1], ["2.25"]) for k in range(20) for _ in range(58)], columns=["key_json", "n", "counts", "sums"])
    out = [r for f in bucket.handleInputRows((0,), iter([pdf]), _Clock(0)) for r in f.itertuples(index=False)]
    assert {r[0] for r in out} == {"-D"}


def test_timers_of_a_bucket_release_every_key():
    bucket, handle = _bucket(R._Versioned())
    cols = ["key_json", "side", "t", "row_json"]
    pdf = pd.DataFrame([(f"k{k}", side, t, f"{side}{k}") for k in range(9) for side, t in ((0, 1_000_000 * k), (1, 1_000_000 * k + 5))] + [("k0", 1, None, "x")], columns=cols)
    assert not list(bucket.handleInputRows((0,), iter([pdf]), _Clock(0)))[1:]
    assert handle.timers == [1]
    out = [tuple(r) for f in bucket.handleExpiredTimer((0,), _Clock(4_500), None) for r in f.itertuples(index=False)]
    assert sorted(out) == [(f"1{k}", f"0{k}") for k in range(5)] and handle.timers == [1, 5_001]
    out = [tuple(r) for f in bucket.handleExpiredTimer((0,), _Clock(60_000), None) for r in f.itertuples(index=False)]
    assert sorted(out) == [(f"1{k}", f"0{k}") for k in range(5, 9)]


def test_parts_of_a_replay_are_whole_micro_batches(spark):
    from rillet.plans.streams import Replay

    for n in (2, 400):
        table = spark.range(n).selectExpr("id", "timestamp_seconds(id) AS t")
        replay = Replay(spark)
        seen = []
        stream = replay.stream(table, "x", "t")
        stream.writeStream.foreachBatch(lambda b, _, seen=seen: seen.append(sorted(r.id for r in b.collect()))) \
            .option("checkpointLocation", f"{replay.folder}/c").trigger(availableNow=True).start().awaitTermination()
        assert len(seen) <= replay.steps and sum(seen, []) == list(range(n))


@pytest.mark.parametrize("factor, chars", [(1000, 1 << 22), (2, 60)])
@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
def test_products_mean_the_pairs_that_a_join_tells(monkeypatch, how, factor, chars):
    monkeypatch.setattr(R, "FACTOR", factor)
    monkeypatch.setattr(R, "FRAME_CHARS", chars)
    pads = how in ("left", "full"), how in ("right", "full")
    for seed in range(30):
        steps = list(_signed_batches(random.Random(seed), ['"a"', '"b"', '"c"'], 2))
        frames = [pd.DataFrame(b, columns=["side", "n", "row_json"]) for b, _ in steps]
        pairs, products = R._Join(*pads, (None, None)), R._Products(*pads, (None, None))
        products.init(_Handle())
        for pdf, want in zip(frames, _fed(pairs, frames), strict=True):
            got, ops = Counter(), []
            for frame in products.handleInputRows(("k",), iter([pdf]), _Clock(0)):
                for op, ls, rs in frame.itertuples(index=False):
                    ops.append(op)
                    for l in [None] if ls is None else json.loads(ls):
                        for r in [None] if rs is None else json.loads(rs):
                            got[l and f'"{l}"', r and f'"{r}"'] += -1 if op[0] == "-" else 1
            assert {k: n for k, n in got.items() if n} == {k: n for k, n in want.items() if n}
            assert ops == sorted(ops, key=lambda op: op[0] == "+") and set(ops) in ({"-U", "+U"}, {"-D"}, {"+I"}, set())


def test_a_hot_change_of_a_join_is_a_few_rows():
    """1 change of the right side with 5,000 left rows: a row for 1,000 pairs, not one for each."""
    join = R._Products(False, False, (None, None))
    join.init(_Handle())
    cols = ["side", "n", "row_json"]
    lefts = [f'{{"i":{i}}}' for i in range(5000)]
    list(join.handleInputRows(("k",), iter([pd.DataFrame([(0, 1, l) for l in lefts] + [(1, 1, "{}")], columns=cols)]), _Clock(0)))
    out = list(join.handleInputRows(("k",), iter([pd.DataFrame([(1, -1, "{}"), (1, 1, '{"r":1}')], columns=cols)]), _Clock(0)))
    rows = [tuple(r) for f in out for r in f.itertuples(index=False)]
    assert [r[0] for r in rows] == ["-U"] * 5 + ["+U"] * 5
    for op, r in (("-U", [{}]), ("+U", [{"r": 1}])):
        assert [x["i"] for o, ls, _ in rows if o == op for x in json.loads(ls)] == list(range(5000))
        assert all(json.loads(rs) == r for o, _, rs in rows if o == op)
