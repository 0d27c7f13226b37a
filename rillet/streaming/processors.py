"""Event-time ordered stateful processors for streams.

Spark rejects OVER windows and has no MATCH_RECOGNIZE on
streams.  :func:`ordered_processor` is the one building block: per key it
keeps rows until the watermark passes them (rows below the watermark are
final, later rows for that time are dropped as late), then feeds the ready
rows in ``(time, order...)`` order to a step function with a small carried
state.  State per key = a list of unreleased rows, to which a batch appends, + the carry; each
step keeps its carry bounded (last values, rows inside the WITHIN bound).  The versioned join (J1) and
changelogs are in :mod:`rillet.streaming.retract`.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator, Sequence
from decimal import Decimal

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from rillet.operators.over import _micros

Step = Callable[[object, list[dict]], tuple[object, list[tuple]]]


class _Ordered(StatefulProcessor):
    def __init__(self, time_col: str, order_cols: Sequence[str], cols: Sequence[str], step: Step, out: Sequence[str], times: Sequence[str]) -> None:
        self.time_col, self.order, self.cols, self.step, self.out, self.times = time_col, [time_col, *order_cols], list(cols), step, list(out), list(times)

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.waiting = handle.getListState("waiting", "t long, row string")
        self.carry = handle.getValueState("carry", "c string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        new = [(t, row) for pdf in rows for t, row in zip(pdf["t"].tolist(), pdf["row_json"], strict=True)]
        if new:
            self.waiting.appendList(new)
        yield from self._released(key, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        yield from self._released(key, timerValues)

    def _released(self, key, timerValues) -> Iterator[pd.DataFrame]:
        clock = timerValues.getCurrentWatermarkInMs() * 1000
        waiting = list(self.waiting.get())
        later = [w for w in waiting if w[0] > clock]
        if later:
            self.handle.registerTimer(max(min(later)[0], clock) // 1000 + 1)
        ready = [self._row(t, row) for t, row in waiting if t <= clock]
        if not ready:
            return
        ready.sort(key=lambda r: tuple((r[c] is not None, r[c]) for c in self.order))
        held = self.carry.get()
        carry, rows = self.step(None if held is None else json.loads(held[0]), ready)
        if carry is not None:
            self.carry.update((json.dumps(carry, default=str),))
        elif held is not None:
            self.carry.clear()
        if later:
            self.waiting.put(later)
        else:
            self.waiting.clear()
        if rows:
            out = pd.DataFrame([(key[0], *r) for r in rows], columns=self.out)
            for c in self.times:
                out[c] = pd.to_datetime(out[c], unit="us")
            yield out

    def _row(self, t: int, text: str) -> dict:
        held = json.loads(text, parse_float=Decimal)
        return {c: held.get(c) for c in self.cols} | {self.time_col: t}

    def close(self) -> None:
        pass


def ordered_processor(df: DataFrame, *, key: str, time_col: str, order_cols: Sequence[str],
                      cols: Sequence[str], step: Step, out_schema: str) -> DataFrame:
    """Run ``step(carry, ready_rows) -> (carry, out_rows)`` per key in event-time order.

    ``ready_rows`` are dicts with ``cols`` (time as epoch microseconds, numbers as int or Decimal, other types
    as text); ``out_rows`` are tuples matching ``out_schema`` after the key column.
    """
    cols = list(dict.fromkeys([time_col, *order_cols, *cols]))
    fields = [f.split()[:2] for f in out_schema.split(",")]
    source = df.select(F.col(key).cast("string").alias("key_text"), F.col(time_col).alias("at"), F.unix_micros(F.col(time_col)).alias("t"),
                       F.to_json(F.struct(*[F.col(c) for c in cols if c != time_col])).alias("row_json"))
    return source.groupBy("key_text").transformWithStateInPandas(
        _Ordered(time_col, order_cols, cols, step, [n for n, _ in fields], [n for n, kind in fields if kind == "timestamp"]), out_schema, "Append", "EventTime")


# ------------------------------------------------------------------ W5 stream
def latest_values_stream(df: DataFrame, *, key: str, time_col: str, order_cols: Sequence[str],
                         value_cols: Sequence[str], id_col: str, prefix: str = "last_") -> DataFrame:
    """W5 on a stream: per row the last non-NULL value of each column so far."""
    vc = list(value_cols)

    def step(carry, rows):
        last = carry or {}
        out = []
        for r in rows:
            for c in vc:
                if r[c] is not None:
                    last[c] = r[c]
            out.append((r[id_col], r[time_col], *[None if last.get(c) is None else str(last[c]) for c in vc]))
        return last, out

    schema = f"{key} string, {id_col} string, {time_col} timestamp, " + ", ".join(f"{prefix}{c} string" for c in vc)
    return ordered_processor(df, key=key, time_col=time_col, order_cols=order_cols, cols=[id_col, *vc],
                             step=step, out_schema=schema)


# ------------------------------------------------------------------ M1-M3 streams
def min_run_stream(df: DataFrame, *, key: str, time_col: str, tiebreak: str, status_col: str, within: str,
                   failed: str = "Failed") -> DataFrame:
    """M1 on a stream.  The greedy scan checks start i when row i+2 arrives, so the
    carry is only the (at most two) failures of the current run after the last match."""
    w = _micros(within)

    def step(carry, rows):
        buf = carry or []
        out = []
        for r in rows:
            if r[status_col] != failed:
                buf = []
                continue
            buf.append(r[time_col])
            if len(buf) >= 3:
                if buf[-1] - buf[-3] <= w:
                    out.append((buf[-3], buf[-1], 3))
                    buf = []
                else:
                    buf = buf[-2:]
        return buf, out

    return ordered_processor(df, key=key, time_col=time_col, order_cols=[tiebreak], cols=[status_col], step=step,
                             out_schema=f"{key} string, first_failed_time timestamp, last_failed_time timestamp, "
                                        "failed_count bigint")


def failures_then_success_stream(df: DataFrame, *, key: str, time_col: str, tiebreak: str, status_col: str,
                                 within: str, carry_cols: Sequence[str] = (), failed: str = "Failed",
                                 success: str = "Successful", min_failed: int = 2) -> DataFrame:
    """M2 on a stream; the carry holds the current run's failures inside the bound."""
    w = _micros(within)
    cc = list(carry_cols)

    def step(carry, rows):
        run = carry or []
        out = []
        for r in rows:
            t = r[time_col]
            if r[status_col] == failed:
                run = [x for x in run if x >= t - w] + [t]
            else:
                if r[status_col] == success:
                    inside = [x for x in run if t - x <= w]
                    if len(inside) >= min_failed:
                        out.append((len(inside), min(inside), t, *[None if r[c] is None else str(r[c]) for c in cc]))
                run = []
        return run, out

    schema = (f"{key} string, failed_attempts bigint, first_attempt_time timestamp, success_time timestamp"
              + "".join(f", {c} string" for c in cc))
    return ordered_processor(df, key=key, time_col=time_col, order_cols=[tiebreak], cols=[status_col, *cc],
                             step=step, out_schema=schema)


def escalating_stream(df: DataFrame, *, key: str, time_col: str, tiebreak: str, value_col: str,
                      within: str) -> DataFrame:
    """M3 on a stream; the carry is the previous two rows."""
    w = _micros(within)

    def step(carry, rows):
        prev = carry or []
        out = []
        for r in rows:
            cur = [r[time_col], None if pd.isna(r[value_col]) else float(r[value_col])]
            if len(prev) == 2:
                (t0, a0), (_, a1) = prev
                if None not in (a0, a1, cur[1]) and a1 > a0 and cur[1] > a1 and cur[0] - t0 <= w:
                    out.append((a0, a1, cur[1], t0, cur[0]))
            prev = (prev + [cur])[-2:]
        return prev, out

    return ordered_processor(df, key=key, time_col=time_col, order_cols=[tiebreak], cols=[value_col], step=step,
                             out_schema=f"{key} string, first_amount double, second_amount double, "
                                        "third_amount double, start_time timestamp, end_time timestamp")


# ------------------------------------------------------------------ W6 stream
class _LagProcessor(StatefulProcessor):
    """Per key: value state with the previous window's count."""

    def __init__(self, time_col: str, count_col: str):
        self.time_col, self.count_col = time_col, count_col

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.prev = handle.getValueState("prev", "c long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows)).sort_values(self.time_col)
        prev = self.prev.get()[0] if self.prev.exists() else None
        prevs = []
        for c in pdf[self.count_col]:
            prevs.append(prev)
            prev = int(c)
        self.prev.update((prev,))
        out = pdf.copy()
        out["_prev"] = pd.array(prevs, dtype="Float64")
        out["_delta"] = out[self.count_col].astype("Float64") - out["_prev"]
        yield out

    def close(self) -> None:
        pass


def lag_stream(counts: DataFrame, *, keys: Sequence[str], time_col: str, count_col: str,
               prev_alias: str = "prev_count", delta_alias: str = "delta") -> DataFrame:
    """W6 on a stream: ``LAG(count, 1)`` per key over the closed windows of a
    watermarked tumbling aggregate, chained after it in append mode.

    The aggregate emits each window once, after the watermark passed it, so
    rows reach the processor final and in time order; the state per key is the
    previous count only."""
    keys = list(keys)
    src = counts.select(*keys, time_col, F.col(count_col).cast("bigint").alias(count_col))
    fields = [f for f in src.schema.fields]
    out = T.StructType(fields + [T.StructField("_prev", T.DoubleType()), T.StructField("_delta", T.DoubleType())])
    res = src.groupBy(*keys).transformWithStateInPandas(
        statefulProcessor=_LagProcessor(time_col, count_col), outputStructType=out,
        outputMode="Append", timeMode="None")
    return res.withColumnRenamed("_prev", prev_alias).withColumnRenamed("_delta", delta_alias)
