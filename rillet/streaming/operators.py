"""Structured Streaming forms of the operators.

Built-in where Spark has the operator (windowed aggregates, interval joins,
stream-static joins); ``applyInPandasWithState`` processors where it has not
(OVER windows and changelog on streams, which Spark rejects).  Event time must
be TIMESTAMP for ``withWatermark``: :func:`event_time` casts NTZ columns.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from rillet.operators.over import _micros, _seconds


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def event_time(df: DataFrame, time_col: str, delay: str) -> DataFrame:
    """Declare the watermark ``time_col - delay`` (NTZ is cast to TIMESTAMP, UTC)."""
    return df.withColumn(time_col, F.col(time_col).cast("timestamp")).withWatermark(time_col, delay)


def keep_above_watermark(pred: Column, time_col: str) -> Column:
    """C14: a filter Catalyst cannot push below the watermark node, so rows it
    discards still advance event time (as a filter after a table's watermark)."""
    return F.when(F.col(time_col).isNotNull(), pred)


def with_heartbeat(df: DataFrame, heartbeats: DataFrame, *, time_col: str, flag_col: str = "_hb") -> DataFrame:
    """Union dummy rows that only move event time.  Apply *before*
    ``withWatermark``; count with :func:`count_real` so they never enter results."""
    return (df.withColumn(flag_col, F.lit(False))
            .unionByName(heartbeats.withColumn(flag_col, F.lit(True)), allowMissingColumns=True))


def count_real(flag_col: str = "_hb") -> Column:
    return F.count_if(~F.col(flag_col))


# ------------------------------------------------------------------ built-ins
def tumbling_count_stream(df: DataFrame, *, time_col: str, size: str, keys: str | Sequence[str],
                          where: Column | None = None, alias: str = "cnt") -> DataFrame:
    """A4 on a watermarked stream; append mode emits one row per closed window."""
    src = df if where is None else df.where(keep_above_watermark(where, time_col))
    g = src.groupBy(F.window(time_col, size).alias("w"), *_cols(keys)).agg(F.count(F.lit(1)).alias(alias))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *_cols(keys), F.col(alias).cast("bigint").alias(alias))


def session_count_stream(df: DataFrame, *, time_col: str, gap: str, keys: str | Sequence[str],
                         alias: str = "total_tx") -> DataFrame:
    """A6 on a watermarked stream (append mode only)."""
    g = df.groupBy(F.session_window(time_col, gap).alias("w"), *_cols(keys)).agg(F.count(F.lit(1)).alias(alias))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    F.expr("timestampdiff(SECOND, w.start, w.end)").cast("bigint").alias("sec_duration"),
                    *_cols(keys), F.col(alias).cast("bigint").alias(alias))


def interval_join_stream(left: DataFrame, right: DataFrame, *, key: str, left_time: str, right_time: str,
                         lower: str, upper: str, how: str = "inner") -> DataFrame:
    """J2 on two watermarked streams; the time bound lets Spark evict join state."""
    lo, hi = _seconds(lower.lstrip("-")) * (-1 if lower.startswith("-") else 1), \
        _seconds(upper.lstrip("-")) * (-1 if upper.startswith("-") else 1)
    l, r = left.alias("l"), right.alias("r")
    cond = ((F.col(f"l.{key}") == F.col(f"r.{key}"))
            & (F.col(f"l.{left_time}") >= F.col(f"r.{right_time}") + F.expr(f"INTERVAL {lo} SECONDS"))
            & (F.col(f"l.{left_time}") <= F.col(f"r.{right_time}") + F.expr(f"INTERVAL {hi} SECONDS")))
    return l.join(r, cond, how)


# ------------------------------------------------------------ OVER processor
def running_range_stream(df: DataFrame, *, keys: str | Sequence[str], time_col: str, value_col: str,
                         range_: str, id_col: str, threshold: float | None = None,
                         total_alias: str = "total_value", flag_alias: str = "flag",
                         agg: str = "sum") -> DataFrame:
    """W1/W2/W3 on a watermarked stream: ``SUM(v) OVER (PARTITION BY keys ORDER BY t
    RANGE range PRECEDING)``, emitted once a row is final (below the watermark).

    Per key the state holds the rows not yet emitted and the emitted rows still
    inside the range; everything older than ``watermark - range`` is evicted,
    so state is bounded by the rows of one range.  Peers (equal time) are
    emitted together, as in the batch frame.  ``agg='count'`` gives W2's
    ``COUNT(*)`` (``value_col`` is then ignored).
    """
    keys = _cols(keys)
    r_us = _micros(range_)
    out_schema = (", ".join(f"{k} string" for k in keys)
                  + f", {id_col} string, {time_col} timestamp, {value_col} double, {total_alias} {'long' if agg == 'count' else 'double'}"
                  + (f", {flag_alias} string" if threshold is not None else ""))

    def fn(key, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        pending, history = ([], []) if not state.exists else json.loads(state.get[0])
        for pdf in pdfs:
            for tid, t, v in zip(pdf[id_col], pdf[time_col], pdf[value_col]):
                pending.append([str(tid), int(pd.Timestamp(t).value // 1000), None if pd.isna(v) else float(v)])
        wm = state.getCurrentWatermarkMs() * 1000  # microseconds, like the rows
        ready = sorted(p for p in pending if p[1] <= wm)
        pending = [p for p in pending if p[1] > wm]
        rows = []
        hist = sorted(history + ready, key=lambda p: p[1])
        times = np.array([h[1] for h in hist], dtype=np.int64)
        # whole millionths: sums and their differences are exact; NULLs add nothing
        known = np.concatenate([[0], np.cumsum([h[2] is not None for h in hist])])
        csum = np.concatenate([[0], np.cumsum([0 if h[2] is None else round(h[2] * 10**6) for h in hist], dtype=np.int64)])
        for tid, t, v in ready:
            hi = np.searchsorted(times, t, side="right")
            lo = np.searchsorted(times, t - r_us, side="left")
            total = int(csum[hi] - csum[lo]) / 10**6 if known[hi] > known[lo] else None
            rows.append((*key, tid, pd.Timestamp(t, unit="us"), v, int(hi - lo) if agg == "count" else total))
        history = [h for h in hist if h[1] >= wm - r_us]
        if pending or history:
            state.update((json.dumps([pending, history], default=str),))
            nxt = min([p[1] for p in pending], default=wm + r_us)
            state.setTimeoutTimestamp(max(nxt // 1000 + 1, wm // 1000 + 1))
        else:
            state.remove()
        if rows:
            out = pd.DataFrame(rows, columns=[*keys, id_col, time_col, value_col, total_alias])
            out = out.astype({c: float for c in (value_col, total_alias) if c == value_col or agg != "count"})
            if threshold is not None:
                out[flag_alias] = (out[total_alias] > threshold).map({True: "YES", False: "NO"})
            yield out

    src = df.select(*[F.col(k).cast("string") for k in keys], F.col(id_col).cast("string"),
                    F.col(time_col), F.col(value_col).cast("double"))
    return src.groupBy(*keys).applyInPandasWithState(
        fn, out_schema, "s string", "append", GroupStateTimeout.EventTimeTimeout)
