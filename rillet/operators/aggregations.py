"""Grouped and time-windowed aggregates.

All are plain ``groupBy().agg()`` plans: Spark runs a partial (map-side)
aggregate before the shuffle, so the exchange carries one row per group and
partition, and a hot key costs no more than a cold one after the partial step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def group_sum_having(df: DataFrame, keys: str | Sequence[str], value_col: str, *,
                     threshold: float | None = None, where: Column | None = None,
                     alias: str = "total_amount", as_type: str | None = "double") -> DataFrame:
    """A1/A2: ``SELECT keys, SUM(v) FROM df WHERE .. GROUP BY keys HAVING SUM(v) > t``.

    The sum runs in the input type (exact for decimals) and is cast once at the
    end.  ``where`` is applied before the aggregate so it reaches the scan.
    """
    src = df if where is None else df.where(where)
    total = F.sum(value_col)
    out = src.groupBy(*_cols(keys)).agg(total.alias(alias))
    if threshold is not None:
        out = out.where(F.col(alias) > F.lit(threshold))
    if as_type:
        out = out.withColumn(alias, F.col(alias).cast(as_type))
    return out


def tumbling_count(df: DataFrame, time_col: str, size: str, keys: str | Sequence[str], *,
                   count_col: str | None = None, where: Column | None = None,
                   alias: str = "cnt") -> DataFrame:
    """A4/A5: count per tumbling window and key.

    ``count_col=None`` counts rows (``COUNT(*)``, A4); a column name counts its
    non-NULL values (``count(merchant)``, A5).
    """
    src = df if where is None else df.where(where)
    cnt = F.count(F.lit(1)) if count_col is None else F.count(F.col(count_col))
    g = src.groupBy(F.window(F.col(time_col), size).alias("w"), *_cols(keys)).agg(cnt.alias(alias))
    return g.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    *_cols(keys), F.col(alias).cast("bigint").alias(alias))


def session_count(df: DataFrame, time_col: str, gap: str, keys: str | Sequence[str], *,
                  where: Column | None = None, alias: str = "total_tx", slice_: str | None = None) -> DataFrame:
    """Session windows per key; a new session starts when the gap *exceeds* ``gap``.

    A session lasts to its last event + gap, as the reference's SESSION TVF has it, so
    ``sec_duration`` includes the gap; rows exactly one gap apart are one session.  Gaps and
    islands in one sliced scan, so that a hot key is not one task: sessions of each slice, numbered within it; one row per
    slice tells whether its first session goes on the last one before and how many began earlier; pieces of one
    number are then one session.  Rows without a time belong to no session; NULL is a key.
    """
    from rillet.operators.over import _micros
    from rillet.operators.scan import key_of, with_slice

    keys, gap_us = _cols(keys), _micros(gap)
    src = (df if where is None else df.where(where)).where(F.col(time_col).isNotNull())
    rows = src.select(key_of(keys).alias("_key"), F.col(time_col).alias("_time"), F.unix_micros(F.col(time_col).cast("timestamp")).alias("_t"))
    rows = with_slice(rows, "_time", slice_)
    inside = Window.partitionBy("_key", "_slice").orderBy("_t")
    apart = F.col("_t") - F.lag("_t").over(inside) > F.lit(gap_us)
    numbered = rows.withColumn("_new", F.when(apart, 1).otherwise(0)).withColumn("_n", F.sum("_new").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    pieces = numbered.groupBy("_key", "_slice", "_n").agg(F.min("_time").alias("_s"), F.max("_time").alias("_e"), F.min("_t").alias("_a"), F.max("_t").alias("_b"),
                                                         F.count(F.lit(1)).alias(alias))
    before = Window.partitionBy("_key").orderBy("_slice")
    slices = pieces.groupBy("_key", "_slice").agg(F.min("_a").alias("_a"), F.max("_b").alias("_b"), F.max("_n").alias("_more"))
    last = F.lag("_b").over(before)
    slices = slices.withColumn("_new", F.when(last.isNull() | (F.col("_a") - last > F.lit(gap_us)), 1).otherwise(0))
    begun = F.sum(F.col("_new") + F.col("_more")).over(before.rowsBetween(Window.unboundedPreceding, 0)) - F.col("_more")
    joined = pieces.join(slices.select("_key", "_slice", begun.alias("_begun")), ["_key", "_slice"])
    g = joined.groupBy("_key", (F.col("_begun") + F.col("_n")).alias("_sid")).agg(F.min("_s").alias("_s"), F.max("_e").alias("_e"), F.sum(alias).alias(alias))
    g = g.select(*[F.col(f"_key.`{k}`").alias(k) for k in keys], "_s", "_e", alias)
    end = f"_e + make_dt_interval(0, 0, 0, {_micros(gap)}BD / 1000000)"
    return g.select(F.col("_s").alias("window_start"), F.expr(end).alias("window_end"),
                    F.expr(f"timestampdiff(SECOND, _s, {end})").cast("bigint").alias("sec_duration"),
                    *keys, F.col(alias).cast("bigint").alias(alias))
