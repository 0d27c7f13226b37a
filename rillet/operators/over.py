"""OVER-window operators.

Sums and counts over ``RANGE BETWEEN INTERVAL x PRECEDING AND CURRENT ROW`` add up parts of
slices and whole slices (:func:`running_range_totals`), so neither a hot key nor a long range has
to fit one task, and nothing is subtracted: any doubles sum as in a plain window.

Unbounded frames (``ROWS UNBOUNDED PRECEDING``) use a two-level scan: a local
scan per slice, a carry computed from one summary row per slice, and a final
combine; see :func:`latest_values`.  There is one plan for every input size.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def _micros(interval: str) -> int:
    """'3 days' / '1 hour' / '1.5 seconds' -> microseconds; an interval that is no whole
    number of them is an error."""
    n, unit = interval.strip().split()
    unit = unit.lower().rstrip("s")
    mult = {"microsecond": 1, "millisecond": 1000, "second": 10**6, "minute": 60 * 10**6, "hour": 3600 * 10**6,
            "day": 86400 * 10**6, "week": 604800 * 10**6}[unit]
    us = Fraction(n) * mult
    if us.denominator != 1:
        raise ValueError(f"{interval!r} is not a whole number of microseconds")
    return int(us)


def _seconds(interval: str) -> int:
    """An interval in whole seconds; a fraction of a second is an error."""
    us = _micros(interval)
    if us % 10**6:
        raise ValueError(f"{interval!r} is not a whole number of seconds")
    return us // 10**6


def _epoch_us(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def running_aggregate(df: DataFrame, *, keys: str | Sequence[str], time_col: str,
                      range_: str, aggs: dict[str, Column], slice_: str | None = None) -> DataFrame:
    """Attach any aggregates over ``RANGE range_ PRECEDING .. CURRENT ROW`` per key.

    For aggregates that have no difference (MIN, MAX, ...): a task holds the rows of a
    key's slice and of the range before it, so the slice (``slice_``, by default four
    ranges) is what splits a key.  Sums and counts: :func:`running_range_totals`.
    Peers are inside the frame; rows without a time are each other's peers, as in SQL.
    """
    keys = _cols(keys)
    r_us = _micros(range_)
    s_us = max(_micros(slice_), r_us) if slice_ else 4 * r_us
    base = df.withColumn("_t", _epoch_us(F.col(time_col))).withColumn("_slice", F.floor(F.col("_t") / F.lit(s_us)))
    # Rows within `range` of the next slice's start are also copied there as halo.
    next_start = (F.col("_slice") + 1) * F.lit(s_us)
    halo = (base.where(F.col("_t") >= next_start - F.lit(r_us))
            .withColumn("_slice", F.col("_slice") + 1).withColumn("_halo", F.lit(True)))
    both = base.withColumn("_halo", F.lit(False)).unionByName(halo)
    w = (Window.partitionBy(*keys, "_slice").orderBy("_t")
         .rangeBetween(-r_us, Window.currentRow))
    out = both.select("*", *[expr.over(w).alias(name) for name, expr in aggs.items()])
    return out.where(~F.col("_halo")).drop("_t", "_slice", "_halo")


def running_range_totals(df: DataFrame, *, keys: str | Sequence[str], time_col: str, range_: str,
                         sums: dict[str, Column] | None = None, counts: dict[str, Column] | None = None,
                         slice_=None) -> DataFrame:
    """Attach ``SUM(v)`` (``sums``) and ``COUNT(v)`` (``counts``) over ``RANGE range_
    PRECEDING .. CURRENT ROW`` per key.

    Slices are cut at the borders of :class:`rillet.operators.scan.Slices` and at these plus the range, so
    the frames that end in a slice all begin in one slice or in neighbours without a border + range
    between.  A row x goes to its own slice and, its values alone, to the slice of x + range if that
    is another: there a plain window finds the rows at both ends of each frame.  What lies between the two
    slices is in every frame of the slice and is added as one total per (key, slice).

    One shuffle of the rows with at most one narrow copy each, one partial aggregate of the values.
    A sum of no values is NULL.  Rows with a NULL key are one key; rows without a time are each
    other's peers and nobody else's.
    """
    from rillet.operators.scan import TIMELESS, key_of, slices_for

    keys, sums, counts = _cols(keys), sums or {}, counts or {}
    r_us, slices = _micros(range_), slices_for(df, time_col, slice_)
    t = _epoch_us(F.col(time_col))
    # borders and borders + range, counted: both slices of x, x's own and that of x + range
    own = F.coalesce(slices.of(t) + slices.of(t - F.lit(r_us)), F.lit(TIMELESS))
    far = F.coalesce(slices.of(t + F.lit(r_us)) + slices.of(t), F.lit(TIMELESS))
    values = {**{f"_s_{n}": v for n, v in sums.items()}, **{f"_n_{n}": v for n, v in {**sums, **counts}.items()}}
    total = {n: F.sum(n) if n.startswith("_s_") else F.count(n) for n in values}
    kind = {f"_s_{n}": df.select(F.sum(v)).schema[0].dataType for n, v in sums.items()}
    base = df.select(key_of(keys).alias("_key"), t.alias("_t"), own.alias("_own"), far.alias("_far"), F.struct(*[F.col(c) for c in df.columns]).alias("_row"),
                     *[v.alias(n) for n, v in values.items()])
    places = F.when(F.col("_far") > F.col("_own"), F.array("_own", "_far")).otherwise(F.array("_own"))
    placed = base.select("_key", "_t", "_own", *values, "_row", F.explode(places).alias("_slice"))
    placed = placed.withColumn("_row", F.when(F.col("_slice") == F.col("_own"), F.col("_row")))
    frame = Window.partitionBy("_key", "_slice").orderBy("_t").rangeBetween(-r_us, Window.currentRow)
    ends = placed.select("_key", "_slice", "_row", *[e.over(frame).alias(n) for n, e in total.items()]).where(F.col("_row").isNotNull())
    inner = None if slices.whole else _between(base, values, total)   # without borders nothing lies between two slices
    both = ends if inner is None else ends.join(inner, ["_key", "_slice"], "left")

    def added(n: str) -> Column:
        if inner is None:
            return F.col(n)
        a, b = F.col(n), F.col(f"_in{n}")
        return F.coalesce(a + b, a, b) if n in kind else a + F.coalesce(b, F.lit(0))

    return both.select(*[F.col(f"_row.`{c}`").alias(c) for c in df.columns],
                       *[F.when(added(f"_n_{n}") > 0, added(f"_s_{n}").cast(kind[f"_s_{n}"])).alias(n) for n in sums],
                       *[added(f"_n_{n}").cast("bigint").alias(n) for n in counts])


def _between(base: DataFrame, values: Sequence[str], total: dict[str, Column]) -> DataFrame:
    """Per (key, slice) the totals of the rows that every frame of the slice holds whole: those
    whose own slice is an earlier one and whose time + range lies in a later one."""
    cells = base.groupBy("_key", "_own", "_far").agg(*[e.alias(n) for n, e in total.items()])
    inner = cells.alias("c").join(cells.select("_key", F.col("_own").alias("_slice")).distinct().alias("s"),
                                  (F.col("c._key") == F.col("s._key")) & (F.col("c._own") < F.col("s._slice")) & (F.col("s._slice") < F.col("c._far")))
    return inner.groupBy(F.col("s._key").alias("_key"), F.col("s._slice").alias("_slice")).agg(*[F.sum(f"c.{n}").alias(f"_in{n}") for n in values])


def running_sum_flag(df: DataFrame, *, keys: str | Sequence[str], time_col: str, value_col: str,
                     range_: str, threshold: float, total_alias: str = "total_value",
                     flag_alias: str = "flag", slice_=None,
                     only: Column | None = None) -> DataFrame:
    """Running SUM over a time range with a YES/NO flag when it exceeds ``threshold``.

    ``only``: compute the window over the rows matching it (as if the input were
    filtered) but keep every row; other rows get NULL total and flag.  This lets
    several differently filtered windows run over one table without joins (W4).
    """
    v = F.col(value_col) if only is None else F.when(only, F.col(value_col))
    out = running_range_totals(df, keys=keys, time_col=time_col, range_=range_, sums={total_alias: v}, slice_=slice_)
    flag = F.when(F.col(total_alias) > F.lit(threshold), "YES").otherwise("NO")
    if only is not None:
        out = out.withColumn(total_alias, F.when(only, F.col(total_alias)))
        flag = F.when(only, flag)
    return out.withColumn(flag_alias, flag)


def running_count(df: DataFrame, *, keys: str | Sequence[str], time_col: str, range_: str,
                  alias: str = "cnt", slice_=None) -> DataFrame:
    """Running ``COUNT(*)`` over a time range."""
    return running_range_totals(df, keys=keys, time_col=time_col, range_=range_, counts={alias: F.lit(1)}, slice_=slice_)


def latest_values(df: DataFrame, *, keys: str | Sequence[str], order_cols: Sequence[str],
                  value_cols: Sequence[str], prefix: str = "last_", slice_=None,
                  time_col: str | None = None) -> DataFrame:
    """``LAST_VALUE(c IGNORE NULLS) OVER (PARTITION BY keys ORDER BY .. ROWS UNBOUNDED
    PRECEDING)`` for each value column, one output row per input row.

    Two-level scan so one hot key never sits in a single task: (1) a local scan
    inside each (key, time slice); (2) per slice a one-row summary of the last
    non-NULL value of every column, carried forward over slices with the same
    window (one row per slice, tiny); (3) combine ``coalesce(local, carry)``.
    ``order_cols[0]`` (or ``time_col``) must be the event time.  ``slice_`` is sized from
    the data if it isn't given.  Rows with a NULL key are one key, rows without a time come
    first in it.
    """
    from rillet.operators.scan import carried, key_of, with_slice

    base = with_slice(df.withColumn("_key", key_of(_cols(keys))), time_col or order_cols[0], slice_)
    local_w = (Window.partitionBy("_key", "_slice").orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base.select("*", *[F.last(c, ignorenulls=True).over(local_w).alias(f"_loc_{c}")
                               for c in value_cols])
    # Summary: last non-null of every column within each slice, ordered by the
    # same keys.  max_by over a struct of the order columns picks it exactly.
    order_struct = F.struct(*[F.col(c) for c in order_cols])
    summ = local.groupBy("_key", "_slice").agg(*[
        F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_struct)).alias(f"_s_{c}")
        for c in value_cols])
    carry_w = (Window.partitionBy("_key").orderBy("_slice")
               .rowsBetween(Window.unboundedPreceding, -1))
    carry = summ.select("_key", "_slice", *[F.last(f"_s_{c}", ignorenulls=True).over(carry_w)
                                            .alias(f"_c_{c}") for c in value_cols])
    return carried(local, carry).select(
                      *[F.col(c) for c in df.columns],
                      *[F.coalesce(F.col(f"_loc_{c}"), F.col(f"_c_{c}")).alias(f"{prefix}{c}")
                        for c in value_cols])


def lag_over_tumble(counts: DataFrame, *, keys: str | Sequence[str], count_col: str,
                    order_col: str = "window_end", prev_alias: str = "prev_count",
                    delta_alias: str = "delta") -> DataFrame:
    """``LAG(COUNT(*), 1) OVER (PARTITION BY keys ORDER BY window_time)`` and the delta.

    Input is the (small) output of a tumbling aggregate: one row per window and
    key, so the window has few rows per key.
    """
    w = Window.partitionBy(*_cols(keys)).orderBy(order_col)
    # NULL for the first window of a key; DOUBLE keeps that NULL type-stable.
    prev = F.lag(F.col(count_col), 1).over(w).cast("double")
    return counts.select("*", prev.alias(prev_alias), (F.col(count_col) - prev).alias(delta_alias))
