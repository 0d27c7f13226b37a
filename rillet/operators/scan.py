"""Skew-safe ordered scans per key.

A window ``PARTITION BY key ORDER BY t`` puts every row of a key in one task.
When one key may hold a large share of all rows, the scans here split each
key by event-time slices (:class:`Slices`) and stitch the slices together exactly:

1. a local window inside each ``(key, slice)``;
2. one summary row per ``(key, slice)`` (partial-aggregated before the shuffle);
3. a carry over the summaries of earlier slices (one row per slice: tiny);
4. ``combine(local, carry)`` per row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.operators.over import _epoch_us, _micros

#: Rows that one slice should have, hence the most that a key can have in one, whatever its share.
ROWS_PER_TASK = 2_000_000
#: Slices at most: their borders are a literal of the plan.
MOST_SLICES = 16_384


class Slices:
    """Event time cut into slices by borders (microseconds) or, given a width, evenly.

    A time equal to a border begins the slice: rows of one time share a slice.
    """

    def __init__(self, borders: Sequence[int] = (), width: int | None = None) -> None:
        self.borders, self.width = sorted(set(borders)), width

    @property
    def whole(self) -> bool:
        """Whether all times are one slice."""
        return not self.width and not self.borders

    def of(self, t: Column) -> Column:
        """Number of the slice that time ``t`` (microseconds) is in, rising with it; NULL for NULL."""
        if self.width:
            return F.floor(t / F.lit(self.width)).cast("long")
        if not self.borders:
            return F.when(t.isNotNull(), F.lit(0).cast("long"))
        # how many borders are at most t, by binary search; the list is folded to one literal
        cuts = F.split(F.lit(",".join(map(str, self.borders))), ",").cast("array<bigint>")
        n = len(self.borders)
        steps = F.array(*[F.lit(1 << k) for k in reversed(range(n.bit_length()))])
        below = F.aggregate(steps, F.lit(0), lambda a, step: F.when((a + step <= n) & (F.get(cuts, a + step - 1) <= t), a + step).otherwise(a))
        return F.when(t.isNotNull(), below.cast("long"))


def rank_slices(df: DataFrame, time_col: str, *, rows_per_task: int | None = None) -> Slices:
    """Slices with about ``rows_per_task`` rows of ``df`` each, so no key can have more in one, be
    it hot, bursty or beside outliers; only rows of one and the same time can't be parted.

    A count and, where one slice is too few, quantiles of the time column are read by the
    driver.  Scans are exact for any borders.  Beyond MOST_SLICES slices they grow with the table.
    """
    t = _epoch_us(F.col(time_col))
    n = -(-df.count() // (rows_per_task or ROWS_PER_TASK))
    if n <= 1:
        return Slices()
    n = min(n, MOST_SLICES)
    return Slices(df.select(F.percentile_approx(t, [i / n for i in range(1, n)], max(10_000, 8 * n))).first()[0] or ())


def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


def matched(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equality of columns in which NULL equals NULL."""
    out = F.col(left[0]).eqNullSafe(F.col(right[0]))
    for a, b in zip(left[1:], right[1:], strict=True):
        out = out & F.col(a).eqNullSafe(F.col(b))
    return out


def key_of(keys: Sequence[str]) -> Column:
    """The keys as one struct, which is never NULL: windows, groups and plain equi-joins on it
    take NULL keys as one key and share one partitioning."""
    return F.struct(*[F.col(k) for k in keys])


#: Slice of the rows without a time, before all others.
TIMELESS = -(1 << 62)


def slices_for(df: DataFrame, time_col: str, slice_: str | Slices | None) -> Slices:
    """``slice_`` as given, a width such as '4 hours', or slices by rank if None."""
    if slice_ is None:
        return rank_slices(df, time_col)
    return Slices(width=_micros(slice_)) if isinstance(slice_, str) else slice_


def with_slice(df: DataFrame, time_col: str, slice_: str | Slices | None) -> DataFrame:
    """``_slice``: the number of the row's slice; rows without a time share one, before all others."""
    number = slices_for(df, time_col, slice_).of(_epoch_us(F.col(time_col)))
    return df.withColumn("_slice", F.coalesce(number, F.lit(TIMELESS)))


def carried(local: DataFrame, carry: DataFrame) -> DataFrame:
    """``local`` with the columns that ``carry`` has for its (_key, _slice)."""
    return local.join(carry, ["_key", "_slice"], "left")


def running_totals(df: DataFrame, *, keys: str | Sequence[str], order_cols: Sequence[str],
                   values: dict[str, Column], time_col: str | None = None,
                   slice_: str | Slices | None = None) -> DataFrame:
    """``SUM(v) OVER (PARTITION BY keys ORDER BY order_cols ROWS UNBOUNDED PRECEDING)``
    for each ``alias -> v`` in ``values``, in one pass.

    The per-slice totals are taken from the local window's output, which is
    already partitioned by (keys, slice): no extra scan or shuffle of the input.
    """
    keys = _cols(keys)
    names = list(values)
    base = with_slice(df.select("*", key_of(keys).alias("_key"), *[v.alias(f"_v_{n}") for n, v in values.items()]),
                      time_col or order_cols[0], slice_)
    local_w = (Window.partitionBy("_key", "_slice").orderBy(*order_cols)
               .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = base.select("*", *[F.sum(f"_v_{n}").over(local_w).alias(f"_loc_{n}") for n in names])
    summ = local.groupBy("_key", "_slice").agg(*[F.sum(f"_v_{n}").alias(f"_tot_{n}") for n in names])
    carry_w = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select("_key", "_slice", *[F.coalesce(F.sum(f"_tot_{n}").over(carry_w), F.lit(0))
                                            .alias(f"_carry_{n}") for n in names])
    return carried(local, carry).select(
                      *[F.col(c) for c in df.columns],
                      *[(F.col(f"_loc_{n}") + F.col(f"_carry_{n}")).alias(n) for n in names])


def running_total(df: DataFrame, *, keys: str | Sequence[str], order_cols: Sequence[str],
                  value: Column, alias: str, time_col: str | None = None,
                  slice_: str | Slices | None = None) -> DataFrame:
    """Single-value form of :func:`running_totals`."""
    return running_totals(df, keys=keys, order_cols=order_cols, values={alias: value},
                          time_col=time_col, slice_=slice_)


def previous_value(df: DataFrame, *, keys: str | Sequence[str], order_cols: Sequence[str],
                   value: Column, alias: str, time_col: str | None = None,
                   slice_: str | Slices | None = None) -> DataFrame:
    """``LAG(value, 1) OVER (PARTITION BY keys ORDER BY order_cols)`` for non-NULL ``value``
    (wrap nullable values in a struct)."""
    keys = _cols(keys)
    base = with_slice(df.withColumn("_v", value).withColumn("_key", key_of(keys)), time_col or order_cols[0], slice_)
    local_w = Window.partitionBy("_key", "_slice").orderBy(*order_cols)
    local = base.withColumn("_loc", F.lag("_v", 1).over(local_w))
    ordering = F.struct(*[F.col(c) for c in order_cols])
    summ = local.groupBy("_key", "_slice").agg(F.max_by("_v", ordering).alias("_lastv"))
    carry_w = Window.partitionBy("_key").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = summ.select("_key", "_slice", F.last("_lastv", ignorenulls=True).over(carry_w).alias("_carry"))
    return carried(local, carry).select(*[F.col(c) for c in df.columns if c != alias],
                                        F.coalesce(F.col("_loc"), F.col("_carry")).alias(alias))


def next_rows(df: DataFrame, *, keys: str | Sequence[str], order_cols: Sequence[str], time_col: str,
              values: Sequence[str], n: int = 2, slice_: str | Slices | None = None) -> DataFrame:
    """``LEAD(v, 1..n) OVER (PARTITION BY keys ORDER BY order_cols)`` for each value.

    Rows that have n successors in their (key, slice) take them from there.  The others are
    the last n rows of a slice, and what follows them is among the last and first n rows of
    slices: at most 2n rows a slice, over which the leads are taken once more.
    """
    keys = _cols(keys)
    base = with_slice(df, time_col, slice_)
    w = Window.partitionBy(*keys, "_slice").orderBy(*order_cols)
    place = base.withColumn("_first", F.row_number().over(w)).withColumn(
        "_left", F.count(F.lit(1)).over(Window.partitionBy(*keys, "_slice")) - F.col("_first"))
    lead = lambda over: [F.lead(v, k).over(over).alias(f"{v}_{k}") for k in range(1, n + 1) for v in values]
    drop = ("_slice", "_first", "_left")
    inside = place.select("*", *lead(w)).where(F.col("_left") >= n).drop(*drop)
    rim = place.where((F.col("_first") <= n) | (F.col("_left") < n))
    across = rim.select("*", *lead(Window.partitionBy(*keys).orderBy("_slice", *order_cols))).where(F.col("_left") < n).drop(*drop)
    return inside.unionByName(across)
