"""Join operators.

Design rules used throughout:

* Equi keys always go into the join condition so Spark hash-partitions (or
  broadcasts) on them; time bounds are residual range predicates.
* No broadcast hints: AQE broadcasts a side whose size it has measured at run
  time, and splits skewed partitions of the others.
* Time-bounded joins (J2, J4, J5) additionally bucket event time so the join
  key is ``(key, bucket)``: a hot key's rows spread over many tasks and no
  pair outside the bound is ever formed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.operators.over import _micros

def _cols(keys: str | Sequence[str]) -> list[str]:
    return [keys] if isinstance(keys, str) else list(keys)


# --------------------------------------------------------------------------- J1
def temporal_join(left: DataFrame, versions: DataFrame, *, key: str, left_time: str,
                  version_time: str, version_cols: Sequence[str], tiebreak: str | None = None,
                  slice_: str | None = None) -> DataFrame:
    """``left JOIN versions FOR SYSTEM_TIME AS OF left.time`` (inner).

    Each left row receives the latest version with ``version_time <= left_time``
    (a version created at the same instant counts as valid).  Left rows with no
    earlier version are dropped (inner join).

    Plan: both sides are tagged and unioned; a LAST(ignore nulls) scan over
    ``(key, time, side)`` carries the current version forward.  Linear, no
    fan-out, and the scan is split by event-time slices (see
    :func:`rillet.operators.over.latest_values`) so a hot key is not one task.
    """
    from rillet.operators.over import latest_values

    vcols = list(version_cols)
    lcols = [c for c in left.columns]
    payload = F.struct(*[F.col(c) for c in vcols])
    l = left.select(*[F.col(c) for c in lcols], F.col(left_time).alias("_ts"),
                    F.lit(1).alias("_side"), F.lit(None).cast(
                        versions.select(payload.alias("v")).schema["v"].dataType).alias("_ver"))
    v = versions.select(*[F.lit(None).cast(left.schema[c].dataType).alias(c) if c != key
                          else F.col(key) for c in lcols],
                        F.col(version_time).alias("_ts"), F.lit(0).alias("_side"),
                        payload.alias("_ver"))
    order = ["_ts", "_side"] + ([tiebreak] if tiebreak else [])
    u = l.unionByName(v)
    scanned = latest_values(u, keys=key, order_cols=order, value_cols=["_ver"], prefix="_cur",
                            slice_=slice_, time_col="_ts")
    out = scanned.where((F.col("_side") == 1) & F.col("_cur_ver").isNotNull())
    return out.select(*[F.col(c) for c in lcols], *[F.col(f"_cur_ver.{c}").alias(c) for c in vcols])


# --------------------------------------------------------------------------- J2
def interval_join(left: DataFrame, right: DataFrame, *, key: str, left_time: str, right_time: str,
                  lower: str, upper: str, how: str = "inner",
                  bucket: str | None = None) -> DataFrame:
    """J2 (and J4/J5): ``l.key = r.key AND l.t BETWEEN r.t + lower AND r.t + upper``.

    ``lower``/``upper`` are signed intervals such as ``'0 seconds'`` and
    ``'10 seconds'``; both ends inclusive.  Event time is cut into buckets of
    ``bucket`` (default: the bound's width); every right row is sent to each
    bucket its window touches, so the equi key is ``(key, bucket)`` and a hot
    key is spread over its buckets.  Output columns: all left, then all right.
    """
    lo_us = _micros(lower) if not lower.startswith("-") else -_micros(lower[1:])
    hi_us = _micros(upper) if not upper.startswith("-") else -_micros(upper[1:])
    b_us = _micros(bucket) if bucket else max(hi_us - lo_us, 1)
    sides = {"inner": (False, False), "left": (True, False), "right": (False, True), "full": (True, True)}
    pad_left, pad_right = sides[_how(how)]
    names = [f"r_{c}" if c in left.columns else c for c in right.columns]
    at = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    l = left.select(F.struct(*[F.col(f"`{c}`") for c in left.columns]).alias("_l"), F.col(f"`{key}`").alias("_lk"), at(left_time).alias("_lt"))
    r = right.select(F.struct(*[F.col(f"`{c}`") for c in right.columns]).alias("_r"), F.col(f"`{key}`").alias("_rk"), at(right_time).alias("_rt"))
    l = l.withColumn("_lb", F.floor(F.col("_lt") / F.lit(b_us)))
    # Buckets touched by [rt+lo, rt+hi]: at most width/b + 2 of them.
    copies = r.withColumn("_rb", F.explode(F.sequence(F.floor((F.col("_rt") + F.lit(lo_us)) / F.lit(b_us)), F.floor((F.col("_rt") + F.lit(hi_us)) / F.lit(b_us)))))
    cond = ((F.col("_lk") == F.col("_rk")) & (F.col("_lb") == F.col("_rb"))
            & F.col("_lt").between(F.col("_rt") + F.lit(lo_us), F.col("_rt") + F.lit(hi_us)))
    # a left row stands in one bucket alone, so it is padded at most once
    pairs = l.join(copies, cond, "left" if pad_left else "inner").select("_l", "_r")
    if pad_right:
        # a right row stands in several: whether any of them met is decided once, by what the row holds
        met = l.join(copies, cond, "inner").select(_identity("_r").alias("_id")).distinct()
        alone = r.withColumn("_id", _identity("_r")).join(met, "_id", "left_anti").select(F.lit(None).cast(pairs.schema["_l"].dataType).alias("_l"), "_r")
        pairs = pairs.unionByName(alone)
    return pairs.select(*[F.col(f"_l.`{c}`").alias(c) for c in left.columns], *[F.col(f"_r.`{c}`").alias(n) for c, n in zip(right.columns, names, strict=True)])


def _how(how: str) -> str:
    """The short name of a join type."""
    name = how.lower().replace("_", "").removesuffix("outer") or "full"
    if name not in ("inner", "left", "right", "full"):
        raise ValueError(f"unknown join type {how!r}")
    return name


def _identity(struct: str) -> Column:
    """128 bits for what a row holds: equal rows meet the same partners."""
    return F.struct(F.xxhash64(struct).alias("a"), F.xxhash64(F.lit(7), struct).alias("b"))


# --------------------------------------------------------------------------- J3
def regular_join(left: DataFrame, right: DataFrame, *, key: str, how: str = "inner") -> DataFrame:
    """Plain equi join on ``key``; Spark picks broadcast or sort-merge.

    Output keeps every left and right column; the right key column is dropped
    (``USING`` semantics), for right rows without a partner the key is theirs.

    Spark splits a hot key of an inner or left join (AQE skew join), but not of a full one.  A full
    join is therefore a left join and the right rows whose key the left side lacks, for which one row per left key is
    enough.  A NULL key has no partner on either side.
    """
    if _how(how) != "full":
        return left.join(right, on=key, how=how)
    others = [c for c in right.columns if c != key]
    present = left.select(key).distinct()
    alone = right.join(present, key, "left_anti")
    alone = alone.select(key, *[F.lit(None).cast(left.schema[c].dataType).alias(c) for c in left.columns if c != key], *others)
    return left.join(right, key, "left").select(key, *[c for c in left.columns if c != key], *others).union(alone)


def per_key_pair_counts(left: DataFrame, right: DataFrame, *, key: str, how: str = "inner",
                        left_value: str | None = None) -> DataFrame:
    """Aggregate form of J3/J9 without materialising the pairs.

    The number of joined rows per key is ``n_left * n_right`` (with outer
    padding); pre-aggregating each side to one row per key makes a many-to-many
    join on a hot key cost O(1) instead of O(n^2).
    """
    lagg = left.groupBy(key).agg(F.count(F.lit(1)).alias("_nl"),
                                 *([F.sum(left_value).alias("_sl")] if left_value else []))
    ragg = right.groupBy(key).agg(F.count(F.lit(1)).alias("_nr"))
    j = lagg.join(ragg, on=key, how=how)
    nl = F.coalesce(F.col("_nl"), F.lit(0))
    nr = F.coalesce(F.col("_nr"), F.lit(0))
    h = how.lower()
    if h in ("full", "outer", "full_outer", "fullouter"):
        pairs = F.greatest(nl, F.lit(1)) * F.greatest(nr, F.lit(1))
    elif h in ("left", "left_outer", "leftouter"):
        pairs = nl * F.greatest(nr, F.lit(1))
    elif h in ("right", "right_outer", "rightouter"):
        pairs = F.greatest(nl, F.lit(1)) * nr
    else:
        pairs = nl * nr
    cols = [F.col(key), pairs.cast("bigint").alias("pair_count")]
    if left_value:
        cols.append((F.col("_sl") * nr.cast("decimal(20,0)")).alias("pair_amount"))
    return j.select(*cols)


# --------------------------------------------------------------------------- J6
def lookup_join(left: DataFrame, table: DataFrame, *, left_key: Column, table_key: str,
                value_cols: Sequence[str], alias: str = "search_results",
                derive: dict[str, Callable[[Column], Column]] | None = None,
                keep_array: bool = True) -> DataFrame:
    """``KEY_SEARCH_AGG(table, DESCRIPTOR(key), expr)`` - one array of all matching rows.

    The lookup side is pre-grouped to one row per key (an array of structs,
    sorted for determinism), then left-joined; no match gives an empty array.
    ``derive`` computes columns from the array once per *key* on the grouped
    side (e.g. a count or a rendering) instead of once per left row; with
    ``keep_array=False`` only those derived columns cross the join.
    """
    grouped = table.groupBy(F.col(table_key).alias("_lk")).agg(
        F.sort_array(F.collect_list(F.struct(*value_cols))).alias(alias))
    empty = F.array().cast(grouped.schema[alias].dataType)
    derive = derive or {}
    grouped = grouped.select("_lk", *([alias] if keep_array else []),
                             *[fn(F.col(alias)).alias(name) for name, fn in derive.items()])
    l = left.withColumn("_lk", left_key)
    j = l.join(grouped, on="_lk", how="left")
    # Unmatched rows: the derived value of an empty array.
    for name, fn in derive.items():
        j = j.withColumn(name, F.coalesce(F.col(name), fn(empty)))
    if keep_array:
        j = j.withColumn(alias, F.coalesce(F.col(alias), empty))
    return j.drop("_lk")


# --------------------------------------------------------------------------- J10
def flag_join(base: DataFrame, flagged: DataFrame, *, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Left join of the base table to a flagged subset on ``keys``."""
    return base.join(flagged, on=list(keys), how=how)


# -------------------------------------------------------------------- helpers
def latest_per_key(df: DataFrame, *, key: str | Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """Keep the last row per key by ``order_cols`` (``max_by`` aggregate: partial
    aggregation before the shuffle, so a hot key is combined map-side)."""
    keys = _cols(key)
    others = [c for c in df.columns if c not in keys]
    ordering = F.struct(*[F.col(c) for c in order_cols])
    agg = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in others]), ordering).alias("_r"))
    return agg.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others])
