"""Row-sequence patterns (MATCH_RECOGNIZE M1-M3) per key, ordered by time.

Spark SQL has no MATCH_RECOGNIZE; each pattern is rewritten to windows,
joins and aggregates over skew-safe scans (:mod:`rillet.operators.scan`).
"Consecutive" means consecutive within the (pre-filtered) input of the key,
ordered by ``(time, tiebreak)``.  WITHIN bounds are inclusive.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillet.operators.over import _micros
from rillet.operators.scan import matched, next_rows, rank_slices, running_total, running_totals

# Rows of one failure run scanned as one array in the M1 scan (bounds task memory
# and the per-block match list).
M1_BLOCK_ROWS = 1024


def _run_ids(df: DataFrame, *, key: str, time_col: str, tiebreak: str, is_a: F.Column,
             slice_: str | None = None) -> DataFrame:
    """Number the runs of consecutive ``is_a`` rows per key: ``_g`` = count of
    non-``is_a`` rows up to and including this row.  A run of ``is_a`` rows
    shares ``_g``; the row ending it has ``_g + 1``."""
    flag = F.when(F.coalesce(is_a, F.lit(False)), 0).otherwise(1)
    return running_total(df, keys=key, order_cols=[time_col, tiebreak], value=flag, alias="_g",
                         time_col=time_col, **({"slice_": slice_} if slice_ else {}))


# --------------------------------------------------------------------------- M3
def escalating(df: DataFrame, *, key: str, time_col: str, value_col: str, within: str,
               tiebreak: str, slice_: str | None = None) -> DataFrame:
    """M3: ``PATTERN (A B C)``, ``B.v > A.v``, ``C.v > B.v``, WITHIN, SKIP TO NEXT ROW.

    Overlapping matches are allowed, so each row is tested independently with
    its next two rows (exact leads from :func:`next_rows`).
    """
    w_us = _micros(within)
    x = next_rows(df.select(key, time_col, tiebreak, value_col), keys=key,
                  order_cols=[time_col, tiebreak], time_col=time_col,
                  values=[value_col, time_col], n=2, slice_=slice_)
    t0 = F.unix_micros(F.col(time_col).cast("timestamp"))
    t2 = F.unix_micros(F.col(f"{time_col}_2").cast("timestamp"))
    m = x.where((F.col(f"{value_col}_1") > F.col(value_col)) & (F.col(f"{value_col}_2") > F.col(f"{value_col}_1"))
                & (t2 - t0 <= F.lit(w_us)))
    return m.select(key, F.col(value_col).alias("first_amount"), F.col(f"{value_col}_1").alias("second_amount"),
                    F.col(f"{value_col}_2").alias("third_amount"), F.col(time_col).alias("start_time"),
                    F.col(f"{time_col}_2").alias("end_time"))


# --------------------------------------------------------------------------- M2
def failures_then_success(df: DataFrame, *, key: str, time_col: str, tiebreak: str, status_col: str,
                          within: str, failed: str = "Failed", success: str = "Successful",
                          min_failed: int = 2, carry: list[str] | None = None,
                          slice_: str | None = None) -> DataFrame:
    """M2: ``PATTERN (FAILED{2,} SUCCESS)`` greedy, WITHIN, SKIP PAST LAST ROW.

    A match ends at a success row; its failures are the run right before it,
    from the earliest failure within the bound.  Runs never overlap, so the
    pattern is a join of each run to the row that ends it plus an aggregate.
    """
    carry = carry or []
    w_us = _micros(within)
    g = _run_ids(df, key=key, time_col=time_col, tiebreak=tiebreak, is_a=F.col(status_col) == failed,
                 slice_=slice_)
    fails = g.where(F.col(status_col) == failed).select(F.col(key).alias("_k"), F.col("_g").alias("_run"), F.col(time_col).alias("_ft"))
    succ = g.where(F.col(status_col) == success).select(
        key, (F.col("_g") - 1).alias("_g"), F.col(time_col).alias("success_time"), *carry)
    j = fails.join(succ, matched(["_k", "_run"], [key, "_g"]), "inner").where(
        F.unix_micros(F.col("success_time").cast("timestamp")) - F.unix_micros(F.col("_ft").cast("timestamp"))
        <= F.lit(w_us))
    out = j.groupBy(key, "_g", "success_time", *carry).agg(
        F.count(F.lit(1)).cast("bigint").alias("failed_attempts"), F.min("_ft").alias("first_attempt_time"))
    return out.where(F.col("failed_attempts") >= min_failed).drop("_g")


# --------------------------------------------------------------------------- M1
# Entry states of consecutive blocks are a prefix composition of 3-state
# transition functions.  Each level groups at most FOLD_FANOUT units, so no
# collected array grows with the run; FOLD_LEVELS levels cover runs of up to
# FOLD_FANOUT ** FOLD_LEVELS blocks.
FOLD_FANOUT = 1024
FOLD_LEVELS = 2


def _step(trans: F.Column, d: F.Column) -> F.Column:
    return F.element_at(F.array(trans["_x0"], trans["_x1"], trans["_x2"]), d + 1)


def _entry_states(units: DataFrame, run_keys: list[str], unit_col: str, levels: int) -> DataFrame:
    """``units``: (run_keys, unit_col, _x0, _x1, _x2) = exit state of each unit for
    entry states 0/1/2.  Returns (run_keys, unit_col, _e): the entry state of each
    unit when the run starts in state 0."""
    item = F.struct(F.col(unit_col).alias("u"), "_x0", "_x1", "_x2")
    if levels <= 1:
        runs = units.groupBy(*run_keys).agg(F.sort_array(F.collect_list(item)).alias("_ch"))
        start = F.lit(0)
    else:
        par = F.floor(F.col(unit_col) / F.lit(FOLD_FANOUT)).cast("bigint")
        runs = units.withColumn("_par", par).groupBy(*run_keys, "_par").agg(
            F.sort_array(F.collect_list(item)).alias("_ch"))
        # Composed transition of each parent: fold its children, no arrays built.
        comp = runs.select(*run_keys, "_par", *[
            F.aggregate("_ch", F.lit(e), lambda d, b: _step(b, d)).alias(f"_x{e}") for e in range(3)])
        parent_entry = _entry_states(comp, run_keys, "_par", levels - 1)
        same = [*run_keys, "_par"]
        parent_entry = parent_entry.select(*[F.col(c).alias(f"_p{c}") for c in same], "_e")
        runs = runs.join(parent_entry, matched(same, [f"_p{c}" for c in same]), "inner").drop(*[f"_p{c}" for c in same])
        start = F.col("_e")
    init = F.struct(start.alias("d"), F.array().cast("array<struct<u:bigint,e:int>>").alias("es"))
    fold = F.aggregate("_ch", init, lambda acc, b: F.struct(
        _step(b, acc["d"]).alias("d"),
        F.concat(acc["es"], F.array(F.struct(b["u"].cast("bigint").alias("u"), acc["d"].alias("e")))).alias("es")))
    return (runs.select(*run_keys, F.inline(fold["es"]))
            .withColumnRenamed("u", unit_col).withColumnRenamed("e", "_e"))


def min_run_reluctant(df: DataFrame, *, key: str, time_col: str, tiebreak: str, status_col: str,
                      within: str, failed: str = "Failed", size: int = 3,
                      block_rows: int = M1_BLOCK_ROWS, slice_: str | None = None) -> DataFrame:
    """M1: ``PATTERN (F{3,}?)`` reluctant, WITHIN, SKIP PAST LAST ROW.

    Reluctant + skip-past-last means exactly ``size`` rows per match, found by
    a greedy left-to-right scan of each failure run: a match starts at row i
    when rows i..i+2 fit the bound, then the scan resumes at i+3.

    The scan is sequential with a 3-value state d (rows still covered by the
    previous match).  Each run is cut into blocks of ``block_rows``; every
    block is scanned JVM-side (``aggregate`` over its sorted rows) for all 3
    possible entry states, the entry state of each block is a prefix
    composition of the per-block exit table (:func:`_entry_states`, at most
    ``FOLD_FANOUT`` units per group and level), and the matching variant is
    kept.  No task holds more than one block of rows.
    """
    if size != 3:
        raise ValueError("only the reference's F{3,}? pattern is supported")
    w_us = _micros(within)
    slice_ = slice_ or rank_slices(df, time_col)
    is_f = F.coalesce(F.col(status_col) == failed, F.lit(False))
    # One pass: _g numbers the failure runs, _nf counts failures so far (its
    # order inside a run is the run order, so blocks are ranges of _nf).
    g = running_totals(df, keys=key, order_cols=[time_col, tiebreak], time_col=time_col,
                       values={"_g": F.when(is_f, 0).otherwise(1), "_nf": F.when(is_f, 1).otherwise(0)}, slice_=slice_)
    fails = g.where(is_f).select(F.col(key).alias("_k"), "_g", "_nf", F.col(time_col).alias("_t"),
                                 F.col(tiebreak).alias("_tb"))
    # Second-next failure of the account; it is in the same run iff its _g matches.
    nx = next_rows(fails, keys="_k", order_cols=["_t", "_tb"], time_col="_t",
                   values=["_t", "_g"], n=2, slice_=slice_)
    ok = F.coalesce((F.col("_g_2") == F.col("_g")) & (
        F.unix_micros(F.col("_t_2").cast("timestamp")) - F.unix_micros(F.col("_t").cast("timestamp"))
        <= F.lit(w_us)), F.lit(False))
    nx = nx.withColumn("_i", F.col("_nf"))
    blocks = (nx.select("_k", "_g", F.floor((F.col("_i") - 1) / F.lit(block_rows)).cast("bigint").alias("_blk"),
                        F.struct(F.col("_i").alias("i"), ok.alias("ok"), F.col("_t").alias("t0"),
                                 F.col("_t_2").alias("t2")).alias("_r"))
              .groupBy("_k", "_g", "_blk").agg(F.sort_array(F.collect_list("_r")).alias("_rows")))
    mtype = f"array<struct<t0:{nx.schema['_t'].dataType.simpleString()},t2:{nx.schema['_t'].dataType.simpleString()}>>"

    def scan(entry: int) -> F.Column:
        init = F.struct(F.lit(entry).alias("d"), F.array().cast(mtype).alias("m"))
        return F.aggregate("_rows", init, lambda acc, x: F.when(
            (acc["d"] == 0) & x["ok"],
            F.struct(F.lit(2).alias("d"), F.concat(acc["m"], F.array(F.struct(x["t0"].alias("t0"),
                                                                              x["t2"].alias("t2")))).alias("m")))
            .otherwise(F.struct(F.greatest(acc["d"] - 1, F.lit(0)).alias("d"), acc["m"].alias("m"))))

    scanned = blocks.select("_k", "_g", "_blk", *[scan(e).alias(f"_s{e}") for e in range(3)])
    exits = scanned.select("_k", "_g", "_blk", *[F.col(f"_s{e}.d").alias(f"_x{e}") for e in range(3)])
    same = ["_k", "_g", "_blk"]
    entries = _entry_states(exits, ["_k", "_g"], "_blk", FOLD_LEVELS).select(*[F.col(c).alias(f"_p{c}") for c in same], "_e")
    picked = scanned.join(entries, matched(same, [f"_p{c}" for c in same]), "inner").select(
        "_k", F.explode(F.element_at(F.array(*[F.col(f"_s{e}.m") for e in range(3)]), F.col("_e") + 1)).alias("_m"))
    return picked.select(F.col("_k").alias(key), F.col("_m.t0").alias("first_failed_time"),
                         F.col("_m.t2").alias("last_failed_time"), F.lit(size).cast("bigint").alias("failed_count"))
