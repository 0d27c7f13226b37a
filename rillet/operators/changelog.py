"""Changelog, upsert and dead-letter operators (C2-C6, C11, C13), batch forms.

Streaming forms that need state across micro-batches live in
:mod:`rillet.streaming.sinks`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillet.operators.joins import latest_per_key
from rillet.operators.scan import previous_value

INSERT, UPDATE_BEFORE, UPDATE_AFTER, DELETE = "+I", "-U", "+U", "-D"


def changelog_view(df: DataFrame, *, key: str, order_cols: Sequence[str], time_col: str | None = None,
                   op_col: str = "op", slice_: str | None = None) -> DataFrame:
    """The changelog of an upsert stream keyed by ``key``.

    First row of a key -> ``+I``; every later row -> ``-U`` (the previous row)
    and ``+U`` (the new row).  The previous row comes from a skew-safe LAG.
    """
    cols = [c for c in df.columns]
    cur = F.struct(*[F.col(c) for c in cols])
    prev = previous_value(df.withColumn("_row", cur), keys=key, order_cols=list(order_cols),
                          value=F.col("_row"), alias="_prev", time_col=time_col,
                          **({"slice_": slice_} if slice_ else {}))
    recs = F.when(F.col("_prev").isNull(), F.array(F.struct(F.lit(INSERT).alias(op_col), F.col("_row").alias("r"))))\
        .otherwise(F.array(F.struct(F.lit(UPDATE_BEFORE).alias(op_col), F.col("_prev").alias("r")),
                           F.struct(F.lit(UPDATE_AFTER).alias(op_col), F.col("_row").alias("r"))))
    # Order of the records: position 0/1 inside the pair, by the new row's time.
    out = prev.select(*[F.col(c).alias(f"_o_{c}") for c in order_cols], F.posexplode(recs).alias("_pos", "_rec"))
    return out.select(F.col("_rec").getField(op_col).alias(op_col),
                      *[F.col("_rec.r").getField(c).alias(c) for c in cols],
                      *[F.col(f"_o_{c}").alias(f"change_{c}") for c in order_cols],
                      F.col("_pos").cast("int").alias("change_seq"))


def materialize(changelog: DataFrame, *, key: str | Sequence[str], order_cols: Sequence[str],
                op_col: str = "op") -> DataFrame:
    """Current rows of a changelog / upsert stream (latest per key, deletes removed)."""
    last = latest_per_key(changelog, key=key, order_cols=order_cols)
    if op_col in last.columns:
        last = last.where(~F.col(op_col).isin(DELETE, UPDATE_BEFORE)).drop(op_col)
    return last


def upsert_by_other_key(results: DataFrame, *, query_key: str, sink_key: str,
                        order_cols: Sequence[str] | None = None) -> DataFrame:
    """C6 batch form: final sink content when the sink's primary key differs from the
    query's upsert key.

    The query yields one current row per ``query_key``; the sink keeps one row
    per ``sink_key`` and the last write wins.  Among equal sink keys the row
    written last is, in a batch, undefined: the largest ``order_cols`` (default:
    the query key) is kept so the result is deterministic.
    """
    order = list(order_cols or [query_key])
    return latest_per_key(results, key=sink_key, order_cols=order)


def tag_invalid(df: DataFrame, checks: dict[str, Column], *, reason_col: str = "error_reason") -> DataFrame:
    """``df`` with the name of the first check that a row fails, NULL if it passes all: one
    scan for good and bad rows together."""
    names = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in checks.items()]
    return df.withColumn(reason_col, F.coalesce(*names, F.lit(None).cast("string")))


def split_valid(df: DataFrame, checks: dict[str, Column], *, reason_col: str = "error_reason"
                ) -> tuple[DataFrame, DataFrame]:
    """Route rows by named checks (a check is a Column that is TRUE when
    the row is valid).  Returns ``(good, dead_letter)``; the dead-letter side gets
    the name of the first failed check.  Both sides read ``df``; where that is dear, write
    or persist it first, or use :func:`tag_invalid` and keep one table.
    """
    tagged = tag_invalid(df, checks, reason_col=reason_col)
    return (tagged.where(F.col(reason_col).isNull()).drop(reason_col),
            tagged.where(F.col(reason_col).isNotNull()))


def json_record_checks(raw: Column, schema: str, required: Sequence[str]) -> tuple[Column, dict[str, Column]]:
    """Parse ``raw`` JSON into ``schema`` and build the C11 checks: syntax, schema fit
    (every required field present and typed), non-NULL keys."""
    parsed = F.from_json(raw, schema)
    checks = {"malformed_json": raw.isNotNull() & F.try_parse_json(raw).isNotNull()}
    for f in required:
        checks[f"missing_{f}"] = parsed.getField(f).isNotNull()
    return parsed, checks


def validated_insert(df: DataFrame, target_schema: dict[str, str], *, not_null: Sequence[str] = ()
                     ) -> tuple[DataFrame, DataFrame]:
    """Cast each column to the target type with ``try_cast``; rows whose cast
    fails (non-NULL in, NULL out) or whose NOT NULL column is NULL are rejected with a
    reason.  A missing or surplus column fails the statement."""
    missing = [c for c in target_schema if c not in df.columns]
    surplus = [c for c in df.columns if c not in target_schema]
    if missing or surplus:
        raise ValueError(f"column count mismatch: missing {missing}, surplus {surplus}")
    cast = df.select(*[F.col(c).try_cast(t).alias(c) for c, t in target_schema.items()],
                     *[F.col(c).alias(f"_raw_{c}") for c in target_schema])
    checks = {f"bad_type_{c}": F.col(f"_raw_{c}").isNull() | F.col(c).isNotNull() for c in target_schema}
    checks.update({f"null_{c}": F.col(c).isNotNull() for c in not_null})
    good, bad = split_valid(cast, checks)
    return good.drop(*[f"_raw_{c}" for c in target_schema]), bad


def as_table(df: DataFrame, *, mode: str, key: str | Sequence[str] | None = None,
             order_cols: Sequence[str] = ()) -> DataFrame:
    """Read a table in ``append`` mode (every row) or ``upsert`` mode (current row per key)."""
    if mode == "append":
        return df
    if mode == "upsert":
        if key is None:
            raise ValueError("upsert mode needs a primary key")
        return latest_per_key(df, key=key, order_cols=order_cols)
    raise ValueError(f"unknown changelog mode {mode!r}")


def first_changes(changelog: DataFrame, *, order_cols: Sequence[str], n: int = 20) -> DataFrame:
    """The first ``n`` records of a changelog in change order (a display
    limit: the limit is the feature)."""
    return changelog.orderBy(*order_cols).limit(n)
