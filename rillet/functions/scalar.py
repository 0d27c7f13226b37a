"""Scalar functions (U-S1..U-S4, F4) as Catalyst expressions.

All of them compile to built-in expressions, so they run inside whole-stage
codegen and never cross into a Python worker.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference for identical output.
LETTERS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
ACCOUNT_REQUIRED_JSON = '{"error": "account_number is required"}'
ACCOUNT_JSON_FORMAT = ('{"account_number": "%s", "balance": %.2f, "status": "%s", '
                       '"last_transaction_amount": %.2f, "last_transaction_date": "%s", "alert_flag": %b}')
ACCOUNT_DATE_FORMAT = "2025-%02d-%02d"
ACCOUNT_BALANCE_BASE, ACCOUNT_BALANCE_FACTOR, ACCOUNT_BALANCE_MOD = 1000.0, 347.83, 9000.0
ACCOUNT_LAST_BASE, ACCOUNT_LAST_FACTOR, ACCOUNT_LAST_MOD = 10.0, 127.5, 990.0
ACCOUNT_FROZEN_MOD, ACCOUNT_ALERT_MOD, ACCOUNT_MONTH_MOD, ACCOUNT_DAY_MOD = 5, 7, 12, 28
# ---------------------------------------------------------------------------


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def concat_with_separator(*args) -> Column:
    """U-S1: ``concat_with_separator(a, b[, c[, d]], sep)`` - separator LAST.

    NULL inputs count as empty strings (so ``(NULL, 'world', '-')`` gives
    ``-world``) and a NULL separator is empty (``('a','b',NULL)`` gives ``ab``).
    Two to four values, as the reference's overloads.
    """
    if not 3 <= len(args) <= 5:
        raise TypeError("concat_with_separator takes 2 to 4 strings and a separator "
                        f"({len(args)} arguments given)")
    *vals, sep = [_c(a) for a in args]
    return F.call_function("concat_ws", F.coalesce(sep, F.lit("")), *[F.coalesce(v, F.lit("")) for v in vals])


def log_out_of_range(value, low, high) -> Column:
    """U-S2: passthrough of ``value`` as DOUBLE.

    The reference only logs values outside ``[low, high]``; per-row executor
    logging is replaced by :func:`out_of_range_report`, a filtered side table
    that Spark computes distributed.
    """
    return _c(value).cast("double")


def out_of_range_flag(value, low, high) -> Column:
    """'below' / 'above' / NULL, strictly outside the bounds (as the reference's checks)."""
    v = _c(value).cast("double")
    lo = low if isinstance(low, Column) else F.lit(float(low))
    hi = high if isinstance(high, Column) else F.lit(float(high))
    return F.when(v < lo, "below").when(v > hi, "above")


def out_of_range_report(df: DataFrame, value: str, low: float, high: float) -> DataFrame:
    """Rows whose ``value`` is outside ``[low, high]`` with the direction."""
    return (df.withColumn("out_of_range", out_of_range_flag(value, low, high))
            .where(F.col("out_of_range").isNotNull()))


def random_string(length) -> Column:
    """U-S3: letters only, a fresh draw per row and per character (non-deterministic).

    ``rand()`` inside the lambda is evaluated per element; n <= 0 gives ''.
    """
    n = _c(length) if not isinstance(length, int) else F.lit(length)
    pick = F.expr(f"substr('{LETTERS}', CAST(floor(rand() * {len(LETTERS)}) AS INT) + 1, 1)")
    chars = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda _i: pick)
    return F.when(n > 0, F.array_join(chars, "")).when(n.isNotNull(), F.lit(""))


def java_string_hash(s: Column) -> Column:
    """Java ``String.hashCode`` (for code points of the Basic Multilingual Plane),
    as a signed 32-bit value held in a BIGINT."""
    h = F.aggregate(F.transform(F.split(s, ""), lambda ch: F.ascii(ch).cast("bigint")),
                    F.lit(0).cast("bigint"),
                    lambda acc, x: F.pmod(acc * F.lit(31) + x, F.lit(4294967296)))
    return F.when(F.length(s) == 0, F.lit(0).cast("bigint")).otherwise(h)


def account_seed(account: Column) -> Column:
    """Digits of the account as a 32-bit int; no digits or overflow: hash & 0x7FFFFFFF."""
    digits = F.regexp_replace(account, "[^0-9]", "")
    fallback = F.pmod(java_string_hash(account), F.lit(2147483648)).cast("int")
    parsed = F.when(F.length(digits) > 0, digits.try_cast("int"))
    return let(parsed, lambda p: F.when(p.isNull(), fallback).otherwise(p))


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and pass it to ``body`` as a lambda variable."""
    return F.element_at(F.transform(F.array(value), body), 1)


def account_lookup(account) -> Column:
    """U-S4: deterministic account details as a JSON string, from a numeric seed."""
    acct = _c(account)
    blank = acct.isNull() | F.regexp_like(acct, F.lit(r"^\s*$"))
    return F.when(blank, F.lit(ACCOUNT_REQUIRED_JSON)).otherwise(
        let(account_seed(acct), lambda seed: _account_json(acct, seed)))


def _account_json(acct: Column, seed: Column) -> Column:
    balance = F.lit(ACCOUNT_BALANCE_BASE) + (seed * F.lit(ACCOUNT_BALANCE_FACTOR)) % F.lit(ACCOUNT_BALANCE_MOD)
    status = F.when(seed % ACCOUNT_FROZEN_MOD == 0, "FROZEN").otherwise("ACTIVE")
    last_amt = F.lit(ACCOUNT_LAST_BASE) + (seed * F.lit(ACCOUNT_LAST_FACTOR)) % F.lit(ACCOUNT_LAST_MOD)
    date = F.format_string(ACCOUNT_DATE_FORMAT, F.lit(1) + seed % ACCOUNT_MONTH_MOD,
                           F.lit(1) + seed % ACCOUNT_DAY_MOD)
    alert = seed % ACCOUNT_ALERT_MOD == 0
    return F.format_string(ACCOUNT_JSON_FORMAT, acct, balance, status, last_amt, date, alert)


ACCOUNT_SCHEMA = ("account_number STRING, balance DOUBLE, status STRING, last_transaction_amount DOUBLE, "
                  "last_transaction_date STRING, alert_flag BOOLEAN, error STRING")


def parse_account_json(js: Column) -> Column:
    return F.from_json(js, ACCOUNT_SCHEMA)


def convert_tz(ts, from_tz: str = "UTC", to_tz: str = "Europe/Berlin") -> Column:
    """``CONVERT_TZ(CAST(ts AS STRING), from, to)`` -> 'yyyy-MM-dd HH:mm:ss'."""
    t = _c(ts).cast("timestamp_ntz").cast("string")
    converted = F.convert_timezone(F.lit(from_tz), F.lit(to_tz), t.cast("timestamp_ntz"))
    return F.date_format(converted, "yyyy-MM-dd HH:mm:ss")
