"""U-R: the workshop's functions registered for SQL users.

Spark 4 SQL functions (``CREATE TEMPORARY FUNCTION .. RETURN``) are inlined by
the analyzer, so calls from SQL run as the same built-in expressions as the
DataFrame forms in :mod:`rillet.functions.scalar` / :mod:`rillet.functions.table`
(no Python worker, no per-row serialisation).  The three overloads of
``concat_with_separator`` (two to four values, the separator last) are one function
whose last parameters have a default that stands for "not given".
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from rillet.functions.scalar import LETTERS
from rillet.functions.table import JSON_ERROR_PREFIX


def _cws(n: int) -> str:
    args = ", ".join(f"v{i} STRING" for i in range(n))
    vals = ", ".join(f"coalesce(v{i}, '')" for i in range(n))
    return f"({args}, sep STRING) RETURNS STRING RETURN concat_ws(coalesce(sep, ''), {vals})"


def _field(f: str) -> str:
    v = f"try_variant_get(try_parse_json(json), '$.{f}', 'variant')"
    return (f"CASE WHEN {v} IS NULL OR is_variant_null({v}) THEN CAST(NULL AS STRING) "
            f"WHEN schema_of_variant({v}) LIKE 'OBJECT%' OR schema_of_variant({v}) LIKE 'ARRAY%' THEN '' "
            f"ELSE variant_get({v}, '$', 'string') END")


_MALFORMED = "(json IS NULL OR (json <> '' AND try_parse_json(json) IS NULL))"
_RAISE = f"raise_error(concat('{JSON_ERROR_PREFIX}', coalesce(json, 'null input')))"

_ADDR_T = "array<struct<street:string,postcode:string,city:string>>"
_MAIL_T = "array<struct<email_index:int,email:string>>"
_ELEM = ("CASE WHEN is_variant_null(e) THEN 'null' WHEN schema_of_variant(e) LIKE 'OBJECT%' "
         "OR schema_of_variant(e) LIKE 'ARRAY%' THEN '' ELSE variant_get(e, '$', 'string') END")

#: Default of a parameter that was not given; NULL is a value of its own.
_ABSENT = "'\\u0001absent'"


def _cws_any() -> str:
    def joined(n: int) -> str:
        names = "abcde"[:n + 1]
        return f"concat_ws(coalesce({names[-1]}, ''), " + ", ".join(f"coalesce({v}, '')" for v in names[:-1]) + ")"

    return (f"(a STRING, b STRING, c STRING, d STRING DEFAULT {_ABSENT}, e STRING DEFAULT {_ABSENT}) RETURNS STRING RETURN "
            f"CASE WHEN d <=> {_ABSENT} THEN {joined(2)} WHEN e <=> {_ABSENT} THEN {joined(3)} ELSE {joined(4)} END")


FUNCTIONS = {
    "concat_with_separator": _cws_any(),
    "concat_with_separator3": _cws(3),
    "concat_with_separator4": _cws(4),
    "log_out_of_range": "(value DOUBLE, low DOUBLE, high DOUBLE) RETURNS DOUBLE RETURN value",
    "random_string": (f"(n INT) RETURNS STRING NOT DETERMINISTIC RETURN CASE WHEN n > 0 THEN array_join("
                      f"transform(sequence(1, n), i -> substr('{LETTERS}', CAST(floor(rand() * {len(LETTERS)}) "
                      f"AS INT) + 1, 1)), '') WHEN n IS NOT NULL THEN '' END"),
    # Array-returning forms for LATERAL VIEW [OUTER] inline(..): a generator on
    # the row, which Spark never decorrelates into a join (the table-function
    # forms below are rewritten to a join + aggregate, i.e. a shuffle).
    "unnest_json_address_rows": (
        f"(json STRING, fail_on_error BOOLEAN) RETURNS {_ADDR_T} RETURN "
        f"CASE WHEN {_MALFORMED} AND fail_on_error THEN CAST({_RAISE} AS {_ADDR_T}) "
        f"WHEN {_MALFORMED} THEN CAST(array() AS {_ADDR_T}) "
        f"ELSE array(named_struct('street', {_field('street')}, 'postcode', {_field('postcode')}, "
        f"'city', {_field('city')})) END"),
    "normalize_json_array_rows": (
        f"(json STRING, fail_on_error BOOLEAN) RETURNS {_MAIL_T} RETURN "
        f"CASE WHEN {_MALFORMED} AND fail_on_error THEN CAST({_RAISE} AS {_MAIL_T}) "
        "ELSE transform(coalesce(try_variant_get(try_parse_json(json), '$', 'array<variant>'), "
        f"CAST(array() AS array<variant>)), (e, i) -> named_struct('email_index', i, 'email', {_ELEM})) END"),
    "unnest_json_address": (
        "(json STRING, fail_on_error BOOLEAN) RETURNS TABLE (street STRING, postcode STRING, city STRING) "
        f"RETURN SELECT {_field('street')}, {_field('postcode')}, {_field('city')} "
        f"WHERE CASE WHEN {_MALFORMED} AND fail_on_error THEN {_RAISE} IS NULL ELSE NOT {_MALFORMED} END"),
    "normalize_json_array": (
        "(json STRING, fail_on_error BOOLEAN) RETURNS TABLE (email_index INT, email STRING) "
        "RETURN SELECT CAST(pos AS INT), CASE WHEN is_variant_null(col) THEN 'null' "
        "WHEN schema_of_variant(col) LIKE 'OBJECT%' OR schema_of_variant(col) LIKE 'ARRAY%' THEN '' "
        "ELSE variant_get(col, '$', 'string') END "
        f"FROM (SELECT posexplode(CASE WHEN {_MALFORMED} AND fail_on_error "
        f"THEN CAST({_RAISE} AS array<variant>) "
        "ELSE coalesce(try_variant_get(try_parse_json(json), '$', 'array<variant>'), "
        "CAST(array() AS array<variant>)) END))"),
}


def register_sql_functions(spark: SparkSession) -> list[str]:
    """Register every function as a temporary SQL function; returns the names."""
    for name, body in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}{body}")
    return list(FUNCTIONS)
