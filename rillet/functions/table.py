"""Table functions (U-T1, U-T2) and lateral application.

Each table function returns an ARRAY<STRUCT> Catalyst expression; applying it
with ``inline`` / ``inline_outer`` gives ``CROSS JOIN LATERAL`` /
``LEFT JOIN LATERAL .. ON TRUE`` semantics without leaving the JVM.

JSON fidelity (the reference parses with a tree parser):
* malformed text -> error (``fail_on_error``) or no row; NULL input counts as
  malformed; ``''`` is a missing document: one all-NULL address, no e-mails;
* missing field or JSON ``null`` -> NULL; nested object/array field -> ``''``;
* array element ``null`` -> ``'null'``; element object/array -> ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: prefix of the error raised on malformed JSON.
JSON_ERROR_PREFIX = "Exception parsing JSON payload: "

ADDRESS_FIELDS = ("street", "postcode", "city")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def _is_container(v: Column) -> Column:
    sch = F.schema_of_variant(v)
    return sch.startswith("OBJECT") | sch.startswith("ARRAY")


def _field_text(v: Column) -> Column:
    """Text of a variant node: NULL for missing/JSON null, '' for containers."""
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit(None).cast("string"))
            .when(_is_container(v), F.lit(""))
            .otherwise(F.variant_get(v, "$", "string")))


def _element_text(v: Column) -> Column:
    """Text of an array element: 'null' for JSON null, '' for containers."""
    return (F.when(v.isNull() | F.is_variant_null(v), F.lit("null"))
            .when(_is_container(v), F.lit(""))
            .otherwise(F.variant_get(v, "$", "string")))


def _malformed(js: Column) -> Column:
    return js.isNull() | ((js != "") & F.try_parse_json(js).isNull())


def _fail(js: Column) -> Column:
    return F.raise_error(F.concat(F.lit(JSON_ERROR_PREFIX), F.coalesce(js, F.lit("null input"))))


def unnest_json_address(json, fail_on_error: bool | Column = False) -> Column:
    """U-T1: ``ARRAY<STRUCT<street, postcode, city>>`` with one element, or none on bad JSON."""
    js = _c(json)
    fail = fail_on_error if isinstance(fail_on_error, Column) else F.lit(bool(fail_on_error))
    v = F.try_parse_json(js)
    row = F.struct(*[_field_text(F.try_variant_get(v, f"$.{f}", "variant")).alias(f)
                     for f in ADDRESS_FIELDS])
    typ = "array<struct<street:string,postcode:string,city:string>>"
    return (F.when(_malformed(js) & fail, _fail(js).cast(typ))
            .when(_malformed(js), F.array().cast(typ))
            .otherwise(F.array(row)))


def normalize_json_array(json, fail_on_error: bool | Column = False,
                         index_name: str = "email_index", value_name: str = "email") -> Column:
    """U-T2: ``ARRAY<STRUCT<email_index INT, email STRING>>``, index from 0.

    Non-array JSON and ``[]`` give no rows.
    """
    js = _c(json)
    fail = fail_on_error if isinstance(fail_on_error, Column) else F.lit(bool(fail_on_error))
    v = F.try_parse_json(js)
    arr = F.try_variant_get(v, "$", "array<variant>")
    typ = f"array<struct<{index_name}:int,{value_name}:string>>"
    rows = F.transform(F.coalesce(arr, F.array().cast("array<variant>")),
                       lambda e, i: F.struct(i.cast("int").alias(index_name), _element_text(e).alias(value_name)))
    return (F.when(_malformed(js) & fail, _fail(js).cast(typ))
            .otherwise(rows.cast(typ)))


def lateral(df: DataFrame, rows: Column, *, outer: bool) -> DataFrame:
    """J11 (``outer=True``: LEFT JOIN LATERAL .. ON TRUE) / J12 (CROSS JOIN LATERAL)."""
    return df.select("*", (F.inline_outer if outer else F.inline)(rows))


def unnest(df: DataFrame, array_col: str, alias: str = "value", *, outer: bool = False) -> DataFrame:
    """``UNNEST`` of a plain array column."""
    return df.select("*", (F.explode_outer if outer else F.explode)(array_col).alias(alias))
