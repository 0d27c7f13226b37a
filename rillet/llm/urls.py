"""URL filters: host-suffix and path-prefix expressions against a rule list; DataFrame
operations only.

A url is expanded into every suffix of its host at a label boundary, combined with every
prefix of its path that ends in a slash (and the empty one).  Expressions are joined to the
rules on a short hash prefix; what meets is confirmed by its full digest, and then the whole
path of the rule must begin the url's path.  The longest rule (host and path together) wins;
of equally long ones the one with the longer host, then block before allow.

The host runs from after the first ``://`` to the next ``/``, ``?``, ``#`` or the end, A-Z
lower-cased; the path goes on to ``?``, ``#`` or the end.  A url that is null or has no
``://`` has an empty host and path, meets no rule and gets the default verdict.  Equal urls
are expanded once.  Rules: a DataFrame (host, path, verdict); duplicates do no harm, a rule
with a null is ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.llm.shared import sealed

#: Hex digits of the short hash that expressions are joined on: 4 bytes.
SHORT = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: Sequence[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) triples as a DataFrame."""
    rows = [F.struct(F.lit(h).alias("host"), F.lit(p).alias("path"), F.lit(v).alias("verdict")) for v, h, p in rules]
    kind = "array<struct<host: string, path: string, verdict: string>>"
    return spark.range(1).select(F.inline(F.array(*rows).cast(kind)))


def _after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, F.substring(url, at + 3, F.length(url)))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)\A([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_after_scheme(url), r"(?s)\A[^/?#]*([^?#]*)", 1), F.lit(""))


def _directory(path: Column) -> Column:
    """The path up to its last slash, empty if it has none."""
    return F.regexp_extract(path, r"(?s)\A(.*/)?", 1)


def _expressions(host: Column, path: Column) -> Column:
    """Array of (suffix, prefix): host suffixes at labels, path prefixes at slashes."""
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    steps = F.split(path, "/")
    prefixes = F.transform(F.sequence(F.lit(0), F.size(steps) - 1), lambda i: F.when(i == 0, F.lit("")).otherwise(
        F.concat(F.array_join(F.slice(steps, 1, F.greatest(i, F.lit(1))), "/"), F.lit("/"))))
    return F.flatten(F.transform(suffixes, lambda s: F.transform(prefixes, lambda p: F.struct(s.alias("suffix"), p.alias("prefix")))))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, *, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (``host`` + ``path`` of the winning rule, else null)
    and verdict (the rule's, else ``default``); input columns of these names are replaced."""
    inner, outer = sealed(pages, ("host", "path", "rule", "verdict"))
    rows = pages.select(*inner, F.col(f"`{url}`").alias("_url"))
    listed = (rules.where("host is not null and path is not null and verdict is not null")
              .select(F.translate("host", _UPPER, _LOWER).alias("r_host"), F.col("path").alias("r_path"), "verdict")
              .withColumn("r_digest", _digest(F.col("r_host"), _directory(F.col("r_path"))))
              .withColumn("short", F.substring("r_digest", 1, SHORT)))
    # no expression of more labels or a longer path than any rule has can meet one
    labels, longest = listed.agg(F.max(F.size(F.split("r_host", r"\."))), F.max(F.length(_directory(F.col("r_path"))))).first()
    urls = rows.select("_url").where("_url is not null").distinct()
    found = (urls.withColumn("path", path_of(F.col("_url")))
             .withColumn("e", F.explode(_expressions(F.substring_index(host_of(F.col("_url")), ".", -(labels or 1)),
                                                     F.substring("path", 1, longest or 0))))
             .select("_url", "path", _digest(F.col("e.suffix"), F.col("e.prefix")).alias("digest"))
             .withColumn("short", F.substring("digest", 1, SHORT))
             .join(listed, "short")
             .where((F.col("digest") == F.col("r_digest")) & F.col("path").startswith(F.col("r_path"))))
    size = F.length("r_host") + F.length("r_path")
    best = (found.groupBy("_url").agg(F.max(F.struct(size.alias("size"), F.length("r_host").alias("long"), (F.col("verdict") == "block").alias("block"),
                                                    F.concat("r_host", "r_path").alias("rule"), "verdict")).alias("best"))
            .select("_url", "best.rule", "best.verdict"))
    return rows.join(best, "_url", "left").select(*outer, host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), "rule",
                                                 F.coalesce("verdict", F.lit(default)).alias("verdict"))
