"""Mixing sources to target weights by systematic sampling; DataFrame operations only.

Every document of a source is expected ``target / source_size`` times.  These expectations
are summed up over the source's documents, one random offset is added, and a document is
emitted once for each integer boundary that its step crosses.  Documents are walked in the
order of their size class, so that the words taken follow the target closely.

The running sum of a source is not one task's work: documents are counted in chunks
(source, size class, hash), the chunks' sums are carried on over at most
``HASHES`` rows a class, and only the position inside a chunk is a window.

A null source is one source, after all others.  Null and empty texts have size 0: they are
walked like others and take no words.  A source of size 0 has target 0 and takes nothing.
Rows that repeat id, text and source are walked one after the other.  The offset depends on
``seed`` and the source alone and the order on the rows alone, so reruns agree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rillet.llm.shared import sealed, unused

#: Parts of a size class, by hash of the id.
HASHES = 256
#: Bits after the leading one that tell size classes apart.
_DETAIL = 3
#: The offset's resolution; sums of an offset and whole copies stay exact in a double.
_STEPS = 1 << 20


def count_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null: 0."""
    solid = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(solid, " "), lambda w: w != "")).cast("long")


#: Classes of sizes that differ by less than an eighth, in order of size.
SIZE_CLASS = f"length(bin(_size)) * {2 << _DETAIL} + shiftright(_size, greatest(length(bin(_size)) - {_DETAIL + 1}, 0))"


def source_targets(sizes: DataFrame, weights: Sequence[float] = (1, 2, 3), limit: float = 3.0) -> DataFrame:
    """Targets of (source, source_size): weights in code point order of the sources, null
    last, repeating; together they share the sum of all sizes, and no target exceeds
    ``limit`` times its source's size.  What a limit cuts off is shared anew by weight.

    The sources that reach their limit are those with the least limit per weight, so one
    sorted pass finds them: below ``share``, what is left per weight, a source is full.
    One row per source is all that is sorted.
    """
    order = Window.orderBy(F.col("source").isNull(), "source")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.row_number().over(order) - 1) % len(weights) + 1)
    full = F.col("source_size") * F.lit(float(limit))
    by_ratio = Window.orderBy(F.col("_full") / F.col("_weight"), F.col("source").isNull(), "source")
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    after = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy().rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    share = (F.col("_total") - F.coalesce(F.sum("_full").over(before), F.lit(0.0))) / F.sum("_weight").over(after)
    return (sizes.withColumn("_weight", weight).withColumn("_full", full).withColumn("_total", F.sum("source_size").over(everything).cast("double"))
            .withColumn("_share", share)
            # the first source whose share fits sets the share of all after it
            .withColumn("_open", F.first(F.when(F.col("_share") * F.col("_weight") <= F.col("_full"), F.col("_share")), True).over(
                by_ratio.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
            .select("source", "source_size", F.coalesce(F.least(F.col("_open") * F.col("_weight"), "_full"), "_full").alias("target")))


def offset_of(source: Column, seed: int) -> Column:
    """The source's random offset in [0, 1)."""
    digits = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(source, F.lit("\x00"))))
    return (F.conv(F.substring(digits, 1, 5), 16, 10).cast("double") + 0.5) / F.lit(float(_STEPS))


def mix(docs: DataFrame, *, id: str = "doc_id", text: str = "text", source: str = "source",
        weights: Sequence[float] = (1, 2, 3), limit: float = 3.0, seed: int = 42) -> DataFrame:
    """Every row of ``docs`` with size, source_size, target (its source's) and copies, how
    often the mix takes it; input columns of these names are replaced."""
    inner, outer = sealed(docs, ("size", "source_size", "target", "copies"))
    digest = F.md5(F.coalesce(F.col(f"`{id}`").cast("string"), F.lit("")))
    rows = docs.select(*inner, F.col(f"`{source}`").alias("_source"),
                       F.col(f"`{id}`").alias("_id"), F.xxhash64(F.col(f"`{text}`")).alias("_text"), count_words(F.col(f"`{text}`")).alias("_size"),
                       F.conv(F.substring(digest, 1, 2), 16, 10).cast("int").alias("_hash"))
    rows = rows.withColumn("_class", F.expr(SIZE_CLASS))
    # null-safe key of the source: a flag and a value
    rows = rows.withColumn("_none", F.col("_source").isNull()).withColumn("_name", F.coalesce("_source", F.lit("")))
    chunk = ["_none", "_name", "_class", "_hash"]
    chunks = rows.groupBy(*chunk).agg(F.count(F.lit(1)).alias("_n"), F.sum("_size").alias("_words"))
    sizes = (chunks.groupBy("_none", "_name").agg(F.sum("_words").alias("source_size"))
             .select(F.when(~F.col("_none"), F.col("_name")).alias("source"), "source_size"))
    targets = (source_targets(sizes, weights, limit)
               .select(F.col("source").isNull().alias("_none"), F.coalesce("source", F.lit("")).alias("_name"),
                       "source_size", "target", offset_of(F.col("source"), seed).alias("_offset")))
    walk = Window.partitionBy("_none", "_name").orderBy("_class", "_hash").rowsBetween(Window.unboundedPreceding, -1)
    starts = chunks.withColumn("_before", F.coalesce(F.sum("_n").over(walk), F.lit(0))).join(targets, ["_none", "_name"])
    place = F.row_number().over(Window.partitionBy(*chunk).orderBy("_size", "_id", "_text"))
    walked = rows.withColumn("_place", place).join(starts.drop("_n", "_words"), chunk)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    until = lambda n: F.floor(rate * n + F.col("_offset"))
    upto = F.col("_before") + F.col("_place")
    copies = F.least(until(upto) - until(upto - 1), F.lit(limit).cast("long"))
    return walked.select(*outer, F.col("_size").alias("size"), "source_size", "target", copies.cast("long").alias("copies"))


def materialise(mixed: DataFrame) -> DataFrame:
    """The mixed documents themselves: each row as often as its ``copies`` say."""
    copy = unused(mixed, "_copy")[0]
    return mixed.where("copies > 0").withColumn(copy, F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop(copy)
