"""Dead letters at the reader (C11): records that can't be decoded, with the place they came from.

A file of JSON records, one a line, is read as lines, so no record is lost or merged: each carries its
file, the byte where its block of the file begins and its number within the block, and is decoded beside them.
Decoding is Spark's PERMISSIVE parser with a column for corrupt records.  Works on batch reads and streams.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

_CORRUPT = "_corrupt_record"
#: What tells where a record stands, and why it is a dead letter.
PLACE = ("record_file", "record_block", "record_number")


def numbered_lines(spark: SparkSession, path: str, *, stream: bool = False, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the files at ``path``: raw, record_file, record_block (byte offset of the part of the
    file that a task reads) and record_number (from 0, within the part)."""
    reader = spark.readStream if stream else spark.read
    if stream and max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.format("text").load(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, n = None, 0   # lines of a part follow each other
        for batch in batches:
            places = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True))
            numbers = []
            for place in places:
                at, n = (place, 0) if place != at else (at, n + 1)
                numbers.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], ["raw", *PLACE])

    return lines.mapInArrow(number, "raw string, record_file string, record_block long, record_number long")


def read_json_records(spark: SparkSession, path: str, schema: str | StructType, *, required: Sequence[str] = (), stream: bool = False,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """The records at ``path``: the columns of ``schema``, raw, their place, and error_reason, NULL for good ones.

    Reasons, the first that holds: ``undecodable`` (the line is no JSON object, or a value doesn't fit its type), ``missing_<column>``
    (a ``required`` column is absent or NULL).  Blank lines are no records.  A dead letter's columns are NULL where they weren't decoded.
    """
    lines = numbered_lines(spark, path, stream=stream, max_files_per_trigger=max_files_per_trigger).where(F.trim("raw") != "")
    kind = schema if isinstance(schema, StructType) else StructType.fromDDL(schema)
    if clash := {f.name for f in kind} & {"raw", "error_reason", _CORRUPT, *PLACE}:
        raise ValueError(f"names that the reader uses: {sorted(clash)}")
    parsed = lines.withColumn("_r", F.from_json("raw", StructType([*kind, *StructType().add(_CORRUPT, StringType())]),
                                                {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}))
    reasons: list[Column] = [F.when(F.col("_r").isNull() | F.col(f"_r.{_CORRUPT}").isNotNull() | ~F.col("raw").rlike(r"^\s*\{"), F.lit("undecodable"))]
    reasons += [F.when(F.col(f"_r.`{c}`").isNull(), F.lit(f"missing_{c}")) for c in required]
    return parsed.select(*[F.col(f"_r.`{f.name}`").alias(f.name) for f in kind], "raw", *PLACE, F.coalesce(*reasons, F.lit(None).cast("string")).alias("error_reason"))


def route(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good records without the reader's columns, and the dead letters: raw, place and reason."""
    good = records.where("error_reason IS NULL").drop("raw", "error_reason", *PLACE)
    return good, records.where("error_reason IS NOT NULL").select("raw", *PLACE, "error_reason")
