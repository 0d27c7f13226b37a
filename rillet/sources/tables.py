"""Opening tables as snapshots or streams (S5-S7): files or Kafka."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.session import scratch_path


def open_table(spark: SparkSession, path: str, *, stream: bool = False, fmt: str = "parquet",
               schema=None, startup: str = "earliest-offset", start_time: str | None = None,
               time_col: str | None = None, with_metadata: bool = False,
               max_files_per_trigger: int | None = None, latest_from: str | None = None) -> DataFrame:
    """Open a table as a bounded snapshot or an unbounded stream.

    ``startup='latest-offset'`` on a file stream skips exactly the files present
    now, whatever their times: their paths are kept in a table of the shared folder
    (``latest_from`` names it, so that a restarted statement keeps its own start) and
    anti-joined; ``start_time`` filters on
    ``time_col`` (file sources have no offsets).  ``with_metadata`` adds the
    file-level record metadata (``_metadata``: path, size, modification time,
    row index), the file-source counterpart of Kafka's metadata columns.
    """
    if fmt == "kafka":
        return _open_kafka(spark, path, stream=stream, startup=startup, with_metadata=with_metadata)
    if stream:
        r = spark.readStream.format(fmt).schema(schema or spark.read.format(fmt).load(path).schema)
        if max_files_per_trigger:
            r = r.option("maxFilesPerTrigger", max_files_per_trigger)
        df = r.load(path)
        if startup == "latest-offset":
            df = _without_present_files(spark, df, path, latest_from)
    else:
        df = spark.read.format(fmt).load(path)
    if start_time and time_col:
        df = df.where(F.col(time_col) >= F.lit(start_time).cast(df.schema[time_col].dataType))
    if with_metadata:
        df = df.select("*", F.col("_metadata.file_path").alias("record_file"),
                       F.col("_metadata.file_modification_time").alias("record_timestamp"),
                       F.col("_metadata.row_index").alias("record_offset"))
    return df


def _without_present_files(spark: SparkSession, stream: DataFrame, path: str, listing: str | None) -> DataFrame:
    """``stream`` without the rows of the files listed at ``listing``, which is written now
    unless it exists."""
    listing = listing or scratch_path(spark, "present-files")
    place = spark._jvm.org.apache.hadoop.fs.Path(listing)
    if not place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place):
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select("path").write.parquet(listing)
    plain = lambda p: F.regexp_replace(p, r"^file:/+", "/")
    present = spark.read.schema("path string").parquet(listing).select(plain(F.col("path")).alias("_present"))
    named = stream.withColumn("_file", plain(F.col("_metadata.file_path")))
    return named.join(present, named["_file"] == present["_present"], "left_anti").drop("_file")


def _open_kafka(spark: SparkSession, topic: str, *, stream: bool, startup: str, with_metadata: bool,
                servers: str | None = None) -> DataFrame:
    """Kafka form of :func:`open_table` (needs the Kafka connector on the classpath;
    ``spark.rillet.kafka.bootstrap`` names the brokers).  ``startup`` maps to
    ``startingOffsets`` (``earliest``/``latest`` or a JSON offset map, e.g. from
    :func:`rillet.streaming.sinks.committed_offsets`)."""
    servers = servers or spark.conf.get("spark.rillet.kafka.bootstrap", None)
    start = {"earliest-offset": "earliest", "latest-offset": "latest"}.get(startup, startup)
    r = (spark.readStream if stream else spark.read).format("kafka")
    r = r.option("kafka.bootstrap.servers", servers).option("subscribe", topic).option("startingOffsets", start)
    if with_metadata:
        r = r.option("includeHeaders", "true")
    df = r.load()
    if not with_metadata:
        return df.select("key", "value")
    return df.select("key", "value",
                     F.map_from_entries("headers").alias("record_headers"),
                     F.col("offset").alias("record_offset"), F.col("partition").alias("record_partition"),
                     F.col("key").alias("record_key"), F.col("value").alias("record_value"),
                     F.col("timestamp").alias("record_timestamp"),
                     F.col("timestampType").cast("string").alias("record_timestamp_type"),
                     F.col("topic").alias("record_topic"))
