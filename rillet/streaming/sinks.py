"""Stateful sinks for streams (S12, A3, C4, C6, C11, C12) via ``foreachBatch``.

Tables are versioned directories under a shared base path (never a machine-local
folder).  A batch reads the newest version, merges, and writes the next one, named after
the streaming query and its epoch: a batch that is run again rewrites its own version, and
a new query on the same table goes on from the newest version whatever its epochs.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rillet.operators.changelog import split_valid
from rillet.operators.joins import latest_per_key


def writer_of(batch: DataFrame) -> str:
    """Id of the streaming query that runs this ``foreachBatch`` call ('direct' outside one);
    it stays the same when the query is restarted from its checkpoint."""
    return batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId") or "direct"


def _list_versions(spark: SparkSession, base: str) -> list[tuple[int, str, str]]:
    """(number, "writer.epoch", path) of the complete versions, oldest first."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if name.startswith("v=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            number, _, source = name[2:].partition(".")
            out.append((int(number), source, f"{base.rstrip('/')}/{name}"))
    return sorted(out)


def _drop_old_versions(spark: SparkSession, base: str, keep: int) -> None:
    """Remove all but the newest ``keep`` complete versions (readers always take
    the newest complete one, so older ones are only needed for replay)."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(base)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    for _, _, path in _list_versions(spark, base)[:-keep]:
        fs.delete(jvm.org.apache.hadoop.fs.Path(path), True)


def read_latest(spark: SparkSession, base: str) -> DataFrame | None:
    """Current content of a versioned table, or ``None`` before the first write."""
    versions = _list_versions(spark, base)
    return spark.read.parquet(versions[-1][2]) if versions else None


class UpsertSink:
    """Keep one row per primary key: the largest by ``order_cols``, among equal ones
    the one that arrived last, so the result doesn't depend on how rows fall into batches.
    Leave ``order_cols`` empty where a later value may be smaller: the last arrival wins.

    ``delete_when`` (A3): rows of the batch matching it delete their key, which
    is how a group that stops satisfying HAVING leaves the sink.
    ``query_key`` (C6): when the query's upsert key differs from the sink's primary key, the table
    holds the current row of every query key, and :meth:`current` derives the sink's rows from them,
    so a row that another one had hidden is there again when that one moves away.  A state operator for the
    same is :func:`rillet.streaming.retract.sink_changes`.

    Each epoch rewrites the table: for small results (a row per account or city), not for sinks of the
    input's size.
    """

    def __init__(self, base: str, pk: Sequence[str], order_cols: Sequence[str], *,
                 delete_when: Callable[[DataFrame], object] | None = None, query_key: str | None = None,
                 keep_versions: int | None = 3):
        self.base, self.pk, self.order = base, list(pk), list(order_cols)
        self.delete_when, self.query_key = delete_when, query_key
        self.keep_versions = keep_versions

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        # The batch is referenced several times below; persist it so the
        # upstream stateful operator runs once per epoch (a second concurrent
        # evaluation would contend for the same state store partition).
        batch = batch.persist()
        try:
            self._merge(batch, epoch_id)
        finally:
            batch.unpersist()
        if self.keep_versions:
            _drop_old_versions(batch.sparkSession, self.base, self.keep_versions)

    def _merge(self, batch: DataFrame, epoch_id: int) -> None:
        spark = batch.sparkSession
        own = f"{writer_of(batch)}.{epoch_id}"
        versions = _list_versions(spark, self.base)
        if own in [v[1] for v in versions[:-1]]:
            return  # others have written since: this batch is in the table
        if versions and versions[-1][1] == own:
            versions.pop()  # run again: on what it saw the first time
        target = f"{self.base.rstrip('/')}/v={versions[-1][0] + 1 if versions else 0:012d}.{own}"
        old = spark.read.parquet(versions[-1][2]) if versions else None
        new = batch.withColumn("_del", self.delete_when(batch) if self.delete_when is not None else F.lit(False))
        merged = merge_latest(old, new, key=self.pk if self.query_key is None else [self.query_key], order_cols=self.order)
        merged.where(~F.col("_del")).drop("_del").write.mode("overwrite").parquet(target)

    def current(self, spark: SparkSession) -> DataFrame | None:
        """The sink's rows: one per primary key, the largest by ``order_cols``, then by query key."""
        rows = read_latest(spark, self.base)
        if rows is None or self.query_key is None:
            return rows
        return latest_per_key(rows, key=self.pk, order_cols=[*self.order, self.query_key])


def merge_latest(old: DataFrame | None, new: DataFrame, *, key: Sequence[str], order_cols: Sequence[str]) -> DataFrame:
    """C4: the latest row per key of ``old`` and a batch ``new`` (with ``_del``): the largest by ``order_cols``,
    among equal ones the batch's."""
    new = latest_per_key(new, key=key, order_cols=order_cols)
    if old is None:
        return new
    both = old.withColumn("_del", F.lit(False)).withColumn("_src", F.lit(0)).unionByName(new.withColumn("_src", F.lit(1)))
    return latest_per_key(both, key=key, order_cols=[*order_cols, "_src"]).drop("_src")


class DeadLetterSink:
    """C11: one pass over each micro-batch, good rows to ``good_path`` and failed
    checks to ``dlq_path``; ``mode='fail'`` raises on the first bad batch instead."""

    def __init__(self, good_path: str, dlq_path: str, checks: Callable[[DataFrame], dict], *,
                 mode: str = "log"):
        self.good_path, self.dlq_path, self.checks, self.mode = good_path, dlq_path, checks, mode

    def __call__(self, batch: DataFrame, epoch_id: int) -> None:
        batch = batch.persist()
        good, bad = split_valid(batch, self.checks(batch))
        bad = bad.withColumn("epoch_id", F.lit(epoch_id))
        try:
            if self.mode == "fail" and not bad.isEmpty():
                first = bad.select("error_reason").first()[0]
                raise RuntimeError(f"record failed validation ({first}) in batch {epoch_id}")
            part = f"query={writer_of(batch)}/batch={epoch_id}"  # another query's batches stay
            good.write.mode("overwrite").parquet(f"{self.good_path.rstrip('/')}/{part}")
            bad.write.mode("overwrite").parquet(f"{self.dlq_path.rstrip('/')}/{part}")
        finally:
            batch.unpersist()


def committed_offsets(spark: SparkSession, checkpoint: str) -> dict | None:
    """The last committed source offsets of a stopped query's checkpoint.

    For a Kafka source the returned JSON is directly usable as
    ``startingOffsets`` of the new query (its state is not carried over)."""
    jvm = spark._jvm
    commits = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/commits")
    fs = commits.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(commits):
        return None
    ids = sorted(int(s.getPath().getName()) for s in fs.listStatus(commits) if s.getPath().getName().isdigit())
    if not ids:
        return None
    off = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/offsets/{ids[-1]}")
    stream = fs.open(off)
    try:
        text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    lines = [ln for ln in text.splitlines() if ln.strip()]
    # Line 0 is the version, line 1 the metadata, then one line per source.
    return {"batch_id": ids[-1], "sources": [json.loads(ln) if ln.startswith("{") else ln for ln in lines[2:]]}


def files_already_read(spark: SparkSession, checkpoint: str, source: int = 0) -> list[str]:
    """C12 for the file source: its offset is only a log index, so the files a
    stopped query consumed are replayed from ``sources/<n>`` to exclude them."""
    jvm = spark._jvm
    d = jvm.org.apache.hadoop.fs.Path(f"{checkpoint.rstrip('/')}/sources/{source}")
    fs = d.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(d):
        return []
    files = []
    for st in fs.listStatus(d):
        stream = fs.open(st.getPath())
        try:
            text = jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()
        for ln in text.splitlines():
            if ln.startswith("{") and '"path"' in ln:
                files.append(json.loads(ln)["path"])
    return sorted(set(files))


def consumed_files(spark: SparkSession, checkpoint: str, source: int = 0) -> DataFrame:
    """The files a stopped file-source query consumed, read from its source
    log (``sources/<n>``, including compacted batches) as a DataFrame."""
    log = spark.read.text(f"{checkpoint.rstrip('/')}/sources/{source}")
    path = F.get_json_object("value", "$.path")
    return log.where(path.isNotNull()).select(_norm_path(path).alias("_consumed")).distinct()


def _norm_path(p):
    return F.regexp_replace(p, r"^file:/+", "/")


def carry_over_file_stream(spark: SparkSession, path: str, schema, old_checkpoint: str, fmt: str = "parquet"
                           ) -> DataFrame:
    """A new file stream that starts where the stopped one ended: files already
    consumed by ``old_checkpoint`` are excluded (state is not carried).

    The exclusion is a stream-static left-anti join against the old source log,
    so no file list passes through the driver however long the old query ran.
    """
    df = spark.readStream.format(fmt).schema(schema).load(path)
    seen = consumed_files(spark, old_checkpoint)
    cur = df.withColumn("_file", _norm_path(F.col("_metadata.file_path")))
    return cur.join(seen, cur["_file"] == seen["_consumed"], "left_anti").drop("_file")
