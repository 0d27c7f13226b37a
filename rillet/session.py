"""Session construction and cluster-safe scratch locations."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every rillet job relies on.  Time zone UTC makes TIMESTAMP and
# TIMESTAMP_NTZ print the same and matches the reference's UTC setting.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Python state server over a socket file instead of a loopback port.
    "spark.python.unix.domain.socket.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "rillet", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with rillet's base settings.

    ``master`` and ``shuffle_partitions`` are meant for local runs; on a cluster
    leave them ``None`` so the submitter's values win.
    """
    b = SparkSession.builder.appName(app_name)
    if master:
        b = b.master(master)
    for k, v in BASE_CONF.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    checkpoint_dir(spark)
    return spark


#: By application: the scratch folder of a local session that names no shared one.
_SCRATCH: dict[str, str] = {}


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints and lineage-cutting tables: the cluster's ``spark.checkpoint.dir``.

    Where it is unset, a local session gets a scratch folder of its own, removed when the driver
    ends; on a cluster that is an error, as executors wouldn't see the driver's files.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or _SCRATCH.get(sc.applicationId)
    if not d:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        d = _SCRATCH[sc.applicationId] = tempfile.mkdtemp(prefix="rillet-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
        atexit.register(shutil.rmtree, d, ignore_errors=True)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete what is at ``path``, through the file system that it names."""
    jvm = spark._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


#: By application: the folder of the shipped archive, kept until the driver ends.
_SHIPPED: dict[str, tempfile.TemporaryDirectory] = {}


def ship_package(spark: SparkSession) -> None:
    """Give the executors this package, once per application, through Spark's own file
    distribution; Python workers need no PYTHONPATH or shared source folder then."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    root = os.path.dirname(os.path.abspath(__file__))
    _SHIPPED[sc.applicationId] = folder = tempfile.TemporaryDirectory(prefix="rillet-ship-")
    archive = os.path.join(folder.name, "rillet_package.zip")
    with zipfile.ZipFile(archive, "w") as z:
        for base, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(base, name)
                    z.write(path, os.path.relpath(path, os.path.dirname(root)))
    sc.addPyFile(archive)
