"""Session helpers: build a session for tests/bench, and find the shared
checkpoint folder the cluster names in ``spark.checkpoint.dir``."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import SparkSession


def build_session(master: str = "local[8]", shuffle_partitions: int = 8,
                  app: str = "eventlake", extra: dict | None = None) -> SparkSession:
    b = (SparkSession.builder.master(master).appName(app)
         .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
         .config("spark.sql.adaptive.enabled", "true")
         .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
         .config("spark.sql.adaptive.skewJoin.enabled", "true")
         .config("spark.sql.session.timeZone", "UTC")
         .config("spark.sql.execution.arrow.pyspark.enabled", "true")
         .config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", "16g"))
    for k, v in (extra or {}).items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
STATE_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def _setting(spark: SparkSession, name: str, value: str):
    before = spark.conf.get(name, None)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def rocksdb_state(spark: SparkSession):
    """Streams started inside keep their state in RocksDB, which ``transformWithState``
    needs. A stream takes the session's settings when it starts and its checkpoint
    remembers them, so the setting is put back afterwards and no other query sees it."""
    return _setting(spark, STATE_PROVIDER, ROCKSDB)


def done_shuffles_removed(spark: SparkSession):
    """Actions run inside remove their shuffle files when they end, not when the driver happens
    to collect garbage: for jobs of many steps, each of which writes its result reliably."""
    return _setting(spark, SHUFFLE_CLEANUP, "true")


def prepare(spark: SparkSession) -> SparkSession:
    """Pin the session settings the operators rely on: UTC time zone (all
    event times are epoch milliseconds rendered in UTC)."""
    if spark.conf.get("spark.sql.session.timeZone", None) != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder. On a cluster it is named in
    ``spark.checkpoint.dir``, and it is an error if it is not; a local master
    gets a folder of its own."""
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        d = tempfile.mkdtemp(prefix="eventlake-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared checkpoint folder (never a
    machine-local temp dir), for written intermediate tables and stream
    checkpoints. It is deleted when the session ends."""
    base = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{base}/eventlake/{name}-{uuid.uuid4().hex[:12]}"
    p, fs = hadoop_path(spark, path)
    fs.deleteOnExit(p)
    return path


def hadoop_path(spark: SparkSession, path: str):
    """(path, file system) of the Hadoop API; a path without a scheme is on the
    default file system, whatever that is."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(p), fs


def clear_own(spark: SparkSession, path: str, marker: str) -> str:
    """An empty folder for a writer that leaves its ``marker`` in it: a folder with the marker is
    emptied, a new or empty one gets it, any other is an error. Returns the full URI."""
    p, fs = hadoop_path(spark, path)
    sign = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p, marker)
    if fs.exists(p) and len(fs.listStatus(p)):
        if not fs.exists(sign):
            raise ValueError(f"{path} is not empty and was not written by this sink")
        fs.delete(p, True)
    fs.mkdirs(p)
    fs.create(sign, True).close()
    return p.toString()
