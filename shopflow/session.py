"""SparkSession construction and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every job relies on: UTC wall clock, ANSI semantics (bad input is
# handled with try_* functions, never silently), adaptive execution for
# runtime broadcast / partition coalescing / skew splitting, no web UI.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "shopflow",
                  shuffle_partitions: int | None = None,
                  extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    # ANSI stays on; lenient parsing is explicit through try_* functions.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder the cluster names.

    ``spark.checkpoint.dir`` (or the context's checkpoint dir) is used as is.
    When neither is set, a local master -- driver and executors in one
    process, as in tests -- gets a private temporary folder; any other master
    raises, since each executor would write to a disk the others cannot see.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        return path
    path = spark.sparkContext.getCheckpointDir()
    if path:
        return path
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError(f"spark.checkpoint.dir must name a folder shared by all executors (master {master})")
    path = tempfile.mkdtemp(prefix="shopflow-ckpt-")
    spark.conf.set("spark.checkpoint.dir", path)
    spark.sparkContext.setCheckpointDir(path)
    return path


def work_path(spark: SparkSession, *parts: str) -> str:
    """A fresh, unique folder below the shared checkpoint folder.

    Intermediate tables (lineage cuts, source round trips, stream inputs and
    outputs) are written here so every executor sees them.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return "/".join([root, "shopflow", *parts, uuid.uuid4().hex])


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within it, the shuffle files of a write go when the write ends, not when the driver's memory next fills up."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def remove(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table below the shared checkpoint folder."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
