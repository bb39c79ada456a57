"""Session helpers.

Library functions never build a session; they take one. ``get_session`` is
for tests, the benchmark and command-line use. Cluster settings such as
``spark.checkpoint.dir`` are read from the session and only filled in here
when they are unset (local runs).
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Settings every run wants; anything already set by the cluster wins.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


def get_session(master: str | None = None, shuffle_partitions: int | None = None,
                app_name: str = "touchline", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    try:
        spark.sparkContext.setLogLevel("ERROR")
    except Exception:  # noqa: BLE001
        pass
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting a local one only if unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    try:
        sc = spark.sparkContext
    except Exception:  # noqa: BLE001  (Spark Connect has no SparkContext)
        sc = None
    if not path and sc is not None:
        path = sc.getCheckpointDir()
    if not path:
        master = sc.master if sc is not None else spark.conf.get("spark.master", "")
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        path = tempfile.mkdtemp(prefix="touchline-ckpt-")   # one process, one machine
    if sc is not None:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(path)
        return sc.getCheckpointDir() or path
    return path


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder.

    Used for written intermediate tables (lineage cuts, round trips);
    never a machine-local temporary folder.
    """
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/touchline/{name}-{uuid.uuid4().hex[:12]}"


@contextmanager
def open_partitions(spark: SparkSession, files: int) -> Iterator[None]:
    """Writes within keep up to ``files`` partitions open in a task instead of sorting all its rows by
    partition; a task that meets more of them sorts the rest."""
    name = "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, "0")
    spark.conf.set(name, str(files))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def remove_scratch(spark: SparkSession) -> None:
    """Delete everything that ``scratch_path`` handed out under this checkpoint folder.

    For the end of a run: results that still read from there must be written first.
    """
    remove_folder(spark, f"{ensure_checkpoint_dir(spark).rstrip('/')}/touchline")


def remove_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote, wherever Spark's file systems put it."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
