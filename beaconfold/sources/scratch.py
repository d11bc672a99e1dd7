"""Where intermediate tables may be written so that every executor sees them."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import SparkSession

_LOCAL_ROOTS: list[tempfile.TemporaryDirectory] = []


def shared_root(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder.

    Taken from ``spark.checkpoint.dir`` or the context's checkpoint directory. Without either, a local session gets a
    temporary folder, removed when Python ends; any other master is refused, as its executors could not see it.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root is None and (given := spark.sparkContext._jsc.sc().getCheckpointDir()).isDefined():
        root = given.get()
    if root is None:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a folder that all executors of {master} share")
        if not _LOCAL_ROOTS:
            _LOCAL_ROOTS.append(folder := tempfile.TemporaryDirectory(prefix="beaconfold-", ignore_cleanup_errors=True))
            atexit.register(folder.cleanup)
        root = _LOCAL_ROOTS[0].name
    return root.rstrip("/")


def remove_dir(spark: SparkSession, path: str) -> None:
    """Delete a folder of the shared root, if it is there."""
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory path under the shared root, deleted with what it holds when the session's application ends."""
    path = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.mkdirs(where.getParent())
    # The file system deletes registered folders as it closes, at the end of the driver's JVM.
    files.mkdirs(where)
    files.deleteOnExit(where)
    files.delete(where, True)
    return path
