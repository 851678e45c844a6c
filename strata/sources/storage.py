"""Paths on whatever file system the session uses (local, HDFS, object store)."""

from __future__ import annotations

import tempfile
import uuid
from datetime import datetime

from pyspark.sql import SparkSession


def _file_system(spark: SparkSession, path: str):
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _file_system(spark, path)
    return fs.exists(p)


def url_path(spark: SparkSession, path: str) -> str:
    """Absolute path, encoded as in ``_metadata.file_path``, without scheme and host."""
    fs, p = _file_system(spark, path)
    return fs.makeQualified(p).toUri().getRawPath()


def names(spark: SparkSession, pattern: str) -> list[str]:
    """Last path components matching a glob. The number of runs and snapshots bounds it."""
    fs, p = _file_system(spark, pattern)
    found = fs.globStatus(p)
    return sorted(status.getPath().getName() for status in found or [])


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def move(spark: SparkSession, source: str, target: str) -> None:
    """Rename; fails when the target exists, so nothing is ever overwritten by accident."""
    fs, p = _file_system(spark, source)
    _, t = _file_system(spark, target)
    if fs.exists(t):
        raise FileExistsError(target)
    fs.mkdirs(t.getParent())
    if not fs.rename(p, t):
        raise OSError(f"Could not move {source} to {target}")


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small text file; the one before it is replaced by a rename once this one is complete."""
    fs, target = _file_system(spark, path)
    _, aside = _file_system(spark, f"{path}.{uuid.uuid4().hex}")
    stream = fs.create(aside, True)
    try:
        stream.write(bytearray(text, "utf-8"))
    finally:
        stream.close()
    fs.delete(target, False)
    fs.rename(aside, target)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The content of a small text file, or None where there is none."""
    fs, p = _file_system(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8")
    finally:
        stream.close()


def staging(root: str) -> str:
    """Fresh folder beside the final one. Spark's readers skip names starting with ``_``."""
    return f"{root.rstrip('/')}/_staging_{uuid.uuid4().hex}"


def run_timestamp(now: datetime | None = None) -> str:
    """``yyyyMMdd_HHmmss_ffffff``: fixed width, so names sort by time."""
    return (now or datetime.now()).strftime("%Y%m%d_%H%M%S_%f")


def workspace(spark: SparkSession, label: str) -> str:
    """Fresh folder for intermediate tables, in the shared folder the cluster names.

    Only a local session without one falls back to the machine's temporary folder.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("Set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/strata-{label}-{uuid.uuid4().hex[:12]}"
