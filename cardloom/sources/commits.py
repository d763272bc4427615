"""Small files that appear whole or not at all, on any file system that Spark writes to."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """A folder that the driver and all executors share: spark.checkpoint.dir, or where that is unset the warehouse."""
    conf = spark.sparkContext.getConf()
    return spark.conf.get("spark.checkpoint.dir", None) or conf.get("spark.checkpoint.dir") or spark.conf.get("spark.sql.warehouse.dir")


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a file under another name and renames it; readers see all of it or none."""
    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    hidden = spark._jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_{uuid.uuid4().hex}")
    out = fs.create(hidden, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    if not fs.rename(hidden, at):
        raise OSError(f"cannot rename to {path}")


def claim(spark: SparkSession, path: str) -> bool:
    """Creates an empty file if there is none; of several callers one gets True.

    File systems with a name service create exclusively; for local files the
    virtual machine's own exclusive creation is used, which theirs lacks.
    """
    from py4j.protocol import Py4JJavaError

    fs, at = _at(spark, path)
    fs.mkdirs(at.getParent())
    if fs.getUri().getScheme() == "file":
        return spark._jvm.java.io.File(fs.makeQualified(at).toUri().getPath()).createNewFile()
    try:
        fs.create(at, False).close()
    except Py4JJavaError as e:
        if "AlreadyExists" in e.java_exception.getClass().getName():
            return False
        raise
    return True


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder without hidden ones; none where there is no folder."""
    fs, at = _at(spark, path)
    if not fs.exists(at):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(at)]
    return sorted(n for n in found if n[:1] not in "_.")


def drop(spark: SparkSession, path: str) -> None:
    """Removes a file or folder, if it is there."""
    fs, at = _at(spark, path)
    fs.delete(at, True)
