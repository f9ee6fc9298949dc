"""Thin access to the Hadoop file system the tables live on (local, HDFS or object store)."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _hadoop_path(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _hadoop_path(spark, path)
    return fs.exists(p)


def child_names(spark: SparkSession, path: str) -> list[str]:
    fs, p = _hadoop_path(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def delete_tree(spark: SparkSession, path: str) -> None:
    fs, p = _hadoop_path(spark, path)
    fs.delete(p, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A new small file, whole or not there: it is written beside its place and renamed."""
    fs, p = _hadoop_path(spark, path)
    beside = p.suffix(".part")
    out = fs.create(beside, True)
    out.writeUTF(text)
    out.close()
    if not fs.rename(beside, p):
        raise OSError(f"could not rename to {path}")


def read_text(spark: SparkSession, path: str) -> str | None:
    """What ``write_text`` has written, or None."""
    fs, p = _hadoop_path(spark, path)
    if not fs.exists(p):
        return None
    held = fs.open(p)
    try:
        return held.readUTF()
    finally:
        held.close()
