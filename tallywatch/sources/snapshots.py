"""Versioned table snapshots: a reader never sees a half-written version.

Each version is its own folder ``v=<number>``; Spark's ``_SUCCESS`` marker commits it. Writing a
version again (a replayed batch) replaces that version only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tallywatch.sources import storage


def version_path(root: str, version: int) -> str:
    return f"{root}/v={version}"


def publish(df: DataFrame, root: str, version: int, files: int | None = None) -> str:
    """Write ``df`` as ``version``. ``files`` caps the number of output files; default leaves it to Spark."""
    path = version_path(root, version)
    (df if files is None else df.coalesce(files)).write.mode("overwrite").parquet(path)
    return path


def committed_versions(spark: SparkSession, root: str) -> list[int]:
    names = [n for n in storage.child_names(spark, root) if n.startswith("v=")]
    return sorted(int(n[2:]) for n in names if storage.exists(spark, f"{root}/{n}/_SUCCESS"))


def latest_version(spark: SparkSession, root: str, below: int | None = None) -> int | None:
    versions = [v for v in committed_versions(spark, root) if below is None or v < below]
    return versions[-1] if versions else None


def read_latest(spark: SparkSession, root: str) -> DataFrame:
    version = latest_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.parquet(version_path(root, version))


def expire(spark: SparkSession, root: str, keep: int) -> None:
    """Drop all but the newest ``keep`` committed versions."""
    for version in committed_versions(spark, root)[:-keep]:
        storage.delete_tree(spark, version_path(root, version))
