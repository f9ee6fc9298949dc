"""Tables that grow by one small delta per batch and are folded, now and then, into a new base.

``root/delta/v=<batch>`` holds what a batch adds, ``root/base/v=<batch>`` everything up to a batch. A base is only ever made of
batches that can't be run again, so a replayed batch replaces its own delta and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tallywatch.sources import snapshots, storage


def delta_path(root: str, batch_id: int) -> str:
    return snapshots.version_path(f"{root}/delta", batch_id)


def add(rows: DataFrame, root: str, batch_id: int) -> None:
    """Publish the delta of a batch; again for the same batch, it replaces it."""
    snapshots.publish(rows, f"{root}/delta", batch_id, files=1)


def base_version(spark: SparkSession, root: str, up_to: int | None = None) -> int | None:
    return snapshots.latest_version(spark, f"{root}/base", None if up_to is None else up_to + 1)


def delta_versions(spark: SparkSession, root: str, up_to: int | None = None) -> list[int]:
    """The batches that are not in the base yet."""
    base = base_version(spark, root, up_to)
    versions = snapshots.committed_versions(spark, f"{root}/delta")
    return [v for v in versions if (base is None or v > base) and (up_to is None or v <= up_to)]


def read(spark: SparkSession, root: str, schema: str, up_to: int | None = None) -> DataFrame:
    """The rows of all batches, or of those up to one."""
    base = base_version(spark, root, up_to)
    paths = [] if base is None else [snapshots.version_path(f"{root}/base", base)]
    paths += [snapshots.version_path(f"{root}/delta", v) for v in delta_versions(spark, root, up_to)]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def fold(spark: SparkSession, root: str, schema: str, below: int, merged: Callable[[DataFrame], DataFrame], at_least: int = 1) -> bool:
    """Write a base of all batches below ``below``, if there are ``at_least`` that no base has; whether it did.

    The base before it, and the deltas since, stay for readers that have begun with them.
    """
    if len(delta_versions(spark, root, below - 1)) < at_least or base_version(spark, root, below - 1) == below - 1:
        return False
    snapshots.publish(merged(read(spark, root, schema, below - 1)), f"{root}/base", below - 1, files=1)
    snapshots.expire(spark, f"{root}/base", keep=2)
    oldest = snapshots.committed_versions(spark, f"{root}/base")[0]
    if oldest < below - 1:
        for version in snapshots.committed_versions(spark, f"{root}/delta"):
            if version <= oldest:
                storage.delete_tree(spark, snapshots.version_path(f"{root}/delta", version))
    return True
