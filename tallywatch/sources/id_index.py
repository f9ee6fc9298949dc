"""The ids a table has taken in, in hash buckets of bounded size: a batch reads only the buckets that can hold its ids.

The index is made from finished batches of its table and from nothing else, so it can't disagree with it: a batch first adds
what the index lacks (:func:`last_batch` tells), then asks. Each addition is a segment, ``seg=<name>/bucket=<n>``, with a row in
a manifest. Segments are merged by size, ``fan_in`` of a level into one of the next, so an id is rewritten a few times in all.
The number of buckets is a power of two that grows with the segment; a batch of n ids reads n buckets per segment at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from tallywatch.sources import folding, storage

ENTRY = "seg string, level int, buckets int, ids bigint, last_batch bigint"
IDS_PER_BUCKET = 1_000_000
#: Segments of a level that are merged into one.
FAN_IN = 8


def _manifest(path: str) -> str:
    return f"{path}/_manifest"


def _folder(path: str, seg: str) -> str:
    return f"{path}/seg={seg}"


def _bucket(buckets: int) -> Column:
    return F.pmod(F.xxhash64("tx_id"), F.lit(buckets)).cast("int").alias("bucket")


def entries(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row per segment."""
    return folding.read(spark, _manifest(path), ENTRY)


def last_batch(spark: SparkSession, path: str) -> int:
    """The newest batch with ids in the index, -1 if there is none."""
    newest = entries(spark, path).agg(F.max("last_batch")).first()[0]
    return -1 if newest is None else newest


def _write(ids: DataFrame, path: str, seg: str, level: int, n: int, batch_id: int, ids_per_bucket: int) -> Row:
    buckets = 1 << max(0, math.ceil(math.log2(max(1, n) / ids_per_bucket)))
    spread = ids.select("tx_id", _bucket(buckets)).hint("rebalance", "bucket")
    spread.write.mode("overwrite").partitionBy("bucket").parquet(_folder(path, seg))
    return Row(seg=seg, level=level, buckets=buckets, ids=n, last_batch=batch_id)


def _read(spark: SparkSession, path: str, folders: list[str]) -> DataFrame:
    if not folders:
        return spark.createDataFrame([], "tx_id string")
    return spark.read.schema("tx_id string").option("basePath", path).parquet(*folders).select("tx_id")


def add(ids: DataFrame, path: str, batch_id: int, *, ids_per_bucket: int = IDS_PER_BUCKET) -> None:
    """Add the ids of finished batches up to ``batch_id``; again for the same batch, they are replaced. Null ids are left out."""
    ids = ids.select("tx_id").filter("tx_id IS NOT NULL")
    n = ids.count()
    if n:
        entry = _write(ids, path, f"b{batch_id}", 0, n, batch_id, ids_per_bucket)
        folding.add(ids.sparkSession.createDataFrame([entry], ENTRY), _manifest(path), batch_id)


def candidates(ids: DataFrame, path: str) -> DataFrame:
    """The part of the index that can hold any of ``ids``: their buckets of every segment.

    What reaches the driver is a row per segment and the numbers of the buckets that are touched.
    """
    spark = ids.sparkSession
    listed = entries(spark, path).collect()
    most = max((e["buckets"] for e in listed), default=1)
    touched = [r["bucket"] for r in ids.filter("tx_id IS NOT NULL").select(_bucket(most)).distinct().collect()] if listed else []
    folders = []
    for e in listed:
        segment = _folder(path, e["seg"])
        wanted = {f"bucket={b % e['buckets']}" for b in touched}
        folders += [f"{segment}/{name}" for name in storage.child_names(spark, segment) if name in wanted]
    return _read(spark, path, folders)


def compact(spark: SparkSession, path: str, below: int, *, every: int = 1, fan_in: int = FAN_IN, ids_per_bucket: int = IDS_PER_BUCKET) -> bool:
    """Merge levels with ``fan_in`` or more segments, if ``every`` additions have come since; whether the manifest was folded.

    Only the stream that writes the index reads it, between compactions, so merged segments are deleted at once.
    """
    def merged(listed: DataFrame) -> DataFrame:
        held = listed.collect()
        level = 0
        while any(e["level"] >= level for e in held):
            own = [e for e in held if e["level"] == level]
            if len(own) >= max(2, fan_in):
                ids = _read(spark, path, [_folder(path, e["seg"]) for e in own])
                whole = _write(ids, path, f"c{below - 1}-{level + 1}", level + 1, sum(e["ids"] for e in own), max(e["last_batch"] for e in own), ids_per_bucket)
                held = [e for e in held if e["level"] != level] + [whole]
            level += 1
        return spark.createDataFrame(held, ENTRY)

    if not folding.fold(spark, _manifest(path), ENTRY, below, merged, every):
        return False
    needed = {f"seg={e['seg']}" for e in entries(spark, path).collect()}
    for name in storage.child_names(spark, path):
        if name.startswith("seg=") and name not in needed:
            storage.delete_tree(spark, f"{path}/{name}")
    return True
