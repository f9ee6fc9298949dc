"""The append-only transaction ledger: Parquet segments by day, and a manifest that lists them.

A batch is one segment, ``seg=b<batch>/dt=<day>``. The manifest has a row for each segment and day, with its rows and first
and last event time, and is what readers go by: a segment that no manifest lists is not part of the ledger. Days that lie in
many segments are compacted into one, ``seg=c<batch>``, in which ``batch_id`` tells the batches apart as before.
"""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.scalars import utc
from tallywatch.schema import LEDGER_SCHEMA
from tallywatch.sources import folding, storage

NO_DAY = "__HIVE_DEFAULT_PARTITION__"
ENTRY = "seg string, dt date, tx_rows bigint, min_ts timestamp, max_ts timestamp, last_batch bigint"
#: Segments of a day that are merged into one.
FAN_IN = 8


def _manifest(path: str) -> str:
    return f"{path}/_manifest"


def _replaced(path: str) -> str:
    return f"{path}/_replaced"


def _folder(path: str, seg: str, day: date | None) -> str:
    return f"{path}/seg={seg}/dt={NO_DAY if day is None else day.isoformat()}"


def append(tx: DataFrame, path: str, batch_id: int) -> None:
    """Add one batch. Appending the same batch again replaces it, so a replay adds nothing.

    Rows are spread by day before the write to keep the file count near the day count. The hint lets
    Spark split a day that holds most of the batch over several tasks.
    """
    spark, seg = tx.sparkSession, f"b{batch_id}"
    spread = tx.withColumn("batch_id", F.lit(batch_id).cast("bigint")).hint("rebalance", "dt")
    spread.write.mode("overwrite").partitionBy("dt").parquet(f"{path}/seg={seg}")
    written = spark.read.schema(LEDGER_SCHEMA).parquet(f"{path}/seg={seg}")
    entries = written.groupBy("dt").agg(F.count("*").alias("tx_rows"), F.min("ts").alias("min_ts"), F.max("ts").alias("max_ts"))
    folding.add(entries.select(F.lit(seg).alias("seg"), "dt", "tx_rows", "min_ts", "max_ts", F.lit(batch_id).cast("bigint").alias("last_batch")), _manifest(path), batch_id)


def entry_path(path: str, batch_id: int) -> str:
    """The manifest's part that lists a batch; it is written last."""
    return folding.delta_path(_manifest(path), batch_id)


def entries(spark: SparkSession, path: str, up_to_batch: int | None = None) -> DataFrame:
    """The manifest: a row per segment and day."""
    return folding.read(spark, _manifest(path), ENTRY, up_to_batch)


def scan(
    spark: SparkSession,
    path: str,
    *,
    since: datetime | Column | None = None,
    up_to_batch: int | None = None,
    after_batch: int | None = None,
) -> DataFrame:
    """The ledger, optionally from an event time on or after a batch; both bounds also prune segments and days."""
    listed = entries(spark, path, up_to_batch)
    if after_batch is not None:
        listed = listed.filter(F.col("last_batch") > after_batch)
    if isinstance(since, datetime):
        listed = listed.filter(F.col("max_ts") >= F.lit(utc(since)))
    tx = _read(spark, path, listed)
    if after_batch is not None:
        tx = tx.filter(F.col("batch_id") > after_batch)
    return tx if since is None else from_time(tx, since)


def _read(spark: SparkSession, path: str, listed: DataFrame) -> DataFrame:
    """The segments that the entries list: a row of metadata for each segment and day comes to the driver, as paths do."""
    folders = sorted(_folder(path, e["seg"], e["dt"]) for e in listed.select("seg", "dt").collect())
    if not folders:
        return spark.createDataFrame([], LEDGER_SCHEMA)
    rows = spark.read.schema(LEDGER_SCHEMA).option("basePath", path).parquet(*folders)
    return rows.select(*LEDGER_SCHEMA.names)


def from_time(tx: DataFrame, since: datetime | Column) -> DataFrame:
    """Rows at or after ``since``; reads only the days that can hold such rows."""
    bound = since if isinstance(since, Column) else F.lit(utc(since))
    return tx.filter((F.col("dt") >= F.to_date(bound)) & (F.col("ts") >= bound))


def days(spark: SparkSession, path: str, since: date | None = None) -> list[date]:
    """Calendar days the ledger holds, from its manifest alone."""
    listed = entries(spark, path).filter("dt IS NOT NULL AND tx_rows > 0").select("dt").distinct()
    return sorted(r["dt"] for r in (listed if since is None else listed.filter(F.col("dt") >= F.lit(since))).collect())


def scan_days(spark: SparkSession, path: str, days: Iterable[date | None], up_to_batch: int | None = None) -> DataFrame:
    """Only the given days (``None`` = rows without event time), listing no other folder."""
    wanted = list(days)
    any_day = reduce(Column.__or__, [F.col("dt").eqNullSafe(F.lit(d).cast("date")) for d in wanted], F.lit(False))
    return _read(spark, path, entries(spark, path, up_to_batch).filter(any_day))


def newest(spark: SparkSession, path: str) -> Column:
    """The ledger's newest event time, answered by its manifest. NULL for an empty ledger."""
    return entries(spark, path).agg(F.max("max_ts")).scalar()


def compact(spark: SparkSession, path: str, below: int, *, every: int = 1, fan_in: int = FAN_IN) -> bool:
    """Merge the days that lie in ``fan_in`` or more segments of batches below ``below``, if ``every`` new ones have come.

    Batches below ``below`` must be finished: they can't be replayed. Merged segments are deleted by the compaction after
    the next, so that a reader that has begun with the older manifest can end. Running it again changes nothing.
    """
    def merged(listed: DataFrame) -> DataFrame:
        seg = f"c{below - 1}"
        many = listed.groupBy("dt").agg(F.count("*").alias("n")).filter(F.col("n") >= fan_in).select(F.col("dt").alias("day"))
        to_merge = listed.join(many, F.col("dt").eqNullSafe(F.col("day")), "left_semi")
        _read(spark, path, to_merge).hint("rebalance", "dt").write.mode("overwrite").partitionBy("dt").parquet(f"{path}/seg={seg}")
        folding.add(to_merge, _replaced(path), below - 1)
        whole = to_merge.groupBy("dt").agg(*[F.expr(f"{f}({c}) AS {c}") for f, c in (("sum", "tx_rows"), ("min", "min_ts"), ("max", "max_ts"), ("max", "last_batch"))])
        kept = listed.join(many, F.col("dt").eqNullSafe(F.col("day")), "left_anti")
        return kept.unionByName(whole.withColumn("seg", F.lit(seg)))

    if not folding.fold(spark, _manifest(path), ENTRY, below, merged, every):
        return False
    _clear(spark, path, below)
    return True


def _clear(spark: SparkSession, path: str, below: int) -> None:
    """Delete segments that neither the manifest nor the one before it lists, and those of compactions that did not end."""
    versions = folding.delta_versions(spark, _replaced(path))
    for old in versions[:-1]:
        storage.delete_tree(spark, f"{_replaced(path)}/delta/v={old}")
    listed = entries(spark, path).select("seg", "dt").unionByName(folding.read(spark, _replaced(path), ENTRY).select("seg", "dt"))
    needed = {_folder(path, e["seg"], e["dt"]) for e in listed.distinct().collect()}
    segments = {f.rsplit("/", 1)[0] for f in needed}
    for name in storage.child_names(spark, path):
        if not name.startswith("seg=") or (name.startswith("seg=b") and int(name[5:]) >= below):
            continue
        folder = f"{path}/{name}"
        if folder not in segments:
            storage.delete_tree(spark, folder)
            continue
        for day in storage.child_names(spark, folder):
            if day.startswith("dt=") and f"{folder}/{day}" not in needed:
                storage.delete_tree(spark, f"{folder}/{day}")
