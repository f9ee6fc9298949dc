"""Streaming tables that batches add to: a replayed batch replaces what it added, late rows are kept."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallywatch.functions.scalars import before, utc
from tallywatch.operators.dedup import dedup_tx, seen_ids, without
from tallywatch.sources import folding, id_index, storage

SERIES = "tier string, start timestamp, tx_count bigint"
TIERS = ("second", "minute", "hour")


def _when(available_now: bool, trigger: str) -> dict:
    return {"availableNow": True} if available_now else {"processingTime": trigger}


def write_first_deliveries(
    tx: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, trigger: str = "5 seconds", compact_every: int = 20
) -> StreamingQuery:
    """One row per ``tx_id`` over the whole life of the stream, however late it comes.

    The written table is the memory; an id index beside it (``_ids``, which readers of the table skip) tells a batch which of
    its ids the table has, from the buckets that can hold them. Every ``compact_every`` batches the index is merged.
    """
    schema = StructType.fromJson(tx.schema.jsonValue()).add("batch_id", "long")
    ids = f"{path}/_ids"

    def first(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch = batch.persist()
        try:
            once = dedup_tx(batch)
            if storage.exists(spark, path):
                earlier = spark.read.schema(schema).parquet(path).filter((F.col("batch_id") > id_index.last_batch(spark, ids)) & (F.col("batch_id") < batch_id))
                id_index.add(earlier, ids, batch_id - 1)
                once = without(once, seen_ids(batch, id_index.candidates(batch, ids)))
            once.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
            id_index.compact(spark, ids, batch_id, every=compact_every)
        finally:
            batch.unpersist()

    return (
        tx.writeStream.foreachBatch(first).option("checkpointLocation", checkpoint)
        .trigger(**_when(available_now, trigger)).start()
    )


def write_seconds(
    tx: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, trigger: str = "5 seconds",
    keep_seconds: int | None = None, keep_minutes: int | None = None, fold_every: int = 20,
) -> StreamingQuery:
    """Transactions per second as partial counts of each batch, the newest second and late rows included.

    Every ``fold_every`` batches the counts are folded into one table of three tiers. Seconds over ``keep_seconds`` older
    than the newest become minutes, and minutes over ``keep_minutes`` older than it hours; without these, tiers keep all. A late
    row is counted in the tier that its time has reached.
    """
    def counts(batch: DataFrame, batch_id: int) -> None:
        timed = batch.filter(F.col("ts").isNotNull())
        seconds = timed.groupBy(F.date_trunc("second", "ts").alias("start")).agg(F.count("*").alias("tx_count"))
        folding.add(seconds.select(F.lit("second").alias("tier"), "start", "tx_count"), path, batch_id)
        folding.fold(batch.sparkSession, path, SERIES, batch_id, lambda rows: _rolled_up(rows, keep_seconds, keep_minutes), fold_every)

    return (
        tx.writeStream.foreachBatch(counts).option("checkpointLocation", checkpoint)
        .trigger(**_when(available_now, trigger)).start()
    )


def _rolled_up(rows: DataFrame, keep_seconds: int | None, keep_minutes: int | None) -> DataFrame:
    """Counts in the tier that their age has reached; whole minutes and hours move, so no count is in two tiers."""
    newest = rows.agg(F.max("start")).scalar()
    tier, start = F.col("tier"), F.col("start")
    for finer, coarser, keep in (("second", "minute", keep_seconds), ("minute", "hour", keep_minutes)):
        if keep is None:
            continue
        old = (tier == finer) & (F.date_trunc(coarser, start) < F.date_trunc(coarser, before(newest, keep)))
        tier, start = F.when(old, coarser).otherwise(tier), F.when(old, F.date_trunc(coarser, start)).otherwise(start)
    return rows.select(tier.alias("tier"), start.alias("start"), "tx_count").groupBy("tier", "start").agg(F.sum("tx_count").alias("tx_count"))


def read_series(spark: SparkSession, path: str, tier: str = "second", since: datetime | None = None) -> DataFrame:
    """(start, tx_count) per ``second``, ``minute`` or ``hour``, from counts of that tier and finer ones; seconds need no other tier."""
    finer = TIERS[: TIERS.index(tier) + 1]
    rows = folding.read(spark, path, SERIES).filter(F.col("tier").isin(*finer))
    if since is not None:
        rows = rows.filter(F.col("start") >= F.date_trunc(tier, F.lit(utc(since))))
    return rows.groupBy(F.date_trunc(tier, "start").alias("start")).agg(F.sum("tx_count").alias("tx_count"))


def read_seconds(spark: SparkSession, path: str, since: datetime | None = None) -> DataFrame:
    """(second, tx_count) of what :func:`write_seconds` has written so far and still keeps by second."""
    return read_series(spark, path, "second", since).withColumnRenamed("start", "second")


def write_table(rows: DataFrame, path: str, checkpoint: str, *, available_now: bool = False, trigger: str = "5 seconds") -> StreamingQuery:
    """Append a streaming result to a Parquet table, each row exactly once across restarts."""
    return (
        rows.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).option("path", path)
        .trigger(**_when(available_now, trigger)).start()
    )
