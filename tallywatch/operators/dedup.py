"""Removing repeated deliveries of one transaction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedup_tx(tx: DataFrame) -> DataFrame:
    """One row per ``tx_id``: the smallest by event time, then by the other columns in order.

    ``min`` of a struct combines on the map side, so many copies of one id never meet in one task.
    """
    rest = ["ts"] + [c for c in tx.columns if c not in ("tx_id", "ts")]
    kept = tx.groupBy("tx_id").agg(F.min(F.struct(*rest)).alias("kept"))
    return kept.select(*[F.col("tx_id") if c == "tx_id" else F.col(f"kept.{c}").alias(c) for c in tx.columns])


def seen_ids(ids: DataFrame, seen: DataFrame) -> DataFrame:
    """The ids of ``ids`` that ``seen`` holds.

    ``ids`` is the small side: while Spark finds it small enough to broadcast, ``seen`` is not shuffled.
    """
    return seen.select("tx_id").join(ids.select("tx_id").distinct(), "tx_id", "left_semi").distinct()


def without(tx: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows whose ``tx_id`` is not in ``ids``."""
    return tx.join(ids, "tx_id", "left_anti").select(*tx.columns)
