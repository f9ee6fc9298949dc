"""Live activity: recent transactions, throughput and the monitor headline."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scalars import before, instant
from tallywatch.plans.metrics import AsOf
from tallywatch.schema import RECENT_COLUMNS

RECENT_SECONDS = 120
ACTIVITY_SECONDS = 10
SERIES_SECONDS = 60


def recent_tx(tx: DataFrame, as_of: AsOf = None, seconds: int = RECENT_SECONDS) -> DataFrame:
    """Raw transactions of the last seconds. A ``dt`` column, if there is one, prunes the scan."""
    start = before(instant(as_of, tx), seconds)
    recent = tx.filter(F.col("ts") >= start)
    if "dt" in tx.columns:
        recent = recent.filter(F.col("dt") >= F.to_date(start))
    return recent.select(*RECENT_COLUMNS)


def last_activity(tx: DataFrame, seconds: int = ACTIVITY_SECONDS) -> DataFrame:
    """One row: transactions in the last seconds before the newest one, and the rate per second."""
    inside = tx.filter(F.col("ts") >= before(instant(None, tx), seconds))
    count = F.count("*")
    return inside.agg(count.alias("tx_count"), (count / F.lit(float(seconds))).alias("tx_per_sec"))


def tx_per_second(tx: DataFrame, seconds: int = SERIES_SECONDS) -> DataFrame:
    """Transactions per second over the last minute, seconds without any in between as 0.

    The filled seconds number at most ``seconds`` + 1, so they are added as zero rows and summed.
    """
    recent = tx.filter(F.col("ts") >= before(instant(None, tx), seconds))
    counts = recent.groupBy(F.window("ts", "1 second").start.alias("second")).agg(F.count("*").alias("n"))
    seconds_between = F.sequence(F.min("second"), F.max("second"), F.expr("interval 1 second"))
    gaps = counts.agg(seconds_between.alias("s")).select(F.explode("s").alias("second"), F.lit(0).cast("bigint").alias("n"))
    return counts.unionByName(gaps).groupBy("second").agg(F.sum("n").alias("tx_count"))


def monitor_summary(flagged: DataFrame, recent: DataFrame) -> DataFrame:
    """One row: last-seconds activity, users tracked, users flagged."""
    users = flagged.agg(
        F.count("*").alias("tracked_users"),
        F.count(F.when(F.col("anomaly"), 1)).alias("flagged_users"),
    )
    activity = last_activity(recent)
    return users.select(
        activity.select("tx_count").scalar().alias("tx_last_10s"),
        activity.select("tx_per_sec").scalar().alias("tx_per_sec"),
        "tracked_users",
        "flagged_users",
    )
