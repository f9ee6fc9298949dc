"""Dashboard tables: which users are shown, and the three metric views of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.scalars import or_zero
from tallywatch.operators.edges import both_parties
from tallywatch.plans.rules import display_numbers
from tallywatch.schema import ROLES, SPANS

SHOWN_USERS = 20
TOP_SENDERS = 10


def recent_users(tx: DataFrame, n: int = SHOWN_USERS) -> DataFrame:
    """The last ``n`` distinct users of either role, newest first, with their rank from 1.

    Equal times are ordered by user. Times are reduced per user before the top-n, and the ranking
    window sees only those n rows.
    """
    last_seen = both_parties(tx, "ts").filter(F.col("user").isNotNull()).groupBy("user").agg(F.max("ts").alias("last_ts"))
    newest = last_seen.orderBy(F.desc_nulls_last("last_ts"), "user").limit(n)
    order = Window.orderBy(F.desc_nulls_last("last_ts"), "user")
    return newest.withColumn("rank", F.row_number().over(order).cast("bigint"))


def most_active(metrics: DataFrame, n: int = SHOWN_USERS) -> DataFrame:
    """Top ``n`` users by transactions sent in 3 hours; users without any are left out."""
    return metrics.dropna(subset=["count_sent_3h"]).orderBy(F.desc("count_sent_3h"), "user").limit(n)


def metrics_of_recent(metrics: DataFrame, tx: DataFrame, n: int = SHOWN_USERS) -> DataFrame:
    """Metric rows of the recently seen users, unordered."""
    return metrics.join(F.broadcast(recent_users(tx, n)), "user", "left_semi")


def recent_users_view(metrics: DataFrame, tx: DataFrame, n: int = SHOWN_USERS) -> DataFrame:
    """Metric rows of the recently seen users with their rank. At most ``n`` rows are broadcast."""
    return metrics.join(F.broadcast(recent_users(tx, n).select("user", "rank")), "user")


def dashboard_view(metrics: DataFrame, recent: DataFrame, n: int = SHOWN_USERS) -> DataFrame:
    """Rows the dashboard shows: the recent users', or the most active ones' while ``recent`` is empty."""
    fallback = most_active(metrics, n).filter(~recent.select("ts").exists())
    rank = F.row_number().over(Window.orderBy(F.desc("count_sent_3h"), "user")).cast("bigint")
    return recent_users_view(metrics, recent, n).unionByName(fallback.withColumn("rank", rank))


def top_displayed(view: DataFrame, n: int = TOP_SENDERS) -> DataFrame:
    """The shown users with most transactions sent in 3 hours (chart data)."""
    top = view.orderBy(F.desc_nulls_last("count_sent_3h"), "user").limit(n)
    return top.select("user", or_zero("count_sent_3h").alias("tx_sent_3h"), "anomaly")


def average_amounts(view: DataFrame) -> DataFrame:
    columns = [f"avg_amount_{role}_{span}" for span in SPANS for role in ROLES]
    return display_numbers(view.select("user", "bank", *columns, "anomaly"), {"user", "bank"})


def counts_and_network(view: DataFrame) -> DataFrame:
    columns = [f"{m}_{role}_{span}" for span in SPANS for m in ("count", "distinct") for role in ROLES]
    return display_numbers(view.select("user", "bank", *columns, "anomaly"), {"user", "bank"})


def lifetime(view: DataFrame) -> DataFrame:
    columns = [f"{m}_{role}" for m in ("total",) for role in ROLES]
    columns += [f"{m}_{role}_life" for m in ("count", "distinct") for role in ROLES]
    columns += [f"avg_{period}_sent" for period in ("hourly", "daily", "weekly", "monthly")]
    return display_numbers(view.select("user", "bank", *columns), {"user", "bank"})
