"""Running account balances, exact also when one user owns a large share of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallywatch.functions.scalars import exact_part, money, rest_part
from tallywatch.operators.edges import both_parties
from tallywatch.session import shared_dir

# Moves are applied in this order within a user.
MOVE_ORDER = ["ts", "tx_id", "role", "counterparty", "amount"]


def running_balance(tx: DataFrame, opening: DataFrame | None = None) -> DataFrame:
    """Every move of every account with the balance after it and whether it overdraws the account.

    ``opening``: optional (user, balance), one row per user; accounts start at 0 without it.
    Overdrafts are flagged, not refused. Range partitioning is made durable while the plan is built.
    """
    sign = F.when(F.col("role") == "sent", -1).otherwise(1)
    moves = (
        both_parties(tx, "tx_id", "ts", "amount")
        .filter(F.col("user").isNotNull())
        .withColumn("change", sign * F.col("amount"))
    )
    moves = moves.withColumns({"exact": exact_part("change"), "rest": rest_part("change")}).drop("change")
    balances = _running_change(moves)
    after = money(F.col("exact"), F.col("rest"))
    if opening is not None:
        start = opening.select("user", exact_part("balance").alias("exact_0"), rest_part("balance").alias("rest_0"))
        balances = balances.join(start, "user", "left")
        after = money(
            F.col("exact") + F.coalesce("exact_0", F.lit(0)), F.col("rest") + F.coalesce("rest_0", F.lit(0.0))
        )
    balances = balances.withColumn("balance", after)
    return balances.select(
        "user", "role", "counterparty", "tx_id", "ts", "amount", "balance",
        ((F.col("role") == "sent") & (F.col("balance") < 0)).alias("overdraft"),
    )


def overdrafts(balances: DataFrame) -> DataFrame:
    """Payments the sender's balance did not cover."""
    return balances.filter("overdraft")


def _running_change(moves: DataFrame) -> DataFrame:
    """Prefix sum in two levels: ranges of moves, then the moves inside each range.

    Range partitioning cuts a big user between rows. The checkpoint fixes which row went to which
    range before range totals and rows are joined, also if an executor is lost in between.
    """
    shared_dir(moves.sparkSession)
    ranges = (
        moves.repartitionByRange("user", *MOVE_ORDER)
        .withColumn("range_no", F.spark_partition_id())
        .checkpoint()
    )
    earlier = Window.partitionBy("user").orderBy("range_no").rowsBetween(Window.unboundedPreceding, -1)
    upto_here = (
        Window.partitionBy("user", "range_no").orderBy(*MOVE_ORDER).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    carried = ranges.groupBy("user", "range_no").agg(F.sum("exact").alias("exact"), F.sum("rest").alias("rest")).select(
        "user", "range_no",
        F.coalesce(F.sum("exact").over(earlier), F.lit(0)).alias("exact_before"),
        F.coalesce(F.sum("rest").over(earlier), F.lit(0.0)).alias("rest_before"),
    )
    # A row without an exact part adds nothing to the exact sum.
    return ranges.join(carried, ["user", "range_no"]).withColumns({
        "exact": F.coalesce(F.sum("exact").over(upto_here), F.lit(0)) + F.col("exact_before"),
        "rest": F.coalesce(F.sum("rest").over(upto_here), F.lit(0.0)) + F.col("rest_before"),
    }).drop("range_no", "exact_before", "rest_before")
