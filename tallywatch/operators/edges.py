"""Two views of a transaction table: legs (one row per party) and edges (one row per pair)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scalars import before, exact_part, money, rest_part
from tallywatch.schema import TRAILING_WINDOWS


def both_parties(df: DataFrame, *keep: str, sides: bool = False) -> DataFrame:
    """Each row twice: as the sender's (``sent``) and as the receiver's (``recv``), in one scan.

    ``sides`` also carries the party's own bank.
    """

    def party(role: str, own: str, other: str) -> Column:
        fields = [
            F.lit(role).alias("role"),
            F.col(f"{own}_id").alias("user"),
            F.col(f"{other}_id").alias("counterparty"),
        ]
        if sides:
            fields.append(F.col(f"{own}_entity").alias("bank"))
        return F.struct(*fields)

    parties = F.array(party("sent", "send", "receive"), party("recv", "receive", "send"))
    return df.select(F.explode(parties).alias("p"), *keep).select("p.*", *keep)


def legs(tx: DataFrame) -> DataFrame:
    """(role, user, counterparty, amount, ts): the ledger seen from each party."""
    return both_parties(tx, "amount", "ts")


def edge_totals(tx: DataFrame, as_of: Column | None = None) -> DataFrame:
    """One row per (sender, receiver): count, money, first and last time, optionally per window.

    A pair's sent and received side are the same rows, so one shuffle of pair totals serves both
    roles. All buffers are fixed-width numbers, which keeps this a hash aggregate with map-side
    combine: a pair that holds most of the rows is folded before the shuffle.
    """
    exact, rest = F.col("exact"), F.col("rest")
    totals = [
        F.count("*").alias("n_life"),
        F.sum(exact).alias("exact_life"),
        F.sum(rest).alias("rest_life"),
        F.min("ts").alias("first_ts"),
        F.max("ts").alias("last_ts"),
    ]
    if as_of is not None:
        for label, seconds in TRAILING_WINDOWS.items():
            inside = F.col("ts") >= before(as_of, seconds)
            totals.append(F.count(F.when(inside, 1)).alias(f"n_{label}"))
            totals.append(F.sum(F.when(inside, exact)).alias(f"exact_{label}"))
            totals.append(F.sum(F.when(inside, rest)).alias(f"rest_{label}"))
    parts = tx.select("send_id", "receive_id", "ts", exact_part("amount").alias("exact"), rest_part("amount").alias("rest"))
    return parts.groupBy("send_id", "receive_id").agg(*totals)


def pair_edges(tx: DataFrame) -> DataFrame:
    """Per user, role and counterparty: count, total amount, first and last time."""
    edges = both_parties(edge_totals(tx), "n_life", "exact_life", "rest_life", "first_ts", "last_ts")
    return edges.filter(F.col("user").isNotNull()).select(
        "user",
        "role",
        "counterparty",
        F.col("n_life").alias("tx_count"),
        money(F.col("exact_life"), F.col("rest_life")).alias("total"),
        "first_ts",
        "last_ts",
    )
