"""From decoded messages to ledger rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scalars import parse_event_time
from tallywatch.schema import TX_COLUMNS


def is_valid() -> Column:
    """A row needs a transaction id and an amount. Never NULL."""
    return F.col("tx_id").isNotNull() & F.col("amount").isNotNull()


def with_event_time(messages: DataFrame) -> DataFrame:
    """Adds ``ts`` and its day ``dt``; a date text that cannot be read leaves both NULL."""
    return messages.withColumn("ts", parse_event_time("date")).withColumn("dt", F.to_date("ts"))


def clean(messages: DataFrame) -> DataFrame:
    """Valid rows in ledger shape. Invalid ones are dropped; count them with :func:`is_valid`."""
    return with_event_time(messages.filter(is_valid())).select(*TX_COLUMNS, "dt")


def self_transfers(tx: DataFrame) -> DataFrame:
    """Rows whose sender is also the receiver: a producer must not emit them."""
    return tx.filter(F.col("send_id") == F.col("receive_id"))
