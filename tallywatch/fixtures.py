"""Transaction tables derived from the given parquet tables; inputs of the registered queries."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.scalars import instant, round2, user_id
from tallywatch.schema import APP_TYPES, BANKS
from tallywatch.session import pin_session
from tallywatch.sources.messages import encode

# Sender, history (rows, receivers, amount), burst (rows, receivers, amount).
BURST_PROFILES = [
    (9000001, 80, 5, 10.0, 5, 5, 12.0),
    (9000002, 40, 5, 10.0, 8, 8, 100.0),
    (9000003, 40, 40, 10.0, 4, 4, 100.0),
    (9000004, 40, 40, 10.0, 12, 1, 20.0),
    (9000005, 40, 40, 10.0, 12, 12, 5.0),
    (9000006, 40, 5, 0.004, 5, 5, 2e13),
    (9000007, 1, 1, 9.9e12, 10000, 1, 9.9e12),
]
BAD_LINES = [
    '{bad',
    '{"send_id":"user_0000001","receive_id":"user_0000002","amount":1.0,"date":"2024-01-15T00:00:00Z"}',
    '{"send_id":"user_0000001","receive_id":"user_0000002","date":"2024-01-15T00:00:00Z","tx_id":"bad-amount"}',
    '{"send_id":"user_0000001","receive_id":"user_0000002","amount":"2.5","date":"2024-01-15T00:00:00Z","tx_id":"bad-quoted"}',
]
ODD_LINES = [
    '{"send_id":"user_0000001","receive_id":"user_0000002","amount":3.25,"date":"nope","tx_id":"odd-date"}',
    '{"send_id":"user_0000001","receive_id":"user_0000002","amount":4.5,"tx_id":"no-date"}',
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return pin_session(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index % len(values) + 1).cast("int"))


def tx_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as transactions: the event's user pays the user named in ``props``."""
    receiver = F.get_json_object("props", "$.k").cast("bigint")
    return _table(spark, sf_dir, "events").select(
        _pick(BANKS, F.col("user_id")).alias("msg_entity"),
        _pick(APP_TYPES, F.col("event_id")).alias("app_type"),
        _pick(BANKS, F.col("user_id")).alias("send_entity"),
        _pick(BANKS, receiver).alias("receive_entity"),
        user_id("user_id").alias("send_id"),
        user_id(receiver).alias("receive_id"),
        F.col("value").alias("amount"),
        F.date_trunc("second", F.col("ts").cast("timestamp")).alias("ts"),
        F.col("event_type").alias("tx_type"),
        F.col("event_id").cast("string").alias("tx_id"),
    )


def tx_burst(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``tx_events`` plus senders whose last three hours exercise each rule, and very small and large amounts."""
    base = tx_events(spark, sf_dir)
    profiles = spark.createDataFrame(
        BURST_PROFILES, "sender bigint, hn int, hfan int, ha double, bn int, bfan int, ba double"
    )

    def rows(kind: str, count: str, fan: str, amount: str, age: Column) -> DataFrame:
        steps = profiles.select("sender", fan, amount, F.explode(F.sequence(F.lit(0), F.col(count) - 1)).alias("i"))
        receiver = F.col("i") % F.col(fan)
        sender_bank = _pick(BANKS, F.col("sender"))
        return steps.select(
            sender_bank.alias("msg_entity"),
            F.lit("mobile_app").alias("app_type"),
            sender_bank.alias("send_entity"),
            _pick(BANKS, receiver).alias("receive_entity"),
            user_id("sender").alias("send_id"),
            user_id(receiver).alias("receive_id"),
            F.col(amount).alias("amount"),
            (instant(None, base) - F.make_dt_interval(secs=age)).alias("ts"),
            F.lit("transfer").alias("tx_type"),
            F.concat_ws("-", F.lit(kind), user_id("sender"), "i").alias("tx_id"),
        )

    history = rows("h", "hn", "hfan", "ha", F.lit(14_400) + F.col("i") * 5_400)
    burst = rows("b", "bn", "bfan", "ba", F.col("i") * 30)
    return base.unionByName(history).unionByName(burst)


def tx_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``lineitem`` as payments from customers to suppliers; some ids occur more than once."""
    items = _table(spark, sf_dir, "lineitem").join(
        _table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    return items.select(
        _pick(BANKS, F.col("o_custkey")).alias("msg_entity"),
        F.col("o_orderpriority").alias("app_type"),
        _pick(BANKS, F.col("o_custkey")).alias("send_entity"),
        _pick(BANKS, F.col("l_suppkey")).alias("receive_entity"),
        F.concat(F.lit("cust_"), F.col("o_custkey").cast("string")).alias("send_id"),
        F.concat(F.lit("supp_"), F.col("l_suppkey").cast("string")).alias("receive_id"),
        round2(F.col("l_extendedprice") * (F.lit(1) - F.col("l_discount"))).alias("amount"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
        F.col("l_returnflag").alias("tx_type"),
        F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("tx_id"),
    )


def message_lines(tx: DataFrame, bad_lines: bool = True) -> DataFrame:
    """``tx`` as JSON messages, with a few broken and odd ones unless ``bad_lines`` is off."""
    lines = encode(tx)
    if not bad_lines:
        return lines
    extra = tx.sparkSession.createDataFrame([(line,) for line in BAD_LINES + ODD_LINES], "value string")
    return lines.unionByName(extra)


def newest(tx: DataFrame) -> datetime:
    """Largest event time, as a UTC datetime on the driver (streaming runs need a fixed moment)."""
    micros = tx.agg(F.unix_micros(F.max("ts")).alias("t")).first()["t"]
    return datetime(1970, 1, 1, tzinfo=timezone.utc) + timedelta(microseconds=micros)
