"""Mergeable per-batch state, so that a batch costs its own rows plus the state, not the whole ledger.

Three tables, each a base version plus one small delta per batch since:

* ``days``: (user, role, day) -> count, money, first time, and how many counterparties were last seen
  on that day. Sums over whole days give every metric, except for the one day a window starts in.
  Days before the longest window are folded into one row per user and role.
* ``pairs``: (sender, receiver) -> last time. Tells a batch which of its pairs are new or move to a
  later day; partitioned by day, so that the pairs of a window's first day are read alone.
* ``banks``: user -> bank.

A batch's deltas depend only on its rows and on older state, so a replay rewrites the same deltas.
Late rows need no care. Repeated deliveries must be removed before they get here.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallywatch.functions.scalars import exact_part, rest_part, utc
from tallywatch.operators.edges import both_parties
from tallywatch.plans.metrics import assemble, per_user, user_bank, user_metrics
from tallywatch.schema import TRAILING_WINDOWS, MonitorConfig
from tallywatch.sources import ledger, snapshots, storage

DAYS = "role string, user string, day date, n bigint, exact decimal(38,9), rest double, first_ts timestamp, pairs bigint"
PAIRS = "send_id string, receive_id string, last_ts timestamp"
PAIR_DELTA = PAIRS + ", prev_ts timestamp, is_new boolean"
PAIR_BASE = PAIRS + ", last_day date"
BANKS = "user string, bank string"
SCHEMAS = {"days": DAYS, "banks": BANKS}
TABLES = ("days", "pairs", "banks")

PAIR_KEYS = ["send_id", "receive_id"]
FOLDED = date(1900, 1, 1)


def _base(config: MonitorConfig, table: str) -> str:
    return f"{config.state}/{table}/base"


def _delta(config: MonitorConfig, table: str) -> str:
    return f"{config.state}/{table}/delta"


def _paths(
    spark: SparkSession, config: MonitorConfig, table: str, batch_id: int, own: bool = True
) -> tuple[list[str], list[str]]:
    """The newest base older than this batch, and every delta after it up to this batch.

    ``own=False`` leaves this batch's own delta out. A base written by this very batch is not used:
    on a replay it is rebuilt, not trusted.
    """
    base = snapshots.latest_version(spark, _base(config, table), below=batch_id)
    last = batch_id if own else batch_id - 1
    deltas = [
        v for v in snapshots.committed_versions(spark, _delta(config, table))
        if v <= last and (base is None or v > base)
    ]
    bases = [] if base is None else [snapshots.version_path(_base(config, table), base)]
    return bases, [snapshots.version_path(_delta(config, table), v) for v in deltas]


def _folds(config: MonitorConfig) -> str:
    return f"{config.state}/folds"


def _folded_before(spark: SparkSession, config: MonitorConfig, batch_id: int) -> date | None:
    """The first day that the base of this batch still holds apart."""
    base = snapshots.latest_version(spark, _base(config, "days"), below=batch_id)
    return None if base is None else spark.read.parquet(snapshots.version_path(_folds(config), base)).first()["day"]


def _read(spark: SparkSession, schema: str, paths: list[str]) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def _rows(spark: SparkSession, config: MonitorConfig, table: str, batch_id: int, own: bool = True) -> DataFrame:
    bases, deltas = _paths(spark, config, table, batch_id, own)
    if table == "pairs":
        return _read(spark, PAIR_BASE, bases).drop("last_day").unionByName(_read(spark, PAIRS, deltas))
    return _read(spark, SCHEMAS[table], bases + deltas)


# ---- adding a batch -------------------------------------------------------------------------


def add_batch(tx: DataFrame, config: MonitorConfig, batch_id: int) -> None:
    """Write this batch's deltas."""
    spark = tx.sparkSession
    pairs = snapshots.publish(_pair_delta(spark, config, tx, batch_id), _delta(config, "pairs"), batch_id)
    days = _day_delta(tx, _read(spark, PAIR_DELTA, [pairs]))
    snapshots.publish(days, _delta(config, "days"), batch_id)
    snapshots.publish(user_bank(tx), _delta(config, "banks"), batch_id)


def entry_path(config: MonitorConfig, batch_id: int) -> str:
    """The delta that a batch writes last."""
    return snapshots.version_path(_delta(config, "banks"), batch_id)


def _pair_delta(spark: SparkSession, config: MonitorConfig, tx: DataFrame, batch_id: int) -> DataFrame:
    """The batch's pairs with their last time, now and before this batch.

    Only these pairs are looked up. While Spark finds them small enough to broadcast, the big table
    is scanned without being shuffled.
    """
    both_known = F.col("send_id").isNotNull() & F.col("receive_id").isNotNull()
    seen = tx.filter(both_known).groupBy(*PAIR_KEYS).agg(F.max("ts").alias("seen_ts"))
    older = _rows(spark, config, "pairs", batch_id, own=False)
    before = older.join(seen.select(*PAIR_KEYS), PAIR_KEYS).groupBy(*PAIR_KEYS).agg(
        F.max("last_ts").alias("prev_ts"), F.lit(False).alias("is_new")
    )
    return seen.join(before, PAIR_KEYS, "left").select(
        *PAIR_KEYS,
        F.greatest("seen_ts", "prev_ts").alias("last_ts"),
        "prev_ts",
        F.coalesce("is_new", F.lit(True)).alias("is_new"),
    )


def _day_delta(tx: DataFrame, pairs: DataFrame) -> DataFrame:
    """The batch's rows by day; a pair seen on a later day than before moves there."""
    legs = both_parties(tx, "amount", "ts").filter("user is not null")
    activity = legs.groupBy("role", "user", F.to_date("ts").alias("day")).agg(
        F.count("*").alias("n"), F.sum(exact_part("amount")).alias("exact"),
        F.sum(rest_part("amount")).alias("rest"), F.min("ts").alias("first_ts")
    )
    now_on = F.struct(F.to_date("last_ts").alias("day"), F.lit(1).cast("bigint").alias("pairs"))
    no_longer_on = F.struct(F.to_date("prev_ts").alias("day"), F.lit(-1).cast("bigint").alias("pairs"))
    moves = F.when(F.col("is_new"), F.array(now_on)).otherwise(F.array(now_on, no_longer_on))
    moved = pairs.filter(F.col("is_new") | ~F.to_date("last_ts").eqNullSafe(F.to_date("prev_ts")))
    counterparties = (
        both_parties(moved.withColumn("moves", moves), "moves")
        .select("role", "user", F.inline("moves"))
        .groupBy("role", "user", "day").agg(F.sum("pairs").alias("pairs"))
    )
    return _merge_days(activity.unionByName(counterparties, allowMissingColumns=True))


# ---- merging --------------------------------------------------------------------------------


def _merge_days(rows: DataFrame) -> DataFrame:
    return rows.groupBy("role", "user", "day").agg(
        F.sum("n").alias("n"), F.sum("exact").alias("exact"), F.sum("rest").alias("rest"),
        F.min("first_ts").alias("first_ts"), F.sum("pairs").alias("pairs")
    )


def _merge_pairs(rows: DataFrame) -> DataFrame:
    return rows.groupBy(*PAIR_KEYS).agg(F.max("last_ts").alias("last_ts"))


def _merge_banks(rows: DataFrame) -> DataFrame:
    return rows.groupBy("user").agg(F.min("bank").alias("bank"))


def compact(spark: SparkSession, config: MonitorConfig, batch_id: int, as_of: datetime) -> None:
    """Fold base and deltas into a new base once enough deltas have gathered.

    The previous base and the deltas after it stay, so this batch can still be replayed.
    """
    # One day of slack: a clock that steps back a little needs no recomputation. Folds are never undone.
    oldest_day = max((_oldest_start(as_of) - timedelta(days=1)).date(), _folded_before(spark, config, batch_id) or FOLDED)
    for table in TABLES:
        if len(_paths(spark, config, table, batch_id)[1]) < config.compact_every:
            continue
        rows = _rows(spark, config, table, batch_id)
        target = snapshots.version_path(_base(config, table), batch_id)
        if table == "pairs":
            by_day = _merge_pairs(rows).withColumn("last_day", F.to_date("last_ts")).hint("rebalance", "last_day")
            by_day.write.mode("overwrite").partitionBy("last_day").parquet(target)
        elif table == "days":
            snapshots.publish(spark.createDataFrame([(oldest_day,)], "day date"), _folds(config), batch_id, files=1)
            snapshots.expire(spark, _folds(config), keep=3)
            folded = F.when(F.col("day") < F.lit(oldest_day), F.lit(FOLDED)).otherwise(F.col("day"))
            _merge_days(rows.withColumn("day", folded)).write.mode("overwrite").parquet(target)
        else:
            _merge_banks(rows).write.mode("overwrite").parquet(target)
        snapshots.expire(spark, _base(config, table), keep=2)
        replay_floor = snapshots.committed_versions(spark, _base(config, table))[0]
        if replay_floor < batch_id:
            for v in snapshots.committed_versions(spark, _delta(config, table)):
                if v <= replay_floor:
                    storage.delete_tree(spark, snapshots.version_path(_delta(config, table), v))


# ---- reading metrics ------------------------------------------------------------------------


def _starts(as_of: datetime) -> dict[str, datetime]:
    return {label: utc(as_of) - timedelta(seconds=seconds) for label, seconds in TRAILING_WINDOWS.items()}


def _oldest_start(as_of: datetime) -> datetime:
    return min(_starts(as_of).values())


def _next_midnight(moment: datetime) -> datetime:
    return moment.replace(hour=0, minute=0, second=0, microsecond=0) + timedelta(days=1)


def metrics(spark: SparkSession, config: MonitorConfig, batch_id: int, as_of: datetime) -> DataFrame:
    """The 45-column metric table from state; equals a recomputation from the ledger.

    When the clock stepped back before days that are folded already, the ledger is read instead.
    """
    now = F.lit(utc(as_of))
    starts = _starts(as_of)
    first_days = {s.date() for s in starts.values()}
    folded = _folded_before(spark, config, batch_id)
    if folded is not None and min(first_days) < folded:
        return user_metrics(ledger.scan(spark, config.ledger, up_to_batch=batch_id), as_of)

    def in_windows(inside: Callable[[str], Column], **values: Column) -> list[Column]:
        return [F.when(inside(w), value).alias(f"{name}_{w}") for w in TRAILING_WINDOWS for name, value in values.items()]

    def on_first_day(ts: str) -> Callable[[str], Column]:
        return lambda w: (F.col(ts) >= F.lit(starts[w])) & (F.col(ts) < F.lit(_next_midnight(starts[w])))

    def on_any_first_day(ts: str) -> Column:
        inside = on_first_day(ts)
        any_day = F.lit(False)
        for w in TRAILING_WINDOWS:
            any_day = any_day | inside(w)
        return any_day

    one = F.lit(1).cast("bigint")
    days = _rows(spark, config, "days", batch_id)
    whole_days = days.select(
        "role", "user", "first_ts",
        F.col("n").alias("n_life"), F.col("exact").alias("exact_life"), F.col("rest").alias("rest_life"), F.col("pairs").alias("known_life"),
        *in_windows(
            lambda w: F.col("day") > F.lit(starts[w].date()),
            n=F.col("n"), exact=F.col("exact"), rest=F.col("rest"), known=F.col("pairs"),
        ),
    )

    first_rows = ledger.scan_days(spark, config.ledger, first_days, batch_id)
    part_days = both_parties(first_rows.filter(on_any_first_day("ts")), "amount", "ts").select(
        "role", "user", *in_windows(on_first_day("ts"), n=one, exact=exact_part("amount"), rest=rest_part("amount"))
    )

    bases, deltas = _paths(spark, config, "pairs", batch_id)
    old_pairs = _read(spark, PAIR_BASE, bases).filter(F.col("last_day").isin(sorted(first_days))).drop("last_day")
    last_seen = _merge_pairs(old_pairs.unionByName(_read(spark, PAIRS, deltas)))
    part_pairs = both_parties(last_seen.filter(on_any_first_day("last_ts")), "last_ts").select(
        "role", "user", *in_windows(on_first_day("last_ts"), known=one)
    )

    rows = whole_days.unionByName(part_days, allowMissingColumns=True).unionByName(part_pairs, allowMissingColumns=True)
    banks = _merge_banks(_rows(spark, config, "banks", batch_id))
    return assemble(per_user(rows).join(banks, "user", "left"), now)
