"""The streaming monitor: messages in; ledger, metric table and recent transactions out."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tallywatch.functions.scalars import before, parse_event_time, utc
from tallywatch.operators.clean import clean, is_valid
from tallywatch.operators.dedup import dedup_tx, seen_ids, without
from tallywatch.plans.activity import recent_tx
from tallywatch.plans.metrics import user_metrics
from tallywatch.schema import MonitorConfig
from tallywatch.sources import folding, id_index, ledger, snapshots, storage
from tallywatch.sources.messages import decode, read_kafka_stream
from tallywatch.streaming import state
from tallywatch.streaming.progress import Progress

LOG = "v bigint, batch_rows bigint, rejected_rows bigint, late_rows bigint, tracked_users bigint"


def kafka_messages(spark: SparkSession, config: MonitorConfig) -> DataFrame:
    return read_kafka_stream(
        spark, config.bootstrap, config.topic, starting_offsets=config.starting_offsets,
        max_per_trigger=config.max_per_trigger, fail_on_data_loss=config.fail_on_data_loss,
    )


def start_monitor(
    spark: SparkSession, messages: DataFrame, config: MonitorConfig, *, available_now: bool = False
) -> StreamingQuery:
    """Run the monitor on a stream with a ``value`` column.

    ``available_now`` drains what is there and stops; otherwise a batch starts every ``config.trigger``.
    """
    if storage.exists(spark, config.ledger) and not storage.exists(spark, config.checkpoint):
        raise RuntimeError("ledger without its checkpoint: batch ids would start over and replace ledger batches")
    trigger = {"availableNow": True} if available_now else {"processingTime": config.trigger}
    return (
        messages.writeStream.foreachBatch(lambda batch, batch_id: process_batch(spark, config, batch, batch_id))
        .option("checkpointLocation", config.checkpoint)
        .trigger(**trigger)
        .start()
    )


def _counts(as_of: datetime, late_after_seconds: int) -> list[Column]:
    late = parse_event_time("date") < before(F.lit(utc(as_of)), late_after_seconds)
    return [
        F.count(F.lit(1)).alias("batch_rows"),
        F.count(F.when(~is_valid(), 1)).alias("rejected_rows"),
        F.count(F.when(is_valid() & late, 1)).alias("late_rows"),
    ]


def observed(decoded: DataFrame, watch: Observation, as_of: datetime, late_after_seconds: int) -> DataFrame:
    """Count rows, rejected rows and late rows of whatever action reads the result; no job of its own."""
    return decoded.observe(watch, *_counts(as_of, late_after_seconds))


def process_batch(spark: SparkSession, config: MonitorConfig, batch: DataFrame, batch_id: int) -> None:
    """One micro-batch. Running it again with the same id leaves every table as it was.

    A batch that failed goes on behind the writes that it had finished. What depends on the clock is made anew if
    that has moved.
    """
    decoded = decode(batch).persist()
    try:
        if decoded.isEmpty():
            return
        as_of = utc(config.clock() if config.clock else datetime.now(timezone.utc))
        moment = as_of.isoformat()
        progress = Progress(spark, config.progress, batch_id, {"incremental": config.incremental, "dedup": config.dedup}, config.after_write)

        def write_ledger() -> dict:
            watch = Observation("batch")
            incoming = clean(observed(decoded, watch, as_of, config.late_after_seconds))
            if config.dedup:
                repeats = _repeats(spark, config, clean(decoded), batch_id)
                incoming = dedup_tx(incoming)
                incoming = incoming if repeats is None else without(incoming, repeats)
            ledger.append(incoming, config.ledger, batch_id)
            return {"as_of": moment, "late_after": config.late_after_seconds, **watch.get}

        counts = progress.once("ledger", ledger.entry_path(config.ledger, batch_id), write_ledger)
        if (counts["as_of"], counts["late_after"]) != (moment, config.late_after_seconds):
            counts = decoded.agg(*_counts(as_of, config.late_after_seconds)).first().asDict()

        def write_state() -> None:
            added = clean(decoded)
            if config.dedup or progress.resumed:
                added = ledger.scan(spark, config.ledger, up_to_batch=batch_id).filter(F.col("batch_id") == batch_id)
            state.add_batch(added, config, batch_id)

        if config.incremental:
            progress.once("state", state.entry_path(config, batch_id), write_state)

        def write_metrics() -> dict:
            if config.incremental:
                metrics = state.metrics(spark, config, batch_id, as_of)
            else:
                metrics = user_metrics(ledger.scan(spark, config.ledger, up_to_batch=batch_id), as_of)
            users = Observation("users")
            metrics = metrics.observe(users, F.count(F.lit(1)).alias("tracked_users"))
            snapshots.publish(metrics, config.user_metrics, batch_id, config.output_files)
            return users.get

        made = {"as_of": moment, "files": config.output_files}
        users = progress.once("user_metrics", snapshots.version_path(config.user_metrics, batch_id), write_metrics, **made)

        def write_recent() -> None:
            snapshots.publish(_recent(spark, config, batch_id, as_of), config.recent_tx, batch_id, config.output_files)

        progress.once("recent_tx", snapshots.version_path(config.recent_tx, batch_id), write_recent, recent=config.recent_seconds, **made)

        def write_log() -> None:
            said = {"v": batch_id, **{n: counts[n] for n in ("batch_rows", "rejected_rows", "late_rows")}, **users}
            log = spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in said.items()])
            folding.add(log, config.batch_log, batch_id)

        progress.once("batch_log", folding.delta_path(config.batch_log, batch_id), write_log, late_after=config.late_after_seconds, **made)
        progress.forget_older()
        _tidy(spark, config, batch_id, as_of)
    finally:
        decoded.unpersist()


def _tidy(spark: SparkSession, config: MonitorConfig, batch_id: int, as_of: datetime) -> None:
    """Fold what earlier batches left in small files, and drop what no reader needs. Nothing here changes what readers see."""
    if config.incremental:
        state.compact(spark, config, batch_id, as_of)
    ledger.compact(spark, config.ledger, batch_id, every=config.compact_every)
    if config.dedup:
        id_index.compact(spark, config.ids, batch_id, every=config.compact_every)
    recent_log = F.col("v") > batch_id - config.keep_log
    folding.fold(spark, config.batch_log, LOG, batch_id, lambda rows: rows.filter(recent_log), config.compact_every)
    for root in (config.user_metrics, config.recent_tx):
        snapshots.expire(spark, root, config.keep_versions)


def _repeats(spark: SparkSession, config: MonitorConfig, tx: DataFrame, batch_id: int) -> DataFrame | None:
    """The batch's ids that an earlier batch delivered, under whatever day.

    The id index first takes in what finished batches have put into the ledger since. Looking only at earlier batches keeps a
    replay of this batch stable.
    """
    if not storage.exists(spark, config.ledger):
        return None
    indexed = id_index.last_batch(spark, config.ids)
    id_index.add(ledger.scan(spark, config.ledger, after_batch=indexed, up_to_batch=batch_id - 1), config.ids, batch_id - 1)
    return seen_ids(tx, id_index.candidates(tx, config.ids))


def _recent(spark: SparkSession, config: MonitorConfig, batch_id: int, as_of: datetime) -> DataFrame:
    rows = ledger.scan(spark, config.ledger, since=as_of - timedelta(seconds=config.recent_seconds), up_to_batch=batch_id)
    return recent_tx(rows, as_of, config.recent_seconds)


def read_batch_log(spark: SparkSession, config: MonitorConfig) -> DataFrame:
    """One row per finished batch, of the newest ``keep_log`` at least: ``v`` is the batch id.

    The row is the last thing that a batch publishes, so a batch is finished for all its tables or for none.
    """
    return folding.read(spark, config.batch_log, LOG)


def finished_batch(spark: SparkSession, config: MonitorConfig) -> int | None:
    """The newest batch of which everything is published."""
    return read_batch_log(spark, config).agg(F.max("v")).first()[0]


def published(spark: SparkSession, config: MonitorConfig) -> tuple[DataFrame, DataFrame] | None:
    """The metric table and the recent transactions of one and the same batch, the newest that is finished."""
    version = finished_batch(spark, config)
    if version is None:
        return None
    return tuple(spark.read.parquet(snapshots.version_path(root, version)) for root in (config.user_metrics, config.recent_tx))
