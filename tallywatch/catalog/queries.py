"""Registered queries: (spark, folder of the given tables) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallywatch import fixtures
from tallywatch.functions import scalars
from tallywatch.operators import balance, clean, dedup, edges
from tallywatch.plans import activity, metrics, rules, views
from tallywatch.schema import PERIOD_HOURS, ROLES, TX_COLUMNS, MonitorConfig
from tallywatch.session import scratch_path
from tallywatch.sources import ledger, messages, snapshots, storage
from tallywatch.streaming import live, monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

MICRO_BATCHES = 2
LATE_AFTER_SECONDS = 7 * 86_400


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def plain(df: DataFrame) -> DataFrame:
    """Timestamps without zone, the type the comparison engine has."""
    zoned = [name for name, kind in df.dtypes if kind == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _burst_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.user_metrics(fixtures.tx_burst(spark, sf_dir))


def _flagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.with_anomalies(_burst_metrics(spark, sf_dir))


def _view(spark: SparkSession, sf_dir: str) -> DataFrame:
    recent = activity.recent_tx(fixtures.tx_burst(spark, sf_dir))
    return views.dashboard_view(_flagged(spark, sf_dir), recent)


def _files(spark: SparkSession) -> int:
    return max(2 * MICRO_BATCHES, spark.sparkContext.defaultParallelism)


def _feed(lines: DataFrame, folder: str) -> int:
    """Write messages as text files; returns the file limit that gives ``MICRO_BATCHES`` batches."""
    files = _files(lines.sparkSession)
    lines.repartition(files, F.xxhash64("value")).write.mode("append").text(folder)
    return -(-files // MICRO_BATCHES)


def _run_monitor(spark: SparkSession, lines: DataFrame, now, **options) -> MonitorConfig:
    config = MonitorConfig(data_dir=scratch_path(spark, "monitor"), clock=lambda: now, **options)
    per_batch = _feed(lines, f"{config.data_dir}/in")
    stream = messages.read_line_stream(spark, f"{config.data_dir}/in", per_batch)
    monitor.start_monitor(spark, stream, config, available_now=True).awaitTermination()
    return config


# ---- sources and sinks ----------------------------------------------------------------------


@query
def src_stream_lines(spark, sf_dir):
    root = scratch_path(spark, "lines")
    _feed(fixtures.message_lines(fixtures.tx_events(spark, sf_dir), bad_lines=False), f"{root}/in")
    stream = messages.read_transaction_stream(spark, "json-lines", f"{root}/in")
    live.write_table(stream, f"{root}/out", f"{root}/check", available_now=True).awaitTermination()
    return spark.read.parquet(f"{root}/out")


@query
def src_rate_limited(spark, sf_dir):
    root = scratch_path(spark, "limited")
    per_batch = _feed(fixtures.message_lines(fixtures.tx_events(spark, sf_dir), bad_lines=False), f"{root}/in")
    stream = messages.read_transaction_stream(spark, "json-lines", f"{root}/in", max_per_trigger=per_batch)
    run = (
        stream.writeStream.foreachBatch(lambda rows, i: ledger.append(clean.clean(rows), f"{root}/ledger", i))
        .option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return ledger.scan(spark, f"{root}/ledger").agg(
        F.count("*").alias("tx_rows"), F.count_distinct("batch_id").alias("micro_batches")
    )


@query
def src_data_loss(spark, sf_dir):
    """A batch fails, and before it runs again the files with the newest week are gone: without ``fail_on_data_loss`` the rest is read."""
    tx = fixtures.tx_events(spark, sf_dir)
    root = scratch_path(spark, "loss")
    recent = F.col("ts") >= scalars.before(F.lit(fixtures.newest(tx)), 604_800)
    for name, part in (("old", tx.filter(~recent)), ("new", tx.filter(recent))):
        _feed(fixtures.message_lines(part, bad_lines=False), f"{root}/in/{name}")

    def run(work) -> None:
        stream = messages.read_transaction_stream(spark, "json-lines", f"{root}/in/*", fail_on_data_loss=False)
        stream.writeStream.foreachBatch(work).option("checkpointLocation", f"{root}/check").trigger(availableNow=True).start().awaitTermination()

    def fail(rows: DataFrame, batch_id: int) -> None:
        raise RuntimeError("planned failure before the first write")

    try:
        run(fail)
    except StreamingQueryException as error:
        if "planned failure" not in str(error):
            raise
    storage.delete_tree(spark, f"{root}/in/new")
    run(lambda rows, batch_id: ledger.append(clean.clean(rows), f"{root}/ledger", batch_id))
    return ledger.scan(spark, f"{root}/ledger").groupBy("dt").agg(F.count("*").alias("tx_rows"))


@query
def decode_json(spark, sf_dir):
    return messages.decode(fixtures.message_lines(fixtures.tx_burst(spark, sf_dir)))


@query
def encode_json(spark, sf_dir):
    sent = messages.encode(fixtures.tx_burst(spark, sf_dir))
    return plain(clean.clean(messages.decode(sent)))


@query
def ledger_scan(spark, sf_dir):
    path = scratch_path(spark, "ledger")
    tx = fixtures.tx_burst(spark, sf_dir)
    ledger.append(tx.withColumn("dt", F.to_date("ts")), path, 0)
    start = scalars.before(ledger.newest(spark, path), 604_800)
    return plain(ledger.scan(spark, path, since=start).drop("batch_id"))


@query
def ledger_append_idempotent(spark, sf_dir):
    """Each batch written twice, and the batches before it compacted in between."""
    path = scratch_path(spark, "ledger")
    for batch_id, tx in ((0, fixtures.tx_events), (1, fixtures.tx_burst)):
        for _ in range(2):
            ledger.append(tx(spark, sf_dir).withColumn("dt", F.to_date("ts")), path, batch_id)
            ledger.compact(spark, path, batch_id, fan_in=1)
    ledger.compact(spark, path, 2, fan_in=2)
    return ledger.scan(spark, path).groupBy("dt", "batch_id").agg(F.count("*").alias("tx_rows"))


@query
def snapshot_latest(spark, sf_dir):
    root = scratch_path(spark, "banks")
    snapshots.publish(metrics.user_bank(fixtures.tx_events(spark, sf_dir)), root, 0)
    snapshots.publish(metrics.user_bank(fixtures.tx_burst(spark, sf_dir)), root, 1)
    return snapshots.read_latest(spark, root)


@query
def publish_user_metrics(spark, sf_dir):
    root = scratch_path(spark, "metrics")
    snapshots.publish(_burst_metrics(spark, sf_dir), root, 0)
    return plain(snapshots.read_latest(spark, root))


@query
def recent_tx(spark, sf_dir):
    return plain(activity.recent_tx(fixtures.tx_burst(spark, sf_dir)))


@query
def batch_observed_counts(spark, sf_dir):
    tx = fixtures.tx_burst(spark, sf_dir)
    watch = Observation("batch")
    decoded = messages.decode(fixtures.message_lines(tx))
    rows = monitor.observed(decoded, watch, fixtures.newest(tx), LATE_AFTER_SECONDS)
    ledger.append(clean.clean(rows), scratch_path(spark, "ledger"), 0)
    return spark.range(1).select(*[F.lit(n).cast("bigint").alias(name) for name, n in watch.get.items()])


# ---- row work -------------------------------------------------------------------------------


@query
def clean_tx(spark, sf_dir):
    return plain(clean.clean(messages.decode(fixtures.message_lines(fixtures.tx_burst(spark, sf_dir)))))


@query
def parse_event_time(spark, sf_dir):
    decoded = messages.decode(fixtures.message_lines(fixtures.tx_burst(spark, sf_dir)))
    return plain(clean.with_event_time(decoded).select("tx_id", "date", "ts", "dt"))


@query
def legs(spark, sf_dir):
    return plain(edges.legs(fixtures.tx_burst(spark, sf_dir)))


@query
def window_filter_7d(spark, sf_dir):
    return plain(metrics.window_filter(fixtures.tx_burst(spark, sf_dir), "7d"))


@query
def self_transfers(spark, sf_dir):
    return plain(clean.self_transfers(fixtures.tx_events(spark, sf_dir)))


@query
def dedup_tx(spark, sf_dir):
    return plain(dedup.dedup_tx(fixtures.tx_lineitem(spark, sf_dir)))


@query
def scalar_pack(spark, sf_dir):
    tx = fixtures.tx_events(spark, sf_dir)
    amount = F.col("amount")
    return tx.select(
        "tx_id",
        scalars.format_event_time("ts").alias("date"),
        F.unix_timestamp("ts").alias("epoch"),
        F.least(amount, F.lit(50.0)).alias("capped"),
        F.greatest(amount, F.lit(1.0)).alias("floored"),
        scalars.ratio_or_zero(amount, F.rint(amount / 100.0)).alias("ratio"),
        scalars.round2(amount / 3.0).alias("third"),
        F.concat_ws(" ", F.when(amount > 100, "HIGH"), F.when(F.hour("ts") < 6, "NIGHT")).alias("reasons"),
        scalars.user_id(F.unix_timestamp("ts") % 1000).alias("made_id"),
    )


@query
def running_balance(spark, sf_dir):
    return plain(balance.running_balance(fixtures.tx_events(spark, sf_dir)))


@query
def overdrafts(spark, sf_dir):
    return plain(balance.overdrafts(balance.running_balance(fixtures.tx_events(spark, sf_dir))))


# ---- metrics --------------------------------------------------------------------------------


@query
def user_metrics(spark, sf_dir):
    return plain(_burst_metrics(spark, sf_dir))


@query
def user_metrics_lineitem(spark, sf_dir):
    return plain(metrics.user_metrics(fixtures.tx_lineitem(spark, sf_dir)))


@query
def metrics_join_form(spark, sf_dir):
    return plain(metrics.user_metrics_by_joins(fixtures.tx_burst(spark, sf_dir)))


@query
def lifetime_sent(spark, sf_dir):
    return plain(metrics.lifetime_side(fixtures.tx_burst(spark, sf_dir), "sent"))


@query
def lifetime_recv(spark, sf_dir):
    return plain(metrics.lifetime_side(fixtures.tx_lineitem(spark, sf_dir), "recv"))


@query
def window_metrics_sent(spark, sf_dir):
    return metrics.window_side(fixtures.tx_burst(spark, sf_dir), "sent")


@query
def window_metrics_recv(spark, sf_dir):
    return metrics.window_side(fixtures.tx_burst(spark, sf_dir), "recv")


@query
def distinct_counterparties(spark, sf_dir):
    return metrics.distinct_counterparties(fixtures.tx_lineitem(spark, sf_dir))


@query
def account_age(spark, sf_dir):
    return _burst_metrics(spark, sf_dir).select(
        "user", F.least("first_seen_sent", "first_seen_recv").cast("timestamp_ntz").alias("first_seen"), "elapsed_hours"
    )


@query
def periodic_averages(spark, sf_dir):
    columns = [f"avg_{period}_{role}" for role in ROLES for period in PERIOD_HOURS]
    return _burst_metrics(spark, sf_dir).select("user", *columns)


@query
def user_bank(spark, sf_dir):
    return metrics.user_bank(fixtures.tx_burst(spark, sf_dir))


@query
def pair_edges(spark, sf_dir):
    return plain(edges.pair_edges(fixtures.tx_lineitem(spark, sf_dir)))


# ---- rules ----------------------------------------------------------------------------------


@query
def rule_amount(spark, sf_dir):
    return _flagged(spark, sf_dir).select("user", "x_amount_vs_life", "flag_amount")


@query
def rule_network(spark, sf_dir):
    return _flagged(spark, sf_dir).select("user", "x_network_vs_life", "flag_network")


@query
def rule_burst(spark, sf_dir):
    return _flagged(spark, sf_dir).select("user", "x_burst_vs_7d", "flag_burst")


@query
def anomaly_flags(spark, sf_dir):
    return _flagged(spark, sf_dir).select(
        "user", "flag_amount", "flag_network", "flag_burst", "anomaly", "fraud_reasons",
        "x_amount_vs_life", "x_network_vs_life", "x_burst_vs_7d",
    )


@query
def fraud_alerts(spark, sf_dir):
    return rules.fraud_alerts(_flagged(spark, sf_dir))


# ---- views and activity ---------------------------------------------------------------------


@query
def recent_users(spark, sf_dir):
    return plain(views.recent_users(activity.recent_tx(fixtures.tx_burst(spark, sf_dir))))


@query
def recent_user_metrics_semi(spark, sf_dir):
    tx = fixtures.tx_burst(spark, sf_dir)
    return plain(views.metrics_of_recent(_burst_metrics(spark, sf_dir), activity.recent_tx(tx)))


@query
def recent_users_view(spark, sf_dir):
    return plain(_view(spark, sf_dir))


@query
def most_active_topk(spark, sf_dir):
    return views.most_active(_burst_metrics(spark, sf_dir)).select("user", "bank", "count_sent_3h")


@query
def top10_displayed(spark, sf_dir):
    return views.top_displayed(_view(spark, sf_dir))


@query
def view_avg_amounts(spark, sf_dir):
    return views.average_amounts(_view(spark, sf_dir))


@query
def view_counts_network(spark, sf_dir):
    return views.counts_and_network(_view(spark, sf_dir))


@query
def view_lifetime(spark, sf_dir):
    return views.lifetime(_view(spark, sf_dir))


@query
def activity_last_window(spark, sf_dir):
    return activity.last_activity(fixtures.tx_burst(spark, sf_dir))


@query
def tx_per_second(spark, sf_dir):
    return plain(activity.tx_per_second(fixtures.tx_burst(spark, sf_dir)))


@query
def monitor_summary(spark, sf_dir):
    recent = activity.recent_tx(fixtures.tx_burst(spark, sf_dir))
    return activity.monitor_summary(_flagged(spark, sf_dir), recent)


# ---- streaming ------------------------------------------------------------------------------


@query
def stream_monitor(spark, sf_dir):
    """Ledger and full recomputation in every micro-batch; the last published metric table."""
    tx = fixtures.tx_burst(spark, sf_dir)
    config = _run_monitor(spark, fixtures.message_lines(tx, bad_lines=False), fixtures.newest(tx), incremental=False)
    return plain(snapshots.read_latest(spark, config.user_metrics))


@query
def stream_incremental_metrics(spark, sf_dir):
    """The same from merged state."""
    tx = fixtures.tx_burst(spark, sf_dir)
    config = _run_monitor(spark, fixtures.message_lines(tx, bad_lines=False), fixtures.newest(tx))
    return plain(snapshots.read_latest(spark, config.user_metrics))


@query
def stream_restart_no_dup(spark, sf_dir):
    """The monitor, with an error after each of a batch's writes and a restart each time, then more input."""
    tx = fixtures.tx_burst(spark, sf_dir)
    now = fixtures.newest(tx)
    failures = ["ledger", "state", "user_metrics", "recent_tx", "batch_log"]

    def fail_once(table: str) -> None:
        if table in failures:
            failures.remove(table)
            raise RuntimeError(f"planned failure after {table}")

    config = MonitorConfig(data_dir=scratch_path(spark, "restart"), clock=lambda: now, after_write=fail_once)
    recent = F.col("ts") >= scalars.before(F.lit(now), 604_800)
    for part in (tx.filter(~recent), tx.filter(recent)):
        _feed(fixtures.message_lines(part, bad_lines=False), f"{config.data_dir}/in")
        done = False
        while not done:
            run = monitor.start_monitor(spark, messages.read_line_stream(spark, f"{config.data_dir}/in"), config, available_now=True)
            try:
                run.awaitTermination()
                done = True
            except StreamingQueryException:
                if "planned failure" not in str(run.exception()):
                    raise
    return ledger.scan(spark, config.ledger).groupBy("dt").agg(
        F.count("*").alias("tx_rows"), F.count_distinct("tx_id").alias("tx_ids")
    )


def _published_view(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    tx = fixtures.tx_burst(spark, sf_dir)
    config = _run_monitor(spark, fixtures.message_lines(tx, bad_lines=False), fixtures.newest(tx), **options)
    user_metrics, recent = monitor.published(spark, config)
    return plain(views.dashboard_view(rules.with_anomalies(user_metrics), recent))


@query
def published_dashboard(spark, sf_dir):
    """What the monitor has published, both tables of one batch, through rules to the view of the recent users."""
    return _published_view(spark, sf_dir)


@query
def published_dashboard_fallback(spark, sf_dir):
    """The same while no transaction is recent (the window begins after the newest one): the most active users."""
    return _published_view(spark, sf_dir, recent_seconds=-1)


@query
def stream_late_rows(spark, sf_dir):
    """Rows, rejects and late rows, as logged per batch by the monitor; late rows are kept."""
    tx = fixtures.tx_burst(spark, sf_dir)
    config = _run_monitor(
        spark, fixtures.message_lines(tx), fixtures.newest(tx), incremental=False, late_after_seconds=LATE_AFTER_SECONDS
    )
    counts = ("batch_rows", "rejected_rows", "late_rows")
    return monitor.read_batch_log(spark, config).agg(*[F.sum(c).alias(c) for c in counts])


@query
def stream_dedup(spark, sf_dir):
    """Every message delivered twice; one row per transaction id remains."""
    tx = fixtures.tx_burst(spark, sf_dir)
    lines = fixtures.message_lines(tx, bad_lines=False)
    root = scratch_path(spark, "dedup")
    per_batch = _feed(lines.unionByName(lines), f"{root}/in")
    stream = messages.read_transaction_stream(spark, "json-lines", f"{root}/in", max_per_trigger=per_batch)
    tx = clean.clean(stream).select(*TX_COLUMNS)
    live.write_first_deliveries(tx, f"{root}/out", f"{root}/check", available_now=True).awaitTermination()
    return plain(spark.read.parquet(f"{root}/out").select(*TX_COLUMNS))


@query
def stream_monitor_dedup(spark, sf_dir):
    """Repeated deliveries inside a batch and across batches do not change the metric table."""
    tx = fixtures.tx_burst(spark, sf_dir)
    lines = fixtures.message_lines(tx, bad_lines=False)
    config = _run_monitor(spark, lines.unionByName(lines), fixtures.newest(tx), dedup=True)
    return plain(snapshots.read_latest(spark, config.user_metrics))


@query
def stream_tx_per_second(spark, sf_dir):
    """Live per-second counts; the newest week arrives first, so that every other row is late."""
    tx = fixtures.tx_burst(spark, sf_dir)
    now = fixtures.newest(tx)
    root = scratch_path(spark, "series")
    recent = F.col("ts") >= scalars.before(F.lit(now), 604_800)
    for part in (tx.filter(recent), tx.filter(~recent)):
        _feed(fixtures.message_lines(part, bad_lines=False), f"{root}/in")
        stream = clean.clean(messages.read_transaction_stream(spark, "json-lines", f"{root}/in"))
        live.write_seconds(stream, f"{root}/out", f"{root}/check", available_now=True).awaitTermination()
    return plain(live.read_seconds(spark, f"{root}/out"))
