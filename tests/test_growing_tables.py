"""Tables that grow for ever: the ledger and its manifest, the batch log, the series; and the monitor as a job."""

from datetime import timedelta

import pytest
from compare import at
from pyspark.sql import functions as F

from tallywatch import __main__ as job
from tallywatch import fixtures
from tallywatch.schema import MonitorConfig
from tallywatch.session import scratch_path
from tallywatch.sources import folding, ledger, messages, snapshots, storage
from tallywatch.streaming import live, monitor

NOW = at("2024-03-02T12:00:00")


def folders(spark, path):
    segments = [n for n in storage.child_names(spark, path) if n.startswith("seg=")]
    return [f"{s}/{d}" for s in segments for d in storage.child_names(spark, f"{path}/{s}") if d.startswith("dt=")]


def batch_of(make_tx, batch_id):
    """Rows of two days, and one without a time."""
    day = f"2024-03-0{1 + batch_id % 2}T10:{batch_id:02}:00"
    return make_tx(("a", "b", 1.0, day, f"{batch_id}-1"), ("a", "c", 2.0, "2024-03-01T00:00:00", f"{batch_id}-2"), ("a", "d", 2.0, None, f"{batch_id}-3"))


def test_ledger_stays_small_and_whole(spark, make_tx):
    path, batches = scratch_path(spark, "ledger"), 26
    older = None
    for batch_id in range(batches):
        rows = batch_of(make_tx, batch_id).withColumn("dt", F.to_date("ts"))
        ledger.append(rows, path, batch_id)
        before = ledger.scan(spark, path)
        merged = ledger.compact(spark, path, batch_id, every=4, fan_in=3)
        assert not ledger.compact(spark, path, batch_id, every=4, fan_in=3)
        if merged:
            older = before  # a reader that began before this compaction, and ends before the next
            assert older.count() == 3 * (batch_id + 1)
            ledger.append(rows, path, batch_id)  # replayed after the compaction
    assert older is not None
    found = ledger.scan(spark, path)
    assert found.count() == 3 * batches and found.select("tx_id").distinct().count() == 3 * batches
    assert {r["batch_id"]: r["count"] for r in found.groupBy("batch_id").count().collect()} == {b: 3 for b in range(batches)}
    assert ledger.scan(spark, path, up_to_batch=batches - 2).count() == 3 * (batches - 1)
    assert len(folders(spark, path)) < 30  # 3 per day and what the last batches wrote; 65 without compaction
    assert ledger.days(spark, path) == [NOW.date() - timedelta(days=1), NOW.date()]
    newest = spark.range(1).select(ledger.newest(spark, path).alias("t")).first()["t"]
    assert newest == found.agg(F.max("ts")).first()[0]
    assert ledger.scan_days(spark, path, [None]).count() == batches
    late = ledger.scan(spark, path, since=at("2024-03-02T10:20:00"))
    assert late.count() == 3 and len(late.inputFiles()) < len(found.inputFiles())


def test_unlisted_segments_are_no_part_of_the_ledger(spark, make_tx):
    path = scratch_path(spark, "ledger")
    ledger.append(batch_of(make_tx, 0).withColumn("dt", F.to_date("ts")), path, 0)
    ledger.append(batch_of(make_tx, 1).withColumn("dt", F.to_date("ts")), path, 1)
    for seg in ("b7", "c0"):  # a batch that ended before its entry, a compaction that ended before its list
        ledger.scan(spark, path).write.partitionBy("dt").parquet(f"{path}/seg={seg}")
    assert ledger.scan(spark, path).count() == 6
    assert ledger.compact(spark, path, 2, fan_in=2) and ledger.scan(spark, path).count() == 6
    assert not any(f.startswith("seg=c0") for f in folders(spark, path)) and any(f.startswith("seg=b7") for f in folders(spark, path))
    assert ledger.scan(spark, scratch_path(spark, "none")).count() == 0


def test_monitor_folds_its_log_and_ledger(spark, make_tx):
    config = MonitorConfig(data_dir=scratch_path(spark, "monitor"), clock=lambda: NOW, compact_every=2, keep_log=4)
    for batch_id in range(7):
        for _ in range(2 if batch_id in (2, 5) else 1):
            monitor.process_batch(spark, config, fixtures.message_lines(batch_of(make_tx, batch_id), False), batch_id)
    log = {r["v"]: r["batch_rows"] for r in monitor.read_batch_log(spark, config).collect()}
    assert set(log) >= {4, 5, 6} and 0 not in log and set(log.values()) == {3}
    assert len(storage.child_names(spark, f"{config.batch_log}/delta")) <= 6
    assert ledger.scan(spark, config.ledger).count() == 21
    user_metrics, recent = monitor.published(spark, config)
    assert user_metrics.filter("user = 'a'").first()["count_sent_life"] == 21 and recent.count() == 0


def test_readers_never_mix_batches(spark, make_tx):
    config = MonitorConfig(data_dir=scratch_path(spark, "monitor"), clock=lambda: NOW)
    assert monitor.published(spark, config) is None
    monitor.process_batch(spark, config, fixtures.message_lines(batch_of(make_tx, 0), False), 0)

    def fail(table):
        if table == "user_metrics":
            raise RuntimeError("planned")

    broken = MonitorConfig(**{**config.__dict__, "after_write": fail})
    with pytest.raises(RuntimeError):
        monitor.process_batch(spark, broken, fixtures.message_lines(batch_of(make_tx, 1), False), 1)
    assert snapshots.latest_version(spark, config.user_metrics) == 1 and monitor.finished_batch(spark, config) == 0
    assert monitor.published(spark, config)[0].filter("user = 'a'").first()["count_sent_life"] == 3
    monitor.process_batch(spark, config, fixtures.message_lines(batch_of(make_tx, 1), False), 1)
    assert monitor.published(spark, config)[0].filter("user = 'a'").first()["count_sent_life"] == 6


def test_series_in_tiers(spark):
    path, start = scratch_path(spark, "series"), at("2024-03-01T00:00:00")
    moments = [start + timedelta(seconds=90 * i) for i in range(60)] + [start + timedelta(seconds=7)] * 3  # late at the end
    for batch_id, moment in enumerate(moments):
        rows = spark.createDataFrame([("second", moment, 2)], live.SERIES)
        folding.add(rows, path, batch_id)
        folding.fold(spark, path, live.SERIES, batch_id, lambda r: live._rolled_up(r, 600, 1200), 5)
    tiers = {r["tier"]: (r["n"], r["s"]) for r in folding.read(spark, path, live.SERIES).groupBy("tier").agg(F.count("*").alias("n"), F.sum("tx_count").alias("s")).collect()}
    assert sum(s for _, s in tiers.values()) == 2 * len(moments) and set(tiers) == {"second", "minute", "hour"}
    hours = {r["start"].hour: r["tx_count"] for r in live.read_series(spark, path, "hour").collect()}
    assert hours == {0: 2 * 43, 1: 2 * 20}
    recent = live.read_seconds(spark, path, since=moments[59] - timedelta(seconds=300)).collect()
    assert sorted(r["second"].timestamp() for r in recent) == [m.timestamp() for m in moments[56:60]]
    assert len(storage.child_names(spark, f"{path}/delta")) <= 12 and len(storage.child_names(spark, f"{path}/base")) == 2


def test_job_over_files_with_a_limit_of_bytes(spark, tiny):
    root = scratch_path(spark, "job")
    lines = fixtures.message_lines(fixtures.tx_events(spark, tiny), False)
    lines.repartition(6).write.text(f"{root}/in")
    size = max(s.getLen() for s in storage._hadoop_path(spark, f"{root}/in")[0].listStatus(storage._hadoop_path(spark, f"{root}/in")[1]))
    job.main(["--data-dir", f"{root}/data", "--lines", f"{root}/in", "--max-bytes-per-trigger", str(2 * size + 10), "--available-now", "--recompute"])
    config = MonitorConfig(data_dir=f"{root}/data")
    log = [r["batch_rows"] for r in monitor.read_batch_log(spark, config).collect()]
    assert len(log) >= 3 and sum(log) == lines.count()
    assert ledger.scan(spark, config.ledger).count() == lines.count()


def test_settings_of_the_job_reach_the_source(spark):
    args = job.arguments(["--data-dir", "/d/", "--bootstrap", "k:1", "--starting-offsets", "latest", "--max-per-trigger", "9", "--allow-data-loss", "--dedup"])
    config = job.config_of(args)
    assert (config.data_dir, config.starting_offsets, config.max_per_trigger, config.fail_on_data_loss, config.dedup, config.incremental) == ("/d", "latest", 9, False, True, True)
    options = messages.kafka_source_options(config.bootstrap, config.topic, starting_offsets=config.starting_offsets, max_per_trigger=config.max_per_trigger, fail_on_data_loss=config.fail_on_data_loss)
    assert options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "9" and options["failOnDataLoss"] == "false"
    with pytest.raises(SystemExit):
        job.arguments(["--lines", "x"])
