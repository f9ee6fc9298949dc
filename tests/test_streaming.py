"""The monitor: batches add up, replays and restarts change nothing, state equals recomputation."""

from datetime import timedelta

import pytest
from compare import at
from pyspark.sql import functions as F

from tallywatch import fixtures
from tallywatch.plans import metrics
from tallywatch.schema import MonitorConfig
from tallywatch.session import scratch_path
from tallywatch.sources import ledger, messages, snapshots
from tallywatch.streaming import monitor


def rows(df):
    return sorted(map(str, df.collect()))


def config_for(spark, **options):
    return MonitorConfig(data_dir=scratch_path(spark, "monitor"), **options)


def feed(lines, config, files):
    lines.repartition(files, F.xxhash64("value")).write.mode("append").text(f"{config.data_dir}/in")


def run(spark, config, limit=None):
    stream = messages.read_line_stream(spark, f"{config.data_dir}/in", limit)
    monitor.start_monitor(spark, stream, config, available_now=True).awaitTermination()


def batches(spark, tx, count):
    """Messages of ``tx`` cut into ``count`` batches that overlap in time."""
    lines = fixtures.message_lines(tx)
    part = F.pmod(F.xxhash64("value"), F.lit(count))
    return [lines.filter(part == i) for i in range(count)]


def test_state_equals_recomputation_after_every_batch(spark, tiny):
    tx = fixtures.tx_burst(spark, tiny)
    newest = fixtures.newest(tx)
    # The clock moves on from a moment before the newest rows, through part of an hour.
    moments = [newest.replace(hour=20, minute=m, second=17) for m in (1, 31, 59)] + [newest]
    config = config_for(spark, compact_every=2, clock=lambda: moments[0])
    for i, lines in enumerate(batches(spark, tx, len(moments))):
        now = moments[i]
        settings = MonitorConfig(**{**config.__dict__, "clock": lambda now=now: now})
        monitor.process_batch(spark, settings, lines, i)
        got = rows(snapshots.read_latest(spark, config.user_metrics))
        assert got == rows(metrics.user_metrics(ledger.scan(spark, config.ledger), now))
        if i in (1, 2):  # replay, also of a batch that had just been compacted
            monitor.process_batch(spark, settings, lines, i)
            assert rows(snapshots.read_latest(spark, config.user_metrics)) == got
    assert len(snapshots.committed_versions(spark, f"{config.state}/days/base")) >= 1
    log = monitor.read_batch_log(spark, config)
    assert log.count() == len(moments)
    total = fixtures.message_lines(tx).count()
    assert log.agg(F.sum("batch_rows"), F.sum("rejected_rows")).first() == (total, len(fixtures.BAD_LINES))


def test_micro_batches_and_restart_equal_one_batch(spark, tiny):
    tx = fixtures.tx_burst(spark, tiny)
    now = fixtures.newest(tx)
    config = config_for(spark, incremental=False, clock=lambda: now)
    first, second = batches(spark, tx, 2)
    feed(first, config, 2)
    run(spark, config, limit=1)
    feed(second, config, 1)
    run(spark, config)
    assert ledger.scan(spark, config.ledger).select("batch_id").distinct().count() == 3
    shown = snapshots.read_latest(spark, config.user_metrics)
    assert rows(shown) == rows(metrics.user_metrics(ledger.scan(spark, config.ledger), now))
    assert ledger.scan(spark, config.ledger).count() == tx.count() + len(fixtures.ODD_LINES)
    assert snapshots.read_latest(spark, config.recent_tx).filter(F.col("ts") < F.lit(now) - F.expr("interval 120 seconds")).count() == 0


def test_dedup_across_batches_and_replay(spark, make_tx):
    config = config_for(spark, dedup=True, clock=lambda: at("2024-01-02T00:00:00"))
    one = fixtures.message_lines(make_tx(("a", "b", 1.0, "2024-01-01T10:00:00", "1"), ("a", "b", 1.0, "2024-01-01T10:00:00", "1")), False)
    two = fixtures.message_lines(make_tx(("a", "b", 1.0, "2024-01-01T10:00:00", "1"), ("a", "c", 2.0, "2024-01-01T11:00:00", "2"), ("a", "c", 4.0, None, "3")), False)
    for batch_id, lines in ((0, one), (1, two), (1, two)):
        monitor.process_batch(spark, config, lines, batch_id)
    assert sorted(r.tx_id for r in ledger.scan(spark, config.ledger).collect()) == ["1", "2", "3"]
    a = snapshots.read_latest(spark, config.user_metrics).filter("user = 'a'").first()
    assert (a.count_sent_life, a.total_sent, a.distinct_sent_life, a.count_sent_7d) == (3, 7.0, 2, 2)


def test_dedup_across_days(spark, make_tx):
    config = config_for(spark, dedup=True, clock=lambda: at("2024-01-03T00:00:00"))
    for batch_id, when in enumerate(("2024-01-01T23:59:59", "2024-01-02T00:00:01")):
        lines = fixtures.message_lines(make_tx(("a", "b", 1.0, when, "1"), ("a", "b", 1.0, when, f"own-{batch_id}")), False)
        monitor.process_batch(spark, config, lines, batch_id)
    assert sorted(r.tx_id for r in ledger.scan(spark, config.ledger).collect()) == ["1", "own-0", "own-1"]


def test_clock_that_steps_back_behind_folded_days(spark, make_tx):
    config = config_for(spark, compact_every=1)
    moments = ["2024-06-01T10:00:00", "2024-06-20T10:00:00", "2024-06-16T10:00:00", "2024-07-20T10:00:00"]
    for batch_id, moment in enumerate(moments):
        now = at(moment)
        days = [now - timedelta(days=d, hours=d) for d in (0, 5, 30, 89, 91, 93, 94, 120)]
        tx = make_tx(*[(f"u{d.day % 3}", "v", 1.5, d.isoformat()[:19], f"{batch_id}-{d}") for d in days])
        settings = MonitorConfig(**{**config.__dict__, "clock": lambda now=now: now})
        monitor.process_batch(spark, settings, fixtures.message_lines(tx, False), batch_id)
        got = rows(snapshots.read_latest(spark, config.user_metrics))
        assert got == rows(metrics.user_metrics(ledger.scan(spark, config.ledger), now)), moment


def test_empty_batch_is_skipped(spark):
    config = config_for(spark)
    monitor.process_batch(spark, config, spark.createDataFrame([], "value string"), 0)
    assert snapshots.committed_versions(spark, config.user_metrics) == []


@pytest.mark.parametrize("incremental", [True, False])
def test_batch_of_rejects_only(spark, make_tx, incremental):
    config = config_for(spark, incremental=incremental, clock=lambda: at("2024-01-02T00:00:00"))
    broken = spark.createDataFrame([("{bad",)], "value string")
    monitor.process_batch(spark, config, broken, 0)
    assert snapshots.read_latest(spark, config.user_metrics).count() == 0
    good = fixtures.message_lines(make_tx(("a", "b", 1.0, "2024-01-01T10:00:00")), False)
    monitor.process_batch(spark, config, good, 1)
    assert snapshots.read_latest(spark, config.user_metrics).count() == 2
    assert [r.rejected_rows for r in monitor.read_batch_log(spark, config).orderBy("v").collect()] == [1, 0]


def test_ledger_without_checkpoint_is_refused(spark, make_tx):
    config = config_for(spark)
    tx = make_tx(("a", "b", 1.0, "2024-01-01T10:00:00"))
    ledger.append(tx.withColumn("dt", F.to_date("ts")), config.ledger, 0)
    feed(fixtures.message_lines(tx, False), config, 1)
    with pytest.raises(RuntimeError):
        run(spark, config)


def test_failed_batch_goes_on_behind_its_finished_writes(spark, make_tx, monkeypatch):
    made = []
    for module, name in ((ledger, "append"), (monitor.state, "add_batch"), (monitor, "_recent"), (monitor.state, "metrics")):
        def counted(*args, _own=getattr(module, name), _name=name, **more):
            made.append(_name)
            return _own(*args, **more)

        monkeypatch.setattr(module, name, counted)
    left = ["ledger", "state", "user_metrics", "recent_tx", "batch_log"]

    def fail_once(table):
        if table in left:
            left.remove(table)
            raise RuntimeError("planned")

    moment = at("2024-01-02T00:00:00")
    config = config_for(spark, clock=lambda: moment, after_write=fail_once)
    lines = fixtures.message_lines(make_tx(("a", "b", 1.0, "2024-01-01T23:59:00"), ("a", "c", 2.0, "2024-01-01T11:00:00")))
    for _ in range(5):
        with pytest.raises(RuntimeError):
            monitor.process_batch(spark, config, lines, 0)
    monitor.process_batch(spark, config, lines, 0)
    assert sorted(made) == ["_recent", "add_batch", "append", "metrics"]
    log = monitor.read_batch_log(spark, config).collect()
    assert [(r.v, r.batch_rows, r.rejected_rows, r.late_rows, r.tracked_users) for r in log] == [(0, 8, 4, 1, 5)]
    assert rows(snapshots.read_latest(spark, config.user_metrics)) == rows(metrics.user_metrics(ledger.scan(spark, config.ledger), moment))
    moment = at("2024-01-02T02:00:00")  # the clock has moved: what it decides is made anew, the ledger and the state are not
    monitor.process_batch(spark, config, lines, 0)
    assert sorted(made) == ["_recent", "_recent", "add_batch", "append", "metrics", "metrics"]
    assert rows(snapshots.read_latest(spark, config.user_metrics)) == rows(metrics.user_metrics(ledger.scan(spark, config.ledger), moment))
    assert monitor.read_batch_log(spark, config).first().late_rows == 2
    monitor.storage.delete_tree(spark, ledger.entry_path(config.ledger, 0))  # a table that is gone is made anew, with all after it
    monitor.process_batch(spark, config, lines, 0)
    assert sorted(made[-4:]) == ["_recent", "add_batch", "append", "metrics"]
