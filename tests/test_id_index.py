"""The id index: whole under merges and replays, and read by bucket."""

from compare import at
from pyspark.sql import functions as F

from tallywatch import fixtures
from tallywatch.operators.dedup import seen_ids
from tallywatch.schema import MonitorConfig
from tallywatch.session import scratch_path
from tallywatch.sources import id_index, ledger, storage
from tallywatch.streaming import monitor


def ids(spark, first, n):
    return spark.range(first, first + n).select(F.concat(F.lit("t"), "id").alias("tx_id"))


def found(spark, path, first, n):
    asked = ids(spark, first, n)
    return seen_ids(asked, id_index.candidates(asked, path)).count()


def read_bytes(spark, path, asked):
    fs, _ = storage._hadoop_path(spark, path)
    files = id_index.candidates(asked, path).inputFiles()
    return sum(fs.getFileStatus(spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f)).getLen() for f in files), len(files)


def test_index_is_whole_under_merges_and_replays(spark):
    path, per_batch = scratch_path(spark, "ids"), 40
    empty = ids(spark, 0, 0)
    assert id_index.last_batch(spark, path) == -1 and id_index.candidates(empty, path).count() == 0
    for batch_id in range(14):
        assert found(spark, path, 0, per_batch * 20) == per_batch * batch_id
        for _ in range(2 if batch_id in (3, 8) else 1):  # replayed
            id_index.add(ids(spark, per_batch * batch_id, per_batch), path, batch_id, ids_per_bucket=30)
        id_index.compact(spark, path, batch_id + 1, fan_in=3, ids_per_bucket=30)
        assert not id_index.compact(spark, path, batch_id + 1, fan_in=3, ids_per_bucket=30)
    listed = id_index.entries(spark, path).collect()
    assert sum(e["ids"] for e in listed) == 14 * per_batch and max(e["level"] for e in listed) >= 2 and len(listed) <= 6
    assert {n for n in storage.child_names(spark, path) if n.startswith("seg=")} == {f"seg={e['seg']}" for e in listed}
    assert id_index.last_batch(spark, path) == 13
    nulls = spark.createDataFrame([(None,), ("t5",), ("t5",), ("other",)], "tx_id string")
    id_index.add(nulls.filter("tx_id IS NULL"), path, 14)
    assert id_index.last_batch(spark, path) == 13
    assert [r["tx_id"] for r in seen_ids(nulls, id_index.candidates(nulls, path)).collect()] == ["t5"]


def test_bytes_read_do_not_grow_with_history(spark):
    path, asked = scratch_path(spark, "ids"), ids(spark, 7, 2)
    read, whole = [], []
    for batch_id, n in enumerate((4_000, 16_000, 64_000)):
        id_index.add(ids(spark, batch_id * 1_000_000, n), path, batch_id, ids_per_bucket=500)
        id_index.compact(spark, path, batch_id + 1, fan_in=2, ids_per_bucket=500)
        read.append(read_bytes(spark, path, asked)[0])
        whole.append(read_bytes(spark, path, ids(spark, 0, 50_000))[0])
    assert whole[2] > 8 * whole[0] and read[2] < 2.5 * read[0] and read[2] < whole[2] / 30
    assert found(spark, path, 7, 2) == 2


def test_index_catches_up_with_a_ledger(spark, make_tx):
    """Batches that ran without dedup, and those whose index was not written, are taken from the ledger."""
    now = at("2024-01-02T00:00:00")
    config = MonitorConfig(data_dir=scratch_path(spark, "monitor"), clock=lambda: now, compact_every=2, incremental=False)
    plain = make_tx(("a", "b", 1.0, "2024-01-01T00:00:00", "x"), ("a", "c", 2.0, "2023-12-30T00:00:00", "y"))
    monitor.process_batch(spark, config, fixtures.message_lines(plain, False), 0)
    dedup = MonitorConfig(**{**config.__dict__, "dedup": True})
    for batch_id in range(1, 5):
        again = make_tx(("a", "b", 1.0, "2024-01-01T00:00:00", "x"), ("a", "d", 2.0, "2024-01-01T00:00:00", f"n{batch_id}"), ("a", "d", 2.0, "2024-01-01T00:00:00", f"n{batch_id - 1}"))
        for _ in range(2 if batch_id == 3 else 1):
            monitor.process_batch(spark, dedup, fixtures.message_lines(again, False), batch_id)
    held = [r["tx_id"] for r in ledger.scan(spark, config.ledger).collect()]
    assert sorted(held) == sorted(["x", "y", *(f"n{i}" for i in range(5))])
    assert ledger.scan(spark, config.ledger, after_batch=2).count() == 2
