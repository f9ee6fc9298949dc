"""Plan shapes, hot keys and independence of row order."""

import random
from functools import reduce

from compare import at
from pyspark.sql import Window
from pyspark.sql import functions as F

from tallywatch import fixtures
from tallywatch.operators import balance, edges
from tallywatch.operators.dedup import dedup_tx
from tallywatch.plans import metrics
from tallywatch.session import scratch_path
from tallywatch.sources import ledger, snapshots


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(str, df.collect()))


def test_flagship_plan(spark, tiny):
    tx = fixtures.tx_events(spark, tiny)
    text = plan(metrics.user_metrics(tx, fixtures.newest(tx)))
    assert "Expand" not in text and "Python" not in text and "CartesianProduct" not in text
    # The ledger is shuffled by pair, then by user; the bank table adds its own small ones.
    assert text.count("Exchange hashpartitioning(send_id") + text.count("Exchange hashpartitioning(receive_id") <= 3
    pair_part = plan(edges.edge_totals(tx, F.lit(fixtures.newest(tx))))
    assert pair_part.count("Exchange hashpartitioning") == 1 and "SortAggregate" not in pair_part


def test_bounded_reads_prune_days(spark, tiny):
    path = scratch_path(spark, "ledger")
    ledger.append(fixtures.tx_events(spark, tiny).withColumn("dt", F.to_date("ts")), path, 0)
    text = plan(ledger.scan(spark, path, since=at("2024-01-20T10:00:00")))
    assert "PartitionFilters: [isnotnull(dt" in text and ">= 2024-01-20" in text
    assert len(ledger.days(spark, path, at("2024-01-20T10:00:00").date())) == 11
    one_day = ledger.scan_days(spark, path, [at("2024-01-20T10:00:00").date()])
    assert {str(r.dt) for r in one_day.select("dt").distinct().collect()} == {"2024-01-20"}
    assert ledger.scan_days(spark, path, [at("2030-01-01T00:00:00").date()]).count() == 0


def test_hot_user_balance_equals_plain_window(spark, tiny):
    tx = fixtures.tx_events(spark, tiny)
    hot = tx.withColumn("send_id", F.when(F.col("tx_id").cast("int") % 3 == 0, "user_hot").otherwise(F.col("send_id")))
    # Equal event times, so that ranges also cut inside one second.
    hot = hot.withColumn("ts", F.date_trunc("day", "ts"))
    legs = edges.both_parties(hot, "tx_id", "ts", "amount")
    upto_here = Window.partitionBy("user").orderBy(*balance.MOVE_ORDER).rowsBetween(Window.unboundedPreceding, 0)
    change = F.expr("if(role = 'sent', -amount, amount)").cast("decimal(28,9)")
    plain = legs.withColumn("balance", F.sum(change).over(upto_here).cast("double"))
    kept = ["user", "role", "counterparty", "tx_id", "ts", "amount", "balance"]
    balances = balance.running_balance(hot)
    assert rows(balances.select(kept)) == rows(plain.select(kept))
    assert balances.filter("overdraft <> (role = 'sent' and balance < 0)").count() == 0


def test_opening_balance(spark, make_tx):
    tx = make_tx(("a", "b", 5.0, "2024-01-01T00:00:00", "1"), ("a", "b", 6.0, "2024-01-01T00:00:01", "2"))
    opening = spark.createDataFrame([("a", 10.0)], "user string, balance double")
    sent = balance.running_balance(tx, opening).filter("role = 'sent'").orderBy("tx_id").collect()
    assert [(r.balance, r.overdraft) for r in sent] == [(5.0, False), (-1.0, True)]


def test_hot_pair_and_hot_copies(spark, tiny):
    tx = fixtures.tx_events(spark, tiny)
    third = F.col("tx_id").cast("int") % 3 == 0
    skewed = tx.withColumns({
        "send_id": F.when(third, "user_hot").otherwise(F.col("send_id")),
        "receive_id": F.when(third, "user_hot2").otherwise(F.col("receive_id")),
        "tx_id": F.when(third, "copy").otherwise(F.col("tx_id")),
    })
    assert rows(metrics.user_metrics(skewed)) == rows(metrics.user_metrics_by_joins(skewed))
    assert dedup_tx(skewed).count() == skewed.select("tx_id").distinct().count()


def test_order_and_split_do_not_matter(spark, tiny):
    tx = fixtures.tx_burst(spark, tiny)
    now = fixtures.newest(tx)
    expected = rows(metrics.user_metrics(tx, now))
    for seed in (1, 2):
        weights = [random.Random(seed).random() for _ in range(3)]
        pieces = tx.randomSplit(weights, seed)
        shuffled = reduce(lambda a, b: a.unionByName(b), reversed(pieces)).repartition(5, F.rand(seed))
        assert rows(metrics.user_metrics(shuffled, now)) == expected


def test_approximate_distinct_is_close(spark, tiny):
    tx = fixtures.tx_lineitem(spark, tiny)
    exact = metrics.distinct_counterparties(tx).select("user", "role", F.col("distinct_life").alias("exact"))
    near = metrics.distinct_counterparties(tx, approximate=True).select("user", "role", "distinct_life")
    errors = exact.join(near, ["user", "role"]).select(F.abs(F.col("exact") - F.col("distinct_life")) / F.col("exact"))
    worst, mean = errors.toDF("e").agg(F.max("e"), F.avg("e")).first()
    assert worst < 0.35 and mean < 0.05


def test_snapshots(spark):
    root = scratch_path(spark, "snap")
    for v in range(3):
        snapshots.publish(spark.range(v + 1), root, v)
    spark.range(9).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(f"{root}/v=7")
    assert snapshots.committed_versions(spark, root) == [0, 1, 2]
    assert snapshots.read_latest(spark, root).count() == 3
    snapshots.publish(spark.range(5), root, 2, files=1)
    assert snapshots.read_latest(spark, root).count() == 5
    snapshots.expire(spark, root, 1)
    assert snapshots.committed_versions(spark, root) == [2]
