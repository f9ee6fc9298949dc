"""Semantics the metric table and the decoder promise, one small frame each."""

import pytest
from compare import at
from pyspark.sql import functions as F

from tallywatch.functions.scalars import exact_part, ratio_or_zero, rest_part, round2
from tallywatch.operators import clean
from tallywatch.operators.dedup import dedup_tx
from tallywatch.plans import activity, metrics, rules, views
from tallywatch.schema import RuleConfig, metric_columns
from tallywatch.sources import messages

NOW = at("2024-03-31T12:00:00")


def by_user(df):
    return {row["user"]: row for row in df.collect()}


def both_forms(tx, now=NOW):
    fast = metrics.user_metrics(tx, now)
    slow = metrics.user_metrics_by_joins(tx, now)
    assert fast.columns == slow.columns == metric_columns()
    rows = by_user(fast)
    assert rows == by_user(slow)
    return rows


def test_invalid_rows_are_dropped(spark):
    lines = [
        ('{"tx_id":"ok","amount":1.5,"date":"2024-01-02T03:04:05Z"}',),
        ('{broken',), ('[1]',), ('{"amount":1.0}',), ('{"tx_id":"no-amount"}',),
        ('{"tx_id":"quoted","amount":"2.5"}',), ('{"tx_id":"nan","amount":NaN}',), ('{"tx_id":"huge","amount":1e300}',), (None,),
    ]
    decoded = messages.decode(spark.createDataFrame(lines, "value string"))
    assert decoded.count() == len(lines)
    assert sorted(r.tx_id for r in clean.clean(decoded).collect()) == ["huge", "nan", "ok"]
    bad_field = decoded.filter("tx_id = 'quoted'").first()
    assert bad_field.amount is None and bad_field.tx_id == "quoted"


def test_bytes_decode_like_text(spark):
    raw = spark.createDataFrame([(bytearray(b'{"tx_id":"a","amount":2.0}'),)], "value binary")
    assert messages.decode(raw).first().amount == 2.0


def test_window_lower_bound_is_inclusive_and_future_rows_count(make_tx):
    tx = make_tx(
        ("a", "b", 1.0, "2024-03-31T09:00:00"),
        ("a", "c", 2.0, "2024-03-31T08:59:59"),
        ("a", "d", 4.0, "2024-04-02T00:00:00"),
    )
    a = both_forms(tx)["a"]
    assert (a.count_sent_3h, a.avg_amount_sent_3h, a.distinct_sent_3h) == (2, 2.5, 2)
    assert (a.count_sent_7d, a.distinct_sent_7d) == (3, 3)


@pytest.mark.parametrize("label, edge", [("7d", "2024-03-24T12:00:00"), ("3w", "2024-03-10T12:00:00"), ("3m", "2024-01-01T12:00:00")])
def test_each_window_length(make_tx, label, edge):
    before = at(edge).replace(minute=0).timestamp() - 1
    earlier = at("1970-01-01T00:00:00").fromtimestamp(before, tz=NOW.tzinfo).isoformat()[:19]
    a = both_forms(make_tx(("a", "b", 1.0, edge), ("a", "b", 1.0, earlier)))["a"]
    assert a[f"count_sent_{label}"] == 1 and a.count_sent_life == 2


def test_empty_window_is_null_not_zero(make_tx):
    a = both_forms(make_tx(("a", "b", 1.0, "2023-01-01T00:00:00")))["a"]
    assert [a.count_sent_3m, a.avg_amount_sent_3m, a.distinct_sent_3m] == [None] * 3
    assert (a.count_sent_life, a.count_recv_life, a.total_recv) == (1, None, None)


def test_distinct_ignores_null_counterparties(make_tx):
    tx = make_tx(("a", None, 1.0, "2024-03-31T11:00:00"), ("a", "b", 1.0, "2024-03-31T11:00:00"), ("a", "b", 1.0, "2024-03-31T11:30:00"))
    a = both_forms(tx)["a"]
    assert (a.count_sent_3h, a.distinct_sent_3h, a.distinct_sent_life) == (3, 1, 1)


def test_null_user_is_left_out_but_his_counterparty_is_not(make_tx):
    rows = both_forms(make_tx((None, "b", 5.0, "2024-03-31T11:00:00")))
    assert set(rows) == {"b"}
    assert (rows["b"].count_recv_3h, rows["b"].distinct_recv_3h) == (1, 0)


def test_user_exists_with_either_role_and_bank_is_the_smallest(make_tx):
    tx = make_tx(
        ("a", "b", 1.0, "2024-03-31T11:00:00", "1", "bank_X", "bank_B"),
        ("c", "a", 1.0, "2024-03-31T11:00:00", "2", "bank_C", "bank_A"),
        ("a", "b", 1.0, "2024-03-31T11:00:00", "3", "bank_Y", "bank_Z"),
    )
    rows = both_forms(tx)
    assert {u: r.bank for u, r in rows.items()} == {"a": "bank_A", "b": "bank_B", "c": "bank_C"}
    # The same counterparty under two banks is still one counterparty.
    assert rows["a"].distinct_sent_life == 1


def test_first_seen_and_one_hour_floor(make_tx):
    tx = make_tx(
        ("new", "old", 12.0, "2024-03-31T11:50:00"),
        ("old", "x", 24.0, "2024-03-30T12:00:00"),
    )
    rows = both_forms(tx)
    assert rows["new"].elapsed_hours == 1.0 and rows["new"].avg_hourly_sent == 12.0
    old = rows["old"]
    assert old.elapsed_hours == 24.0
    assert (old.avg_hourly_sent, old.avg_daily_sent, old.avg_weekly_sent, old.avg_monthly_sent) == (1.0, 24.0, 168.0, 720.0)
    assert (old.avg_daily_recv, rows["x"].avg_daily_sent) == (12.0, 0.0)


def test_missing_event_time_counts_for_life_only(make_tx):
    a = both_forms(make_tx(("a", "b", 3.0, None)))["a"]
    assert (a.count_sent_life, a.total_sent, a.count_sent_3m, a.first_seen_sent, a.elapsed_hours) == (1, 3.0, None, None, 1.0)


def test_unreadable_dates_give_null(spark):
    lines = spark.createDataFrame([('{"tx_id":"1","amount":1,"date":"nope"}',), ('{"tx_id":"2","amount":1}',)], "value string")
    assert [(r.ts, r.dt) for r in clean.clean(messages.decode(lines)).collect()] == [(None, None)] * 2


def test_default_moment_is_the_newest_row(make_tx):
    tx = make_tx(("a", "b", 1.0, "2024-03-31T11:00:00"), ("a", "c", 1.0, "2024-03-31T07:59:59"))
    assert by_user(metrics.user_metrics(tx)) == by_user(metrics.user_metrics(tx, at("2024-03-31T11:00:00")))


def test_ratio_and_rounding(spark):
    row = spark.range(1).select(
        ratio_or_zero(F.lit(1.0), F.lit(0.0)).alias("zero"),
        ratio_or_zero(F.lit(None).cast("double"), F.lit(2.0)).alias("null"),
        round2(F.lit(0.125)).alias("tie"),
        round2(F.lit(2.675)).alias("scaled"),
        exact_part(F.lit(0.29)).cast("string").alias("exact"),
        exact_part(F.lit(float("nan"))).alias("nan"),
        rest_part(F.lit(0.29)).alias("no_rest"),
        rest_part(F.lit(2e20)).alias("all_rest"),
    ).first()
    assert row.asDict() == {"zero": 0.0, "null": 0.0, "tie": 0.12, "scaled": 2.68, "exact": "0.290000000", "nan": None, "no_rest": 0.0, "all_rest": 2e20}


def test_money_is_neither_cut_nor_flattened(make_tx):
    when = "2024-03-31T11:00:00"
    tx = make_tx(
        *[("small", "r", 0.004, when, f"s{i}") for i in range(10)], *[("big", "r2", 9.9e12, when, f"b{i}") for i in range(1000)],
        ("huge", "r3", 1e300, when), ("huge", "r3", 1.0, when), ("inf", "r4", float("inf"), when), ("tiny", "r5", 1e-12, when),
    )
    rows = both_forms(tx)
    totals = {u: rows[u].total_sent for u in ("small", "big", "huge", "inf", "tiny")}
    assert totals == {"small": 0.04, "big": 9.9e15, "huge": 1e300, "inf": float("inf"), "tiny": 1e-12}
    nan = by_user(metrics.user_metrics(make_tx(("n", "r", float("nan"), when), ("n", "r", 1.0, when)), NOW))["n"]
    assert nan.count_sent_life == 2 and str(nan.total_sent) == "nan"


def test_zero_amount_user_does_not_fire(make_tx):
    tx = make_tx(*[("z", f"r{i}", 0.0, "2024-03-31T11:00:00") for i in range(4)])
    z = by_user(rules.with_anomalies(metrics.user_metrics(tx, NOW)))["z"]
    assert (z.x_amount_vs_life, z.flag_amount, z.anomaly, z.fraud_reasons) == (0.0, False, False, "")


def test_rule_thresholds_are_settings(make_tx):
    history = [("a", "b", 1.0, f"2024-03-0{d}T11:00:00") for d in range(1, 8)]
    tx = make_tx(*history, ("a", "b", 50.0, "2024-03-31T11:00:00"))
    table = metrics.user_metrics(tx, NOW)
    assert not by_user(rules.with_anomalies(table))["a"].flag_amount
    assert by_user(rules.with_anomalies(table, RuleConfig(amount_min_count=0)))["a"].flag_amount


def test_recent_users_ties_and_fallback(spark, make_tx):
    tx = make_tx(("b", "a", 1.0, "2024-03-31T11:59:59"), ("c", "b", 1.0, "2024-03-31T12:00:00"))
    assert [(r.user, r["rank"]) for r in views.recent_users(tx, 2).orderBy("rank").collect()] == [("b", 1), ("c", 2)]
    flagged = rules.with_anomalies(metrics.user_metrics(tx, NOW))
    assert set(by_user(views.dashboard_view(flagged, tx.limit(0)))) == {"b", "c"}
    assert set(by_user(views.dashboard_view(flagged, tx, 2))) == {"b", "c"}


def test_series_fills_gaps(make_tx):
    tx = make_tx(("a", "b", 1.0, "2024-03-31T12:00:00"), ("a", "b", 1.0, "2024-03-31T12:00:03"), ("a", "b", 1.0, "2024-03-31T11:58:00"))
    assert [r.tx_count for r in activity.tx_per_second(tx).orderBy("second").collect()] == [1, 0, 0, 1]


def test_dedup_keeps_one_row_whatever_the_order(make_tx):
    rows = [("a", "b", 2.0, "2024-03-31T12:00:00", "x"), ("a", "b", 1.0, "2024-03-31T11:00:00", "x"), ("a", "b", 9.0, None, "y")]
    for order in (rows, rows[::-1]):
        assert {(r.tx_id, r.amount) for r in dedup_tx(make_tx(*order)).collect()} == {("x", 1.0), ("y", 9.0)}


def test_kafka_options():
    options = messages.kafka_source_options("k:9092", "transactions", max_per_trigger=2000, fail_on_data_loss=False)
    assert options == {
        "kafka.bootstrap.servers": "k:9092", "subscribe": "transactions", "startingOffsets": "earliest",
        "failOnDataLoss": "false", "maxOffsetsPerTrigger": "2000",
    }
    assert messages.kafka_source_options("k:9092", "t")["failOnDataLoss"] == "true"
    with pytest.raises(ValueError):
        messages.read_transaction_stream(None, "carrier-pigeon", "here")
