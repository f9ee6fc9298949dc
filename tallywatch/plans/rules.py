"""Anomaly rules on the metric table, for every user, and the alerts report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallywatch.functions.scalars import or_zero, ratio_or_zero, round2
from tallywatch.schema import TRAILING_WINDOWS, RuleConfig

# Report headings.
ALERT_COLUMNS = {
    "user": "user",
    "bank": "bank",
    "fraud_reasons": "triggered_rules",
    "count_sent_3h": "tx_cnt_3h",
    "avg_amount_sent_3h": "avg_amt_3h",
    "avg_amount_sent_life": "avg_amt_life",
    "x_amount_vs_life": "x_amt/life",
    "distinct_sent_3h": "dist_recv_3h",
    "distinct_sent_life": "dist_recv_life",
    "x_network_vs_life": "x_dist/life",
    "x_burst_vs_7d": "x_cnt/expected",
}
_TEXT = {"user", "bank", "fraud_reasons"}


def amount_ratio() -> Column:
    """3-hour average sent amount against the life average."""
    return ratio_or_zero(or_zero("avg_amount_sent_3h"), or_zero("avg_amount_sent_life"))


def network_ratio() -> Column:
    """Share of all receivers ever that were paid within 3 hours."""
    return ratio_or_zero(or_zero("distinct_sent_3h"), or_zero("distinct_sent_life"))


def burst_ratio() -> Column:
    """3-hour count against the count a 3-hour slice of the last 7 days would hold on average."""
    slice_of_week = F.lit(TRAILING_WINDOWS["3h"] / TRAILING_WINDOWS["7d"])
    return ratio_or_zero(or_zero("count_sent_3h"), or_zero("count_sent_7d") * slice_of_week)


def _not_below_usual_amount() -> Column:
    return or_zero("avg_amount_sent_3h") >= or_zero("avg_amount_sent_life")


def is_amount_spike(rules: RuleConfig = RuleConfig()) -> Column:
    enough = or_zero("count_sent_3h") >= rules.amount_min_count
    return (amount_ratio() > rules.amount_ratio) & enough


def is_network_fan_out(rules: RuleConfig = RuleConfig()) -> Column:
    enough = or_zero("distinct_sent_3h") >= rules.network_min_distinct
    return (
        (network_ratio() >= rules.network_ratio)
        & enough
        & _not_below_usual_amount()
        & (or_zero("distinct_sent_life") > 0)
    )


def is_activity_burst(rules: RuleConfig = RuleConfig()) -> Column:
    enough = or_zero("count_sent_3h") >= rules.burst_min_count
    return (
        (burst_ratio() > rules.burst_ratio)
        & enough
        & _not_below_usual_amount()
        & (or_zero("count_sent_7d") > 0)
    )


def with_anomalies(metrics: DataFrame, rules: RuleConfig = RuleConfig()) -> DataFrame:
    """Metric rows plus one flag per rule, their OR, the reasons as text and the three ratios."""
    flagged = metrics.withColumns({
        "flag_amount": is_amount_spike(rules),
        "flag_network": is_network_fan_out(rules),
        "flag_burst": is_activity_burst(rules),
        "x_amount_vs_life": round2(amount_ratio()),
        "x_network_vs_life": round2(network_ratio()),
        "x_burst_vs_7d": round2(burst_ratio()),
    })
    reasons = [F.when(F.col(f"flag_{name}"), name.upper()) for name in ("amount", "network", "burst")]
    return flagged.withColumns({
        "anomaly": F.col("flag_amount") | F.col("flag_network") | F.col("flag_burst"),
        "fraud_reasons": F.concat_ws(" ", *reasons),
    })


def fraud_alerts(flagged: DataFrame) -> DataFrame:
    """Report of flagged users: missing numbers as 0, two decimals, display headings."""
    report = flagged.filter("anomaly").select(*ALERT_COLUMNS)
    return display_numbers(report, _TEXT).withColumnsRenamed(ALERT_COLUMNS)


def display_numbers(report: DataFrame, text: set[str]) -> DataFrame:
    """NULL to 0 in every number column; doubles to two decimals."""
    shown = []
    for name, kind in report.dtypes:
        if name in text or kind == "boolean":
            shown.append(F.col(name))
        else:
            filled = or_zero(name)
            shown.append((round2(filled) if kind == "double" else filled).alias(name))
    return report.select(*shown)
