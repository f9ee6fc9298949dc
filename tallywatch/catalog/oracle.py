"""The registered queries in DuckDB SQL over the given tables."""

from __future__ import annotations

from tallywatch.catalog.queries import LATE_AFTER_SECONDS
from tallywatch.fixtures import BAD_LINES, BURST_PROFILES, ODD_LINES
from tallywatch.plans.rules import ALERT_COLUMNS
from tallywatch.schema import (
    APP_TYPES, BANKS, PERIOD_HOURS, RECENT_COLUMNS, ROLES, SPANS, TRAILING_WINDOWS, TX_COLUMNS, metric_columns,
)

TX = ", ".join(TX_COLUMNS)


def _pick(values: list[str], index: str) -> str:
    items = ", ".join(f"'{v}'" for v in values)
    return f"list_extract([{items}], ({index} % {len(values)}) + 1)"


def _user(number: str) -> str:
    return f"printf('user_%07d', cast({number} as bigint))"


_K = "cast(regexp_extract(props, '[0-9]+') as bigint)"

EVENTS = f"""tx_events AS (
  SELECT {_pick(BANKS, 'user_id')} AS msg_entity, {_pick(APP_TYPES, 'event_id')} AS app_type,
         {_pick(BANKS, 'user_id')} AS send_entity, {_pick(BANKS, _K)} AS receive_entity,
         {_user('user_id')} AS send_id, {_user(_K)} AS receive_id, value AS amount,
         cast(date_trunc('second', ts) AS timestamp) AS ts, event_type AS tx_type,
         cast(event_id AS varchar) AS tx_id
  FROM events)"""


def _profile_rows(kind: str, count: str, fan: str, amount: str, age: str) -> str:
    return f"""
  SELECT {_pick(BANKS, 'sender')}, 'mobile_app', {_pick(BANKS, 'sender')}, {_pick(BANKS, f'(i % {fan})')},
         {_user('sender')}, {_user(f'i % {fan}')}, {amount},
         (SELECT max(ts) FROM tx_events) - to_seconds({age}), 'transfer',
         '{kind}-' || {_user('sender')} || '-' || cast(i AS varchar)
  FROM profiles, unnest(range(0, {count})) AS r(i)"""


_PROFILES = ", ".join(str(p) for p in BURST_PROFILES)
BURST = f"""{EVENTS},
profiles(sender, hn, hfan, ha, bn, bfan, ba) AS (
  SELECT sender, hn, hfan, cast(ha AS double), bn, bfan, cast(ba AS double)
  FROM (VALUES {_PROFILES}) AS v(sender, hn, hfan, ha, bn, bfan, ba)),
tx_burst AS (
  SELECT {TX} FROM tx_events
  UNION ALL {_profile_rows('h', 'hn', 'hfan', 'ha', '14400 + i * 5400')}
  UNION ALL {_profile_rows('b', 'bn', 'bfan', 'ba', 'i * 30')})"""

LINEITEM = f"""tx_lineitem AS (
  SELECT {_pick(BANKS, 'o_custkey')} AS msg_entity, o_orderpriority AS app_type,
         {_pick(BANKS, 'o_custkey')} AS send_entity, {_pick(BANKS, 'l_suppkey')} AS receive_entity,
         'cust_' || o_custkey AS send_id, 'supp_' || l_suppkey AS receive_id,
         round_even(l_extendedprice * (1 - l_discount), 2) AS amount, cast(l_shipdate AS timestamp) AS ts,
         l_returnflag AS tx_type, l_orderkey || '-' || l_linenumber AS tx_id
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

FIXTURES = {"tx_events": EVENTS, "tx_burst": BURST, "tx_lineitem": LINEITEM}


def _now(t: str) -> str:
    return f"(SELECT max(ts) FROM {t})"


def _start(t: str, seconds: int) -> str:
    return f"{_now(t)} - INTERVAL {seconds} SECOND"


def _on(t: str, body: str, *more: str) -> str:
    return "WITH " + ",\n".join([FIXTURES[t], *more]) + "\n" + body


def _legs(t: str) -> str:
    return f"""legs AS (
  SELECT 'sent' AS role, send_id AS "user", receive_id AS counterparty, send_entity AS bank, amount, ts, tx_id FROM {t}
  UNION ALL
  SELECT 'recv', receive_id, send_id, receive_entity, amount, ts, tx_id FROM {t})"""


# Through text both ways, which rounds once and rightly.
_EXACT = "cast(cast(amount AS varchar) AS decimal(38,9))"
_SUM = f"cast(cast(sum({_EXACT}) FILTER ({{c}}) AS varchar) AS double)"


def _in_span(t: str, span: str) -> str:
    return "true" if span == "life" else f"ts >= {_start(t, TRAILING_WINDOWS[span])}"


def _measures(t: str, role: str, spans) -> list[str]:
    out = []
    for span in spans:
        c = f"role = '{role}' AND {_in_span(t, span)}"
        n = f"nullif(count(*) FILTER ({c}), 0)"
        out += [
            f"{n} AS count_{role}_{span}",
            f"{_SUM.format(c=c)} / {n} AS avg_amount_{role}_{span}",
            f"CASE WHEN {n} IS NOT NULL THEN count(DISTINCT counterparty) FILTER ({c}) END AS distinct_{role}_{span}",
        ]
    return out


def _life(role: str) -> list[str]:
    c = f"role = '{role}'"
    return [f"{_SUM.format(c=c)} AS total_{role}", f"min(ts) FILTER ({c}) AS first_seen_{role}"]


def _metrics(t: str) -> str:
    sums = [m for role in ROLES for m in _measures(t, role, SPANS) + _life(role)]
    averages = [
        f"coalesce(total_{role}, 0) / (elapsed_hours / {hours}) AS avg_{period}_{role}"
        for role in ROLES for period, hours in PERIOD_HOURS.items()
    ]
    return f"""{_legs(t)},
sums AS (SELECT "user", min(bank) AS bank, {', '.join(sums)} FROM legs WHERE "user" IS NOT NULL GROUP BY "user"),
aged AS (SELECT *, greatest((epoch({_now(t)}) - epoch(least(first_seen_sent, first_seen_recv))) / 3600.0::double, 1.0::double)
         AS elapsed_hours FROM sums),
metrics AS (SELECT *, {', '.join(averages)} FROM aged)"""


METRICS = ", ".join(f'"{c}"' for c in metric_columns())

FLAGGED = """flagged AS (
  SELECT *, flag_amount OR flag_network OR flag_burst AS anomaly,
         trim(CASE WHEN flag_amount THEN 'AMOUNT ' ELSE '' END || CASE WHEN flag_network THEN 'NETWORK ' ELSE '' END
              || CASE WHEN flag_burst THEN 'BURST' ELSE '' END) AS fraud_reasons,
         round_even(ra, 2) AS x_amount_vs_life, round_even(rn, 2) AS x_network_vs_life, round_even(rb, 2) AS x_burst_vs_7d
  FROM (SELECT *, ra > 3 AND c3 >= 3 AS flag_amount,
               rn >= 0.5 AND d3 >= 5 AND a3 >= al AND dl > 0 AS flag_network,
               rb > 5 AND c3 >= 5 AND a3 >= al AND c7 > 0 AS flag_burst
        FROM (SELECT *, coalesce(a3 / nullif(al, 0), 0) AS ra, coalesce(d3 / nullif(dl, 0), 0) AS rn,
                     coalesce(c3 / nullif(c7 * (3.0::double / 168.0::double), 0), 0) AS rb
              FROM (SELECT *, coalesce(avg_amount_sent_3h, 0) AS a3, coalesce(avg_amount_sent_life, 0) AS al,
                           coalesce(count_sent_3h, 0) AS c3, coalesce(count_sent_7d, 0) AS c7,
                           coalesce(distinct_sent_3h, 0) AS d3, coalesce(distinct_sent_life, 0) AS dl FROM metrics))))"""

RECENT = f"recent AS (SELECT * FROM tx_burst WHERE ts >= {_start('tx_burst', 120)})"
RECENT_USERS = """recent_users AS (
  SELECT *, row_number() OVER (ORDER BY last_ts DESC NULLS LAST, "user") AS rank FROM (
    SELECT "user", max(ts) AS last_ts FROM (
      SELECT send_id AS "user", ts FROM recent UNION ALL SELECT receive_id, ts FROM recent)
    WHERE "user" IS NOT NULL GROUP BY "user" ORDER BY last_ts DESC NULLS LAST, "user" LIMIT 20))"""
VIEW = """view AS (SELECT f.*, r.rank FROM flagged f JOIN recent_users r ON f."user" = r."user")"""
FLAG_COLUMNS = "flag_amount, flag_network, flag_burst, x_amount_vs_life, x_network_vs_life, x_burst_vs_7d, anomaly, fraud_reasons"


def _burst(body: str, *more: str) -> str:
    return _on("tx_burst", body, _metrics("tx_burst"), FLAGGED, *more)


def _shown(body: str) -> str:
    return _burst(body, RECENT, RECENT_USERS, VIEW)


def _money(name: str) -> str:
    return f"round_even(coalesce({name}, 0), 2) AS {name}"


def _number(name: str) -> str:
    return f"coalesce({name}, 0) AS {name}"


# Messages as the decoder should return them: the fixture, then the broken and odd lines field by field.
_DATE = "strftime(ts, '%Y-%m-%dT%H:%M:%SZ')"
_DECODED_LITERALS = [
    ("NULL", "NULL", "NULL", "NULL", "NULL"),
    ("'user_0000001'", "'user_0000002'", "1.0", "'2024-01-15T00:00:00Z'", "NULL"),
    ("'user_0000001'", "'user_0000002'", "NULL", "'2024-01-15T00:00:00Z'", "'bad-amount'"),
    ("'user_0000001'", "'user_0000002'", "NULL", "'2024-01-15T00:00:00Z'", "'bad-quoted'"),
    ("'user_0000001'", "'user_0000002'", "3.25", "'nope'", "'odd-date'"),
    ("'user_0000001'", "'user_0000002'", "4.5", "NULL", "'no-date'"),
]
assert len(_DECODED_LITERALS) == len(BAD_LINES) + len(ODD_LINES)
DECODED = "decoded AS (\n  SELECT msg_entity, app_type, send_entity, receive_entity, send_id, receive_id, amount, " + (
    f"{_DATE} AS date, tx_type, tx_id FROM tx_burst"
    + "".join(
        f"\n  UNION ALL SELECT NULL, NULL, NULL, NULL, {s}, {r}, cast({a} AS double), {d}, NULL, {i}"
        for s, r, a, d, i in _DECODED_LITERALS
    )
) + ")"
_TS = "try_strptime(date, '%Y-%m-%dT%H:%M:%SZ')"
TIMED = f"timed AS (SELECT *, {_TS} AS ts, cast({_TS} AS date) AS dt FROM decoded)"
VALID = "tx_id IS NOT NULL AND amount IS NOT NULL"
COUNTS = f"""SELECT count(*) AS batch_rows, count(*) FILTER (NOT ({VALID})) AS rejected_rows,
  count(*) FILTER ({VALID} AND ts < {_start('tx_burst', LATE_AFTER_SECONDS)}) AS late_rows FROM timed"""

ALL_METRICS = _on("tx_burst", f"SELECT {METRICS} FROM metrics", _metrics("tx_burst"))


def _side(t: str, role: str, columns: list[str]) -> str:
    return _on(t, f"""SELECT "user", {', '.join(columns)} FROM legs WHERE role = '{role}' AND "user" IS NOT NULL GROUP BY "user" """, _legs(t))


BALANCE = f"""moves AS (
  SELECT *, CASE WHEN role = 'sent' THEN -{_EXACT} ELSE {_EXACT} END AS change FROM legs),
balances AS (
  SELECT "user", role, counterparty, tx_id, ts, amount,
         cast(cast(sum(change) OVER (PARTITION BY "user" ORDER BY ts, tx_id, role, counterparty, amount
              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS varchar) AS double) AS balance
  FROM moves WHERE "user" IS NOT NULL),
flags AS (SELECT *, role = 'sent' AND balance < 0 AS overdraft FROM balances)"""

_SERIES = f"""WITH {BURST},
counts AS (SELECT date_trunc('second', ts) AS second, count(*) AS n FROM tx_burst
           WHERE ts >= {_start('tx_burst', 60)} GROUP BY 1)
SELECT cast(s AS timestamp) AS second, coalesce(n, 0) AS tx_count
FROM (SELECT unnest(generate_series((SELECT min(second) FROM counts), (SELECT max(second) FROM counts), INTERVAL 1 SECOND)) AS s)
LEFT JOIN counts ON s = second"""

ORACLE: dict[str, str] = {
    "src_stream_lines": _on("tx_events", f"""SELECT msg_entity, app_type, send_entity, receive_entity, send_id, receive_id, amount,
        {_DATE} AS date, tx_type, tx_id FROM tx_events"""),
    "src_rate_limited": "SELECT count(*) AS tx_rows, cast(2 AS bigint) AS micro_batches FROM events",
    "decode_json": _on("tx_burst", "SELECT * FROM decoded", DECODED),
    "encode_json": _on("tx_burst", f"SELECT {TX}, cast(ts AS date) AS dt FROM tx_burst"),
    "ledger_scan": _on("tx_burst", f"SELECT {TX}, cast(ts AS date) AS dt FROM tx_burst WHERE ts >= {_start('tx_burst', 604_800)}"),
    "ledger_append_idempotent": _on("tx_burst", """
        SELECT cast(ts AS date) AS dt, cast(0 AS bigint) AS batch_id, count(*) AS tx_rows FROM tx_events GROUP BY 1
        UNION ALL SELECT cast(ts AS date), cast(1 AS bigint), count(*) FROM tx_burst GROUP BY 1"""),
    "src_data_loss": _on("tx_events", f"""SELECT cast(ts AS date) AS dt, count(*) AS tx_rows FROM tx_events
        WHERE ts < {_start('tx_events', 604_800)} GROUP BY 1"""),
    "snapshot_latest": _on("tx_burst", """SELECT "user", min(bank) AS bank FROM legs GROUP BY 1""", _legs("tx_burst")),
    "publish_user_metrics": ALL_METRICS,
    "recent_tx": _on("tx_burst", f"SELECT {', '.join(RECENT_COLUMNS)} FROM recent", RECENT),
    "batch_observed_counts": _on("tx_burst", COUNTS, DECODED, TIMED),
    "clean_tx": _on("tx_burst", f"SELECT {TX}, dt FROM timed WHERE {VALID}", DECODED, TIMED),
    "parse_event_time": _on("tx_burst", "SELECT tx_id, date, ts, dt FROM timed", DECODED, TIMED),
    "legs": _on("tx_burst", 'SELECT role, "user", counterparty, amount, ts FROM legs', _legs("tx_burst")),
    "window_filter_7d": _on("tx_burst", f"SELECT {TX} FROM tx_burst WHERE ts >= {_start('tx_burst', 604_800)}"),
    "self_transfers": _on("tx_events", f"SELECT {TX} FROM tx_events WHERE send_id = receive_id"),
    "dedup_tx": _on("tx_lineitem", f"""SELECT {TX} FROM (SELECT *, row_number() OVER (PARTITION BY tx_id ORDER BY ts,
        {', '.join(c for c in TX_COLUMNS if c not in ('tx_id', 'ts'))}) AS rn FROM tx_lineitem) WHERE rn = 1"""),
    "scalar_pack": _on("tx_events", f"""SELECT tx_id, {_DATE} AS date, cast(epoch(ts) AS bigint) AS epoch,
        least(amount, 50.0::double) AS capped, greatest(amount, 1.0::double) AS floored,
        coalesce(amount / nullif(round_even(amount / 100.0::double, 0), 0), 0) AS ratio,
        round_even(amount / 3.0::double, 2) AS third,
        concat_ws(' ', CASE WHEN amount > 100 THEN 'HIGH' END, CASE WHEN hour(ts) < 6 THEN 'NIGHT' END) AS reasons,
        {_user('cast(epoch(ts) AS bigint) % 1000')} AS made_id FROM tx_events"""),
    "running_balance": _on("tx_events", "SELECT * FROM flags", _legs("tx_events"), BALANCE),
    "overdrafts": _on("tx_events", "SELECT * FROM flags WHERE overdraft", _legs("tx_events"), BALANCE),
    "user_metrics": ALL_METRICS,
    "user_metrics_lineitem": _on("tx_lineitem", f"SELECT {METRICS} FROM metrics", _metrics("tx_lineitem")),
    "metrics_join_form": ALL_METRICS,
    "lifetime_sent": _side("tx_burst", "sent", _measures("tx_burst", "sent", ["life"]) + _life("sent")),
    "lifetime_recv": _side("tx_lineitem", "recv", _measures("tx_lineitem", "recv", ["life"]) + _life("recv")),
    "window_metrics_sent": _side("tx_burst", "sent", _measures("tx_burst", "sent", TRAILING_WINDOWS)),
    "window_metrics_recv": _side("tx_burst", "recv", _measures("tx_burst", "recv", TRAILING_WINDOWS)),
    "distinct_counterparties": _on("tx_lineitem", 'SELECT "user", role, ' + ", ".join(
        f"count(DISTINCT counterparty) FILTER ({_in_span('tx_lineitem', span)}) AS distinct_{span}" for span in SPANS
    ) + ' FROM legs GROUP BY 1, 2', _legs("tx_lineitem")),
    "account_age": _on("tx_burst", 'SELECT "user", least(first_seen_sent, first_seen_recv) AS first_seen, elapsed_hours FROM metrics',
                       _metrics("tx_burst")),
    "periodic_averages": _on("tx_burst", 'SELECT "user", ' + ", ".join(
        f"avg_{period}_{role}" for role in ROLES for period in PERIOD_HOURS) + " FROM metrics", _metrics("tx_burst")),
    "user_bank": _on("tx_burst", """SELECT "user", min(bank) AS bank FROM legs GROUP BY 1""", _legs("tx_burst")),
    "pair_edges": _on("tx_lineitem", f"""SELECT "user", role, counterparty, count(*) AS tx_count, {_SUM.format(c='true')} AS total,
        min(ts) AS first_ts, max(ts) AS last_ts FROM legs GROUP BY 1, 2, 3""", _legs("tx_lineitem")),
    "rule_amount": _burst('SELECT "user", x_amount_vs_life, flag_amount FROM flagged'),
    "rule_network": _burst('SELECT "user", x_network_vs_life, flag_network FROM flagged'),
    "rule_burst": _burst('SELECT "user", x_burst_vs_7d, flag_burst FROM flagged'),
    "anomaly_flags": _burst(f'SELECT "user", {FLAG_COLUMNS} FROM flagged'),
    "fraud_alerts": _burst("SELECT " + ", ".join(
        f'"{c}" AS "{shown}"' if c in ("user", "bank", "fraud_reasons") else
        (f'coalesce({c}, 0) AS "{shown}"' if c.startswith(("count", "distinct")) else f'round_even(coalesce({c}, 0), 2) AS "{shown}"')
        for c, shown in ALERT_COLUMNS.items()) + " FROM flagged WHERE anomaly"),
    "recent_users": _on("tx_burst", "SELECT * FROM recent_users", RECENT, RECENT_USERS),
    "recent_user_metrics_semi": _shown(f'SELECT {METRICS} FROM metrics WHERE "user" IN (SELECT "user" FROM recent_users)'),
    "recent_users_view": _shown(f"SELECT {METRICS}, {FLAG_COLUMNS}, rank FROM view"),
    "published_dashboard": _shown(f"SELECT {METRICS}, {FLAG_COLUMNS}, rank FROM view"),
    "published_dashboard_fallback": _burst(f"""SELECT {METRICS}, {FLAG_COLUMNS}, row_number() OVER (ORDER BY count_sent_3h DESC, "user") AS rank
        FROM flagged WHERE count_sent_3h IS NOT NULL ORDER BY rank LIMIT 20"""),
    "most_active_topk": _burst("""SELECT "user", bank, count_sent_3h FROM metrics WHERE count_sent_3h IS NOT NULL
        ORDER BY count_sent_3h DESC, "user" LIMIT 20"""),
    "top10_displayed": _shown("""SELECT "user", coalesce(count_sent_3h, 0) AS tx_sent_3h, anomaly FROM view
        ORDER BY count_sent_3h DESC NULLS LAST, "user" LIMIT 10"""),
    "view_avg_amounts": _shown('SELECT "user", bank, anomaly, ' + ", ".join(
        _money(f"avg_amount_{role}_{span}") for span in SPANS for role in ROLES) + " FROM view"),
    "view_counts_network": _shown('SELECT "user", bank, anomaly, ' + ", ".join(
        _number(f"{m}_{role}_{span}") for span in SPANS for m in ("count", "distinct") for role in ROLES) + " FROM view"),
    "view_lifetime": _shown('SELECT "user", bank, ' + ", ".join(
        [_money(f"total_{role}") for role in ROLES]
        + [_number(f"{m}_{role}_life") for m in ("count", "distinct") for role in ROLES]
        + [_money(f"avg_{period}_sent") for period in PERIOD_HOURS]) + " FROM view"),
    "activity_last_window": _on("tx_burst", f"""SELECT count(*) AS tx_count, count(*) / 10.0::double AS tx_per_sec
        FROM tx_burst WHERE ts >= {_start('tx_burst', 10)}"""),
    "tx_per_second": _SERIES,
    "monitor_summary": _burst(f"""SELECT
        (SELECT count(*) FROM tx_burst WHERE ts >= {_start('tx_burst', 10)}) AS tx_last_10s,
        (SELECT count(*) / 10.0::double FROM tx_burst WHERE ts >= {_start('tx_burst', 10)}) AS tx_per_sec,
        count(*) AS tracked_users, count(*) FILTER (anomaly) AS flagged_users FROM flagged"""),
    "stream_monitor": ALL_METRICS,
    "stream_incremental_metrics": ALL_METRICS,
    "stream_monitor_dedup": ALL_METRICS,
    "stream_restart_no_dup": _on("tx_burst", """SELECT cast(ts AS date) AS dt, count(*) AS tx_rows,
        count(DISTINCT tx_id) AS tx_ids FROM tx_burst GROUP BY 1"""),
    "stream_late_rows": _on("tx_burst", COUNTS, DECODED, TIMED),
    "stream_dedup": _on("tx_burst", f"SELECT {TX} FROM tx_burst"),
    "stream_tx_per_second": _on("tx_burst", f"""SELECT cast(date_trunc('second', ts) AS timestamp) AS second, count(*) AS tx_count
        FROM tx_burst GROUP BY 1"""),
}
