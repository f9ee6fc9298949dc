"""Table schemas and settings shared by batch and streaming code."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import types as T

# Wire field names, window lengths and labels every consumer of the tables relies on.
MESSAGE_FIELDS = {
    "msg_entity": T.StringType(),
    "app_type": T.StringType(),
    "send_entity": T.StringType(),
    "receive_entity": T.StringType(),
    "send_id": T.StringType(),
    "receive_id": T.StringType(),
    "amount": T.DoubleType(),
    "date": T.StringType(),
    "tx_type": T.StringType(),
    "tx_id": T.StringType(),
}
EVENT_TIME_PATTERN = "yyyy-MM-dd'T'HH:mm:ss'Z'"
TRAILING_WINDOWS = {"3h": 10_800, "7d": 604_800, "3w": 1_814_400, "3m": 7_776_000}
ROLES = ("sent", "recv")
PERIOD_HOURS = {"hourly": 1.0, "daily": 24.0, "weekly": 168.0, "monthly": 720.0}
APP_TYPES = ["mobile_app", "web_app", "atm", "pos", "ussd"]
BANKS = ["bank_X", "bank_A", "bank_B"]

SPANS = (*TRAILING_WINDOWS, "life")

MESSAGE_SCHEMA = T.StructType([T.StructField(name, kind) for name, kind in MESSAGE_FIELDS.items()])

# The ledger keeps the message without its raw date text, plus the parsed event time.
TX_COLUMNS = [
    "msg_entity", "app_type", "send_entity", "receive_entity", "send_id", "receive_id",
    "amount", "ts", "tx_type", "tx_id",
]
LEDGER_SCHEMA = T.StructType(
    [T.StructField(c, MESSAGE_FIELDS.get(c, T.TimestampType())) for c in TX_COLUMNS]
    + [T.StructField("dt", T.DateType()), T.StructField("batch_id", T.LongType())]
)

RECENT_COLUMNS = ["send_id", "receive_id", "amount", "ts", "send_entity", "receive_entity", "tx_type", "tx_id"]


def metric_columns() -> list[str]:
    """Column order of the wide per-user metric table (45 columns)."""
    cols = ["user", "bank"]
    for role in ROLES:
        for span in SPANS:
            cols += [f"count_{role}_{span}", f"avg_amount_{role}_{span}", f"distinct_{role}_{span}"]
        cols += [f"total_{role}", f"first_seen_{role}"]
    cols.append("elapsed_hours")
    cols += [f"avg_{period}_{role}" for role in ROLES for period in PERIOD_HOURS]
    return cols


@dataclass(frozen=True)
class RuleConfig:
    """Thresholds of the three anomaly rules; each compares a user with that user's own history."""

    amount_ratio: float = 3.0
    amount_min_count: int = 3
    network_ratio: float = 0.5
    network_min_distinct: int = 5
    burst_ratio: float = 5.0
    burst_min_count: int = 5


@dataclass(frozen=True)
class MonitorConfig:
    """Where the streaming monitor keeps its tables and how it runs."""

    data_dir: str
    bootstrap: str = "kafka:9092"
    topic: str = "transactions"
    starting_offsets: str = "earliest"
    trigger: str = "5 seconds"
    max_per_trigger: int | None = None
    fail_on_data_loss: bool = True
    incremental: bool = True
    dedup: bool = False
    late_after_seconds: int = 600
    recent_seconds: int = 120
    output_files: int | None = None
    compact_every: int = 20
    keep_versions: int = 2
    keep_log: int = 10_000
    clock: Callable[[], datetime] | None = None
    #: Called with the name of each table that a batch has just written; an error in it ends the batch there.
    after_write: Callable[[str], None] | None = None

    @property
    def ledger(self) -> str:
        return f"{self.data_dir}/tx_store"

    @property
    def ids(self) -> str:
        return f"{self.data_dir}/ids"

    @property
    def state(self) -> str:
        return f"{self.data_dir}/state"

    @property
    def user_metrics(self) -> str:
        return f"{self.data_dir}/output/user_metrics"

    @property
    def recent_tx(self) -> str:
        return f"{self.data_dir}/output/recent_tx"

    @property
    def batch_log(self) -> str:
        return f"{self.data_dir}/output/batch_log"

    @property
    def progress(self) -> str:
        return f"{self.data_dir}/progress"

    @property
    def checkpoint(self) -> str:
        return f"{self.data_dir}/checkpoints/monitor"
