import os
import sys

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import types as T

sys.path[:0] = [os.path.dirname(os.path.dirname(os.path.abspath(__file__))), os.path.dirname(os.path.abspath(__file__))]

from compare import at  # noqa: E402
from tallywatch.schema import LEDGER_SCHEMA, TX_COLUMNS  # noqa: E402
from tallywatch.session import pin_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield pin_session(session)
    session.stop()


@pytest.fixture(scope="session")
def tiny():
    return "/root/testdata/sf0.001"


TX_SCHEMA = T.StructType([f for f in LEDGER_SCHEMA.fields if f.name in TX_COLUMNS])


@pytest.fixture
def make_tx(spark):
    """Transactions from short tuples (sender, receiver, amount, ts[, tx_id[, sender bank, receiver bank]])."""

    def build(*rows):
        full = []
        for i, row in enumerate(rows):
            sender, receiver, amount, ts, *rest = row
            tx_id = rest[0] if rest else f"t{i}"
            banks = rest[1:] if len(rest) > 1 else ("bank_X", "bank_A")
            moment = None if ts is None else at(ts)
            full.append((banks[0], "pos", banks[0], banks[1], sender, receiver, amount, moment, "transfer", tx_id))
        return spark.createDataFrame(full, TX_SCHEMA)

    return build
