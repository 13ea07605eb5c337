import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from cardlens.session import session_builder  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = (
        session_builder("tests")
        .master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        # not UTC, with daylight saving: results must not depend on it
        .config("spark.sql.session.timeZone", "Europe/Paris")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make(spark):
    """Transactions from (txn_id, card_id, "YYYY-MM-DD HH:MM", amount, state, is_fraud)."""

    def build(rows):
        schema = (
            "txn_id bigint, card_id bigint, ts string, amount double, "
            "merchant_state string, is_fraud int"
        )
        df = spark.createDataFrame(rows, schema)
        return df.selectExpr(
            "txn_id", "card_id", "card_id AS user_id", "cast(ts AS timestamp_ntz) AS event_ts",
            "amount", "merchant_state", "is_fraud",
        )

    return build
