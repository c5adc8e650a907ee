import os
import sys
from datetime import datetime, timedelta, timezone

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tillwatch.session import local_session  # noqa: E402

BASE = datetime(2024, 1, 10, 12, 0, 0, tzinfo=timezone.utc)
PAYMENT = ("transaction_id string, user_id string, merchant_id string, amount bigint, currency string, "
           "location struct<lat: double, lon: double>, ip_address string, device_id string, "
           "channel string, event_ts timestamp, status string, failure_reason string, txn_type string, "
           "original_txn_id string, experiment_group string, ingested_at timestamp, "
           "src_partition bigint, dt date, amount_vnd bigint")
HANOI, HCMC = (21.0278, 105.8342), (10.7769, 106.7009)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(4, "tests", {"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    yield session
    session.stop()


def at(seconds: float) -> datetime:
    return BASE + timedelta(milliseconds=round(seconds * 1000))


def payment(txn: str, seconds: float = 0, **kw) -> tuple:
    row = {
        "transaction_id": txn, "user_id": "U1", "merchant_id": "M0001", "amount": 100_000,
        "currency": "VND", "location": HANOI, "ip_address": "115.78.1.2", "device_id": "d1",
        "channel": "APP", "event_ts": at(seconds), "status": "SUCCESS", "failure_reason": None,
        "txn_type": "PAYMENT", "original_txn_id": None, "experiment_group": "TREATMENT",
        "ingested_at": at(seconds + 1), "src_partition": 0, "dt": at(seconds).date(),
    }
    row.update(kw)
    row.setdefault("amount_vnd", row["amount"])
    return tuple(row.values())


@pytest.fixture
def payments(spark):
    return lambda *rows: spark.createDataFrame(list(rows), PAYMENT)


def ids(df, col="transaction_id"):
    return sorted(r[0] for r in df.select(col).collect())
