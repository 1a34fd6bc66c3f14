from __future__ import annotations

import json
import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shopstream.session import build_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="shopstream-tests", shuffle_partitions=4)
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shopstream-test-")


def ev(event_id, event_type, product_id="prod-001", *, event_time="2024-01-01T00:00:30.000Z",
       ingested_at=None, category="casa", cart_action=None, total_value=0.0, unit_price=10.0,
       quantity=1, delivery_status=None, order_id=None, **extra):
    d = {
        "event_id": event_id, "schema_version": "1.0", "event_type": event_type,
        "event_time": event_time, "ingested_at": ingested_at or event_time, "source": "web",
        "user_id": "user-0001", "session_id": "sess-user-0001-01", "product_id": product_id,
        "category": category, "quantity": quantity, "unit_price": unit_price,
        "total_value": total_value, "cart_action": cart_action, "order_id": order_id,
        "delivery_status": delivery_status,
    }
    d.update(extra)
    return d


def lines_df(spark, events):
    rows = [(e if isinstance(e, str) else json.dumps(e, separators=(",", ":")),) for e in events]
    return spark.createDataFrame(rows, "value string")


def write_lines(path, events, mtime=None):
    with open(path, "w") as fh:
        for e in events:
            fh.write((e if isinstance(e, str) else json.dumps(e, separators=(",", ":"))) + "\n")
    if mtime is not None:
        os.utime(path, (mtime, mtime))
