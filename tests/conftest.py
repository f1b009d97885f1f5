import os
import sys
from datetime import datetime
from decimal import Decimal

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from billtide import schema  # noqa: E402

DATA = "/root/testdata"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .appName("tests")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.default.parallelism", "2")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


PRICE = {plan: Decimal(price) for plan, _, _, price in schema.PLANS}


def at(text):
    """``03-01 10:00`` to a time in 2024, seconds and fractions allowed."""
    day, clock = text.split(" ")
    pattern = "%Y-%m-%d %H:%M" + (":%S" if clock.count(":") == 2 and "." not in clock else "")
    if "." in clock:
        pattern = "%Y-%m-%d %H:%M:%S.%f"
    return datetime.strptime(f"2024-{day} {clock}", pattern)


def event(event_id, subscription, kind, time, ingested=None, **changes):
    """One event in the contract; ``kind`` without the ``subscription_`` prefix."""
    kind = kind if kind == "payment_failed" else f"subscription_{kind}"
    plan = changes.pop("plan_id", "basic_monthly")
    row = {
        "event_id": event_id,
        "event_time": at(time),
        "event_type": kind,
        "schema_version": "1.0",
        "user_id": f"user_{subscription}",
        "subscription_id": subscription,
        "plan_id": plan,
        "billing_cycle": "monthly",
        "price": PRICE.get(plan, Decimal("9.99")),
        "currency": "USD",
        "status": schema.STATUS_AFTER.get(kind, "active"),
        "source": "system",
        "ingested_at": at(ingested or time),
    }
    row.update(changes)
    return tuple(row[c] for c in schema.EVENT_COLUMNS)


@pytest.fixture
def table(spark):
    """Builds a frame of events."""
    return lambda *rows: spark.createDataFrame(list(rows), schema.EVENT)


def kpi_rows(df):
    """(month-day, new, cancelled, active, mrr) in date order."""
    return [
        (
            r["date"].strftime("%m-%d"),
            r["new_subscriptions"],
            r["new_cancellations"],
            r["active_subscriptions"],
            str(r["mrr"]),
        )
        for r in df.orderBy("date").collect()
    ]
