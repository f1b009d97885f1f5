"""Subscription events derived from a generic ``events`` table.

``n`` is the numeric event id. Every row of the table becomes an event; one in twenty is delivered a
second time, a day later and from another source, as a message queue would after a lost
acknowledgement. Of these second deliveries some are corrections: the event happened two days earlier, or
twenty hours later, or to another subscription.
"""

from pyspark.sql import DataFrame, SparkSession

from billtide import schema
from billtide.functions.times import iso_text
from billtide.session import utc

# fixed values: source event -> subscription event; an error is one of two, by parity of the id
KIND = """CASE event_type
    WHEN 'signup' THEN 'subscription_created'
    WHEN 'purchase' THEN 'subscription_renewed'
    WHEN 'click' THEN 'subscription_upgraded'
    WHEN 'view' THEN 'subscription_downgraded'
    WHEN 'error' THEN if(n % 2 = 0, 'payment_failed', 'subscription_cancelled') END"""
LATEST_ARRIVAL_MINUTES = 4320
# fixed values: what a second delivery corrects
CORRECTED_TIME = """CAST(ts AS TIMESTAMP) + CASE WHEN again AND n % 60 = 0 THEN INTERVAL '-2' DAY
    WHEN again AND n % 60 = 20 THEN INTERVAL '20' HOUR ELSE INTERVAL '0' HOUR END"""
CORRECTED_SUBSCRIPTION = "user_id + if(again AND n % 100 = 40, 1, 0)"


def subscription_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First deliveries and redeliveries in the event contract, from one scan of the table."""
    plans = ", ".join(f"'{plan}'" for plan, *_ in schema.PLANS)
    prices = ", ".join(f"CAST('{price}' AS DECIMAL(10,2))" for *_, price in schema.PLANS)
    statuses = " ".join(f"WHEN '{e}' THEN '{s}'" for e, s in schema.STATUS_AFTER.items())
    return (
        utc(spark)
        .read.parquet(f"{sf_dir}/events.parquet")
        .withColumnRenamed("event_id", "n")
        .selectExpr(
            "n", "ts", "user_id", f"{KIND} AS kind",
            f"make_interval(0, 0, 0, 0, 0, CAST((n * 37) % {LATEST_ARRIVAL_MINUTES} AS INT)) AS delay",
            "explode(if(n % 20 = 0, array(false, true), array(false))) AS again",
        )
        .selectExpr(
            f"{padded('evt_', 'n', 9)} AS event_id",
            f"{CORRECTED_TIME} AS event_time",
            "kind AS event_type",
            f"'{schema.EVENT_SCHEMA_VERSION}' AS schema_version",
            f"{padded('user_', 'user_id', 5)} AS user_id",
            f"{padded('sub_', CORRECTED_SUBSCRIPTION, 5)} AS subscription_id",
            f"array({plans})[CAST(n % 3 AS INT)] AS plan_id",
            "'monthly' AS billing_cycle",
            f"array({prices})[CAST(n % 3 AS INT)] AS price",
            "'USD' AS currency",
            f"CASE kind {statuses} END AS status",
            "CASE WHEN again THEN 'mobile' WHEN n % 4 = 0 THEN 'web' WHEN n % 4 = 1 THEN 'mobile' "
            "ELSE 'system' END AS source",
            "CAST(ts AS TIMESTAMP) + delay + if(again, INTERVAL '1' DAY, INTERVAL '0' DAY) "
            "AS ingested_at",
        )
    )


def dirty_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same events as text, with a share of bad values in most columns, for the checks."""
    changed = {
        "event_time": "CASE WHEN n % 127 = 0 THEN 'not-a-time' WHEN n % 149 = 0 THEN '12:30' "
        "WHEN n % 151 = 0 THEN 'T12:30' WHEN n % 103 = 0 THEN "
        f"{iso_text('ingested_at + INTERVAL 1 HOUR')} ELSE {iso_text('event_time')} END",
        "schema_version": "if(n % 113 = 0, '0.9', schema_version)",
        "user_id": "if(n % 107 = 0, NULL, user_id)",
        "plan_id": "if(n % 131 = 0, 'gold_monthly', plan_id)",
        "price": "CASE WHEN n % 139 = 0 THEN 'abc' WHEN n % 157 = 0 THEN 'NaN' WHEN n % 137 = 0 THEN '-9.99' "
        "WHEN n % 101 = 0 THEN '1.00' ELSE CAST(price AS STRING) END",
        "currency": "if(n % 109 = 0, 'EUR', currency)",
        "status": "CASE WHEN n % 97 = 0 THEN if(status = 'active', 'cancelled', 'active') "
        "ELSE status END",
        "ingested_at": iso_text("ingested_at"),
    }
    numbered = subscription_events(spark, sf_dir).selectExpr(
        "*", "CAST(substring(event_id, 5) AS BIGINT) AS n"
    )
    return numbered.selectExpr(*[f"{changed.get(c, c)} AS {c}" for c in schema.EVENT_COLUMNS])


def tampered_snapshot(current: DataFrame) -> DataFrame:
    """A snapshot with missing, changed and invented subscriptions, for the reconciliation."""
    kept = current.where("right(subscription_id, 1) <> '0'").selectExpr(
        *[
            "CAST(if(right(subscription_id, 1) = '1', current_price + 1, current_price) "
            "AS DECIMAL(10,2)) AS current_price"
            if c == "current_price"
            else c
            for c in current.columns
        ]
    )
    invented = current.sparkSession.sql("SELECT * FROM VALUES ('sub_99999') AS invented (subscription_id)")
    return kept.unionByName(invented, allowMissingColumns=True)


def padded(prefix, number, width):
    """At least ``width`` digits; a longer number stays whole."""
    digits = f"CAST({number} AS STRING)"
    return f"concat('{prefix}', lpad({digits}, greatest(length({digits}), {width}), '0'))"
