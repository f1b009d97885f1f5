"""Lookups of event type and plan in the fixed reference tables (a handful of rows, broadcast)."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide import schema


def with_expected_status(df: DataFrame) -> DataFrame:
    """Adds ``expected_status``; null for an unknown event type."""
    return df.join(F.broadcast(schema.status_after_event(df.sparkSession)), "event_type", "left")


def with_catalog(df: DataFrame) -> DataFrame:
    """Adds ``expected_price``, ``expected_billing_cycle`` and ``tier``; null for an unknown plan."""
    catalog = schema.plan_catalog(df.sparkSession).select(
        "plan_id",
        "tier",
        F.col("price").alias("expected_price"),
        F.col("billing_cycle").alias("expected_billing_cycle"),
    )
    return df.join(F.broadcast(catalog), "plan_id", "left")
