"""The orders that decide which event wins."""

from pyspark.sql import Column
from pyspark.sql import functions as F

EVENT_ORDER = ["event_time", "ingested_at", "event_id"]
ARRIVAL_ORDER = ["ingested_at", "event_id"]


def sort_columns(columns=EVENT_ORDER) -> list[Column]:
    """Ascending, nulls last: the order in which tables are shown and stored."""
    return [F.col(c).asc_nulls_last() for c in columns]
