"""What is new since a mark, and what it touches.

The mark is a high-water mark on ``ingested_at``. It selects rows to process and drops none: however
old the event time of a new row is, its date is reopened.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide.functions.times import event_date, moment


def newer_than(events: DataFrame, mark, ingest_date: str | None = None) -> DataFrame:
    """Rows ingested strictly after ``mark``; all rows without one.

    ``ingest_date`` names the partition column that holds the date of ``ingested_at``, if the table
    has one: folders before the mark's date are then not opened. A history is partitioned by event
    date instead and must not name it, because late rows lie below the mark's date.
    """
    if mark is None:
        return events
    mark = moment(mark)
    if ingest_date:
        events = events.where(F.col(ingest_date) >= F.to_date(mark))
    return events.where(F.col("ingested_at") > mark)


def next_mark(events: DataFrame) -> DataFrame:
    """The mark after processing ``events``: one row, null when there are none."""
    return events.agg(F.max("ingested_at").alias("last_processed_ingested_at"))


def affected_start(events: DataFrame) -> DataFrame:
    """The earliest event date in ``events``: one row, null when there are none."""
    return events.agg(F.to_date(F.min("event_time")).alias("start_date"))


def late_events(events: DataFrame, mark) -> DataFrame:
    """New rows that belong to a date the pipeline had already passed at ``mark``."""
    passed = F.to_date(moment(mark))
    return (
        newer_than(events, mark)
        .where(event_date() < passed)
        .withColumn("days_late", F.datediff(F.to_date("ingested_at"), event_date()))
    )
