"""Keep-last deduplication and the merge of new events into the history."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.times import event_date

# rows of a batch whose ids Spark may broadcast; it guesses their size from compressed files, many times too low
BROADCAST_ROWS = 200_000


def last_per_key(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the one with the largest ``order``, ties broken by the rest of the row.

    Ranking for the first row only lets every map task drop all but its own first row of each key
    before the shuffle, so a key that holds a third of the table costs its reducer one row per map
    task. Nulls rank lowest.
    """
    ties = [c for c in df.columns if c not in keys and c not in order]
    newest_first = [F.col(c).desc_nulls_last() for c in [*order, *ties]]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest_first))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def dedup_events(events: DataFrame) -> DataFrame:
    """One row per ``event_id``: the delivery that was ingested last."""
    return last_per_key(events, ["event_id"], ["ingested_at", "event_time"])


def affected_dates(new_events: DataFrame) -> DataFrame:
    """The event dates that a batch touches, one row each."""
    return new_events.select(event_date().alias("dt")).where("dt IS NOT NULL").distinct()


def redelivered_dates(history: DataFrame, new_events: DataFrame) -> DataFrame:
    """The event dates on which the history holds an event of the batch, one row each.

    A new delivery may carry another event date than the stored one; the old copy then lies on a
    date the batch does not name. Of a stored history only the ids are read, and the date is the
    partition's.
    """
    date = F.col("dt") if "dt" in history.columns else event_date()
    ids = new_events.select("event_id").distinct()
    return (
        history.select("event_id", date.alias("dt"))
        .join(ids, "event_id", "left_semi")
        .select("dt")
        .distinct()
    )


def arrived_versions(
    merged: DataFrame, new_events: DataFrame, batch_rows: int = 0, alone: bool = False
) -> DataFrame:
    """The rows that merging has left for the events of the batch.

    ``batch_rows`` is the size of the batch where it is known: the ids of a large one are shuffled, never collected
    and broadcast. ``alone`` says that the batch was merged with nothing, so what has an id is the batch's.
    """
    if alone:
        return merged.where("event_id IS NOT NULL")
    ids = new_events.select("event_id").distinct()
    if batch_rows > BROADCAST_ROWS:
        ids = ids.hint("shuffle_hash")
    return merged.join(ids, "event_id", "left_semi")


def restrict_to_dates(history: DataFrame, dates: list) -> DataFrame:
    """Only the named event dates. With a ``dt`` partition column no other folder is opened."""
    column = F.col("dt") if "dt" in history.columns else event_date()
    return history.where(column.isin(list(dates)))


def merge_events(existing: DataFrame, new_events: DataFrame) -> DataFrame:
    """Union by name, then keep the last delivery of each event; on equal times the batch wins."""
    schema.require_columns(new_events, ["event_time", "ingested_at", "event_id"], "event batch")
    stored = existing.drop("dt").withColumn("_is_new", F.lit(0))
    arrived = new_events.drop("dt").withColumn("_is_new", F.lit(1))
    both = stored.unionByName(arrived, allowMissingColumns=True)
    return last_per_key(both, ["event_id"], ["ingested_at", "_is_new", "event_time"]).drop("_is_new")


def restrict_to_affected(history: DataFrame, new_events: DataFrame) -> DataFrame:
    """Only the event dates that a batch touches, as a semi join on the dates (one per calendar day).

    On a stored history the join key is its partition column, so other folders are pruned at run time.
    """
    if "dt" not in history.columns:
        history = history.withColumn("dt", event_date())
    return history.join(F.broadcast(affected_dates(new_events)), "dt", "left_semi")
