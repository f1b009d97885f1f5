"""State of subscriptions at moments that are asked for row by row."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.ordering import EVENT_ORDER
from billtide.operators.ordered import with_last

# events before asks of the same time, which therefore see them
AS_OF_ORDER = ["_time", "_asked", *EVENT_ORDER[1:]]


def state_at(
    history: DataFrame, asks: DataFrame, columns=("status", "plan_id", "price"), chunks: int | None = None
) -> DataFrame:
    """Each row of ``asks`` (``subscription_id``, ``asked_at`` and anything else) with the state of its
    subscription at that moment, events of the very moment included.

    The state is null for a subscription that has no event by then, or no id, and for a missing time. Events and
    asks are put in one order and the last event is carried to the asks behind it, so neither a busy
    subscription nor one that is asked for often comes into one task. Asks must not name their columns like
    the state's.
    """
    schema.require_columns(asks, ["subscription_id", "asked_at"], "asks")
    given = [*columns, "last_event_id"]
    if clash := sorted(set(given) & set(asks.columns)):
        raise ValueError(f"asks have columns of the state: {clash}")
    event = F.struct(*columns, F.col("event_id").alias("last_event_id"))
    events = history.where("subscription_id IS NOT NULL AND event_time IS NOT NULL").select(
        "subscription_id", F.col("event_time").alias("_time"), F.lit(0).alias("_asked"), *EVENT_ORDER[1:],
        event.alias("_event"),
    )
    asked = asks.select(
        "subscription_id", F.col("asked_at").alias("_time"), F.lit(1).alias("_asked"),
        F.struct(*[F.col(f"`{c}`") for c in asks.columns]).alias("_ask"),
    )
    both = events.unionByName(asked, allowMissingColumns=True)
    found = with_last(both, "subscription_id", AS_OF_ORDER, "_event", chunks).where("_asked = 1")
    return found.select("_ask.*", *[F.col(f"last.{c}").alias(c) for c in given])
