"""State of subscriptions: now, and as of any date."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.ordering import EVENT_ORDER
from billtide.functions.times import event_date, moment
from billtide.operators.dedup import last_per_key
from billtide.session import written

STATE_COLUMNS = [
    "subscription_id",
    "user_id",
    "plan_id",
    "billing_cycle",
    "price",
    "currency",
    "status",
    "event_type",
    "event_time",
]
# what decides between events of equal time
TIES = ["ingested_at", "event_id"]


def last_events(history: DataFrame, columns=STATE_COLUMNS) -> DataFrame:
    """The last event of each subscription; rows without a subscription are left out."""
    schema.require_columns(history, {*columns, *EVENT_ORDER}, "history")
    kept = history.where("subscription_id IS NOT NULL").select(
        *columns, *[c for c in EVENT_ORDER if c not in columns]
    )
    return last_per_key(kept, ["subscription_id"], EVENT_ORDER).select(*columns)


def current_state(history: DataFrame, snapshot_time) -> DataFrame:
    """The current snapshot, one row per subscription."""
    return _as_snapshot(last_events(history), snapshot_time)


def current_with_order(history: DataFrame, snapshot_time) -> DataFrame:
    """The snapshot with the two columns that say how late its last event is in the event order."""
    return _as_snapshot(last_events(history, [*STATE_COLUMNS, *TIES]), snapshot_time)


def advance_current(old: DataFrame, arrived: DataFrame, snapshot_time) -> DataFrame:
    """The snapshot (with order) after events have arrived, without a look at the history.

    ``arrived`` holds the rows that the history now has for the events of the batch. Each
    subscription's last event is the later of the old one and the last that arrived. That is right
    for all subscriptions but those in ``withdrawn``.
    """
    source = {name: column for name, column in zip(_snapshot_names(), [*STATE_COLUMNS, *TIES])}
    before = old.select(*[F.col(name).alias(column) for name, column in source.items()])
    both = before.unionByName(arrived.select(*source.values()))
    return _as_snapshot(last_events(both, [*STATE_COLUMNS, *TIES]), snapshot_time)


def withdrawn(old: DataFrame, arrived: DataFrame) -> DataFrame:
    """Subscriptions whose last event was delivered again with an earlier time or for another one.

    What came before that event is not in the snapshot, so their state must be found in the history.
    """
    again = arrived.selectExpr(
        "event_id AS last_event_id",
        "event_time AS new_time",
        "subscription_id AS new_subscription",
    )
    gone = "new_time < last_event_time OR NOT (new_subscription <=> subscription_id)"
    return (
        old.select("subscription_id", "last_event_id", "last_event_time")
        .join(again, "last_event_id")
        .where(gone)
        .select("subscription_id")
        .distinct()
    )


def refresh_current(
    old: DataFrame, arrived: DataFrame, history: DataFrame, snapshot_time, undecided: DataFrame | None = None
) -> DataFrame:
    """The snapshot (with order) brought up to date at the cost of what arrived.

    The history is read only when there are withdrawn subscriptions, and only for these. ``undecided`` are the
    withdrawn ones where the caller has stored them: of a stored table Spark knows the size, and while it is small
    the history is not shuffled to meet it.
    """
    advanced = advance_current(old, arrived, snapshot_time)
    if undecided is None:
        undecided = written(withdrawn(old, arrived), "withdrawn")
    if undecided.isEmpty():
        return advanced
    again = current_with_order(
        history.join(undecided, "subscription_id", "left_semi"), snapshot_time
    )
    # subscriptions that the withdrawn events now belong to are among those that have advanced
    return advanced.join(undecided, "subscription_id", "left_anti").unionByName(again)


def _snapshot_names():
    renamed = {source: name for name, source in schema.CURRENT_FROM_HISTORY.items()}
    renamed |= {"ingested_at": "last_ingested_at", "event_id": "last_event_id"}
    return [renamed.get(c, c) for c in [*STATE_COLUMNS, *TIES]]


def _as_snapshot(last: DataFrame, snapshot_time) -> DataFrame:
    names = dict(zip([*STATE_COLUMNS, *TIES], _snapshot_names()))
    return last.select(
        *[F.col(c).alias(names[c]) for c in last.columns],
        moment(snapshot_time).alias("snapshot_time"),
    )


def end_of_day_states(history: DataFrame, columns=("status", "plan_id", "price")) -> DataFrame:
    """The last event of each subscription on each date it has events."""
    kept = history.where("subscription_id IS NOT NULL").select(
        "subscription_id", event_date().alias("date"), *EVENT_ORDER, *columns
    )
    return last_per_key(kept, ["subscription_id", "date"], EVENT_ORDER)


def state_intervals(history: DataFrame, columns=("status", "plan_id", "price")) -> DataFrame:
    """Validity intervals ``[valid_from, valid_to)`` of each subscription's end-of-day state.

    ``valid_to`` is null for the state that still holds. The window sees one row per subscription
    and date, so even the busiest subscription has no more rows than the calendar has days.
    """
    by_date = Window.partitionBy("subscription_id").orderBy("date")
    return end_of_day_states(history, columns).select(
        "subscription_id",
        F.col("date").alias("valid_from"),
        F.lead("date").over(by_date).alias("valid_to"),
        *columns,
        F.col("event_id").alias("last_event_id"),
    )


def state_as_of(history: DataFrame, dates: DataFrame, columns=("status", "plan_id", "price")):
    """The state of every subscription at the end of each date in ``dates`` (column ``date``).

    The asked dates, one per calendar day at most, travel to the intervals as one sorted array; an interval
    gives rise to the asked dates it contains and to no others.
    """
    asked = dates.where("date IS NOT NULL").agg(F.sort_array(F.collect_set("date")).alias("asked"))
    inside = F.filter(
        "asked",
        lambda d: (d >= F.col("valid_from")) & (F.col("valid_to").isNull() | (d < F.col("valid_to"))),
    )
    return (
        state_intervals(history, columns)
        .withColumn("asked", asked.scalar())
        .withColumn("date", F.explode(inside))
        .select("date", "subscription_id", *columns, "last_event_id")
    )
