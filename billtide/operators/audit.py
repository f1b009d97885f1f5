"""Audits of the history against the subscription life cycle, and of arrival order."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.ordering import ARRIVAL_ORDER, EVENT_ORDER
from billtide.operators.ordered import in_chunks, with_max_before, with_previous


def illegal_transitions(history: DataFrame, chunks: int | None = None) -> DataFrame:
    """Events that may not follow the state their subscription was in.

    A subscription must begin with its creation and is created once; the top plan cannot be
    upgraded nor the lowest downgraded; nothing follows a cancellation.
    """
    before = F.col("previous")
    kind = F.col("event_type")
    legal = F.when(before.isNull(), kind == "subscription_created")
    for status, followers in schema.MAY_FOLLOW.items():
        legal = legal.when(
            before["status"] == status, kind.isin(followers) if followers else F.lit(False)
        )
    at_top = before["plan_id"].eqNullSafe(schema.HIGHEST_PLAN)
    at_bottom = before["plan_id"].eqNullSafe(schema.LOWEST_PLAN)
    beyond = ((kind == "subscription_upgraded") & at_top) | (
        (kind == "subscription_downgraded") & at_bottom
    )
    steps = _steps(history, ["status", "plan_id"], chunks)
    return steps.where(~F.coalesce(legal & ~beyond, F.lit(False))).select(
        "event_id",
        "subscription_id",
        "event_type",
        before["status"].alias("previous_status"),
        before["plan_id"].alias("previous_plan_id"),
    )


def plan_step_mismatches(history: DataFrame, chunks: int | None = None) -> DataFrame:
    """Events after which plan, price, billing cycle or status are not what the event implies.

    An upgrade moves one tier up and a downgrade one down, both ending at the outer tiers, and take price and billing
    cycle of the new plan; other events keep plan, price and cycle. First events are not judged. After a plan that is not
    in the catalog nothing is expected of a step to another plan, so every such step is a mismatch with nulls.
    """
    steps = _steps(history, ["plan_id", "price", "billing_cycle"], chunks)
    tiers = schema.plan_catalog(history.sparkSession)
    earlier = tiers.select(
        F.col("plan_id").alias("previous_plan_id"), F.col("tier").alias("previous_tier")
    )
    target = tiers.select(*[F.col(c).alias(f"target_{c}") for c in ("tier", "plan_id", "price", "billing_cycle")])
    kind = F.col("event_type")
    up, down = kind == "subscription_upgraded", kind == "subscription_downgraded"
    status = F.create_map(*[F.lit(x) for pair in schema.STATUS_AFTER.items() for x in pair])
    expected = lambda c: F.when(up | down, F.col(f"target_{c}")).otherwise(F.col(f"previous.{c}"))
    judged = (
        steps.where("previous IS NOT NULL")
        .withColumn("previous_plan_id", F.col("previous.plan_id"))
        .join(F.broadcast(earlier), "previous_plan_id", "left")
        .withColumn(
            "target_tier",
            F.when(up, F.least(F.col("previous_tier") + 1, F.lit(schema.TOP_TIER)))
            .when(down, F.greatest(F.col("previous_tier") - 1, F.lit(0))),
        )
        .withColumn("target_tier", F.when(F.col("previous_tier").isNotNull(), F.col("target_tier")))
        .join(F.broadcast(target), "target_tier", "left")
        .select(
            "event_id",
            "subscription_id",
            "event_type",
            "previous_plan_id",
            "plan_id",
            expected("plan_id").alias("expected_plan_id"),
            "price",
            expected("price").alias("expected_price"),
            "billing_cycle",
            expected("billing_cycle").alias("expected_billing_cycle"),
            "status",
            F.element_at(status, kind).alias("expected_status"),
        )
    )
    agrees = F.lit(True)
    for column in ("plan_id", "price", "billing_cycle", "status"):
        agrees = agrees & F.col(column).eqNullSafe(F.col(f"expected_{column}"))
    return judged.where(~agrees)


def out_of_order_events(history: DataFrame, chunks: int | None = None) -> DataFrame:
    """How many events arrived after a later one: over all events and within subscriptions.

    Arrival order is (``ingested_at``, ``event_id``); an event counts when its time lies below the
    largest event time that arrived before it.
    """
    arrived = history.select("event_time", *ARRIVAL_ORDER, "subscription_id")
    chunked = in_chunks(arrived, ARRIVAL_ORDER, chunks)
    whole = with_max_before(chunked, [], ARRIVAL_ORDER, "event_time")
    within = with_max_before(
        chunked.where("subscription_id IS NOT NULL"), ["subscription_id"], ARRIVAL_ORDER, "event_time"
    )
    return _count_late(whole, "overall").unionByName(_count_late(within, "within_subscription"))


def _count_late(df, scope):
    late = F.col("event_time") < F.col("max_before")
    return df.agg(F.count_if(late).alias("out_of_order")).select(
        F.lit(scope).alias("scope"), "out_of_order"
    )


def _steps(history, columns, chunks):
    wanted = [*EVENT_ORDER, "subscription_id", "event_type", "plan_id", "price", "billing_cycle", "status"]
    kept = history.where("subscription_id IS NOT NULL").select(*wanted)
    return with_previous(kept, "subscription_id", EVENT_ORDER, columns, chunks)
