"""Daily KPIs.

Flow metrics count what happened on a date; stock metrics are the state of all subscriptions at its
end. Instead of rebuilding the state per date, each subscription's end-of-day state is compared
with its previous one; the differences are summed per date and accumulated over the dates.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.ordering import EVENT_ORDER
from billtide.functions.times import event_date, moment

METRICS = ["new_subscriptions", "new_cancellations", "active_subscriptions", "mrr"]


def day_states(history: DataFrame) -> DataFrame:
    """End-of-day state of each subscription on each date it has events, and whether it was created or cancelled then.

    Rows without a subscription make one row per date, which keeps the date and counts for nothing.
    """
    return _per_subscription_and_date(history, None)


def kpi_flow_daily(history: DataFrame) -> DataFrame:
    """Distinct subscriptions created and cancelled per event date."""
    return per_date(_per_subscription_and_date(history, None)).select(
        "date", "new_subscriptions", "new_cancellations"
    )


def kpi_stock_daily(history: DataFrame, start_date=None) -> DataFrame:
    """Active subscriptions and monthly recurring revenue at the end of each event date."""
    return _accumulate(history, start_date).select("date", "active_subscriptions", "mrr")


def kpi_daily(history: DataFrame, snapshot_time, start_date=None) -> DataFrame:
    """One KPI row per date that has events, from ``start_date`` on (all dates without one)."""
    return _accumulate(history, start_date).select(
        "date",
        *METRICS,
        F.lit(schema.KPI_CURRENCY).alias("currency"),
        moment(snapshot_time).alias("snapshot_time"),
    )


def _accumulate(history, start_date):
    # the only window without a partition: one row per calendar date
    so_far = Window.orderBy(F.col("date").asc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    return per_date(_per_subscription_and_date(history, start_date)).select(
        "date",
        "new_subscriptions",
        "new_cancellations",
        F.sum("active_change").over(so_far).alias("active_subscriptions"),
        F.sum("mrr_change").over(so_far).cast(schema.MONEY_SUM).alias("mrr"),
    ).where("date IS NOT NULL")


def _per_subscription_and_date(history, start_date):
    """End-of-day state and flow flags. Everything before ``start_date`` falls into one group with
    a null date, which carries the earlier state into the first date."""
    date = event_date()
    history = history.where("event_time IS NOT NULL")
    if start_date is not None:
        start = start_date if hasattr(start_date, "alias") else F.lit(start_date).cast("date")
        date = F.when(date >= start, date)
    last = F.max(F.struct(*EVENT_ORDER, "status", "price"))
    return (
        history.groupBy("subscription_id", date.alias("date"))
        .agg(
            last.alias("last"),
            F.max(F.col("event_type") == "subscription_created").alias("created"),
            F.max(F.col("event_type") == "subscription_cancelled").alias("cancelled"),
        )
        .select(
            "subscription_id",
            "date",
            F.coalesce(F.col("last.status") == "active", F.lit(False)).alias("active"),
            F.coalesce("last.price", F.lit(0).cast(schema.MONEY)).alias("price"),
            "created",
            "cancelled",
        )
    )


def per_date(states: DataFrame) -> DataFrame:
    """Flows and changes of the stocks per date, from all end-of-day states of some subscriptions."""
    by_date = Window.partitionBy("subscription_id").orderBy(F.col("date").asc_nulls_first())
    # rows without a subscription keep their date in the result but count for nothing
    known = F.col("subscription_id").isNotNull()
    active = F.when(F.col("active") & known, 1).otherwise(0)
    revenue = F.when(F.col("active") & known, F.col("price")).otherwise(
        F.lit(0).cast(schema.MONEY)
    )
    changes = states.select(
        "date",
        (known & F.col("created")).alias("created"),
        (known & F.col("cancelled")).alias("cancelled"),
        (active - F.lag(active, 1, 0).over(by_date)).alias("active_change"),
        (revenue - F.coalesce(F.lag(revenue).over(by_date), F.lit(0).cast(schema.MONEY))).alias(
            "mrr_change"
        ),
    )
    return changes.groupBy("date").agg(
        F.count_if("created").alias("new_subscriptions"),
        F.count_if("cancelled").alias("new_cancellations"),
        F.sum("active_change").alias("active_change"),
        F.sum("mrr_change").alias("mrr_change"),
    )


def latest_kpi(kpis: DataFrame) -> DataFrame:
    """The KPI row of the last date."""
    return kpis.orderBy(F.col("date").desc()).limit(1)
