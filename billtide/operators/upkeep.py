"""KPIs kept up by differences: what has changed in the end-of-day states is added to the stored rows.

Beside the KPIs the end-of-day states of subscriptions are stored by date. When events arrive late, move to another
date or subscription, or are withdrawn, the states of the touched dates are made anew and compared with the
stored ones. Only subscriptions that differ count: their old and new sequences of states give the old and new changes per
date, and the difference between the two, summed up over the dates, is what the stored KPIs are wrong by.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.times import moment
from billtide.operators.kpi import METRICS, per_date

STATE = ["subscription_id", "date", "active", "price", "created", "cancelled"]
FLOWS = {"new_subscriptions": "new_subscriptions", "new_cancellations": "new_cancellations"}
STOCKS = {"active_subscriptions": "active_change", "mrr": "mrr_change"}


def changed_subscriptions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Subscriptions whose end-of-day states (of the same dates) are not the same in both, one row each."""
    both = before.select(*STATE, F.lit(-1).alias("sign")).union(after.select(*STATE, F.lit(1).alias("sign")))
    differ = both.groupBy(*STATE).agg(F.sum("sign").alias("sign")).where("sign <> 0")
    return differ.where("subscription_id IS NOT NULL").select("subscription_id").distinct()


def kpi_differences(before: DataFrame, after: DataFrame) -> DataFrame:
    """``date`` and by how much the flows and the changes of the stocks differ between two sets of end-of-day states.

    Both hold all states of the subscriptions they are about.
    """
    measures = [*FLOWS.values(), *STOCKS.values()]
    old = per_date(before).select("date", *[(-F.col(m)).alias(m) for m in measures])
    both = old.unionByName(per_date(after).select("date", *measures))
    return both.groupBy("date").agg(*[F.sum(m).alias(m) for m in measures])


def renewed_kpis(
    kpis: DataFrame, states: DataFrame, made: DataFrame, dates: list, kept_dates: list, snapshot_time
) -> DataFrame:
    """The KPI rows from the first of ``dates`` on, after the states of ``dates`` have become ``made``.

    ``kpis`` and ``states`` are as stored, ``kept_dates`` the dates that have events now. The history isn't read. Stored
    states are read for the touched dates and, by a semi join, for the subscriptions that have changed; everything else
    has one row per calendar date.
    """
    touched = F.col("date").isin(list(dates))
    changed = changed_subscriptions(states.where(touched), made)
    mine = states.select(*STATE).join(changed, "subscription_id", "left_semi").select(*STATE)
    after = mine.where(~touched).union(made.select(*STATE).join(changed, "subscription_id", "left_semi").select(*STATE))
    differences = kpi_differences(mine, after)
    # one row per calendar date, here and in the window
    calendar = kpis.sparkSession.createDataFrame([(str(d),) for d in kept_dates], "date string")
    now = calendar.select(F.col("date").cast("date").alias("date"), F.lit(True).alias("kept"))
    by_date = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = kpis.select("date", *METRICS).join(differences.select("date", *[F.col(m).alias(f"d_{m}") for m in [*FLOWS.values(), *STOCKS.values()]]), "date", "full").join(now, "date", "full")
    flows = [(F.coalesce(F.col(m), F.lit(0)) + F.coalesce(F.col(f"d_{c}"), F.lit(0))).alias(m) for m, c in FLOWS.items()]
    stocks = [
        F.coalesce(F.last(m, ignorenulls=True).over(by_date), F.lit(0))
        + F.coalesce(F.sum(f"d_{c}").over(by_date), F.lit(0))
        for m, c in STOCKS.items()
    ]
    active, mrr = stocks
    return (
        rows.select("date", "kept", *flows, active.cast("bigint").alias("active_subscriptions"), mrr.cast(schema.MONEY_SUM).alias("mrr"))
        .where(F.col("kept") & (F.col("date") >= F.lit(min(dates)).cast("date")))
        .select("date", *METRICS, F.lit(schema.KPI_CURRENCY).alias("currency"), moment(snapshot_time).alias("snapshot_time"))
    )
