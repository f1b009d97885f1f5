"""Comparisons between tables: snapshot against history, KPIs against snapshot."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.ordering import EVENT_ORDER
from billtide.operators import digest
from billtide.session import cut_lineage, written

SAMPLE_ROWS = 10
MATCHES_HISTORY = "current_matches_latest_history"


def expected_current(history: DataFrame) -> DataFrame:
    """What the snapshot should say, by aggregating instead of ranking, so that the two forms check
    each other. The last event travels inside the aggregate: one row per key and map task. Rows are sorted for
    it, by a hash of the key first.
    """
    compared = schema.CURRENT_FROM_HISTORY.values()
    row = F.struct(*EVENT_ORDER, *[c for c in compared if c not in EVENT_ORDER])
    return (
        history.where("subscription_id IS NOT NULL")
        .groupBy(F.xxhash64("subscription_id").alias("_hash"), "subscription_id")
        .agg(F.max(row).alias("last"))
        .select(
            "subscription_id", *[F.col(f"last.{c}").alias(f"expected_{c}") for c in compared]
        )
    )


def compare_current(current: DataFrame, history: DataFrame) -> DataFrame:
    """Full outer join of the snapshot with the history's last events.

    ``origin`` is ``both``, ``current_only`` or ``history_only``; ``mismatch`` says whether any
    compared column differs, null counting as different. Equal rows of the snapshot are counted
    into ``copies`` before the join.
    """
    return _compare(current, expected_current(history))


def _compare(current, expected):
    compared = list(schema.CURRENT_FROM_HISTORY)
    ours = (
        current.groupBy("subscription_id", *compared)
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("_current", F.lit(True))
    )
    theirs = expected.withColumn("_history", F.lit(True))
    same = F.lit(True)
    for ours_column, source in schema.CURRENT_FROM_HISTORY.items():
        same = same & F.coalesce(F.col(ours_column) == F.col(f"expected_{source}"), F.lit(False))
    origin = (
        F.when(F.col("_history").isNull(), "current_only")
        .when(F.col("_current").isNull(), "history_only")
        .otherwise("both")
    )
    return (
        ours.join(theirs, "subscription_id", "full_outer")
        .withColumn("origin", origin)
        .withColumn("mismatch", (F.col("origin") == "both") & ~same)
        .withColumn("copies", F.coalesce("copies", F.lit(1)))
        .drop("_current", "_history")
    )


def current_vs_history(current: DataFrame, history: DataFrame) -> DataFrame:
    """One row: missing in current, missing in history, mismatched."""
    return _counts(compare_current(current, history))


def current_vs_history_by_digests(current: DataFrame, history: DataFrame) -> DataFrame:
    """The same row, for tables that are expected to agree.

    Digests of buckets of subscriptions are compared first and only the rows of buckets that differ are joined.
    The last events of the history are written once, because both steps read them.
    """
    expected = written(expected_current(history), "expected")
    wrong = cut_lineage(unequal_buckets(current, expected))
    if wrong.isEmpty():
        return _counts(_compare(current.limit(0), expected.limit(0)))
    key = "subscription_id"
    return _counts(_compare(digest.within(current, key, wrong), digest.within(expected, key, wrong)))


def unequal_buckets(current: DataFrame, expected: DataFrame) -> DataFrame:
    """The buckets of subscriptions in which the snapshot and ``expected_current`` differ."""
    ours, key = list(schema.CURRENT_FROM_HISTORY), "subscription_id"
    # hashes depend on types
    theirs = expected.select(
        key,
        *[
            F.col(f"expected_{source}").cast(current.schema[name].dataType).alias(name)
            for name, source in schema.CURRENT_FROM_HISTORY.items()
        ],
    )
    return digest.differing_buckets(
        digest.bucket_digests(current, key, ours, 1), digest.bucket_digests(theirs, key, ours, 2)
    )


def _counts(compared):
    copies = F.col("copies")

    def counted(condition):
        return F.coalesce(F.sum(F.when(condition, copies)), F.lit(0))

    return compared.agg(
        counted(F.col("origin") == "history_only").alias("missing_in_current"),
        counted(F.col("origin") == "current_only").alias("missing_in_history"),
        counted(F.col("mismatch")).alias("mismatched"),
    )


def mismatch_sample(current: DataFrame, history: DataFrame, rows=SAMPLE_ROWS) -> DataFrame:
    """The first few mismatched subscriptions by id, with both sides' values."""
    shown = []
    for ours, source in schema.CURRENT_FROM_HISTORY.items():
        shown += [ours, f"expected_{source}"]
    compared = compare_current(current, history).where("mismatch")
    return compared.select("subscription_id", *shown).orderBy("subscription_id", *shown).limit(rows)


def differing_subscriptions(current: DataFrame, history: DataFrame, rows=SAMPLE_ROWS) -> DataFrame:
    """(check_name, value): the first few subscriptions that are missing on a side or mismatched, by id."""
    wrong = compare_current(current, history).where("mismatch OR origin <> 'both'")
    first = wrong.select("subscription_id").distinct().orderBy("subscription_id").limit(rows)
    return first.select(F.lit(MATCHES_HISTORY).alias("check_name"), F.col("subscription_id").alias("value"))


def check_current_vs_history(current: DataFrame, history: DataFrame, by_digests: bool = False) -> DataFrame:
    counts = (current_vs_history_by_digests if by_digests else current_vs_history)(current, history)
    names = counts.columns
    total = sum((F.col(c) for c in names), F.lit(0).cast("bigint"))
    return _check_row(
        counts, "silver", "subscription_state_current", MATCHES_HISTORY,
        total == 0, total, {c: F.col(c) for c in names},
    )


def kpi_vs_current(kpis: DataFrame, current: DataFrame) -> DataFrame:
    """One row: the last KPI row's stock metrics beside the same metrics of the snapshot.

    ``checked`` is false and both matches hold when either table is empty.
    """
    latest = kpis.agg(F.max(F.struct("date", "active_subscriptions", "mrr"))).scalar()
    active = F.col("current_status") == "active"
    compared = current.agg(
        F.count(F.lit(1)).alias("subscriptions"),
        F.count_if(active).alias("expected_active_subscriptions"),
        F.coalesce(
            F.sum(F.when(active, F.col("current_price"))), F.lit(0)
        ).cast(schema.MONEY_SUM).alias("expected_mrr"),
    ).withColumn("latest", latest)
    checked = F.col("latest").isNotNull() & (F.col("subscriptions") > 0)
    return compared.select(
        checked.alias("checked"),
        F.col("latest.date").alias("date"),
        F.col("latest.active_subscriptions").alias("actual_active_subscriptions"),
        "expected_active_subscriptions",
        F.col("latest.mrr").alias("actual_mrr"),
        "expected_mrr",
        (~checked | F.col("latest.active_subscriptions").eqNullSafe(
            F.col("expected_active_subscriptions")
        )).alias("active_subscriptions_match"),
        (~checked | F.col("latest.mrr").eqNullSafe(F.col("expected_mrr"))).alias("mrr_match"),
    )


def check_kpi_vs_current(kpis: DataFrame, current: DataFrame) -> DataFrame:
    compared = kpi_vs_current(kpis, current)
    wrong = (~F.col("active_subscriptions_match")).cast("bigint") + (~F.col("mrr_match")).cast(
        "bigint"
    )
    return _check_row(
        compared, "gold", "kpi_daily", "latest_kpi_matches_current_snapshot",
        wrong == 0, wrong, {c: F.col(c) for c in compared.columns},
    )


def _check_row(df, layer, dataset, name, passed, violations, details):
    pairs = [x for key, c in details.items() for x in (F.lit(key), c.cast("string"))]
    return df.select(
        F.lit(layer).alias("layer"),
        F.lit(dataset).alias("dataset"),
        F.lit(name).alias("check_name"),
        passed.alias("passed"),
        violations.cast("bigint").alias("violation_count"),
        F.create_map(*pairs).alias("details"),
    )
