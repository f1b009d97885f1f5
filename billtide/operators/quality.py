"""Data-quality checks.

A check is one row (layer, dataset, check_name, passed, violation_count, details). Everything that
can be judged row by row is counted in a single aggregate over the table, so a suite reads its table
once; key uniqueness adds one grouped count beside it. Details hold counts; the offending values and
rows themselves come from the listing functions, which stay distributed.
"""

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtide import schema
from billtide.functions.catalog import with_catalog, with_expected_status
from billtide.functions.times import parsed_or_null

MISSING = "-1"
OFFENDERS = 10
# times between them have four digits for the year, and so are what their text says
FIRST_TIME, LAST_TIME = "0001-01-02 00:00:00", "9999-12-30 00:00:00"
# characters of an offending value that are shown
SHOWN = 200


@dataclass(frozen=True)
class Check:
    """``counts`` are named SQL aggregates. ``violations`` names those that add up to the violation
    count, by default all. The check passes when that is zero and every count in ``needed`` is not.
    ``offending`` is SQL for what is wrong with a row, as text, and null for a row that is right."""

    name: str
    counts: dict[str, str]
    violations: tuple[str, ...] | None = None
    needed: tuple[str, ...] = ()
    offending: str | None = None


# ---- single checks ----


def not_empty() -> Check:
    return Check("not_empty", {"row_count": "count(1)"}, (), ("row_count",))


def required_columns(df: DataFrame, columns) -> Check:
    missing = [c for c in columns if c not in df.columns]
    return Check("required_columns", {"missing_columns": str(len(missing))})


def non_null(df: DataFrame, columns) -> Check:
    """No nulls; a column that is not there counts as -1 and fails."""
    counts = {f"nulls_{c}": _count(df, [c], f"{c} IS NULL") for c in columns}
    return Check("non_null_columns", counts)


def datetime_parseable(df: DataFrame, columns) -> Check:
    """Every value is a time; null counts as bad."""
    counts = {f"invalid_{c}": _count(df, [c], f"{_time(df, c)} IS NULL") for c in columns}
    wrong = [_text(df, [c], f"{_time(df, c)} IS NULL", c) for c in columns]
    return Check("datetime_parseable", counts, offending=f"coalesce({', '.join([*wrong, 'NULL'])})")


def allowed_values(df: DataFrame, column, allowed) -> Check:
    """Only the allowed values; nulls pass."""
    return Check(
        f"{column}_allowed_values",
        {"invalid_rows": _count(df, [column], _outside(column, allowed))},
        offending=_text(df, [column], _outside(column, allowed), column),
    )


def not_after(df: DataFrame, left, right, name=None) -> Check:
    """``left`` is no later than ``right`` wherever both are times."""
    later = f"{_time(df, left)} > {_time(df, right)}"
    return Check(
        name or f"{left}_le_{right}", {"failed_rows": _count(df, [left, right], later)}
    )


def non_negative(df: DataFrame, column, name=None) -> Check:
    """Numbers of at least zero; nulls pass, text that is no number does not."""
    number = finite_or_null(column)
    counts = {
        "not_numeric": _count(df, [column], f"{column} IS NOT NULL AND {number} IS NULL"),
        "negative": _count(df, [column], f"{number} < 0"),
    }
    wrong = f"{column} IS NOT NULL AND {number} IS NULL OR {number} < 0"
    return Check(name or f"{column}_non_negative", counts, offending=_text(df, [column], wrong, column))


def finite_or_null(column: str) -> str:
    """A number; text that is none, NaN and the infinities become null."""
    number = f"try_cast({column} AS DOUBLE)"
    return f"if(abs({number}) < double('Infinity'), {number}, NULL)"


def schema_version_expected(df: DataFrame) -> Check:
    """The only version present is the expected one, and it is present."""
    expected = f"'{schema.EVENT_SCHEMA_VERSION}'"
    counts = {
        "expected_rows": _count(df, ["schema_version"], f"schema_version = {expected}"),
        "other_rows": _count(df, ["schema_version"], f"schema_version <> {expected}"),
    }
    other = _text(df, ["schema_version"], f"schema_version <> {expected}", "schema_version")
    return Check("schema_version_expected", counts, ("other_rows",), ("expected_rows",), other)


def plan_in_catalog(df: DataFrame) -> Check:
    known = [plan for plan, *_ in schema.PLANS]
    return Check(
        "plan_id_exists_in_catalog",
        {"invalid_rows": _count(df, ["plan_id"], _outside("plan_id", known))},
        offending=_text(df, ["plan_id"], _outside("plan_id", known), "plan_id"),
    )


def plan_attributes_match(df: DataFrame) -> Check:
    """Price and cycle equal the catalog's; null is a mismatch, an unknown plan is skipped."""
    needs = ["plan_id", "price", "billing_cycle"]
    return Check(
        "plan_attributes_match_catalog", {"invalid_rows": _count(df, needs, ATTRIBUTES_DIFFER)},
        offending=_text(df, needs, ATTRIBUTES_DIFFER, *needs),
    )


def status_matches_event_type(df: DataFrame) -> Check:
    """The status is the one the event type leads to; null is a mismatch, unknown types pass."""
    needs = ["event_type", "status"]
    return Check(
        "event_type_status_consistency", {"invalid_rows": _count(df, needs, STATUS_DIFFERS)},
        offending=_text(df, needs, STATUS_DIFFERS, *needs),
    )


# needs ``with_catalog``; prices are compared as numbers whatever type the table keeps them in
ATTRIBUTES_DIFFER = """expected_price IS NOT NULL
    AND NOT (try_cast(price AS DOUBLE) <=> CAST(expected_price AS DOUBLE)
             AND billing_cycle <=> expected_billing_cycle)"""

# needs ``with_expected_status``
STATUS_DIFFERS = "expected_status IS NOT NULL AND NOT (status <=> expected_status)"


def _time(df, column):
    """``parsed_or_null``, without a look at the text of what is a time already."""
    parsed = parsed_or_null(column)
    if column not in df.columns or not isinstance(df.schema[column].dataType, T.TimestampType):
        return parsed
    return f"if({column} BETWEEN TIMESTAMP'{FIRST_TIME}' AND TIMESTAMP'{LAST_TIME}', {column}, {parsed})"


def _count(df, needs, condition):
    return f"count_if({condition})" if set(needs) <= set(df.columns) else MISSING


def _text(df, needs, condition, *columns):
    """The columns of a row that is wrong as text joined by slashes, a missing one as ``-``."""
    if not set(needs) <= set(df.columns):
        return None
    parts = ", ".join(f"coalesce(CAST({c} AS STRING), '-')" for c in columns)
    return f"if({condition}, left(concat_ws('/', {parts}), {SHOWN}), NULL)"


def _outside(column, allowed):
    return f"{column} NOT IN ({', '.join(repr(v) for v in allowed)})"


def key_unique(df: DataFrame, columns, name: str, layer: str, dataset: str) -> DataFrame:
    """Rows beyond the first of each key; null equals null."""
    if not set(columns) <= set(df.columns):
        return run_checks(df, [Check(name, {"duplicate_count": MISSING})], layer, dataset)
    per_key = df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies"))
    duplicates = "coalesce(sum(copies - 1), 0)"
    return run_checks(per_key, [Check(name, {"duplicate_count": duplicates})], layer, dataset)


# ---- running checks ----


def run_checks(df: DataFrame, checks: list[Check], layer: str, dataset: str) -> DataFrame:
    """All ``checks`` in one aggregate over ``df``, one result row per check."""
    counts, rows = [], []
    for i, check in enumerate(checks):
        counts += [f"CAST({sql} AS BIGINT) AS `{i}_{name}`" for name, sql in check.counts.items()]
        summed = check.counts if check.violations is None else check.violations
        violations = " + ".join([f"abs(`{i}_{name}`)" for name in summed]) or "0L"
        passed = " AND ".join([f"{violations} = 0", *[f"`{i}_{n}` > 0" for n in check.needed]])
        details = ", ".join(f"'{name}', CAST(`{i}_{name}` AS STRING)" for name in check.counts)
        rows.append(
            f"struct('{check.name}' AS check_name, {passed} AS passed, "
            f"{violations} AS violation_count, map({details}) AS details)"
        )
    return df.selectExpr(*counts).selectExpr(
        f"'{layer}' AS layer", f"'{dataset}' AS dataset", f"inline(array({', '.join(rows)}))"
    )


def offenders(df: DataFrame, checks: list[Check], limit: int = OFFENDERS) -> DataFrame:
    """(check_name, value): the first few distinct offending values of each check, in order.

    Equal values are counted down to one and ranks beyond the limit dropped by each task before a shuffle, so
    however many there are, a check's task sees a few from each.
    """
    found = ", ".join(
        f"if(({c.offending}) IS NULL, NULL, named_struct('check_name', '{c.name}', 'value', {c.offending}))"
        for c in checks
        if c.offending
    )
    values = df.selectExpr(f"inline(array_compact(array({found})))").distinct()
    rank = F.row_number().over(Window.partitionBy("check_name").orderBy("value"))
    return values.withColumn("_rank", rank).where(F.col("_rank") <= limit).drop("_rank")


def with_offenders(results: DataFrame, found: DataFrame) -> DataFrame:
    """Check rows whose details also hold their ``offenders``, sorted and joined by commas."""
    listed = found.groupBy("check_name").agg(
        F.array_join(F.array_sort(F.collect_list("value")), ",").alias("_offenders")
    )
    details = "if(_offenders IS NULL, details, map_concat(details, map('offenders', _offenders)))"
    joined = results.join(listed, "check_name", "left").withColumn("details", F.expr(details))
    return joined.select(*results.columns)


def event_offenders(events: DataFrame) -> DataFrame:
    """What ``check_events`` counts, by value."""
    return offenders(_looked_up(events), event_checks(events))


def history_offenders(history: DataFrame) -> DataFrame:
    """What ``check_history`` counts, by value; event ids that occur twice are in ``duplicate_keys``."""
    return offenders(history, history_checks(history))


def check_events(events: DataFrame) -> DataFrame:
    """The contract of incoming events, parsed or still as text."""
    return run_checks(_looked_up(events), event_checks(events), "bronze", "subscription_events")


def _looked_up(events):
    if "plan_id" in events.columns:
        events = with_catalog(events)
    return with_expected_status(events) if "event_type" in events.columns else events


def event_checks(events: DataFrame) -> list[Check]:
    return [
        not_empty(),
        required_columns(events, schema.EVENT_COLUMNS),
        non_null(events, schema.EVENT_COLUMNS),
        datetime_parseable(events, ["event_time", "ingested_at"]),
        allowed_values(events, "event_type", schema.EVENT_TYPES),
        allowed_values(events, "billing_cycle", schema.BILLING_CYCLES),
        allowed_values(events, "currency", schema.CURRENCIES),
        allowed_values(events, "status", schema.STATUSES),
        allowed_values(events, "source", schema.SOURCES),
        not_after(events, "event_time", "ingested_at"),
        schema_version_expected(events),
        non_negative(events, "price"),
        plan_in_catalog(events),
        plan_attributes_match(events),
        status_matches_event_type(events),
    ]


def check_history(history: DataFrame) -> DataFrame:
    layer, dataset = "silver", "subscription_state_history"
    return run_checks(history, history_checks(history), layer, dataset).unionByName(
        key_unique(history, ["event_id"], "event_id_unique", layer, dataset)
    )


def history_checks(history: DataFrame) -> list[Check]:
    return [
        not_empty(),
        required_columns(history, schema.HISTORY_COLUMNS),
        non_null(history, schema.HISTORY_COLUMNS),
        datetime_parseable(history, ["event_time", "ingested_at"]),
        allowed_values(history, "status", schema.STATUSES),
        not_after(history, "event_time", "ingested_at"),
    ]


def check_stored_order(out_of_place: DataFrame) -> DataFrame:
    """The check of the order in which history files hold their rows, from their count of those out of place."""
    check = Check("sorted_by_event_order", {"out_of_place": "sum(out_of_place)"})
    return run_checks(out_of_place, [check], "silver", "subscription_state_history")


def check_current(current: DataFrame) -> DataFrame:
    """The snapshot on its own; ``reconcile.check_current_vs_history`` compares it."""
    layer, dataset = "silver", "subscription_state_current"
    checks = [
        not_empty(),
        required_columns(current, schema.CURRENT.fieldNames()),
        non_null(current, schema.CURRENT.fieldNames()),
        datetime_parseable(current, ["last_event_time", "snapshot_time"]),
        allowed_values(current, "current_status", schema.STATUSES),
    ]
    return run_checks(current, checks, layer, dataset).unionByName(
        key_unique(current, ["subscription_id"], "subscription_id_unique", layer, dataset)
    )


def check_kpis(kpis: DataFrame) -> DataFrame:
    """The KPI table on its own; ``reconcile.check_kpi_vs_current`` compares it."""
    layer, dataset = "gold", "kpi_daily"
    checks = [
        not_empty(),
        required_columns(kpis, schema.KPI.fieldNames()),
        non_null(kpis, schema.KPI.fieldNames()),
        datetime_parseable(kpis, ["snapshot_time"]),
        allowed_values(kpis, "currency", schema.CURRENCIES),
        non_negative(kpis, "new_subscriptions"),
        non_negative(kpis, "new_cancellations"),
        non_negative(kpis, "active_subscriptions"),
        non_negative(kpis, "mrr"),
    ]
    return run_checks(kpis, checks, layer, dataset).unionByName(
        key_unique(kpis, ["date"], "date_unique", layer, dataset)
    )


# ---- verdict ----


def verdict(checks: DataFrame) -> DataFrame:
    """One row per dataset: whether all checks passed and the names of those that did not."""
    failed = "array_sort(collect_list(if(passed, NULL, check_name)))"
    return checks.groupBy("layer", "dataset").agg(
        F.bool_and("passed").alias("passed"),
        F.count(F.lit(1)).alias("check_count"),
        F.expr("count_if(NOT passed)").alias("failed_check_count"),
        F.expr(f"array_join({failed}, ',')").alias("failed_checks"),
    )


def raise_if_failed(checks: DataFrame) -> list:
    """Runs the checks, raises ``ValueError`` naming the failed ones, else returns the result rows.

    The rows are the checks of a suite, some twenty, whatever the size of the table.
    """
    return judged(checks.collect())


def judged(results: list) -> list:
    """The rows of checks that have run; raises if any failed, naming all that did."""
    failed: dict[str, dict] = {}
    for r in results:
        if not r["passed"]:
            failed.setdefault(f"{r['layer']}.{r['dataset']}", {})[r["check_name"]] = r["violation_count"]
    if failed:
        raise ValueError("; ".join(f"{where} failed its checks: {found}" for where, found in failed.items()))
    return results


# ---- listings ----


def null_counts(df: DataFrame, columns) -> DataFrame:
    """(column_name, null_count) for each column."""
    return _per_column(df, {c: {"null_count": f"count_if({c} IS NULL)"} for c in columns})


def unparseable_times(df: DataFrame, columns) -> DataFrame:
    """(column_name, invalid_count): values that are null or no time."""
    return _per_column(
        df, {c: {"invalid_count": f"count_if({parsed_or_null(c)} IS NULL)"} for c in columns}
    )


def number_problems(df: DataFrame, columns) -> DataFrame:
    """(column_name, not_numeric, negative) for each column."""
    return _per_column(df, {c: non_negative(df, c).counts for c in columns})


def duplicate_keys(df: DataFrame, columns) -> DataFrame:
    """Keys that occur more than once, with their number of copies."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def invalid_values(df: DataFrame, allowed: dict[str, list]) -> DataFrame:
    """(column_name, value, row_count) of every value outside its column's domain."""
    outside = ", ".join(
        f"if({_outside(c, values)}, named_struct('column_name', '{c}', 'value', {c}), NULL)"
        for c, values in allowed.items()
    )
    return (
        df.selectExpr(f"inline(array_compact(array({outside})))")
        .groupBy("column_name", "value")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def events_after_ingest(df: DataFrame) -> DataFrame:
    """Rows whose event time is later than their ingestion."""
    return df.where(f"{parsed_or_null('event_time')} > {parsed_or_null('ingested_at')}")


def unknown_plans(df: DataFrame) -> DataFrame:
    """(plan_id, row_count) of plans that the catalog lacks."""
    catalog = schema.plan_catalog(df.sparkSession).select("plan_id")
    return (
        df.where("plan_id IS NOT NULL")
        .join(F.broadcast(catalog), "plan_id", "left_anti")
        .groupBy("plan_id")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def plan_mismatches(df: DataFrame) -> DataFrame:
    """Rows of known plans whose price or cycle is not the catalog's."""
    return with_catalog(df).where(ATTRIBUTES_DIFFER).drop("tier")


def status_mismatch_pairs(df: DataFrame) -> DataFrame:
    """(event_type, status, row_count) of every combination that should not occur."""
    return (
        with_expected_status(df)
        .where(STATUS_DIFFERS)
        .groupBy("event_type", "status")
        .agg(F.count(F.lit(1)).alias("row_count"))
    )


def _per_column(df, counts):
    """One aggregate over ``df``, turned into a row per column."""
    flat = [
        f"{sql} AS `{c}_{name}`" for c, named in counts.items() for name, sql in named.items()
    ]
    rows = ", ".join(
        f"struct('{c}' AS column_name, "
        + ", ".join(f"`{c}_{name}` AS {name}" for name in named)
        + ")"
        for c, named in counts.items()
    )
    return df.selectExpr(*flat).selectExpr(f"inline(array({rows}))")
