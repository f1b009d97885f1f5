"""Small hand-computed cases."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from billtide import schema
from billtide.functions.times import moment
from billtide.operators import audit, dedup, incremental, kpi, quality, reconcile, state
from billtide.sources import tables
from tests.conftest import at, event, kpi_rows

NOW = "2024-06-01 00:00:00"

BASE = [
    event("a", "s1", "created", "03-01 10:00", "03-01 10:01"),
    event("b", "s1", "cancelled", "03-03 09:00", "03-03 09:01"),
    event("c", "s2", "created", "03-02 10:00", "03-02 10:01"),
]
LATE = event("d", "s1", "payment_failed", "03-02 08:00", "03-04 00:00")


def current(df):
    return {r["subscription_id"]: r for r in state.current_state(df, NOW).collect()}


def test_kpis_of_a_created_and_a_cancelled_subscription(table):
    assert kpi_rows(kpi.kpi_daily(table(*BASE), NOW)) == [
        ("03-01", 1, 0, 1, "9.99"),
        ("03-02", 1, 0, 2, "19.98"),
        ("03-03", 0, 1, 1, "9.99"),
    ]


def test_late_event_changes_its_date_and_not_the_one_before(table):
    history = table(*BASE, LATE)
    news = incremental.newer_than(history, at("03-03 09:01"))
    start = incremental.affected_start(news).first()["start_date"]
    assert start == at("03-02 00:00").date()
    assert kpi_rows(kpi.kpi_daily(history, NOW, start)) == [
        ("03-02", 1, 0, 1, "9.99"),
        ("03-03", 0, 1, 1, "9.99"),
    ]
    assert kpi_rows(kpi.kpi_daily(history, NOW))[0] == ("03-01", 1, 0, 1, "9.99")
    assert current(history) == current(table(*BASE))


def test_last_delivery_wins(table):
    twice = table(
        event("a", "s1", "created", "03-01 10:00", "03-02 00:00", source="mobile"),
        event("a", "s1", "created", "03-01 10:00", "03-01 10:01", source="web"),
    )
    assert [r["source"] for r in dedup.dedup_events(twice).collect()] == ["mobile"]


def test_events_without_id_count_as_copies(table):
    twice = table(
        event(None, "s1", "created", "03-01 10:00", "03-01 10:01"),
        event(None, "s2", "created", "03-01 10:00", "03-01 10:02"),
    )
    assert [r["subscription_id"] for r in dedup.dedup_events(twice).collect()] == ["s2"]


def test_equal_event_times_are_ordered_by_arrival(table):
    history = table(
        event("a", "s1", "created", "03-01 10:00", "03-01 10:01"),
        event("b", "s1", "payment_failed", "03-01 10:00", "03-01 10:02"),
    )
    assert current(history)["s1"]["current_status"] == "past_due"


def test_equal_times_are_ordered_by_id(table):
    history = table(
        event("b", "s1", "created", "03-01 10:00"), event("a", "s1", "cancelled", "03-01 10:00")
    )
    assert current(history)["s1"]["current_status"] == "active"


def test_a_missing_time_never_wins(table):
    history = table(
        event("b", "s1", "cancelled", "03-01 10:00", event_time=None),
        event("a", "s1", "created", "03-01 10:00"),
    )
    assert current(history)["s1"]["current_status"] == "active"


def test_rows_without_subscription_are_no_subscription(table):
    history = table(*BASE, event("x", None, "created", "03-05 10:00"))
    assert set(current(history)) == {"s1", "s2"}
    assert kpi_rows(kpi.kpi_daily(history, NOW))[-1] == ("03-05", 0, 0, 1, "9.99")


def test_dates_without_events_have_no_row(table):
    history = table(
        event("a", "s1", "created", "03-01 10:00"), event("b", "s2", "created", "03-04 10:00")
    )
    assert [r[0] for r in kpi_rows(kpi.kpi_daily(history, NOW))] == ["03-01", "03-04"]


def test_the_mark_itself_is_not_new(table):
    rows = table(
        event("a", "s1", "created", "03-01 09:00", "03-01 10:00:00"),
        event("b", "s2", "created", "03-01 09:00", "03-01 10:00:00.000001"),
    )
    assert [r["event_id"] for r in incremental.newer_than(rows, at("03-01 10:00")).collect()] == ["b"]
    assert incremental.newer_than(rows, None).count() == 2


def test_money_adds_up_exactly(table):
    history = table(*[event(f"e{i}", f"s{i}", "created", "03-01 10:00") for i in range(6)])
    daily = kpi.kpi_daily(history, NOW)
    assert kpi_rows(daily) == [("03-01", 6, 0, 6, "59.94")]
    result = reconcile.check_kpi_vs_current(daily, state.current_state(history, NOW)).first()
    assert result["passed"] and result["details"]["checked"] == "true"


def test_a_subscription_created_twice_counts_once(table):
    history = table(
        event("a", "s1", "created", "03-01 10:00"), event("b", "s1", "created", "03-01 11:00")
    )
    assert kpi_rows(kpi.kpi_daily(history, NOW)) == [("03-01", 1, 0, 1, "9.99")]


def test_price_null_adds_nothing(table):
    history = table(*BASE[:1], event("z", "s9", "created", "03-01 10:00", price=None))
    assert kpi_rows(kpi.kpi_daily(history, NOW)) == [("03-01", 2, 0, 2, "9.99")]


def test_fractions_of_seconds_are_optional(spark):
    text = spark.createDataFrame(
        [("2024-03-01T10:00:25.100000Z",), ("2024-03-01T10:00:25Z",), ("soon",), (None,)], "t string"
    )
    found = quality.unparseable_times(text, ["t"]).first()
    assert found["invalid_count"] == 2
    latest = text.selectExpr("max(try_cast(t AS TIMESTAMP))").first()[0]
    assert latest == at("03-01 10:00:25.100000")


def test_status_must_follow_from_the_event_type(table):
    events = table(
        event("a", "s1", "created", "03-01 10:00", status=None),
        event("b", "s2", "paused", "03-01 10:00", status="cancelled"),
    )
    pairs = [tuple(r) for r in quality.status_mismatch_pairs(events).collect()]
    assert pairs == [("subscription_created", None, 1)]


def test_plan_attributes(table):
    events = table(
        event("a", "s1", "created", "03-01 10:00", price=None),
        event("b", "s2", "created", "03-01 10:00", plan_id="gold_monthly", price=None),
        event("c", "s3", "created", "03-01 10:00", billing_cycle=None),
        event("d", "s4", "created", "03-01 10:00"),
        event("e", "s5", "created", "03-01 10:00", price=Decimal("29.99")),
        event("f", "s6", "created", "03-01 10:00", plan_id=None),
    )
    found = sorted(r["event_id"] for r in quality.plan_mismatches(events).collect())
    assert found == ["a", "c", "e"]
    assert [tuple(r) for r in quality.unknown_plans(events).collect()] == [("gold_monthly", 1)]


def test_legal_and_illegal_transitions(table):
    top = {"plan_id": "enterprise_monthly"}
    history = table(
        event("a1", "a", "created", "03-01 10:00", **top),
        event("a2", "a", "upgraded", "03-02 10:00", **top),
        event("b1", "b", "created", "03-01 10:00"),
        event("b2", "b", "payment_failed", "03-02 10:00"),
        event("b3", "b", "upgraded", "03-03 10:00"),
        event("c1", "c", "created", "03-01 10:00"),
        event("c2", "c", "cancelled", "03-02 10:00"),
        event("c3", "c", "renewed", "03-03 10:00"),
        event("d1", "d", "created", "03-01 10:00"),
        event("d2", "d", "payment_failed", "03-02 10:00"),
        event("d3", "d", "renewed", "03-03 10:00"),
        event("e1", "e", "renewed", "03-01 10:00"),
        event("f1", "f", "created", "03-01 10:00"),
        event("f2", "f", "downgraded", "03-02 10:00"),
        event("g1", "g", "created", "03-01 10:00"),
        event("g2", "g", "created", "03-02 10:00"),
        event("h1", "h", "created", "03-01 10:00", plan_id="gold_monthly"),
        event("h2", "h", "upgraded", "03-02 10:00"),
    )
    found = sorted(r["event_id"] for r in audit.illegal_transitions(history).collect())
    assert found == ["a2", "b3", "c3", "e1", "f2", "g2"]


def test_plan_steps(table):
    history = table(
        event("a1", "a", "created", "03-01 10:00"),
        event("a2", "a", "upgraded", "03-02 10:00", plan_id="pro_monthly"),
        event("a3", "a", "renewed", "03-03 10:00", plan_id="pro_monthly"),
        event("a4", "a", "downgraded", "03-04 10:00"),
        event("a5", "a", "downgraded", "03-05 10:00"),
        event("b1", "b", "created", "03-01 10:00"),
        event("b2", "b", "upgraded", "03-02 10:00", plan_id="enterprise_monthly"),
        event("b3", "b", "renewed", "03-03 10:00", plan_id="pro_monthly", price=Decimal("99.99")),
        event("c1", "c", "created", "03-01 10:00"),
        event("c2", "c", "renewed", "03-02 10:00", status="cancelled"),
        event("d1", "d", "created", "03-01 10:00"),
        event("d2", "d", "renewed", "03-02 10:00", billing_cycle="yearly"),
        event("d3", "d", "renewed", "03-03 10:00", billing_cycle="yearly"),
        event("e1", "e", "created", "03-01 10:00", plan_id="gold"),
        event("e2", "e", "renewed", "03-02 10:00", plan_id="gold"),
        event("e3", "e", "upgraded", "03-03 10:00", plan_id="pro_monthly"),
        event("f1", "f", "created", "03-01 10:00"),
        event("f2", "f", "upgraded", "03-02 10:00", plan_id="pro_monthly", billing_cycle="yearly"),
    )
    found = {r["event_id"]: r for r in audit.plan_step_mismatches(history).collect()}
    assert sorted(found) == ["b2", "b3", "c2", "d2", "e3", "f2"]
    assert found["e3"]["expected_plan_id"] is None and found["f2"]["expected_billing_cycle"] == "monthly"


def test_empty_tables_reconcile_unchecked(spark, table):
    nothing = spark.createDataFrame([], schema.KPI)
    snapshot = state.current_state(table(*BASE), NOW)
    daily = kpi.kpi_daily(table(*BASE), NOW)
    for kpis, current_rows in [(nothing, snapshot), (daily, snapshot.limit(0))]:
        row = reconcile.check_kpi_vs_current(kpis, current_rows).first()
        assert row["passed"] and row["details"]["checked"] == "false"


def test_reconciliation_counts_copies_and_nulls(spark, table):
    history = table(*BASE, event("n", "s3", "created", "03-01 10:00", status=None))
    snapshot = state.current_state(history, NOW)
    doubled = snapshot.union(snapshot.where("subscription_id = 's3'"))
    row = reconcile.current_vs_history(doubled, history).first()
    # a null status never equals another one, and each of the two copies counts
    assert tuple(row) == (0, 0, 2)
    row = reconcile.current_vs_history(snapshot.where("subscription_id = 's1'"), history).first()
    assert tuple(row) == (2, 0, 0)
    row = reconcile.current_vs_history(snapshot, history.where("subscription_id = 's1'")).first()
    assert tuple(row) == (0, 2, 0)


def test_state_as_of_given_dates(spark, table):
    dates = spark.sql(
        "SELECT explode(array(DATE'2024-02-01', DATE'2024-03-02', DATE'2024-04-01')) AS date"
    )
    found = state.state_as_of(table(*BASE), dates).orderBy("date", "subscription_id").collect()
    assert [(str(r["date"]), r["subscription_id"], r["status"]) for r in found] == [
        ("2024-03-02", "s1", "active"),
        ("2024-03-02", "s2", "active"),
        ("2024-04-01", "s1", "cancelled"),
        ("2024-04-01", "s2", "active"),
    ]


def test_missing_columns_fail_their_checks(table):
    events = table(*BASE).drop("price", "status", "plan_id", "schema_version")
    rows = {r["check_name"]: r for r in quality.check_events(events).collect()}
    failed = {name for name, r in rows.items() if not r["passed"]}
    assert failed == {
        "required_columns",
        "non_null_columns",
        "status_allowed_values",
        "schema_version_expected",
        "price_non_negative",
        "plan_id_exists_in_catalog",
        "plan_attributes_match_catalog",
        "event_type_status_consistency",
    }
    assert rows["non_null_columns"]["details"]["nulls_price"] == "-1"
    keys = quality.key_unique(events, ["nothing"], "key_unique", "bronze", "events").first()
    assert not keys["passed"]


def test_an_empty_table_fails_only_where_rows_are_needed(table):
    rows = quality.check_events(table(*BASE).limit(0)).collect()
    failed = {r["check_name"] for r in rows if not r["passed"]}
    assert failed == {"not_empty", "schema_version_expected"}


def test_required_columns_are_asserted(table):
    with pytest.raises(ValueError, match="ingested_at"):
        state.current_state(table(*BASE).drop("ingested_at"), NOW)
    with pytest.raises(ValueError, match="event_id"):
        dedup.merge_events(table(*BASE), table(*BASE).drop("event_id"))


def test_merge_prefers_the_batch_on_equal_times(table):
    old = table(event("a", "s1", "created", "03-01 10:00", source="web"))
    new = table(event("a", "s1", "created", "03-01 10:00", source="mobile"))
    assert dedup.merge_events(old, new).first()["source"] == "mobile"
    assert dedup.merge_events(new, old).first()["source"] == "web"


def test_moment_accepts_text_times_and_columns(spark):
    row = spark.range(1).select(
        moment("2024-03-01T10:00:00Z").alias("a"),
        moment(at("03-01 10:00")).alias("b"),
        moment(F.lit(at("03-01 10:00"))).alias("c"),
    ).first()
    assert row["a"] == row["b"] == row["c"] == at("03-01 10:00")


def test_parse_landing_is_strict(spark, table):
    text = table(*BASE).selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in schema.EVENT_COLUMNS])
    assert tables.parse_landing(text).schema == schema.EVENT
    broken = text.withColumn("event_time", F.lit("soon"))
    with pytest.raises(Exception, match="USER_RAISED_EXCEPTION"):
        tables.parse_landing(broken).collect()
