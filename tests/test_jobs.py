"""The jobs end to end: late data, replays, moved events, failures, restarts."""

from contextlib import suppress
from datetime import timedelta

import pytest

from billtide import schema
from billtide.operators import dedup, kpi, state, upkeep
from billtide.plans import jobs
from billtide.plans.queries import as_text
from billtide.sources import control, files, pointers, tables
from billtide.streaming import runs
from tests.conftest import at, event, kpi_rows

NOW = at("06-01 00:00")

FIRST = [
    event("a", "s1", "created", "03-01 10:00", "03-01 10:01"),
    event("b", "s1", "cancelled", "03-03 09:00", "03-03 09:01"),
    event("c", "s2", "created", "03-02 10:00", "03-02 10:01"),
]
LATE = [event("d", "s1", "payment_failed", "03-02 08:00", "03-04 00:00")]


@pytest.fixture
def lake(tmp_path):
    return tables.Lake(str(tmp_path / "lake"))


@pytest.fixture
def step(spark, table, lake):
    """Ingests events (if any) and runs both jobs; the clock moves on an hour per call."""
    clock = [NOW]

    def run(*rows, **how):
        clock[0] += timedelta(hours=1)
        if rows:
            jobs.ingest(as_text(table(*rows)), lake, clock[0])
        return (
            jobs.update_silver(spark, lake, clock[0], **how),
            jobs.update_gold(spark, lake, clock[0]),
        )

    return run


def stored(spark, lake):
    history = tables.read_history(spark, lake.history).drop("dt").orderBy("event_id").collect()
    current = tables.read_current(spark, lake.current).drop("snapshot_time")
    kpis = tables.read_kpis(spark, lake.kpi)
    return history, current.orderBy("subscription_id").collect(), kpi_rows(kpis)


def consistent(spark, lake):
    """What is stored equals a computation from the whole stored history."""
    history = tables.read_history(spark, lake.history)
    full = state.current_state(history, NOW).drop("snapshot_time")
    kept = tables.read_current(spark, lake.current).drop("snapshot_time")
    assert full.exceptAll(kept).isEmpty() and kept.exceptAll(full).isEmpty()
    assert kpi_rows(tables.read_kpis(spark, lake.kpi)) == kpi_rows(kpi.kpi_daily(history, NOW))
    states = tables.read_day_states(spark, lake.day_states).select(*upkeep.STATE)
    made = kpi.day_states(history).select(*upkeep.STATE)
    assert states.exceptAll(made).isEmpty() and made.exceptAll(states).isEmpty()
    assert tables.stored_order_violations(spark, lake.history).first()[0] == 0


def test_late_event(spark, lake, step):
    step(*FIRST)
    before = stored(spark, lake)
    assert before[2] == [
        ("03-01", 1, 0, 1, "9.99"), ("03-02", 1, 0, 2, "19.98"), ("03-03", 0, 1, 1, "9.99"),
    ]
    first_day = tables.gold_dates(spark, lake.kpi)["2024-03-01"]
    silver, gold = step(*LATE)
    assert [str(d) for d in silver["dates"]] == ["2024-03-02"]
    assert [str(d) for d in gold["dates"]] == ["2024-03-02", "2024-03-03"]
    history, current, kpis = stored(spark, lake)
    assert [r["event_id"] for r in history] == ["a", "b", "c", "d"]
    assert current == before[1]
    assert kpis == [
        ("03-01", 1, 0, 1, "9.99"), ("03-02", 1, 0, 1, "9.99"), ("03-03", 0, 1, 1, "9.99"),
    ]
    assert tables.gold_dates(spark, lake.kpi)["2024-03-01"] == first_day
    consistent(spark, lake)


def test_nothing_new_changes_nothing(spark, lake, step):
    assert step() == (None, None)
    assert not files.exists(spark, lake.control)
    step(*FIRST)
    marks = control.read_marks(spark, lake.control).collect()
    before = stored(spark, lake)
    assert step() == (None, None)
    assert control.read_marks(spark, lake.control).collect() == marks
    assert stored(spark, lake) == before
    assert jobs.ingest(as_text(spark.createDataFrame([], schema.EVENT)), lake, NOW) == []


def test_replay_changes_nothing(spark, table, lake, step):
    step(*FIRST)
    before = stored(spark, lake)
    jobs.apply_to_silver(table(*FIRST), lake, NOW + timedelta(days=1))
    jobs.update_gold(spark, lake, NOW + timedelta(days=1))
    assert stored(spark, lake) == before


def test_arrival_order_does_not_matter(spark, lake, step, tmp_path, table):
    step(*FIRST)
    step(*LATE)
    other = tables.Lake(str(tmp_path / "other"))
    for n, rows in enumerate([[LATE[0], FIRST[1]], [FIRST[2], FIRST[0]]]):
        jobs.apply_to_silver(table(*rows), other, NOW + timedelta(hours=n))
        jobs.update_gold(spark, other, NOW + timedelta(hours=n))
    assert stored(spark, other) == stored(spark, lake)


def test_event_moved_to_a_later_date(spark, lake, step):
    step(*FIRST, event("z", "s2", "renewed", "03-04 10:00"))
    step(event("b", "s1", "cancelled", "03-05 09:00", "03-05 09:01"))
    history, _, kpis = stored(spark, lake)
    assert [r["event_id"] for r in history] == ["a", "b", "c", "z"]
    assert kpis == [
        ("03-01", 1, 0, 1, "9.99"), ("03-02", 1, 0, 2, "19.98"),
        ("03-04", 0, 0, 2, "19.98"), ("03-05", 0, 1, 1, "9.99"),
    ]
    # the emptied date is gone from both tables
    assert "dt=2024-03-03" not in pointers.in_force(spark, lake.history)
    assert "2024-03-03" not in tables.gold_dates(spark, lake.kpi)
    assert "2024-03-03" not in tables.gold_dates(spark, lake.day_states)
    consistent(spark, lake)


def test_event_moved_to_an_earlier_date(spark, lake, step):
    step(*FIRST)
    step(event("b", "s1", "cancelled", "03-02 23:00", "03-05 09:01"))
    assert stored(spark, lake)[2] == [("03-01", 1, 0, 1, "9.99"), ("03-02", 1, 1, 1, "9.99")]
    consistent(spark, lake)


def test_event_moved_to_another_subscription(spark, lake, step):
    step(*FIRST)
    step(event("b", "s3", "cancelled", "03-03 09:00", "03-05 09:01"))
    current = {r["subscription_id"]: r["current_status"] for r in stored(spark, lake)[1]}
    assert current == {"s1": "active", "s2": "active", "s3": "cancelled"}
    consistent(spark, lake)


def test_refresh_equals_rebuild(spark, lake, step):
    step(*FIRST)
    step(*LATE, event("f", "s4", "created", "03-04 10:00", "03-04 10:01"))
    consistent(spark, lake)
    # of events of equal time the one ingested later wins, then the one with the larger id
    step(
        event("e", "s4", "payment_failed", "03-04 10:00", "03-04 10:02"),
        event("0", "s2", "cancelled", "03-02 10:00", "03-04 10:02"),
        event("1", "s2", "renewed", "03-02 10:00", "03-04 10:02"),
    )
    current = {r["subscription_id"]: r["current_status"] for r in stored(spark, lake)[1]}
    assert current == {"s1": "cancelled", "s2": "active", "s4": "past_due"}
    consistent(spark, lake)


def test_refresh_ignores_an_older_delivery(spark, table, lake, step):
    step(*FIRST)
    stale = event("b", "s1", "renewed", "03-03 09:30", "03-03 09:00")
    jobs.apply_to_silver(table(stale), lake, NOW + timedelta(days=1))
    jobs.update_gold(spark, lake, NOW + timedelta(days=1))
    consistent(spark, lake)
    assert stored(spark, lake)[1][0]["current_status"] == "cancelled"


def test_rebuild_from_bronze(spark, lake, step):
    step(*FIRST)
    step(*LATE)
    before = stored(spark, lake)
    pointers.publish(spark, lake.history, {"dt=2024-03-02": None})
    step(from_start=True)
    assert stored(spark, lake) == before


def test_bad_events_are_not_ingested(spark, table, lake):
    bad = table(*FIRST, event("x", "s9", "created", "03-05 10:00", currency="EUR"))
    with pytest.raises(ValueError, match="currency_allowed_values"):
        jobs.ingest(as_text(bad), lake, NOW)
    assert not files.exists(spark, lake.bronze)


def test_bad_history_is_not_written(spark, table, lake, step):
    step(*FIRST)
    before = stored(spark, lake)
    bad = table(event("x", "s9", "created", "03-05 10:00", "03-05 10:01", user_id=None))
    with pytest.raises(ValueError, match="non_null_columns"):
        jobs.apply_to_silver(bad, lake, NOW + timedelta(days=1))
    assert stored(spark, lake) == before
    assert step() == (None, None)


MOVED = [
    event("b", "s1", "cancelled", "03-05 09:00", "03-05 09:01"),  # from 03-03
    event("c", "s9", "created", "03-02 10:00", "03-05 09:02"),  # from s2
    *LATE,
]
#: What a run calls from one step to the next, and whether it is lost after the call or before it.
STEPS = [
    ("tables", "stage_history", True),
    ("control", "save_intent", True),
    ("tables", "publish_history", True),
    ("tables", "publish_current", True),
    ("control", "save_mark", False),
    ("tables", "stage_gold", True),
    ("tables", "publish_gold", False),
    ("tables", "publish_gold", True),
]


@pytest.mark.parametrize(("module", "name", "after"), STEPS)
def test_a_job_that_died_is_repeated(spark, lake, step, monkeypatch, module, name, after):
    """Lost before or after any step, with late and moved events, a repeated run ends in the same tables."""
    step(*FIRST)
    owner = getattr(jobs, module)
    call = getattr(owner, name)

    def die(*args, **kwargs):
        if after:
            call(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(owner, name, die)
        with pytest.raises(RuntimeError):
            step(*MOVED)
    step()
    consistent(spark, lake)
    history, current, kpis = stored(spark, lake)
    assert [r["event_id"] for r in history] == ["a", "b", "c", "d"]
    assert {r["subscription_id"]: r["current_status"] for r in current} == {"s1": "cancelled", "s9": "active"}
    assert kpis == [
        ("03-01", 1, 0, 1, "9.99"), ("03-02", 1, 0, 1, "9.99"), ("03-05", 0, 1, 1, "9.99"),
    ]


@pytest.mark.parametrize(("module", "name", "after"), STEPS[:5])
def test_gold_between_a_lost_silver_run_and_its_repeat(spark, lake, step, monkeypatch, module, name, after):
    """Gold may run on what a lost run has begun, before or after any of its steps; nothing is forgotten for it."""
    step(*FIRST)
    call = getattr(getattr(jobs, module), name)

    def die(*args, **kwargs):
        if after:
            call(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(getattr(jobs, module), name, die)
        with pytest.raises(RuntimeError):
            step(*MOVED)
    # where the new history stands beside the old snapshot, gold refuses to go on
    with suppress(ValueError):
        jobs.update_gold(spark, lake, NOW + timedelta(days=1))
    step()
    consistent(spark, lake)


def test_gold_between_announcement_and_publication(spark, lake, step, monkeypatch):
    """Silver says that an event moves, gold runs, silver publishes and is lost, and only then is repeated."""
    step(*FIRST)
    publish = tables.publish_history

    def gold_first(*args, **kwargs):
        jobs.update_gold(spark, lake, NOW + timedelta(days=1))
        publish(*args, **kwargs)
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(tables, "publish_history", gold_first)
        with pytest.raises(RuntimeError):
            step(event("b", "s1", "cancelled", "03-05 09:00", "03-05 09:01"))
    step()
    consistent(spark, lake)


def test_gold_reads_only_the_named_dates(spark, lake, step, monkeypatch):
    step(*FIRST)
    step(event("y", "s7", "created", "03-07 09:00", "03-07 09:01"))
    plans = []
    make = kpi.day_states

    def watched(history):
        plans.append(history._jdf.queryExecution().executedPlan().toString())
        return make(history)

    monkeypatch.setattr(kpi, "day_states", watched)
    step(event("d", "s1", "payment_failed", "03-02 08:00", "03-08 00:00"))
    assert len(plans) == 1 and "PartitionFilters: [isnotnull(dt" in plans[0] and "2024-03-02" in plans[0]
    monkeypatch.undo()
    consistent(spark, lake)


def test_states_that_are_gone_are_made_anew(spark, lake, step):
    step(*FIRST)
    pointers.publish(spark, lake.gold, {f"table=day_states/dt={d}": None for d in tables.gold_dates(spark, lake.day_states)})
    step(event("y", "s7", "created", "03-07 09:00", "03-07 09:01"))
    consistent(spark, lake)


def test_changes_that_list_no_dates_count_from_their_start_on(spark, table, lake, step):
    step(*FIRST)
    history = tables.read_history(spark, lake.history)
    moved = dedup.merge_events(history, table(event("b", "s1", "cancelled", "03-01 20:00", "03-05 09:01")))
    tables.overwrite_history(moved, lake.history, ["2024-03-03"])
    control.save_mark(spark, lake.control, jobs.SILVER, at("03-05 09:01"), committed_at=NOW, affected_start=at("03-01 00:00").date())
    jobs.update_gold(spark, lake, NOW)
    assert kpi_rows(tables.read_kpis(spark, lake.kpi)) == kpi_rows(kpi.kpi_daily(moved, NOW))


def test_no_order_is_taken_from_the_clock(spark, table, lake, step):
    step(*FIRST)
    for row in MOVED:
        jobs.apply_to_silver(table(row), lake, NOW - timedelta(days=300))
        jobs.update_gold(spark, lake, NOW - timedelta(days=400))
    consistent(spark, lake)


def test_checks_are_kept_also_of_failed_runs(spark, table, lake, step):
    step(*FIRST)
    bad = table(event("x", "s9", "created", "03-05 10:00", currency="EUR"))
    with pytest.raises(ValueError):
        jobs.ingest(as_text(bad), lake, NOW)
    failed = tables.read_checks(spark, lake.checks).where("NOT passed").collect()
    assert [(r.job, r.check_name) for r in failed] == [("ingest", "currency_allowed_values")]
    assert {r.job for r in tables.read_checks(spark, lake.checks).collect()} == {"ingest", jobs.SILVER, jobs.GOLD}
    assert all(r.passed for r in jobs.reconcile_all(spark, lake, NOW))


def test_a_run_says_how_much_it_has_done(spark, lake, step):
    step(*FIRST, FIRST[0])
    step(*LATE)
    rows = tables.read_checks(spark, lake.checks).where("check_name = 'run_summary'").orderBy("run_time", "layer").collect()
    assert [(r["layer"], r["details"]["row_count_in"], r["details"]["row_count_out"], r["details"]["affected_partitions"]) for r in rows] == [
        ("gold", "3", "3", "2024-03-01,2024-03-02,2024-03-03"), ("silver", "4", "3", "2024-03-01,2024-03-02,2024-03-03"),
        ("gold", "2", "2", "2024-03-02,2024-03-03"), ("silver", "1", "2", "2024-03-02"),
    ]
    assert all(r["passed"] and r["details"]["failed_checks"] == "0" for r in rows)


def test_a_time_of_day_is_no_time(spark, table, lake):
    for wrong in ("12:30", "T12:30", "2024-03", "2024-03-05 10"):
        events = as_text(table(*FIRST)).selectExpr(
            f"'{wrong}' AS event_time", *[c for c in schema.EVENT_COLUMNS if c != "event_time"]
        )
        with pytest.raises(ValueError, match="datetime_parseable"):
            jobs.ingest(events.select(schema.EVENT_COLUMNS), lake, NOW)
        with pytest.raises(Exception, match="no time"):
            tables.parse_landing(events).collect()


def test_gold_learns_of_changes_below_its_mark(spark, table, lake, step):
    """A late file whose events carry an ingestion time below the mark, as a stream may deliver."""
    step(*FIRST)
    jobs.apply_to_silver(
        table(event("e", "s5", "created", "03-01 12:00", "03-02 00:00")), lake,
        NOW + timedelta(days=1),
    )
    jobs.update_gold(spark, lake, NOW + timedelta(days=1))
    consistent(spark, lake)


def test_streams_equal_the_batch_jobs(spark, table, lake, step, tmp_path):
    step(*FIRST)
    step(*LATE)
    streamed = tables.Lake(str(tmp_path / "streamed"))
    landing = str(tmp_path / "landing")

    def land(*rows):
        as_text(table(*rows)).coalesce(1).write.mode("append").json(landing)

    def run():
        ingest = runs.stream_ingest(spark, landing, streamed, str(tmp_path / "cp1"), NOW, 1)
        ingest.awaitTermination()
        silver = runs.stream_silver(
            spark, streamed, str(tmp_path / "cp2"), NOW, files_per_batch=1, with_gold=True
        )
        silver.awaitTermination()
        return silver.lastProgress

    land(LATE[0])
    land(FIRST[1], FIRST[1])
    run()
    land(FIRST[0], FIRST[2])
    run()
    assert stored(spark, streamed) == stored(spark, lake)
    versions = pointers.in_force(spark, streamed.current)
    # started again from the checkpoints it finds nothing to do
    run()
    assert pointers.in_force(spark, streamed.current) == versions


def test_a_stream_stops_at_bad_events(spark, table, lake, tmp_path):
    landing = str(tmp_path / "landing")
    as_text(table(event("x", "s9", "created", "03-05 10:00", currency="EUR"))).write.json(landing)
    query = runs.stream_ingest(spark, landing, lake, str(tmp_path / "cp"), NOW)
    with pytest.raises(Exception, match="currency_allowed_values"):
        query.awaitTermination()
    assert not files.exists(spark, lake.bronze)
