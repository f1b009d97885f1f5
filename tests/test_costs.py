"""What a run reads, joins and stores, and that the cheaper ways say the same."""

from datetime import datetime, timedelta, timezone

import pyarrow.parquet as pq

from billtide import schema
from billtide.functions.times import event_date, parsed_or_null
from billtide.operators import dedup, quality, state
from billtide.plans import jobs, queries
from billtide.session import fresh_dir, written
from billtide.sources import files, ids, tables
from billtide.sources.tables import Lake
from tests.conftest import event

NOW = datetime(2024, 3, 1, tzinfo=timezone.utc)
FIRST = [
    event("e1", "s1", "created", "01-01 10:00"),
    event("e2", "s2", "created", "01-01 11:00"),
    event("e3", "s1", "cancelled", "01-02 09:00"),
]
# the last event of s1 is delivered again for s3
AGAIN = [event("e3", "s3", "cancelled", "01-02 09:00", ingested="01-05 00:00")]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_few_withdrawn_subscriptions_do_not_shuffle_the_history(spark, table):
    first, again = written(table(*FIRST), "first"), written(table(*AGAIN), "again")
    events = written(dedup.dedup_events(first.union(again)), "events")
    old = written(state.current_with_order(first, NOW), "old")
    made = state.refresh_current(old, dedup.arrived_versions(events, again), events, NOW)
    # before it runs: a join that is changed while it runs has shuffled the history already
    assert "SortMergeJoin" not in plan_of(made)
    assert "BroadcastHashJoin" in plan_of(made)
    rows = {r.subscription_id: (r.last_event_type, r.last_event_id) for r in made.collect()}
    assert rows == {
        "s1": ("subscription_created", "e1"), "s2": ("subscription_created", "e2"), "s3": ("subscription_cancelled", "e3")
    }


def test_what_arrived_is_looked_for_once_a_run(spark, table, monkeypatch):
    lake, seen, found = Lake(fresh_dir(spark, "lake")), [], dedup.arrived_versions

    def counted(*tables_):
        seen.append(1)
        return found(*tables_)

    monkeypatch.setattr(dedup, "arrived_versions", counted)
    jobs.apply_to_silver(table(*FIRST), lake, NOW)
    jobs.apply_to_silver(table(*AGAIN), lake, NOW + timedelta(hours=1))
    assert len(seen) == 2
    current = {r.subscription_id: r.current_status for r in tables.read_current(spark, lake.current).collect()}
    assert current == {"s1": "active", "s2": "active", "s3": "cancelled"}
    known = sorted((r.event_id, r.dt.day) for r in ids.read_ids(spark, lake.ids).collect())
    assert known == [("e1", 1), ("e2", 1), ("e3", 2), ("e3", 2)]
    # and times are stored as microseconds
    file = files.matching(spark, lake.history, "*/dt=*/*.parquet")[0].removeprefix("file:")
    columns = {c.name: c.physical_type for c in pq.ParquetFile(file).schema}
    assert columns["event_time"] == columns["ingested_at"] == "INT64"


def test_ids_that_repeat_are_added_once(spark, table):
    path = fresh_dir(spark, "ids")
    some = table(*FIRST, *FIRST, *AGAIN).select("event_id", event_date().alias("dt"))
    ids.append_ids(some, path, buckets=3)
    assert sorted(r.event_id for r in ids.read_ids(spark, path).collect()) == ["e1", "e2", "e3"]


TIMES = [None, "0001-01-01 00:00:00", "0001-01-03 00:00:00", "1582-10-10 12:00:00", "2024-02-29 10:00:00.123456",
         "9999-12-29 23:59:59", "9999-12-31 23:59:59.999999", "+12000-01-01 00:00:00", "-0005-01-01 00:00:00"]


def test_times_are_judged_without_their_text(spark):
    rows = spark.createDataFrame([(t,) for t in TIMES], "text string").selectExpr("CAST(text AS TIMESTAMP) AS t")
    both = rows.selectExpr(f"{quality._time(rows, 't')} AS fast", f"{parsed_or_null('t')} AS slow")
    assert both.where("NOT (fast <=> slow)").isEmpty()
    assert "BETWEEN" in quality._time(rows, "t")
    text = spark.createDataFrame([("x",)], "t string")
    assert quality._time(text, "t") == parsed_or_null("t")
    counted = quality.run_checks(rows, [quality.datetime_parseable(rows, ["t"])], "a", "b").first()
    assert counted.violation_count == both.where("slow IS NULL").count()


def test_a_replayed_batch_is_made_once(spark, table, monkeypatch):
    made, applied = table(*FIRST), []
    lake = Lake(fresh_dir(spark, "lake"))
    tables.overwrite_history(made, lake.history)
    monkeypatch.setattr(queries, "_two_runs", lambda spark, sf, run: run(lake, 1) or lake)
    monkeypatch.setattr(queries, "increment", lambda spark, sf: made)
    monkeypatch.setattr(jobs, "update_silver", lambda *a: None)
    monkeypatch.setattr(jobs, "update_gold", lambda *a: None)
    monkeypatch.setattr(jobs, "apply_to_silver", lambda batch, *a: applied.append(batch))
    queries.jobs_replay(spark, "nowhere")
    # read from a stored table, not from the tables that it comes from
    assert len(applied) == 2 and all(batch.inputFiles() for batch in applied)
    assert {tuple(r) for r in applied[0].select(*schema.EVENT_COLUMNS).collect()} == set(FIRST)


def test_what_is_merged_with_nothing_has_arrived_whole(spark, table, monkeypatch):
    lake, named, staged = Lake(fresh_dir(spark, "lake")), [], jobs.staged

    def noted(df, name):
        named.append(name)
        return staged(df, name)

    monkeypatch.setattr(jobs, "staged", noted)
    jobs.apply_to_silver(table(*FIRST), lake, NOW)
    # another date, so again nothing to merge with, but a snapshot to advance
    later = [event("e4", "s2", "cancelled", "01-09 10:00")]
    jobs.apply_to_silver(table(*later), lake, NOW + timedelta(hours=1))
    assert "arrived" not in named
    jobs.apply_to_silver(table(*AGAIN), lake, NOW + timedelta(hours=2))
    assert named.count("arrived") == 1
    current = tables.read_current(spark, lake.current, schema.STORED_CURRENT).collect()
    current = {r.subscription_id: (r.current_status, r.last_event_id) for r in current}
    assert current == {"s1": ("active", "e1"), "s2": ("cancelled", "e4"), "s3": ("cancelled", "e3")}
    known = sorted((r.event_id, r.dt.day) for r in ids.read_ids(spark, lake.ids).collect())
    assert known == [("e1", 1), ("e2", 1), ("e3", 2), ("e3", 2), ("e4", 9)]


def test_ids_of_a_large_batch_are_not_broadcast(spark, table, monkeypatch):
    lake, plans, found = Lake(fresh_dir(spark, "lake")), [], dedup.arrived_versions

    def planned(*args):
        plans.append(plan_of(found(*args)))
        return found(*args)

    monkeypatch.setattr(dedup, "arrived_versions", planned)
    monkeypatch.setattr(dedup, "BROADCAST_ROWS", 2, raising=False)
    again = [*AGAIN, event("e4", "s1", "renewed", "01-01 12:00"), event("e5", "s1", "renewed", "01-02 12:00")]
    for batch in (FIRST, again):
        jobs.apply_to_silver(table(*batch), lake, NOW)
    assert "ShuffledHashJoin" in plans[1] and "Broadcast" not in plans[1]
    # as many as may be broadcast
    jobs.apply_to_silver(table(*again[:2]), lake, NOW)
    assert "BroadcastHashJoin" in plans[2]
    current = tables.read_current(spark, lake.current, schema.STORED_CURRENT).collect()
    current = {r.subscription_id: (r.current_status, r.last_event_id) for r in current}
    assert current == {"s1": ("active", "e5"), "s2": ("active", "e2"), "s3": ("cancelled", "e3")}
