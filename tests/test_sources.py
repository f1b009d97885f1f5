"""Readers, writers and the control table."""

import time
from datetime import date, datetime, timedelta, timezone

import pytest

from billtide import schema
from billtide.session import cut_lineage, fresh_dir, shared_dir
from billtide.sources import control, files, tables
from tests.conftest import at, event

EVENTS = [
    event("a", "s1", "created", "03-01 10:00", "03-01 10:00:25.100001"),
    event("b", "s2", "created", "03-01 10:00", "03-02 10:00:25"),
    event("c", "s1", "cancelled", "03-02 09:00", "03-02 09:01"),
]


def test_what_is_missing_reads_as_empty(spark, tmp_path):
    root = str(tmp_path / "nothing")
    lake = tables.Lake(root)
    for df, columns in [
        (tables.read_bronze(spark, lake.bronze), schema.EVENT_COLUMNS + ["dt"]),
        (tables.read_history(spark, lake.history), schema.EVENT_COLUMNS + ["dt"]),
        (tables.read_current(spark, lake.current), schema.CURRENT.fieldNames()),
        (tables.read_kpis(spark, lake.kpi), schema.KPI.fieldNames() + ["dt"]),
    ]:
        assert df.columns == columns
        assert df.isEmpty()
    assert files.partition_dates(spark, root) == []
    assert control.load_mark(spark, lake.control, "any") is None


def test_bronze_keeps_microseconds_and_appends(spark, table, tmp_path):
    path = str(tmp_path / "bronze")
    events = table(*EVENTS)
    tables.append_bronze(events, path)
    back = tables.read_bronze(spark, path)
    assert back.drop("dt").exceptAll(events).isEmpty() and back.count() == 3
    assert files.partition_dates(spark, path) == ["2024-03-01", "2024-03-02"]
    tables.append_bronze(events, path)
    assert tables.read_bronze(spark, path).count() == 6
    assert len(files.matching(spark, path, "dt=*/*.json")) >= 4


def test_bronze_folders_before_the_mark_are_not_opened(spark, table, tmp_path):
    from billtide.operators.incremental import newer_than

    path = str(tmp_path / "bronze")
    tables.append_bronze(table(*EVENTS), path)
    new = newer_than(tables.read_bronze(spark, path), at("03-02 00:00"), ingest_date="dt")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan
    assert {r["event_id"] for r in new.collect()} == {"b", "c"}


def test_malformed_lines(spark, table, tmp_path):
    path = tmp_path / "bronze" / "dt=2024-03-01"
    tables.append_bronze(table(EVENTS[0]), str(tmp_path / "bronze"))
    (path / "broken.json").write_text('{"event_id": "x", \n')
    with pytest.raises(Exception, match="MALFORMED|malformed"):
        tables.read_bronze(spark, str(tmp_path / "bronze")).collect()
    rows = tables.read_bronze_with_rejects(spark, str(tmp_path / "bronze")).collect()
    assert sorted(r["_corrupt_record"] is None for r in rows) == [False, True]


def test_history_overwrite_touches_only_its_dates(spark, table, tmp_path):
    path = str(tmp_path / "history")
    tables.overwrite_history(table(*EVENTS), path)
    untouched = files.matching(spark, path, "dt=2024-03-02/*.parquet")
    moved = table(event("a", "s9", "created", "03-01 10:00"))
    tables.overwrite_history(moved, path)
    assert files.matching(spark, path, "dt=2024-03-02/*.parquet") == untouched
    stored = tables.read_history(spark, path).orderBy("event_id").collect()
    assert [(r["event_id"], r["subscription_id"], r["dt"]) for r in stored] == [
        ("a", "s9", date(2024, 3, 1)),
        ("c", "s1", date(2024, 3, 2)),
    ]


def test_history_is_read_and_overwritten_in_place(spark, table, tmp_path):
    path = str(tmp_path / "history")
    tables.overwrite_history(table(*EVENTS), path)
    tables.overwrite_history(tables.read_history(spark, path).where("dt = '2024-03-01'"), path)
    assert tables.read_history(spark, path).count() == 3


def test_history_files_are_stored_in_order(spark, table, tmp_path):
    path = str(tmp_path / "history")
    rows = [event(f"e{i:03d}", "s1", "renewed", f"03-0{i % 3 + 1} {i % 24:02d}:00") for i in range(200)]
    tables.overwrite_history(table(*rows).repartition(4), path)
    assert tables.stored_order_violations(spark, path).first()[0] == 0
    shuffled = str(tmp_path / "shuffled")
    table(*reversed(rows)).selectExpr("*", "to_date(event_time) AS dt").coalesce(1).write.partitionBy(
        "dt"
    ).parquet(f"{shuffled}/publish=x")
    tables.publish_history(spark, shuffled, "publish=x")
    assert tables.stored_order_violations(spark, shuffled).first()[0] > 0


def test_current_versions(spark, tmp_path):
    path = str(tmp_path / "current")

    def write(n):
        row = (f"s{n}", "u", "p", "monthly", None, "USD", "active", "x", at("03-01 10:00"), None)
        tables.overwrite_current(spark.createDataFrame([row], schema.CURRENT), path)

    for n in range(4):
        write(n)
        assert [r["subscription_id"] for r in tables.read_current(spark, path).collect()] == [f"s{n}"]
    assert len(files.matching(spark, path, "publish=*")) == 2
    # what is staged but not published is not seen
    tables.stage_current(tables.read_current(spark, path).limit(0), path)
    assert tables.read_current(spark, path).first()["subscription_id"] == "s3"


def test_marks_are_kept_per_pipeline(spark, tmp_path):
    path = str(tmp_path / "control")
    first, second = at("03-01 10:00"), at("03-02 10:00:00.000001")
    control.save_mark(spark, path, "a", first, committed_at=first)
    control.save_mark(spark, path, "b", first, committed_at=first, affected_start=date(2024, 3, 1))
    control.save_mark(spark, path, "a", second, committed_at=second, affected_start=date(2024, 2, 1))
    assert control.load_mark(spark, path, "a")["last_processed_ingested_at"] == second
    assert control.load_mark(spark, path, "b")["last_processed_ingested_at"] == first
    assert control.load_mark(spark, path, "c") is None
    assert control.read_marks(spark, path).count() == 2
    assert control.changes_since(spark, path, "a", 1)["affected_start"] == date(2024, 2, 1)
    assert control.changes_since(spark, path, "a", 1)["unlisted_start"] == date(2024, 2, 1)
    assert control.changes_since(spark, path, "a", 2)["affected_start"] is None
    # an earlier clock does not hide a commit, an intent is no mark but a change
    control.save_mark(spark, path, "a", first, committed_at=first - timedelta(days=9))
    days = [date(2024, 1, 1), date(2024, 1, 5)]
    control.save_intent(spark, path, "a", committed_at=first, affected_start=days[0], affected_dates=days)
    assert control.load_mark(spark, path, "a")["last_processed_ingested_at"] == first
    found = control.changes_since(spark, path, "a", 3)
    # it stays due until it is committed: the number to go on from is that of the last commit
    assert (found["affected_start"], found["affected_dates"], found["unlisted_start"]) == (days[0], days, None)
    assert found["sequence"] == 3


def test_marks_do_not_pass_through_local_time(spark, tmp_path, monkeypatch):
    """Half past five UTC and half past six are both half past one in New York on the day clocks go back."""
    path = str(tmp_path / "control")
    monkeypatch.setenv("TZ", "America/New_York")
    time.tzset()
    try:
        for hour in (5, 6):
            micros = int(datetime(2024, 11, 3, hour, 30, tzinfo=timezone.utc).timestamp() * 1_000_000)
            control.save_mark(spark, path, "a", micros, committed_at=micros)
            assert control.load_mark(spark, path, "a")["mark"] == micros
    finally:
        monkeypatch.undo()
        time.tzset()


def test_literal_frames_round_trip(spark, tmp_path):
    lines = spark.createDataFrame([(1, "created"), (2, "cancelled")], "id BIGINT, event STRING")
    lines.write.json(str(tmp_path / "lines"))
    assert spark.read.schema(lines.schema).json(str(tmp_path / "lines")).exceptAll(lines).isEmpty()
    frame = spark.createDataFrame([(1, "x"), (2, "y")], "a BIGINT, b STRING")
    frame.write.parquet(str(tmp_path / "frame"))
    assert tables.read_or_empty(spark, str(tmp_path / "frame"), frame.schema).count() == 2


def test_scratch_paths_lie_in_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir")
    assert shared_dir(spark) == named
    assert fresh_dir(spark, "x").startswith(f"{named}/x-")
    assert cut_lineage(spark.range(3)).count() == 3
