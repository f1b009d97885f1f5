"""KPIs kept up by differences, and the bucketed table of event ids."""

import random

import pytest
from pyspark.sql import functions as F

from billtide.functions.times import event_date
from billtide.operators import dedup, kpi, upkeep
from billtide.sources import ids
from tests.conftest import at, event, kpi_rows

NOW = at("06-01 00:00")
KINDS = ["created", "renewed", "upgraded", "cancelled", "payment_failed"]


def renewed(before, after, dates):
    """What is stored for ``before``, brought up to ``after`` where events of ``dates`` differ."""
    stored, states = kpi.kpi_daily(before, NOW), kpi.day_states(before)
    made = kpi.day_states(after.where(event_date().isin(dates)))
    kept = [r[0] for r in after.select(event_date()).where("event_time IS NOT NULL").distinct().collect()]
    new = upkeep.renewed_kpis(stored, states, made, dates, kept, NOW)
    return stored.where(F.col("date") < F.lit(min(dates))).unionByName(new)


def random_rows(r, n):
    rows = []
    for i in range(n):
        day, hour = r.randrange(1, 9), r.randrange(24)
        sub = r.choice(["s1", "s1", "s1", "s2", "s3", None])  # a hot subscription, and none
        rows.append(event(f"e{i}", sub, r.choice(KINDS), f"03-0{day} {hour:02}:00", f"03-1{r.randrange(3)} {hour:02}:00"))
    return rows


@pytest.mark.parametrize("seed", range(4))
def test_differences_equal_recomputation(spark, table, seed):
    """Events are added, moved to other dates and subscriptions, and withdrawn; any dates may be empty afterwards."""
    r = random.Random(seed)
    old = random_rows(r, 40)
    new = [row for row in old if r.random() > 0.2]
    for i, row in enumerate(random_rows(r, 15)):
        new.append(row | {"event_id": f"n{i}"} if isinstance(row, dict) else (f"n{i}", *row[1:]))
    before, after = table(*old), table(*new)
    moved = before.exceptAll(after).union(after.exceptAll(before))
    dates = [x[0] for x in moved.select(event_date()).distinct().collect()]
    assert kpi_rows(renewed(before, after, dates)) == kpi_rows(kpi.kpi_daily(after, NOW))


def test_nothing_changed_and_everything_gone(spark, table):
    rows = random_rows(random.Random(9), 30)
    full, empty = table(*rows), table(*rows).limit(0)
    dates = [x[0] for x in full.select(event_date()).distinct().collect()]
    assert kpi_rows(renewed(full, full, dates)) == kpi_rows(kpi.kpi_daily(full, NOW))
    assert upkeep.changed_subscriptions(kpi.day_states(full), kpi.day_states(full)).isEmpty()
    assert kpi_rows(renewed(empty, full, dates)) == kpi_rows(kpi.kpi_daily(full, NOW))
    assert kpi_rows(renewed(full, empty, dates)) == []


def test_only_changed_subscriptions_count(spark, table):
    rows = random_rows(random.Random(3), 30)
    more = event("x", "s2", "cancelled", "03-04 23:30", "03-15 00:00")
    states, made = kpi.day_states(table(*rows)), kpi.day_states(table(*rows, more))
    assert [r[0] for r in upkeep.changed_subscriptions(states, made).collect()] == ["s2"]


def parents(df, name):
    """The lines of the physical plan above the first one that holds ``name``, from the bottom up."""
    lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
    depth = lambda line: len(line) - len(line.lstrip(" :+-*"))
    at = next(i for i, line in enumerate(lines) if name in line)
    found, low = [], depth(lines[at])
    for line in reversed(lines[:at]):
        if depth(line) < low:
            found.append(line)
            low = depth(line)
    return found


def test_ids_are_found_without_an_exchange_of_the_table(spark, table, tmp_path):
    path = str(tmp_path / "ids")
    first = table(*random_rows(random.Random(5), 40))
    ids.append_ids(first.select("event_id", event_date().alias("dt")), path, buckets=8)
    again = table(event("e3", "s1", "renewed", "03-09 10:00"), event("new", "s1", "renewed", "03-09 10:00"))
    ids.append_ids(again.select("event_id", event_date().alias("dt")), path)
    batch = table(event("e3", "s1", "renewed", "03-01 10:00"), event("e7", "s1", "renewed", "03-01 10:00"))
    both = first.union(again).select("event_id", event_date().alias("dt"))
    expected = dedup.redelivered_dates(both, batch)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for limit in (threshold, "-1"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
            found = ids.dates_of(ids.read_ids(spark, path), batch)
            assert sorted(found.collect()) == sorted(expected.collect())
        above = parents(found, "FileScan parquet")
        join = next(i for i, line in enumerate(above) if "SortMergeJoin" in line)
        assert not any("Exchange" in line for line in above[:join])
        assert "SelectedBucketsCount: 8 out of 8" in found._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_no_ids_yet(spark, table, tmp_path):
    assert ids.dates_of(ids.read_ids(spark, str(tmp_path / "none")), table(event("a", "s", "created", "03-01 00:00"))).isEmpty()
