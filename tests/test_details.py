"""As-of states, digests, offending values, rejected lines and the order in files against brute force."""

import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from billtide import schema
from billtide.operators import asof, dedup, digest, quality, reconcile, state
from billtide.plans import jobs
from billtide.session import fresh_dir
from billtide.sources import file_order, tables
from billtide.streaming import runs
from tests.conftest import event
from tests.test_skew import START, frame, in_order, random_events

NOW = "2024-06-01 00:00:00"
ASK = "ask_id long, subscription_id string, asked_at timestamp"


@pytest.mark.parametrize("chunks", [1, 7, 40, None])
def test_state_at_against_brute_force(spark, chunks):
    rows, pick = random_events(5, 500), random.Random(6)
    # a third for the busiest subscription; unknown and missing ones, missing times, repeated asks
    known = ["hot", "hot", "hot", "s1", "s2", "s3", "nobody", None]
    asks = [(i, pick.choice(known), START + timedelta(hours=pick.randrange(-24, 240))) for i in range(300)]
    asks += [(300, "hot", None), *asks[:20]]
    last = {}
    for r in in_order(rows):
        last.setdefault(r["subscription_id"], []).append((r["event_time"], r["event_id"]))

    def expected(subscription, time):
        before = [e for t, e in last.get(subscription, []) if time is not None and t <= time]
        return before[-1] if before else None

    found = asof.state_at(frame(spark, rows), spark.createDataFrame(asks, ASK).repartition(3), chunks=chunks)
    assert found.columns == ["ask_id", "subscription_id", "asked_at", "status", "plan_id", "price", "last_event_id"]
    key = lambda r: (r[0], str(r[1]))
    assert sorted(((r.ask_id, r.last_event_id) for r in found.collect()), key=key) == sorted(
        ((i, expected(s, t)) for i, s, t in asks), key=key
    )


def test_state_at_of_empty_tables_and_clashing_names(spark, table):
    asks = spark.createDataFrame([(1, "a", START)], ASK)
    assert [tuple(r)[3:] for r in asof.state_at(table(), asks).collect()] == [(None,) * 4]
    events = table(event("1", "a", "created", "03-01 10:00"))
    assert asof.state_at(events, asks.limit(0)).count() == 0
    with pytest.raises(ValueError, match="price"):
        asof.state_at(events, asks.withColumn("price", F.lit(1)))
    # other columns of events are no clash
    assert asof.state_at(events, asks.withColumn("event_time", F.lit(1))).first()["event_time"] == 1


def test_digests_find_what_the_join_finds(spark, table):
    history = frame(spark, random_events(7, 400, subscriptions=60))
    true = state.current_state(history, NOW)
    some = F.col("subscription_id").isin("s3", "s7")
    cases = {
        "equal": true,
        "changed": true.withColumn("current_status", F.when(some, "odd").otherwise(F.col("current_status"))),
        "null": true.withColumn("current_price", F.when(some, None).otherwise(F.col("current_price"))),
        "missing": true.where(~some),
        "twice": true.union(true.where(some)),
        "none": true.limit(0),
    }
    for name, snapshot in cases.items():
        ours = reconcile.current_vs_history_by_digests(snapshot, history).first()
        assert ours == reconcile.current_vs_history(snapshot, history).first(), name
    assert reconcile.current_vs_history_by_digests(true.limit(0), table()).first() == (0, 0, 0)
    # null on both sides counts as different
    odd = table(event("1", "a", "created", "03-01 10:00", plan_id=None, price=None))
    assert reconcile.current_vs_history_by_digests(state.current_state(odd, NOW), odd).first() == (0, 0, 1)


def test_only_digests_of_equal_tables_move(spark, tmp_path):
    state.current_state(frame(spark, random_events(8, 100)), NOW).write.parquet(str(tmp_path / "current"))
    current = spark.read.parquet(str(tmp_path / "current"))
    digests = digest.bucket_digests(current, "subscription_id", list(schema.CURRENT_FROM_HISTORY), 1)
    plan = digests._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange" in line]
    assert len(moved) == 1 and "hashpartitioning(_groupingexpression" in moved[0]


def test_first_offenders_in_order(spark):
    rows = [(f"v{i % 40:02d}" if i % 2 else None, "USD" if i % 3 else "x" * 900) for i in range(4000)]
    df = spark.createDataFrame(rows, "plan_id string, currency string").repartition(5)
    checks = [quality.plan_in_catalog(df), quality.allowed_values(df, "currency", schema.CURRENCIES)]
    checks += [quality.allowed_values(df, "status", schema.STATUSES)]  # no such column
    found = {}
    for r in quality.offenders(df, checks).orderBy("check_name", "value").collect():
        found.setdefault(r.check_name, []).append(r.value)
    assert found == {
        "plan_id_exists_in_catalog": [f"v{i:02d}" for i in range(1, 21, 2)],
        "currency_allowed_values": ["x" * quality.SHOWN],
    }
    results = quality.with_offenders(
        quality.run_checks(df, checks, "l", "d"), quality.offenders(df.where("currency = 'USD'"), checks)
    )
    details = {r.check_name: r.details for r in results.collect()}
    assert "offenders" not in details["currency_allowed_values"]
    assert details["plan_id_exists_in_catalog"]["offenders"].startswith("v01,v03")


def test_failed_checks_are_stored_with_their_offenders(spark, tmp_path, table):
    lake = tables.Lake(str(tmp_path))
    bad = table(event("1", "a", "created", "03-01 10:00", currency="EUR"), event("2", "b", "created", "03-01 10:00"))
    text = bad.selectExpr(*[f"CAST({c} AS STRING) AS {c}" for c in schema.EVENT_COLUMNS])
    with pytest.raises(ValueError, match="currency_allowed_values"):
        jobs.ingest(text, lake, NOW)
    kept = {r.check_name: r.details for r in tables.read_checks(spark, lake.checks).collect()}
    assert kept["currency_allowed_values"]["offenders"] == "EUR"
    assert not any("offenders" in d for name, d in kept.items() if name != "currency_allowed_values")


LINES = ['{"event_id":', "no json", "[1, 2]", "null", "7", '"{"']


def json_lines(spark, table):
    good = table(event("1", "a", "created", "03-01 10:00"), event("2", "b", "created", "03-02 10:00"))
    text = good.selectExpr(
        *[
            f"date_format({c}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") AS {c}" if c.endswith(("_time", "_at")) else c
            for c in schema.EVENT_COLUMNS
        ]
    )
    return [r[0] for r in text.selectExpr("to_json(struct(*))").collect()]


def test_broken_lines_are_kept_aside(spark, tmp_path, table):
    lake = tables.Lake(str(tmp_path))
    good = json_lines(spark, table)
    lines = spark.createDataFrame([(line,) for line in [*good, *LINES, "", "   "]], "value string")
    assert jobs.ingest_lines(lines, lake, NOW)
    assert sorted(r.event_id for r in tables.read_bronze(spark, lake.bronze).collect()) == ["1", "2"]
    assert sorted(r.line for r in tables.read_rejects(spark, lake.rejects).collect()) == sorted(LINES)
    # nothing but broken lines: no batch
    assert jobs.ingest_lines(lines.where("value = 'no json'"), lake, NOW) == []
    assert tables.read_rejects(spark, lake.rejects).where("line = 'no json'").count() == 2


def test_a_stream_keeps_broken_lines_aside(spark, tmp_path, table):
    lake = tables.Lake(str(tmp_path / "lake"))
    (tmp_path / "landing").mkdir()
    (tmp_path / "landing" / "a.json").write_text("\n".join([*json_lines(spark, table), "no json"]))
    landing, checkpoint = str(tmp_path / "landing"), str(tmp_path / "cp")
    for _ in range(2):
        runs.stream_ingest(spark, landing, lake, checkpoint, NOW, keep_rejects=True).awaitTermination()
    assert tables.read_bronze(spark, lake.bronze).count() == 2
    assert [r.line for r in tables.read_rejects(spark, lake.rejects).collect()] == ["no json"]


@pytest.mark.parametrize("batch", ["10000", "7"])
def test_order_in_files_against_brute_force(spark, tmp_path, batch):
    rows = random_events(9, 300)
    path, expected = str(tmp_path / "events"), 0
    for part in range(3):
        some = rows[part::3]
        some[5]["event_time"] = None
        some = some[:40] + sorted(some[40:], key=lambda r: r["event_id"]) if part else [r for r in some if r["event_time"]]
        if not part:
            some = in_order(some)
        key = lambda r: (r["event_time"] is None, r["event_time"] or START, r["ingested_at"], r["event_id"])
        expected += sum(key(b) < key(a) for a, b in zip(some, some[1:]))
        one = spark.createDataFrame([tuple(r[c] for c in schema.EVENT_COLUMNS) for r in some], schema.EVENT)
        one.coalesce(1).write.mode("append").parquet(path)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        assert expected and file_order.out_of_place(spark.read.parquet(path)).first()[0] == expected
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_order_in_files_shuffles_no_rows(spark):
    path = fresh_dir(spark, "history")
    tables.overwrite_history(frame(spark, random_events(10, 200)), path)
    found = tables.stored_order_violations(spark, path)
    assert found.first()[0] == 0
    plan = found._jdf.queryExecution().executedPlan().toString()
    # nothing between the files and the judgement
    below = plan[plan.index("MapInArrow"):].split("Initial Plan")[0]
    assert "Exchange" not in below


def test_dates_of_a_stored_history_are_pruned_at_run_time(spark):
    path = fresh_dir(spark, "history")
    rows = random_events(11, 300)
    tables.overwrite_history(frame(spark, rows), path)
    batch = frame(spark, rows).where("event_time >= '2024-01-04' AND event_time < '2024-01-06'")
    found = dedup.restrict_to_affected(tables.read_history(spark, path), batch)
    dates = {r.dt.isoformat() for r in found.select("dt").distinct().collect()}
    assert dates == {"2024-01-04", "2024-01-05"}
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString().lower()
