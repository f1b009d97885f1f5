"""Hot keys: the cut forms equal the plain ones, and plans reduce rows before they shuffle them."""

import random
from datetime import datetime, timedelta

import pytest

from billtide import schema
from billtide.operators import audit, dedup, kpi, ordered, reconcile, state
from tests.conftest import PRICE

NOW = "2024-06-01 00:00:00"
START = datetime(2024, 1, 1)


def random_events(seed, n, subscriptions=12, days=9):
    """Events of which about a third belong to one subscription, with many equal times."""
    pick = random.Random(seed)
    rows = []
    for i in range(n):
        kind = pick.choice(schema.EVENT_TYPES)
        plan = pick.choice(list(PRICE))
        time = START + timedelta(days=pick.randrange(days), hours=pick.randrange(6))
        subscription = "hot" if pick.random() < 0.35 else f"s{pick.randrange(subscriptions)}"
        row = {
            "event_id": f"e{i:05d}", "event_time": time, "event_type": kind,
            "schema_version": "1.0", "user_id": "u", "subscription_id": subscription,
            "plan_id": plan, "billing_cycle": "monthly", "price": PRICE[plan], "currency": "USD",
            "status": schema.STATUS_AFTER[kind], "source": "web",
            "ingested_at": time + timedelta(hours=pick.randrange(72)),
        }
        rows.append(row)
    return rows


def frame(spark, rows):
    return spark.createDataFrame(
        [tuple(r[c] for c in schema.EVENT_COLUMNS) for r in rows], schema.EVENT
    ).repartition(4)


def in_order(rows):
    return sorted(rows, key=lambda r: (r["event_time"], r["ingested_at"], r["event_id"]))


@pytest.mark.parametrize("chunks", [1, 5, 40, None])
def test_previous_row_against_brute_force(spark, chunks):
    rows = random_events(1, 600)
    expected, last = {}, {}
    for r in in_order(rows):
        expected[r["event_id"]] = last.get(r["subscription_id"])
        last[r["subscription_id"]] = r["event_id"]
    found = ordered.with_previous(
        frame(spark, rows), "subscription_id", ["event_time", "ingested_at", "event_id"],
        ["event_id"], chunks,
    ).selectExpr("event_id", "previous.event_id AS before").collect()
    assert {r["event_id"]: r["before"] for r in found} == expected


@pytest.mark.parametrize("chunks", [1, 5, 40, None])
def test_out_of_order_against_brute_force(spark, chunks):
    rows = random_events(2, 600)
    arrived = sorted(rows, key=lambda r: (r["ingested_at"], r["event_id"]))
    overall, within, top, top_of = 0, 0, datetime.min, {}
    for r in arrived:
        time, key = r["event_time"], r["subscription_id"]
        overall += time < top
        within += time < top_of.get(key, datetime.min)
        top = max(top, time)
        top_of[key] = max(top_of.get(key, datetime.min), time)
    found = audit.out_of_order_events(frame(spark, rows), chunks).collect()
    assert {r["scope"]: r["out_of_order"] for r in found} == {
        "overall": overall, "within_subscription": within,
    }


def test_audits_do_not_depend_on_where_keys_are_cut(spark):
    history = frame(spark, random_events(3, 500))
    for question in (audit.illegal_transitions, audit.plan_step_mismatches):
        plain, cut = question(history, 1), question(history, 20)
        assert plain.count() == cut.count() > 0
        assert plain.exceptAll(cut).isEmpty()


@pytest.mark.parametrize("seed", [4, 5, 6])
def test_kpis_against_brute_force(spark, seed):
    rows = in_order(random_events(seed, 300))
    dates = sorted({r["event_time"].date() for r in rows})
    expected = []
    for d in dates:
        last = {r["subscription_id"]: r for r in rows if r["event_time"].date() <= d}
        active = [r for r in last.values() if r["status"] == "active"]
        of_day = [r for r in rows if r["event_time"].date() == d]

        def subscriptions(kind):
            return {r["subscription_id"] for r in of_day if r["event_type"] == kind}

        expected.append(
            (
                d,
                len(subscriptions("subscription_created")),
                len(subscriptions("subscription_cancelled")),
                len(active),
                sum(r["price"] for r in active),
            )
        )
    history = frame(spark, rows)
    columns = ["date", "new_subscriptions", "new_cancellations", "active_subscriptions", "mrr"]
    full = [tuple(r) for r in kpi.kpi_daily(history, NOW).select(columns).orderBy("date").collect()]
    assert full == expected
    for start in (dates[0], dates[len(dates) // 2], dates[-1]):
        part = kpi.kpi_daily(history, NOW, start).select(columns).orderBy("date").collect()
        assert [tuple(r) for r in part] == [e for e in expected if e[0] >= start]
    past = dates[-1] + timedelta(days=1)
    assert kpi.kpi_daily(history, NOW, past).isEmpty()


def test_dedup_of_a_group_of_copies(spark):
    rows = random_events(7, 50)
    copies = [{**rows[0], "source": f"copy{i:04d}", "ingested_at": START} for i in range(400)]
    found = dedup.dedup_events(frame(spark, rows[1:] + copies)).collect()
    assert len(found) == 50
    kept = next(r for r in found if r["event_id"] == rows[0]["event_id"])
    # all times are equal, so the rest of the row decides, whatever the order of arrival
    assert kept["source"] == "copy0399"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def above_and_below_first_shuffle(df):
    lines = plan_of(df).splitlines()
    cut = max(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    return "\n".join(lines[:cut]), "\n".join(lines[cut:])


@pytest.mark.parametrize(
    "build",
    [
        dedup.dedup_events,
        lambda h: state.current_state(h, NOW),
        state.end_of_day_states,
    ],
)
def test_last_rows_are_picked_before_the_shuffle(spark, build):
    _, below = above_and_below_first_shuffle(build(frame(spark, random_events(8, 20))))
    assert "WindowGroupLimit" in below


@pytest.mark.parametrize("build", [lambda h: kpi.kpi_daily(h, NOW), reconcile.expected_current])
def test_aggregates_are_partial_before_the_shuffle(spark, build):
    _, below = above_and_below_first_shuffle(build(frame(spark, random_events(9, 20))))
    assert "partial_max" in below


def test_no_query_compares_all_pairs(spark):
    from billtide.plans.queries import QUERIES
    from tests.conftest import DATA

    writes = (
        "jobs_", "stream_", "bronze_json", "bronze_part", "bronze_app", "watermark",
        "history_stored", "history_partition", "kpi_partition",
    )
    for name, build in QUERIES.items():
        if name.startswith(writes):
            continue
        plan = plan_of(build(spark, f"{DATA}/sf0.001"))
        assert "CartesianProduct" not in plan, name
        assert "NestedLoop" not in plan, name
        assert "PythonUDF" not in plan and "InPandas" not in plan, name
