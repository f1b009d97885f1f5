"""The comparison of everything, where the snapshot is wrong."""

import pytest

from billtide import schema
from billtide.operators import state
from billtide.plans import jobs
from billtide.sources import tables
from tests.conftest import event

NOW = "2024-06-01 00:00:00"


def test_reconcile_all_names_the_subscriptions_that_differ(spark, tmp_path, table):
    lake = tables.Lake(str(tmp_path))
    history = table(event("1", "a", "created", "03-01 10:00"), event("2", "b", "created", "03-02 10:00"))
    tables.overwrite_history(history, lake.history)
    columns = schema.STORED_CURRENT.fieldNames()
    true = state.current_with_order(history, NOW).select(*columns)
    tables.overwrite_current(true, lake.current)
    assert all(r.passed for r in jobs.reconcile_all(spark, lake, NOW))
    tables.overwrite_current(true.where("subscription_id = 'a'"), lake.current)
    with pytest.raises(ValueError, match="current_matches_latest_history"):
        jobs.reconcile_all(spark, lake, NOW)
    failed = tables.read_checks(spark, lake.checks).where("not passed").collect()
    assert [(r.check_name, r.details["offenders"]) for r in failed] == [("current_matches_latest_history", "b")]
