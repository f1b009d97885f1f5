"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from billtide.plans.oracles import all_oracles
from billtide.plans.queries import all_queries
from tests.conftest import DATA

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM '{SF}/events.parquet'")
    return con


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(repr(row[i]) for i in order) for row in rows)


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(all_queries()))
def test_query(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    ours = canonical(df.columns, [tuple(r) for r in df.collect()])
    found = sql.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in found.description]
    rows = found.fetchall()
    assert rows
    assert ours == canonical(columns, rows)


def test_entry(spark):
    # 30 dates of deliveries, and three to which redeliveries have moved events
    assert entry.entry(spark).count() == 33
