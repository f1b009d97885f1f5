"""The registered queries over whole tables, against SQL, brute force or held-out labels."""

import duckdb
import pytest

import __spark_entry__ as entry
from billtide.llm import queries
from tests.conftest import DATA
from tests.llm import brute

SF = f"{DATA}/sf0.001"


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for table in ("documents", "embeddings", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def rows(sql):
    return sql.execute("SELECT doc_id, text FROM documents ORDER BY doc_id").fetchall()


def result(spark, name, *columns, sf=SF):
    df = entry.queries()[name](spark, sf)
    return {r[0]: tuple(r[1:]) for r in df.select(*columns).collect()}


def test_all_are_registered():
    assert set(queries.QUERIES) <= set(entry.queries())
    numbers = sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op"))
    assert numbers == list(range(1, 14)) and "pipeline" in entry.queries()


@pytest.mark.parametrize("name", list(queries.SQL))
def test_query_like_sql(spark, sql, name):
    df = entry.queries()[name](spark, SF)
    found = sql.execute(entry.oracle_sql()[name])
    columns = sorted(d[0] for d in found.description)
    assert columns == sorted(df.columns)
    theirs = found.df()[columns].astype(object)
    assert len(theirs)
    rows = [tuple(None if v != v else v for v in r) for r in theirs.itertuples(index=False)]
    ours = [tuple(r[c] for c in columns) for r in df.collect()]
    assert sorted(map(repr, ours)) == sorted(map(repr, rows))


def test_repeated_text(spark, rows):
    got = result(spark, "op1_repeated_text", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    assert got == brute.repeated_text(rows)


def test_pii(spark, rows):
    got = result(spark, "op3_pii", "doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")
    for doc, text in rows:
        spans = brute.base_spans(text)
        counts = tuple(sum(s[0] == kind for s in spans) for kind in ("email", "ip", "card", "phone"))
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        assert got[doc][:5] == (*counts, brute.sha256(joined))
        assert set(joined.split(",")) <= set(got[doc][5].split(","))


def test_notices(spark, rows):
    columns = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    got = result(spark, "op4_license_scan", *columns)
    for doc, text in rows:
        assert got[doc][:5] == brute.base_places(text)
        assert set(got[doc][4].split(",")) <= {*got[doc][5].split(","), ""}
        assert (got[doc][6] > 0) == (got[doc][5] != "")


def test_bpe(spark, rows):
    got = result(spark, "op6_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256")
    assert got == brute.tokens(rows)


def test_simhash(spark, rows):
    assert result(spark, "op10_simhash", "doc_id", "fingerprint", "component_id") == brute.near_texts(rows)


@pytest.mark.parametrize(
    ("name", "label", "folds", "held", "right", "falsely"),
    [("op2_quality_model", "quality", 3, 1, 0.98, 0.02), ("op8_toxicity", "toxic", 4, 2, 0.95, 0.04)],
)
def test_held_out(spark, name, label, folds, held, right, falsely):
    import zlib

    sf = f"{DATA}/sf0.1"
    got = result(spark, name, "doc_id", "held_out", "score", "predicted", sf=sf)
    known = dict(duckdb.sql(f"SELECT doc_id, {label} FROM '{sf}/labels.parquet'").fetchall())
    assert all(r[0] == (zlib.crc32(str(doc).encode()) % folds == held) for doc, r in got.items())
    assert all(0 <= r[1] <= 1 for r in got.values())
    test = {doc: r for doc, r in got.items() if r[0] and known.get(doc) is not None}
    assert sum(r[2] == known[doc] for doc, r in test.items()) >= right * len(test)
    clean = [r[2] for doc, r in test.items() if known[doc] == 0]
    assert sum(clean) <= falsely * len(clean)
