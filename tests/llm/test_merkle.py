"""The Merkle manifest against a tree built by hand."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F

from billtide.llm import merkle

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    doc, source, lang, n_chars, text = row
    values = [None if v is None else str(v) for v in (doc, source, lang, n_chars, text)]
    return h(*["-" if v is None else f"{len(v.encode())}:{v}" for v in values])


def levels(nodes):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [h(*nodes[i : i + 2]) for i in range(0, len(nodes), 2)]
        found.append(nodes)
    return found


def way(tree, place):
    """Siblings from the leaf up."""
    found = []
    for nodes in tree[:-1]:
        if place ^ 1 < len(nodes):
            found.append(nodes[place ^ 1])
        place //= 2
    return found


def by_hand(rows):
    by_lang = {}
    for row in rows:
        by_lang.setdefault(row[2], []).append(row)
    order = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    key = lambda r: (r[0] is not None, r[0] or 0, leaf(r))
    trees = {x: levels([leaf(r) for r in sorted(by_lang[x], key=key)]) for x in order}
    top = levels([trees[x][-1][0] for x in order])
    found = []
    for place, x in enumerate(order):
        for i, row in enumerate(sorted(by_lang[x], key=key)):
            siblings = way(trees[x], i) + way(top, place)
            found.append((row[0], leaf(row), trees[x][-1][0], top[-1][0], siblings))
    return sorted(found, key=repr)


def sample(n, langs, seed=1):
    r = random.Random(seed)
    rows = [(i, r.choice([None, "a", "ä"]), r.choice(langs), r.choice([None, i]), r.choice([None, "", "x" * (i % 50), "ü€😀"])) for i in range(n)]
    return rows


@pytest.mark.parametrize(
    "rows",
    [
        sample(1, ["en"]),
        sample(2, [None]),
        sample(700, ["en", "en", "en", "de", None, ""]),
        sample(257, ["en"]) + sample(256, ["de"]) + sample(3, ["fr"]),
        [(None, None, None, None, None)] * 5 + sample(20, ["en"]) * 2,  # null and shared ids, repeated rows
        [(7, "s", "en", 1, "same")] * 300,
        sample(40, [f"l{i}" for i in range(20)] + [None]),
        [(1, "s", "en", 1, "w " * 300_000), (2, None, "en", 0, "")],
    ],
)
def test_like_by_hand(spark, rows):
    made = merkle.manifest(merkle.leaves(spark.createDataFrame(rows, SCHEMA)))
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["siblings"]) for r in made.collect()]
    assert sorted(got, key=repr) == by_hand(rows)
    assert made.where("folded_root <> root").isEmpty()


def test_tampering_shows_and_nothing_else(spark):
    docs = spark.createDataFrame(sample(300, ["en", "de", None]), SCHEMA)
    moved = F.when(F.col("doc_id") % 5 == 0, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    found = merkle.manifest(merkle.leaves(docs, n_chars=moved)).join(docs, "doc_id")
    wrong = found.where("folded_root <> root").select("doc_id").collect()
    assert sorted(r[0] for r in wrong) == [r[0] for r in sample(300, ["en", "de", None]) if r[0] % 5 == 0 and r[3] is not None]


def test_order_of_rows_does_not_matter(spark):
    rows = sample(400, ["en", None])
    shuffled = rows[:]
    random.Random(3).shuffle(shuffled)
    roots = {merkle.manifest(merkle.leaves(spark.createDataFrame(x, SCHEMA).repartition(n))).first()["root"] for x, n in ((rows, 1), (shuffled, 7))}
    assert len(roots) == 1


def test_nothing_and_clashing_columns(spark):
    assert merkle.manifest(merkle.leaves(spark.createDataFrame([], SCHEMA))).count() == 0
    rows = sample(10, ["en"])
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(9) for c in ("tree", "leaf", "number", "digest", "steps", "size", "a b")})
    got = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["siblings"]) for r in merkle.manifest(merkle.leaves(docs)).collect()]
    assert sorted(got, key=repr) == by_hand(rows)
