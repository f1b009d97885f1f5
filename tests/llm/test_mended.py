"""Long and awkward texts, families of notices, prose that only looks like what is searched for."""

import random
import time

import duckdb
import pytest
import regex

from billtide.llm import line_rules, mixing, notices, pii, queries
from tests.conftest import DATA


def seconds(work):
    begun = time.time()
    work()
    return time.time() - begun


# ---- personal data ----


@pytest.mark.parametrize(
    "text",
    [" " * 1_000_000 + "dot", "\n" * 1_000_000 + "[at]", "x" + "\t \n" * 300_000 + "dot y", "one" + " " * 1_000_000 + "x", "a at" + " " * 1_000_000 + "b.c", "a at b" + " " * 1_000_000 + "dot com", "[ " * 400_000, "plus " * 200_000, "a at b " * 150_000, "one " * 250_000, "a dot " * 150_000],
    ids=range(11),
)
def test_pii_of_long_runs_takes_time_in_proportion(text):
    assert seconds(lambda: pii.find(text)) < 20


@pytest.mark.parametrize(
    "text",
    ["we looked at polka dot dresses", "she pointed at a dot on the map", "seven at one dot five", "pointed at a dot in the middle", "look at that dot to the left", "a dance at noon dot it was grand"],
)
def test_prose_is_no_mail(text):
    assert pii.find(text) == []
    assert pii.masked(text, pii.find(text)) == text


def test_brackets_after_brackets():
    text = "so john [at] [dot] x; mail: ann  (at)\texample \n (dot)  org."
    assert [text[s:e] for _, s, e, _ in pii.find(text)] == ["ann  (at)\texample \n (dot)  org"]


# ---- notices ----

SEARCH = notices.Search(notices.NOTICES, 10)


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("licensed under the gnu general public license version 2", ["gpl-2.0"]),
        ("licensed under the gnu general public license version 3", ["gpl-3.0"]),
        ("licenced under the gnu general public licence version 3 or later", ["gpl-3.0"]),
        ("licensed under cc by sa 4 0", ["cc-by-sa"]),
        ("licensed under cc by nc sa 4 0", ["cc-by-nc-sa"]),
        ("licensed under cc by nc 4 0", ["cc-by-nc"]),
        ("licensed under cc by 4 0 and no other", ["cc-by"]),
        ("licensed under the gnu affero general public license", ["agpl"]),
        ("licensed under the gnu lesser general public license", ["lgpl"]),
        ("licensed under the apache license version 1 1", []),
        ("released under the bsd license", []),
        ("all right reserved", ["reserved"]),
        ("released under the mit license and licensed under the apache license version 2 0", ["mit", "apache-2.0"]),
    ],
)
def test_families_of_notices(text, labels):
    assert [s[0] for s in SEARCH.find(text)] == labels


def test_seeds_miss_no_match():
    """A bounded-error search at every place finds nothing in texts where the seeds find nothing."""
    r = random.Random(5)
    for notice, label in notices.NOTICES.items():
        k = max(1, len(notice) // 10)
        everywhere = regex.compile(f"(?:{regex.escape(notice)}){{e<={k}}}")
        for _ in range(60):
            body = list(notice)
            for _ in range(r.randrange(k + 3)):
                at = r.randrange(len(body))
                body[at] = r.choice(["", "q", body[at] + "z", "e"])
            text = " ".join(" ".join(["some words here", "".join(body), "and after"]).split())
            i = [n for n, _ in SEARCH.notices].index(notice)
            met = any(SEARCH.verify(i, text[a:b]) for j, a, b in SEARCH.windows(text) if j == i)
            assert met == (everywhere.search(text) is not None), text


@pytest.mark.parametrize("text", ["all rights reserved ", "all right reserved ", "released under the mit licence ", "licensed under the ", "permission is hereby granted "])
def test_notices_take_time_in_proportion(text):
    long = (text * (1_000_000 // len(text))).strip()
    assert seconds(lambda: SEARCH.find(long)) < 30


def test_best_of_a_place():
    spans = [("a", 0, 5, 1, 0.9), ("b", 3, 8, 0, 1.0), ("c", 8, 9, 0, 1.0), ("d", 0, 3, 2, 0.8)]
    assert notices.likest(spans) == [("d", 0, 3, 2, 0.8), ("b", 3, 8, 0, 1.0), ("c", 8, 9, 0, 1.0)]


# ---- lines ----


def test_clean_texts_about_furniture_stay():
    lines = [
        "JavaScript runs in every browser you will ever use.", "A newsletter reaches people who asked for it before.",
        "Bake the cookies until the edges are golden and firm.", "To log in, the server compares a hash of the password.",
        "People subscribe because the letters are worth their time.", "The privacy of readers matters more than any number.",
        "| name | age | town |", "| Ann | 31 | Ulm |", "A table like this one is no row of links at all.",
    ]
    found = line_rules.judged("\n".join(lines), 0.3, 0.3, 0.15)
    names = [f[0] for f in line_rules.FIELDS]
    assert dict(zip(names, found))["n_failed_lines"] == 0 and dict(zip(names, found))["kept"]


@pytest.mark.parametrize("line", ["Home | About | Contact", "Please accept all cookies", "Sign in", "Subscribe to our newsletter today", "You must enable JavaScript"])
def test_furniture_goes(line):
    raw = line.encode()
    assert line_rules.line_fails(raw, raw.split(), 0.3, 0.15)


# ---- toxicity ----


def test_offending_sentences_are_where_the_score_comes_from(spark):
    sf = f"{DATA}/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    found = queries.op8_toxicity(spark, sf).collect()
    located = 0
    for r in found:
        spans = [tuple(map(int, s.split(":"))) for s in r["offending"].split(",") if s]
        text = texts[r["doc_id"]] or ""
        assert all(0 <= a < b <= len(text) for a, b in spans) and spans == sorted(spans)
        assert not spans or r["predicted"] == 1
        located += bool(spans)
    assert located >= 0.9 * sum(r["predicted"] for r in found) > 0


# ---- mixing ----


def test_rows_without_an_id_are_mixed_each_by_itself(spark):
    rows = [(None, f"text {i} " + "x" * (i % 9), "a" if i % 2 else "b") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    mixed = mixing.shuffled(mixing.replicated(docs, {"a": 0.8}, 0.2))
    found = mixed.collect()
    share = sum(len(r["text"]) for r in found if r["source"] == "a") / sum(len(r["text"]) for r in found)
    assert 0.75 < share < 0.85
    assert len({r["place"] for r in found}) > 0.99 * len(found)
    again = mixing.shuffled(mixing.replicated(docs.repartition(5), {"a": 0.8}, 0.2)).collect()
    assert [tuple(r) for r in again] == [tuple(r) for r in found]
