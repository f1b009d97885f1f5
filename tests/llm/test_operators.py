"""Each operator on awkward tables: nulls, empty and long texts, ties, repeated rows, clashing names."""

import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import public_tokenizers
from billtide.llm import (
    bpe,
    components,
    labelled,
    line_rules,
    mixing,
    near_vectors,
    notices,
    pii,
    quality_model,
    repeated_text,
    simhash,
    toxicity,
)
from tests.llm import brute
from tests.llm.conftest import TEXTS, prose

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXT_OPERATORS = {
    "lines": (line_rules.clean_lines, "KEPT"),
    "pii": (pii.find_pii, "Masked"),
    "bpe": (lambda df: bpe.encode(df, PATH), "IDS"),
    "notices": (notices.scan_licenses, "Labels"),
    "toxicity": (lambda df: toxicity.score_toxicity(df, toxicity.Model({"idiot$": 6.0}, -5.0)), "Score"),
    "quality": (lambda df: quality_model.score_quality(df, quality_model.train(["a"], [1])), "score"),
    "simhash": (simhash.fingerprints, "Fp"),
}


@pytest.mark.parametrize("name", list(TEXT_OPERATORS))
def test_text_operators(name, awkward, nothing):
    operator, clash = TEXT_OPERATORS[name]
    out = operator(awkward.withColumn(clash, F.lit("old")).withColumn("odd `name.s", F.lit(1)))
    rows = out.collect()
    assert len(rows) == awkward.count()
    assert len({c.lower() for c in out.columns}) == len(out.columns)
    result = [c for c in out.columns if c not in awkward.columns and c != "odd `name.s"]
    by_text = {}
    for r in rows:
        assert by_text.setdefault(r.text, [r[c] for c in result]) == [r[c] for c in result]
    assert by_text[None] == by_text[""] or name == "lines"
    assert operator(nothing).collect() == []


def test_lines_of_null_and_furniture(awkward):
    rows = {r.doc_id: r for r in line_rules.clean_lines(awkward).collect()}
    assert not rows[0].kept and rows[0].n_words == 0 and rows[0].cleaned == ""
    assert rows[11].kept and "Home" not in rows[11].cleaned and "rights" not in rows[11].cleaned
    assert rows[11].n_failed_lines == 2
    assert rows[12].base_failed and not rows[12].kept
    assert rows[5].kept and rows[5].cleaned == rows[5].text


def test_line_rules_leave_prose(spark):
    for line in ("A | in maths: |x| is never negative, he said.", "Really?! Yes!! It works.", "Read this: it's fine."):
        assert not line_rules.line_fails(line.encode(), line.encode().split(), 0.3, 0.2), line
    for line in ("Home | News | Shop", "BUY!! NOW!! ALL!! MUST!! GO!!", "Accept all cookies"):
        assert line_rules.line_fails(line.encode(), line.encode().split(), 0.3, 0.2), line


# ---- personal data ----


@pytest.mark.parametrize(
    ("text", "kind", "found"),
    [
        ("write to jane (at) example [dot] com today", "email", "jane (at) example [dot] com"),
        ("write to jane at example dot co dot uk please", "email", "jane at example dot co dot uk"),
        ("jаne@exаmple.com", "email", "jаne@exаmple.com"),
        ("ip １０.0.0.１ here", "ip", "１０.0.0.１"),
        ("ten dot 1 dot 2 dot 3 no, 10 dot 1 dot 2 dot 3", "ip", "10 dot 1 dot 2 dot 3"),
        ("plus four nine three zero one two three four five six seven", "phone", None),
        ("call +49 three zero one two three four five six seven", "phone", "+49 three zero one two three four five six seven"),
        ("card 4​111 1111 1111 1111", "card", "4​111 1111 1111 1111"),
    ],
)
def test_disguises(text, kind, found):
    spans = [s for s in pii.find(text) if not s[3]]
    assert [s[0] for s in spans] == [kind]
    if found:
        assert text[spans[0][1] : spans[0][2]] == found
    assert pii.masked(text, spans).count("<") == 1


@pytest.mark.parametrize(
    ("whole", "base"),
    [
        ("аnna@example.com", "nna@example.com"),
        ("jo\u200bhn@example.com", "hn@example.com"),
        ("john dot doe@example.com", "doe@example.com"),
        ("john@example.cоm", "john@example.c"),
        ("+1 415 555 01 two three", "+1 415 555 01"),
    ],
)
def test_disguises_that_a_base_span_overlaps(whole, base):
    text = f"so: {whole}; then"
    spans = pii.find(text)
    assert {(text[s:e], is_base) for _, s, e, is_base in spans} == {(whole, False), (base, True)}
    assert pii.masked(text, spans) == f"so: <{spans[0][0].upper()}>; then"


@pytest.mark.parametrize(
    "whole",
    [
        "john at example.com",
        "john at example [dot] com",
        "john at mail.example dot co.uk",
        "john [\u2009at] example.com",
        "JOHN\tat\u2009EXAMPLE.ORG",
        "+1 415 55 five 0123",
        "+1 415 555 012 three",
    ],
)
def test_bare_at_and_single_spelled_digits(whole):
    text = f"so: {whole}; then"
    assert [text[s:e] for _, s, e, is_base in pii.find(text) if not is_base] == [whole]


def test_names_of_sites_are_no_mail():
    for text in ("Visit us at example.com.", "We met at noon.Then at home.It rained.", "the shop at www.example.com", "at a.b-c"):
        assert pii.find(text) == [], text


def test_clean_prose_has_no_added_spans():
    text = "Look at the dog. He arrived at noon on time. One two three, un dos tres, at example. Привет мир."
    assert pii.find(text) == []


def test_base_spans_like_the_patterns():
    r = random.Random(4)
    alphabet = ["a", "b@", "c.", ".", "1", "25", "255", "256", "+", "4111111111111111", " ", "-", "(", ")", "@x.y", "é"]
    for _ in range(3000):
        text = "".join(r.choices(alphabet, k=r.randrange(25)))
        assert pii.detect(text) == brute.base_spans(text), text
    assert pii.find("1" * 200_000) == [] and pii.find("a" * 200_000) == []
    assert pii.find("@" * 50_000) == []


# ---- BPE ----


def decoded(ids):
    return b"".join(map(bpe.token_bytes(PATH).__getitem__, ids)).decode("utf-8", "replace") if ids else ""


def test_bpe_like_the_library():
    from tokenizers import Tokenizer

    library, encode = Tokenizer.from_file(PATH), bpe.encoder(PATH)
    r = random.Random(9)
    pieces = [" ", " \n", "\x1c", "\u3000", "\u200b", "b.", "a", "aa", "ab", "th", "he", " the", "ing", "!!", "..", "--", "é", "ß", "  ", "\n", "'s", "<|endoftext|>", "\x85"]
    for i in range(1500):
        if i % 3:
            text = "".join(r.choices(pieces, k=40))
        else:
            text = "".join(chr(c) for c in r.choices(range(0x20000), k=30) if not 0xD800 <= c < 0xE000)
        ids = library.encode(text, add_special_tokens=False).ids
        mine = encode([text])[0].as_py()
        assert mine == ids, text
        assert decoded(mine) == library.decode(ids, skip_special_tokens=False)


def test_words_taken_together_like_one_by_one(monkeypatch):
    own = bpe.load(PATH)
    r = random.Random(4)
    words = [bytes(r.choices(b" aeinrstxzAE019.,!'\xc3\xa9\x00", k=r.randrange(1, 60))) for _ in range(3000)]
    words += [b"a" * n for n in range(1, 60)]
    assert own.encode_words(words) == [own.merge(w) for w in words]
    for batch in ([w for w in words if len(w) <= n] for n in (1, 3, 40)):
        width = max(map(len, batch))
        octets = np.frombuffer(b"".join(w.ljust(width, b"\0") for w in batch), np.uint8).reshape(len(batch), width)
        tokens, made = own.greedy_together(octets, np.array([len(w) for w in batch]))
        assert [t[:n] for t, n in zip(tokens.tolist(), made.tolist())] == [own.greedy(w) for w in batch]


def test_an_encoder_forgets_and_learns_anew(monkeypatch):
    monkeypatch.setattr(bpe, "REMEMBERED", 50)
    bpe.encoder.cache_clear()
    texts = [f"number {i} of {i * 7} texts, {i}x" for i in range(300)]
    encode, own = bpe.encoder(PATH), bpe.load(PATH)
    by_tens = [ids for i in range(0, 300, 10) for ids in encode(texts[i : i + 10]).to_pylist()]
    bpe.encoder.cache_clear()
    monkeypatch.undo()
    assert by_tens == bpe.encoder(PATH)(texts).to_pylist()
    assert own.encode_words([b""]) == [[]] and encode([None, ""]).to_pylist() == [[], []]


def test_only_failing_words_are_merged():
    own = bpe.load(PATH)
    words = [w.encode() for w in " the quick wisest thstouwh erandoned blehaing tionreth".split(" ")]
    greedy = [own.greedy(w) for w in words]
    exact = [own.merge(w) for w in words]
    for g, e in zip(greedy, exact):
        a, b = np.array(g[:-1], np.int64), np.array(g[1:], np.int64)
        assert own.compatible(a, b).all() == (g == e)


def test_decode_of_nothing(spark):
    rows = spark.createDataFrame([(None,), ([],), ([50256],), ([172, 17],), ([],), ([17, 18],)], "ids array<int>")
    found = [r.decoded for r in bpe.decode(rows.coalesce(1), PATH).collect()]
    assert found == ["", "", "<|endoftext|>", "\ufffd2", "", "23"]


# ---- notices ----


def test_notices_with_errors():
    search = notices.Search(notices.NOTICES, 10)
    for text, label, edits in (
        ("licensed under the apache license version 2 0", "apache-2.0", 0),
        ("x licenced under the apach license version 2 0 y", "apache-2.0", 2),
        ("released unter the mit license", "mit", 1),
    ):
        spans = search.find(text)
        assert [(s[0], s[3]) for s in spans] == [(label, edits)]
    assert search.find("x licenced under the apach license version 2 0 y")[0][1:3] == (1, 9)
    assert search.find("the licence of poets is never reserved by right") == []


def test_places_overlap():
    assert notices.places(b" cc by cc by ", b"cc by") == [0, 2]
    assert notices.places(b" a a a ", b"a a") == [0, 1]


# ---- repeated text ----


def test_repeated_text_by_brute_force(spark):
    r = random.Random(3)
    pool, rows = ["lorem ipsum dolor sit amet " * 9], []
    for i in range(160):
        kind = r.randrange(6)
        old = r.choice(pool)
        if kind == 0:
            text = r.choice("ab") * r.randrange(400)
        elif kind == 1:
            text = "".join(r.choices(["ab", "abc", "aab", "é"], k=r.randrange(150)))
        elif kind == 2:
            at = r.randrange(len(old) + 1)
            text = "x" * r.randrange(99) + old[at : at + r.randrange(300)] + "y" * r.randrange(99)
        elif kind == 3:
            text = old
        elif kind == 4:
            text = "".join(c if r.random() > 0.01 else "#" for c in old) * 2
        else:
            text = "".join(r.choices("abcdefgh ", k=r.randrange(400)))
        pool += [text] if text else []
        rows.append((i * 3 - 50, None if r.random() < 0.05 else text))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    for length in (100, 30):
        got = {
            r.doc_id: (r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), brute.sha256(bytes(r.kept)))
            for r in repeated_text.remove_repeated(df, length=length).collect()
        }
        assert got == brute.repeated_text(rows, length)


@pytest.mark.parametrize("shared", [None, 7])
def test_thousands_of_texts_under_one_id(spark, shared):
    """Texts of one id, or of none, are told apart, and come in the order of their hashes."""
    r = random.Random(12)
    phrases = ["".join(r.choices("abcdefgh ", k=130)) for _ in range(400)]
    texts = list({"".join(r.choices("xyz ", k=r.randrange(40))) + r.choice(phrases) + str(i) for i in range(3000)})
    order = dict(zip(texts, repeated_text.text_tags([t.encode() for t in texts]).tolist()))
    df = spark.createDataFrame([(shared, t) for t in texts], "doc_id bigint, text string").repartition(6)
    got = Counter((r.n_bytes, sum(x.end - x.start for x in r.removed), len(r.removed), brute.sha256(bytes(r.kept))) for r in repeated_text.remove_repeated(df).collect())
    rows = [(i, t) for i, t in enumerate(sorted(texts, key=order.get))]
    assert got == Counter(brute.repeated_text(rows).values())


def test_repeated_rows_and_null_ids(spark, awkward, nothing):
    text = prose(8, 200)[:150]
    rows = [(1, text), (1, text), (None, text), (None, None), (2, text + "!"), (1, text[:110])]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    out = [(r.doc_id, r.n_bytes, bytes(r.kept)) for r in repeated_text.remove_repeated(df).collect()]
    assert out.count((None, 150, text.encode())) == 1  # a null id is the first
    assert out.count((1, 150, b"")) == 2
    assert (2, 151, b"!") in out and (1, 110, b"") in out
    assert len(out) == 6
    assert repeated_text.remove_repeated(nothing).collect() == []
    assert repeated_text.remove_repeated(awkward).count() == awkward.count()


# ---- SimHash ----


def test_vantage_trees_miss_no_pair():
    r = np.random.default_rng(1)
    base = r.integers(0, 2**63, 60, dtype=np.uint64)
    near = [b ^ (np.uint64(1) << np.uint64(r.integers(64))) ^ (np.uint64(1) << np.uint64(r.integers(64))) for b in base for _ in range(30)]
    points = np.unique(np.concatenate([base, np.array(near, np.uint64), r.integers(0, 2**63, 3000, dtype=np.uint64)]))
    for depth in (0, 3, 6):
        nodes = simhash.layout(points[::7], depth)
        row, shard, home = simhash.places(points, nodes, depth, 2)
        assert home.sum() == len(points)
        found = set()
        for s in np.unique(shard):
            own = row[shard == s]
            for a, b in simhash.linked(points[own], home[shard == s], 2):
                found |= {(min(x, y), max(x, y)) for x, y in zip(own[a].tolist(), own[b].tolist())}
        x, y = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 2)
        assert found == {(a, b) for a, b in zip(x.tolist(), y.tolist()) if a < b}


def test_shards_in_spark(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SHARD_ROWS", 100)
    r = np.random.default_rng(2)
    base = r.integers(-(2**62), 2**62, 300)
    rows = [(i, int(b) ^ (1 << int(r.integers(62))) if i % 3 else int(b)) for i, b in enumerate(np.repeat(base, 3))]
    df = spark.createDataFrame([*rows, (None, int(base[0])), (None, 77)], "doc_id bigint, fp bigint")
    got = {(x.doc_id, x.fp): x.component_id for x in simhash.near_groups(df).collect()}
    marks = {i: v & (2**64 - 1) for i, v in rows}
    links = {a: {b for b, y in marks.items() if (x ^ y).bit_count() <= 2} for a, x in marks.items()}
    least = brute.components(links)
    assert all(got[i, v] == least[i] for i, v in rows)
    assert got[None, int(base[0])] == 0 and got[None, 77] is None
    assert simhash.near_groups(df.limit(0)).collect() == []


def test_near_copies(awkward):
    marked = simhash.fingerprints(awkward).select("doc_id", "text", "fp")
    got = {r.doc_id: r.component_id for r in simhash.near_groups(marked).collect()}
    rows = [*enumerate(TEXTS), (100, TEXTS[5])]
    assert got == {doc: least for doc, (_, least) in brute.near_texts(rows).items()}


# ---- components ----


def test_components(spark):
    r = random.Random(5)
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(0, i) for i in range(200, 230)]
    edges = [*chain, *star, *[(r.randrange(300, 400), r.randrange(300, 400)) for _ in range(60)], (7, 7)]
    df = spark.createDataFrame([*edges, (None, 3), chain[0]], "src bigint, dst bigint")
    got = {x.node: x.component for x in components.connected(df).collect()}
    links = {}
    for a, b in edges:
        if a != b:
            links.setdefault(a, set()).add(b)
            links.setdefault(b, set()).add(a)
    assert got == brute.components(links)
    assert components.connected(df.limit(0)).collect() == []


# ---- vectors ----


def vectors(seed=1):
    r = np.random.default_rng(seed)
    rows, n = [], 0
    for c in range(25):
        middle = r.normal(size=16)
        for _ in range(12):
            rows.append((n, (middle * r.uniform(0.1, 9) + r.normal(size=16) * 0.12).tolist(), c % 3))
            n += 1
    rows += [(n + j, rows[i][1], rows[i][2]) for j, i in enumerate((0, 0, 5))]
    n = len(rows)
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [1.0, None], [float("inf"), 1.0], rows[0][1], [1.0, 2.0], [2.0, 4.0]]
    rows += [(n + i, e, None if i == 6 else 1) for i, e in enumerate(odd)]
    return [(a, None if e is None else [None if x is None else float(np.float32(x)) for x in e], b) for a, e, b in rows]


def test_vectors_by_brute_force(spark, monkeypatch):
    rows = vectors()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    least, count = brute.near_vectors(rows)
    assert max(count.values()) > 5
    for tile, cell in ((4000, 2000), (8, 10)):
        monkeypatch.setattr(near_vectors, "TILE_ROWS", tile)
        monkeypatch.setattr(near_vectors, "CELL_ROWS", cell)
        got = near_vectors.near_vectors(df).collect()
        assert len(got) == len(rows)
        for r in got:
            assert (r.n_links, r.component_id) == (count.get(r.vec_id, 0), least[r.vec_id])
            assert r.kept == (r.vec_id == least[r.vec_id])
    assert near_vectors.near_vectors(df.limit(0)).collect() == []
    alone = near_vectors.near_vectors(spark.createDataFrame([(None, [1.0], 1)], df.schema)).first()
    assert (alone.n_links, alone.component_id, alone.kept) == (0, None, False)


def test_crowd_at_the_edge_of_cells_stays_in_small_units(spark, monkeypatch):
    r = np.random.default_rng(5)
    middle = r.normal(size=8)
    crowd = [middle + r.normal(size=8) * 1e-3 for _ in range(300)]
    # some at the edge of what is near, in cells the crowd visits; all others are far
    around = [middle + 0.2 * np.linalg.norm(middle) * x / np.linalg.norm(x) for x in r.normal(size=(40, 8))]
    rows = [(i, [float(np.float32(x)) for x in v], 1) for i, v in enumerate([*crowd, *around])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    monkeypatch.setattr(near_vectors, "TILE_ROWS", 20)
    points = df.selectExpr("vec_id AS rep", "1L AS n", "label", "embedding")
    units = near_vectors.in_units(points, 0.98, 2).groupBy(*near_vectors.UNIT)
    units = units.agg(F.count("*").alias("n"), F.count_if("home").alias("homes")).where("n > 20").collect()
    assert units and max(u.n for u in units) <= 80  # two tiles of 20 on average, dealt by a hash
    assert min(u.homes for u in units) > 0
    least, count = brute.near_vectors(rows)
    monkeypatch.setattr(near_vectors, "CELL_ROWS", 40)
    for got in near_vectors.near_vectors(df).collect():
        assert (got.n_links, got.component_id) == (count.get(got.vec_id, 0), least[got.vec_id])


# ---- mixing ----


def test_counts_follow_the_distribution(spark):
    docs = spark.range(6000).selectExpr(
        "id AS doc_id", "repeat('x', 10) AS text", "if(id % 3 = 0, null, concat('s', id % 3)) AS source", "1 AS COPY"
    )
    out = mixing.replicated(docs, {"s1": 3.0, "s2": 0.0, "gone": 5.0}, other=1.0)
    assert [c.lower() for c in out.columns].count("copy") == 1
    n = {r.source: r.n for r in out.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert set(n) == {"s1", None}
    assert abs(n["s1"] - 4500) < 250 and abs(n[None] - 1500) < 150
    again = mixing.replicated(docs.repartition(7), {"s1": 3.0, "s2": 0.0, "gone": 5.0}, other=1.0)
    assert again.exceptAll(out).count() == 0 and out.exceptAll(again).count() == 0


def test_large_means_and_nothing(spark, nothing, awkward):
    docs = spark.range(300).selectExpr("id AS doc_id", "if(id < 10, 'a', 'aaaaaaaaaaaaaaaaaaaa') AS text", "if(id < 10, 'few', 'many') AS source")
    rows = mixing.replicated(docs, {"few": 0.5, "many": 0.5}).groupBy("source").count().collect()
    n = {r.source: r["count"] for r in rows}
    assert abs(n["few"] - 2905) < 300  # ten documents, each some 290 times
    assert mixing.shuffled(mixing.replicated(nothing, {"a": 1.0})).collect() == []
    out = mixing.shuffled(mixing.replicated(awkward, {}, other=1.0, epochs=3.0)).collect()
    assert [r.place for r in out] == sorted(r.place for r in out)
    counts = [sum(1 for r in out if r.doc_id == 5)]
    assert counts[0] % 2 == 0  # two equal rows have equal counts
    assert abs(sum(mixing.cumulative(7.0)[k] * 0 for k in range(3))) == 0 and mixing.cumulative(0.0)[0] == 1.0


# ---- classifiers ----


def test_toxicity_finds_the_sentence():
    clean = [f"The weather in town {i} is fine. People walk along the river." for i in range(60)]
    toxic = [f"The weather in town {i} is fine. You are a horrid gnarlfex person." for i in range(60)]
    model = toxicity.train(clean + toxic, [0] * 60 + [1] * 60)
    score, offending = toxicity.judged("All is well here. What a gnarlfex! The end.", model, 0.3)
    assert score > 0.3 and len(offending) == 1 and offending[0]["start"] == 17
    assert toxicity.judged("All is well. " * 500, model, 0.3) == (0.0, [])
    assert toxicity.train(clean, [0] * 60).evidence == {}


def test_quality_needs_both_labels():
    model = quality_model.train(["good text here."], [1])
    assert model.score(["", "anything"]).tolist() == [0.5, 0.5] or len(model.score(["", "x"])) == 2
    good = [f"A calm sentence number {i}. It ends well." for i in range(40)]
    bad = [f"BUY!! {i} NOW!! $$$ ***" for i in range(40)]
    model = quality_model.train(good + bad, [1] * 40 + [0] * 40, steps=150)
    assert (model.score(["One more calm sentence. It ends."]) > 0.5).all()
    assert (model.score(["SALE!! NOW!! *** $$$"]) < 0.5).all()


def test_passages_are_alike_in_any_batch():
    rows, starts = quality_model.measured(TEXTS[5:] + [""])
    for i, text in enumerate([*TEXTS[5:], ""]):
        alone, _ = quality_model.measured([text])
        upto = starts[i + 1] if i + 1 < len(starts) else len(rows)
        assert np.allclose(rows[starts[i] : upto], alone)


# ---- labelled samples ----


def test_sample_is_filled_where_most_labelled_texts_are_long(spark):
    texts = [(i, "é" * 500 if i % 20 > 1 else None if i == 0 else f"short {i}") for i in range(400)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(800)], "doc_id bigint, bad int")
    got, y = labelled.sample(docs, labels, "bad", 10, 0, rows=20, most_bytes=100)
    assert len(got) == 20 and sum(y) == 10
    assert all(t.startswith("short") for t in got)
    got, y = labelled.sample(docs.where("length(text) > 100"), labels, "bad", 10, 0, rows=20, most_bytes=100)
    assert len(got) == 20 and sum(y) == 10 and set(got) == {"é" * 25}
    assert labelled.sample(docs.limit(0), labels, "bad", 10, 0) == ([], [])
