"""Main text of pages: by rules that know the given pages, and over templates written here."""

import html
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from billtide.llm import queries, wrappers
from billtide.llm.markup import parse
from tests.conftest import DATA

SCHEMA = "page_id bigint, url string, html string"


def known_text(page):
    """The given pages have one article of headings and paragraphs."""
    article = re.search(r"<article>(.*?)</article>", page, re.S)[1]
    blocks = re.split(r"</?(?:p|h1)>", article.replace("<br>", " "))
    texts = (" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks)
    return "\n".join(t for t in texts if t)


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_given_pages(spark, sf):
    rows = duckdb.sql(f"SELECT page_id, url, html FROM '{DATA}/{sf}/pages.parquet'").fetchall()
    got = {r["page_id"]: tuple(r)[1:] for r in queries.op12_main_text(spark, f"{DATA}/{sf}").collect()}
    assert got == {i: (url, known_text(page), len(known_text(page))) for i, url, page in rows}


SHELLS = {
    "semantic": "<body><header>Site name</header><nav><a href=/>Home</a></nav><main><article>{}</article></main>"
    "<aside>Popular posts</aside><section id=comments><h3>Comments</h3><article class=comment><p>{}</p></article></section><footer>(c)</footer>",
    "named": "<body class='has-sidebar'><div id=header>Site name</div><div class='main-menu'><ul><li><a href=/>Home</a><li><a href=/a>A</a></ul></div>"
    "<div class=cookie-notice>We use cookies</div><div id=page class=with-sidebar><div class=post-content>{}</div><div class='ad ad-300'>Buy now</div>"
    "<form><label>Name</label><input><button>Go</button></form><div class=comments-area><p>{}</p></div></div><div class=sidebar>More</div><div id=footer>(c)</div>",
    "bare": "<body><div><ul><li><a href=/>Home</a></li><li><a href=/b>Away</a></li></ul></div><div>{}</div><div>All content is ours for ever</div><!-- {} -->",
}


def article(i):
    return f"<h1>Title {i} &amp; more</h1><p>First  paragraph\n number <b>{i}</b> says something long enough.<p>Second &eacute; of {i}<br>goes on, too." + (
        f"<ul><li>item {i}a<li>item {i}b</ul>" if i % 2 else ""
    )


def expected(i):
    return f"Title {i} & more\nFirst paragraph number {i} says something long enough.\nSecond é of {i} goes on, too." + (f"\nitem {i}a\nitem {i}b" if i % 2 else "")


@pytest.mark.parametrize("shell", list(SHELLS))
def test_templates(spark, shell):
    pages = [(i, f"https://{shell}.example/{i}", SHELLS[shell].format(article(i), f"reader {i * 7} disagrees")) for i in range(12)]
    got = {r["page_id"]: r["text"] for r in wrappers.extract(spark.createDataFrame(pages, SCHEMA)).collect()}
    assert got == {i: expected(i) for i in range(12)}


def test_wrapper_is_a_union_free_expression(spark):
    pages = [("x", SHELLS["semantic"].format(article(i), "no")) for i in range(6)]
    found = wrappers.wrappers(spark.createDataFrame(pages, "host string, html string")).collect()
    assert len(found) == 1
    names = {}

    def walk(item):
        names.setdefault(item[wrappers.LABEL], []).append(item)
        for part in item[wrappers.ITEMS]:
            walk(part)

    walk(wrappers.from_json(found[0]["expression"]))
    assert names["article"][0][wrappers.MARK] == "m" and names["nav"][0][wrappers.MARK] == "x"
    assert names["ul"][0][wrappers.OPTIONAL] and names["li"][0][wrappers.REPEATED] and names["p"][0][wrappers.REPEATED]
    heading, site = names["h1"][0][wrappers.ITEMS][0], names["header"][0][wrappers.ITEMS][0]
    assert heading[wrappers.CONSTANT] is None and site[wrappers.CONSTANT] is not None


def test_the_order_and_partitions_of_pages_do_not_matter(spark):
    pages = [(i, f"http://h{i % 3}/x", SHELLS[list(SHELLS)[i % 3]].format(article(i), "c")) for i in range(60)]
    one = wrappers.extract(spark.createDataFrame(pages, SCHEMA).coalesce(1)).collect()
    other = wrappers.extract(spark.createDataFrame(pages[::-1], SCHEMA).repartition(7)).collect()
    assert sorted(map(tuple, one)) == sorted(map(tuple, other))


AWKWARD = [
    (1, None, None, ""),
    (2, "", "", ""),
    (3, "no url", "just text &lt;here", "just text <here"),
    (4, "http://a/", "<p>one<p>two < three <b>four", "one\ntwo < three four"),
    (5, "http://a/", "<script>var p='</p>'", ""),
    (6, "http://b/", "<article><p>cut off in the mid", "cut off in the mid"),
    (7, "http://c/", "<article>x<!-- never closed <p>y", "x"),
    (8, "http://d/", "<article><a title='a > b'>&#228;&amp;amp;</a> &nope; &#x41;</article>", "ä&amp; &nope; A"),
    (8, "http://d/", "<article><a title='a > b'>&#228;&amp;amp;</a> &nope; &#x41;</article>", "ä&amp; &nope; A"),
    (9, "http://e/", "<div>" * 3000 + "deep" + "</div>" * 3000, "deep"),
    (None, "http://f/", "<article></b></p></div>ok</article></article>", "ok"),
    (10, "http://g/", "<article><table><tr><td>a<td>b<tr><td>c</table></article>", "a\nb\nc"),
]


def test_awkward_pages(spark):
    got = wrappers.extract(spark.createDataFrame([r[:3] for r in AWKWARD], SCHEMA)).collect()
    assert sorted(((r["page_id"], r["text"], r["n_chars"]) for r in got), key=repr) == sorted(((r[0], r[3], len(r[3])) for r in AWKWARD), key=repr)


def test_very_long_pages_take_time_in_proportion():
    import time

    for piece in ("<a \"", "<p>word ", "<div class='x'>", "<!-- ", "<", "&amp;", "<script>", "</div>", "<ul><li>x", "<x y='"):
        begun = time.time()
        wrappers.main_text("<article>" + piece * (1_000_000 // len(piece)), None)
        assert time.time() - begun < 20, piece


def test_long_pages_are_whole(spark):
    words = [f"paragraph {i}" for i in range(30_000)]
    page = "<nav>menu</nav><article>" + "".join(f"<p>{w}</p>" if i % 7 else f"<div class=c{i}><em>{w}</em></div>" for i, w in enumerate(words)) + "</article>"
    odd = "<article>" + "".join(f"<e{i}>{w}</e{i}>" for i, w in enumerate(words[:500])) + "</article>"
    df = spark.createDataFrame([(1, "http://h/", page), (2, "http://h/", odd)], SCHEMA)
    got = {r["page_id"]: r["text"] for r in wrappers.extract(df).collect()}
    assert got == {1: "\n".join(words), 2: "\n".join(words[:500])}


def test_nothing_and_clashing_columns(spark):
    assert wrappers.extract(spark.createDataFrame([], SCHEMA)).count() == 0
    df = spark.createDataFrame([(4, "http://a/", "<p>one")], SCHEMA).withColumns({c: F.lit(1) for c in ("host", "expression", "TEXT", "row", "part", "a b")})
    made = wrappers.extract(df)
    assert made.columns == ["page_id", "url", "html", "host", "expression", "row", "part", "a b", "text", "n_chars"]
    assert made.first()["text"] == "one" and made.first()["host"] == 1


def test_tree_of_broken_markup():
    tree = parse("<ul><li>a<li>b</ul><p>x<b>y</p>z")
    assert [c.label for c in tree.children] == ["ul", "p", "#"]
    assert [c.label for c in tree.children[0].children] == ["li", "li"]
