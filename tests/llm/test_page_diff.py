from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from starblend.llm import page_diff
from starblend.llm.html_blocks import blocks
from tests.llm import brute

SCHEMA = "page_id long, url string, html string, text int, n_chars string, key string"


def article(html):
    return page_diff.article(blocks(html))


@pytest.mark.parametrize(
    ("html", "want"),
    [
        ("<article><h1>T</h1><p>a  b\n c</p><p><b>x<br><p>y</article>", "T\na b c\nx\ny"),
        ("<nav>menu</nav><main><p>one &amp;amp; t&eacute;&#x41;&nbsp;z</p></main><footer>f</footer>", "one &amp; téA z"),
        ("<main><script>var t='</p>';</script><style>p{}</style><p>x<!-- no --></p><form>f<p>g</p></form></main>", "x"),
        ("<article><p>a</p><aside>side</aside><div class='ad'>buy</div><div id=cookie-notice>c</div><p>b</article>", "a\nb"),
        ("<article><p>text<a class='share-button'>Share</a> on</p><section class=comments><article>c1</article></section></article>", "text on"),
        ("<div class='no-sidebar'><article class='post'><header><h1>H</h1></header><ul><li>1<li>2</ul></article></div>", "H\n1\n2"),
        ("<ARTICLE><P>up<TABLE><TR><TD>c1<TD>c2</TABLE></ARTICLE>", "up\nc1\nc2"),
        ("<article><p title='a>b'>q</p><p title=\"open>r</p><p>s</p></article>", "q\nr\ns"),
        ("<head><title>t</title><meta x><body><div role=main>m</div><div role=navigation>n</div>", "m"),
        ("<article>&lt;b&gt; 1 < 2 <![CDATA[c]]></article>", "<b> 1 < 2 c"),
        ("<div class='content-with-sidebar'><div>Menu</div><article><p>whole</p></article></div>", "whole"),
        ("<div class='sidebar-layout'><main><p>whole</p><div class=sidebar>side</div></main></div>", "whole"),
        ("<article><h2 id='comments-on-method'>Method</h2><p id='privacy'>On privacy</p><div id=comments>c</div></article>", "Method\nOn privacy"),
        ("<article><p>text</p></article><div class=sidebar><article><p>teaser</p></article></div>", "text"),
        ("<aside class=sidebar><article><p>teaser</p></article></aside><article>text</article>", "text"),
    ],
)
def test_article(html, want):
    assert article(html) == want


@pytest.mark.parametrize("html", ["", "<", "<article", "<p>only", "</p></div>", "<script>x", "<!-- x", "<a href='", "&", "<article></article>"])
def test_broken_pages_do_not_fail(html):
    assert article(html) is None


def test_long_page_takes_linear_time():
    page = "<article>" + "<p>line <b>x</b>" * 60_000 + "</article>"
    assert article(page).count("\n") == 59_999
    assert article("<div>" * 3000 + "<article>x")


def test_common_lines_are_a_longest_subsequence():
    rng = random.Random(2)
    for _ in range(200):
        a, b = ([rng.randrange(5) for _ in range(rng.randrange(12))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
        shared = page_diff.common_lines(a, b)
        assert len(shared) == best[-1][-1] and shared == sorted(set(shared))
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in shared)


def found(spark, work, rows):
    table = spark.createDataFrame([(*r, 1, "x", "k") for r in rows], SCHEMA).repartition(4)
    return sorted((tuple(r) for r in page_diff.extract(table, work).collect()), key=repr)


@pytest.mark.parametrize("block", [2, 64])
def test_siblings_lose_their_shared_lines(spark, work, monkeypatch, block):
    """Pages without any marks: the frame goes by differencing, however the order is cut into blocks."""
    monkeypatch.setattr(page_diff, "BLOCK", block)

    def page(i):
        return f"<div>Site name</div><div>Start</div><div>Story {i} tells</div><div>of matter {i * 7}</div><div>All rights</div>"

    rows = [(i, f"http://h.example/a/{i:03d}.html", page(i)) for i in range(40)]
    rows += [(100, "http://other.example/a/001", page(1)), (101, None, page(2)), (102, "no url", page(3))]
    want = [(i, u, f"Story {i} tells\nof matter {i * 7}") for i, u, _ in rows[:40]]
    whole = "Site name\nStart\nStory {0} tells\nof matter {1}\nAll rights"
    want += [(100, rows[40][1], whole.format(1, 7)), (101, None, whole.format(2, 14)), (102, "no url", whole.format(3, 21))]
    assert found(spark, work, rows) == sorted(((*w, len(w[2])) for w in want), key=repr)


def test_copies_delete_nothing(spark, work):
    text = "".join(f"<div>line {i} of the story</div>" for i in range(9))
    rows = [(i, f"http://h.example/{i}", f"<div>Top</div>{text}") for i in range(3)]
    assert all(r[2].count("\n") == 9 for r in found(spark, work, rows))


def test_a_teaser_is_not_the_page(spark, work):
    """One small marked article beside a long text without marks: the neighbours tell the text from the frame."""
    def page(i):
        return (f"<div>Site name of all pages</div><article><p>Teaser</p></article><div>Story {i} tells at length</div>"
                f"<div>of matter {i * 7} and of more</div><div>All rights are reserved</div>")

    rows = [(i, f"http://h.example/a/{i:03d}.html", page(i)) for i in range(6)]
    got = {r[0]: r[2] for r in found(spark, work, rows)}
    assert got == {i: f"Teaser\nStory {i} tells at length\nof matter {i * 7} and of more" for i in range(6)}


def test_articles_stay_whole(spark, work):
    rows = [(i, f"http://h.example/{i}", "<nav>n</nav><article><p>quoted by both</p></article>") for i in range(3)]
    assert {r[2] for r in found(spark, work, rows)} == {"quoted by both"}


def test_defined_cases(spark, work):
    page = "<div>a</div><div>é\U0001f600</div>"
    rows = [(None, None, None), (1, "http://h/x", None), (2, "http://h/x", ""), (3, "http://h/y", page), (3, "http://h/y", page), (None, "http://h/z", page)]
    got = found(spark, work, rows)
    assert got == sorted([(*r[:2], t, len(t)) for r, t in zip(rows, ["", "", "", "a\né\U0001f600", "a\né\U0001f600", "a\né\U0001f600"])], key=repr)
    assert found(spark, work, []) == []


def test_pages_table(spark, work):
    table = spark.read.parquet(f"{brute.SMALL}/pages.parquet")
    got = page_diff.extract(table, work).collect()
    pages = brute.rows(brute.SMALL, "pages")
    assert {r.page_id: r.text for r in got} == {p[0]: article(p[2]) or "" for p in pages}
    assert all(r.n_chars == len(r.text) for r in got)


def test_pages_with_an_article_are_differenced_too(spark, work):
    """The open lines of a page with a long article go to the neighbours as any others, and the text stays the article."""
    frame, said = "Shop of the week and its offers", "A long paragraph of the article itself, number {0} of all. " * 3
    rows = [(n, f"http://a.b/{n}", f"<div>{frame}</div><div>Only page {n} says this</div><article><p>{said.format(n)}</p></article>") for n in range(4)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    keyed = pages.withColumn("id_key", F.col("page_id")).withColumn("key", F.col("page_id"))
    parsed = page_diff._parse(keyed, work)
    assert all(list(r["weights"]) == [len(frame), 21, 0] for r in parsed.collect())
    gone = {r["id_key"]: r["gone"] for r in page_diff._deletions(parsed, work).collect()}
    assert gone == {n: [0] for n in range(4)}
    assert {r["page_id"]: r["text"] for r in page_diff.extract(pages, work).collect()} == {n: said.format(n).strip() for n in range(4)}
