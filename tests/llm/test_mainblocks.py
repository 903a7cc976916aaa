import html
import re

import pytest

from regiobank.llm import mainblocks
from regiobank.llm.mainblocks import best_container, read_page
from regiobank.llm.queries import op12_html_extraction


def plain(page):
    """The article of the pages of the test tables, by their one template."""
    inner = re.search("<article>(.*?)(?:</article>|$)", page or "", re.S)
    blocks = re.split("</?(?:p|h1)>", inner[1]) if inner else []
    blocks = [" ".join(html.unescape(re.sub("</?b>", "", re.sub("<br>", " ", b))).split()) for b in blocks]
    return "\n\n".join(b for b in blocks if b)


def test_query_equals_brute_force(spark, folder):
    pages = {r.page_id: r for r in spark.read.parquet(f"{folder}/pages.parquet").collect()}
    got = op12_html_extraction(spark, folder).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == plain(pages[r.page_id].html) and r.url == pages[r.page_id].url
        assert r.n_chars == len(r.text) > 0


def own(source):
    page = read_page(source)
    return mainblocks.extract(page, [])


LONG = "This sentence of the article is long enough to count for something. " * 4
LONG = LONG.strip()


@pytest.mark.parametrize(
    "source,wanted",
    [
        (f"<nav>menu</nav><main><h1>T</h1><p>{LONG}<p>B &amp; b&nbsp;&eacute;&#8212;c</main><footer>f</footer>", f"T\n\n{LONG}\n\nB & b é—c"),
        (f"<div id=top>site</div><div class='post'><h2>T</h2><div>{LONG}</div><div class='ad-3'>buy</div><div>{LONG}</div></div>", f"T\n\n{LONG}\n\n{LONG}"),
        (f"<article><header><h1>T</h1></header><p>{LONG}</p><aside>s</aside><form>f<p>x</form><footer>y</footer></article>", f"T\n\n{LONG}"),
        (f"<body class='no-sidebar has-comments'><article><p>{LONG}</article><section id='comments'><p>{LONG * 5}</section>", LONG),
        (f"<div class=x><p>a<b>b</b>c <i>d</i><br>e\n\t f</p><p>{LONG}</p><ul><li>one<li>two</ul></div>", f"abc d e f\n\n{LONG}\n\none\n\ntwo"),
        (f"<script>var a='<p>no</p>';</script><style>p{{}}</style><!-- <p>no</p> --><p>{LONG}</p><textarea><p>no</textarea>", LONG),
        (f"<p>1 < 2 & 3 > 2 &lt;p&gt;</p><p>{LONG}</p>", f"1 < 2 & 3 > 2 <p>\n\n{LONG}"),
        (f"<p title='a > b' class=\"x\">{LONG}</p><p hidden>no</p><p style='display: none'>no</p><div aria-hidden=true>no</div>", LONG),
        (f"<p>{LONG} <span class='advert'>buy <span>now</span> cheap</span>end</p>", f"{LONG} end"),
        (f"<div class='entry'><div class='entry-header'><h1>T</h1></div><p>{LONG}</div><div class=header>no</div>", f"T\n\n{LONG}"),
        (f"<table><tr><td><p>{LONG}</p></td><td><a href=x>link</a><a href=y>link</a></td></tr></table>", LONG),
        ("", ""),
        ("<nav>only a menu</nav>", ""),
        ("plain words, no tags", "plain words, no tags"),
        ("<p>never ends <a href='", "never ends"),
        ("</div></p>odd<div></article>even", "odd\n\neven"),
    ],
)
def test_pages(source, wanted):
    assert own(source) == wanted


def test_paths_are_generalised():
    page = read_page(f"<html><body><DIV Class='B12 a'><section id='s-77'><p>{LONG}</section></div>")
    at, share = best_container(page)
    assert (page.path(page.nodes[at].path), share) == ("div.a.b#>section#s-#", 1.0)


def test_long_and_deep_pages():
    assert own("<div>" * 20000 + LONG + "</div>" * 20000) == LONG
    many = "<p>word " * 50000
    assert own(many).count("\n\n") == 49999
    assert own("<a " * 20000) == "" and own("<" * 50000) == "<" * 50000
    assert own("<p>x</p>" + "<b>" * 30000 + LONG) == f"x\n\n{LONG}"
    assert own(f"<p>{LONG}" + "<!-- " * 30000) == LONG


def pages(spark, rows):
    return spark.createDataFrame([(*row, "h", "w", 3) for row in rows], "page_id long, url string, html string, host string, winners string, votes int")


def test_the_host_decides(spark):
    """Where readers wrote more than the author, a page alone takes their part for the article."""

    def page(article, readers):
        return f"<div class='c1'><p>{article}</p></div><div class='c2'><p>{readers}</p></div>"

    rows = [(i, f"https://Host.example:8080/{i}", page(LONG, "short")) for i in range(8)]
    rows.append((100, "http://host.example/x", page(LONG, f"{LONG} " * 6)))
    rows.append((101, None, page(LONG, f"{LONG} " * 6)))
    rows.append((102, "https://other.example/", page(LONG, f"{LONG} " * 6)))
    rows.append((103, "https://host.example/", f"<main>{LONG}</main>"))
    got = {r.page_id: r.text for r in mainblocks.main_texts(pages(spark, rows).repartition(3)).collect()}
    assert got[100] == LONG and got[3] == LONG and got[103] == LONG
    assert got[101] == got[102] == (f"{LONG} " * 6).strip()


def test_defined_results(spark):
    rows = [(None, None, None), (1, "", ""), (2, "no address", f"<p>{LONG}"), (2, "no address", f"<p>{LONG}"), (3, "http://a.example", None)]
    got = mainblocks.main_texts(pages(spark, rows))
    assert got.columns == ["page_id", "url", "text", "n_chars"]
    assert sorted((str(r.page_id), r.text, r.n_chars) for r in got.collect()) == [
        ("1", "", 0), ("2", LONG, len(LONG)), ("2", LONG, len(LONG)), ("3", "", 0), ("None", "", 0),
    ]
    assert mainblocks.main_texts(pages(spark, [])).collect() == []


def test_hosts(spark):
    urls = ["https://A.b.Example:80/x", "http://user:pw@c.example?q", "ftp://d.example#f", "//e.example", "mailto:x", None, "HTTP:/f.example"]
    rows = spark.createDataFrame([(u,) for u in urls], "url string").select(mainblocks.host_of(mainblocks.F.col("url")).alias("h")).collect()
    assert [r.h for r in rows] == ["a.b.example", "c.example", "d.example", None, "x", None, "f.example"]


def test_few_paths_of_a_host_win(spark):
    rows = [(i, "http://h.example/", f"<div class='{'abcdefghijklmnopqrstuvwxyz'[i % 26]}x'><p>{LONG}</div>") for i in range(60)]
    found = mainblocks.host_paths(pages(spark, rows)).collect()
    assert all(len(r.winners) <= 20 for r in found)
