import html as entities
import re
import time

import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from windrow.llm import html


@pytest.fixture(scope="session")
def pages(spark, small):
    return spark.read.parquet(f"{small}/pages.parquet")


def brute(page):
    """The article of the given pages, which have one each, cut at its block tags."""
    body = re.search(r"<article>(.*?)(</article>|<footer|\Z)", page or "", re.S)
    parts = re.split(r"</?p>|</?h1>", body[1]) if body else []
    texts = [" ".join(entities.unescape(re.sub(r"<[^>]*>", " ", p)).split()) for p in parts]
    return "\n".join(t for t in texts if t)


def test_same_as_brute_force(pages):
    found = {r.page_id: r for r in html.extracted(pages).collect()}
    for r in pages.collect():
        assert found[r.page_id].text == brute(r.html) and found[r.page_id].n_chars == len(brute(r.html))
        assert found[r.page_id].url == r.url


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("no markup &amp; more", "no markup & more"),
        ("<p>a<p>b<br>c<div>d</div>e", "a\nb c\nd\ne"),
        ("<ul><li>one<li>two</ul><p>x &lt;b&gt; &#233; &copy; y", "one\ntwo\nx <b> é © y"),
        ("<body><nav>menu</nav><div class='ad-box'>buy</div><p>text</p><footer>end", "text"),
        ("<article><header><h1>Title</h1></header><p>text</p><section class=comments>first!</section></article>after", "Title\ntext"),
        ("<header>site</header><main><p>text</p><form><p>mail</p></form></main>", "text"),
        ("<p>a<script>if (a < b) document.write('<p>no</p>')</script>b", "ab"),
        ("<style>p{}</style><p>a <!-- <p>no</p> --> b <i>c</b></i> d", "a b c d"),
        ("<p title='x > y'>a</p><p title=\"cut", "a"),
        ("<article>cut <b>off", "cut off"),
        ("<div id=comments><p>me too</p></div><p class=lead>text", "text"),
        ("<article>1</article><aside>no</aside><article>2</article>", "1\n2"),
        ("<article class='post has-comments'><p>text</p></article><article class=comment><p>first!</p></article>", "text"),
        ("<article><p>text</p><div class=cookieBanner>ok?</div><div hidden>no</div><p>more</p></article>", "text\nmore"),
        ("<table><tr><td>a<td>b<tr><td>c</table>", "a\nb\nc"),
        ("<p>a&nbsp;b\n\t c</p>", "a b c"),
    ],
)
def test_pages(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize(
    "page, text",
    [
        ("<article title='a hidden gem'><p title=\"its class=ad id=nav\">text</p><p alt = 'role=search'>more</p></article>", "text\nmore"),
        ("<article><p title='x' class='ad'>no</p><p data-class=ad CLASS=lead>yes</p><p Hidden>no</p></article>", "yes"),
        ("<div class='layout with-sidebar'><div class=menu>menu</div><article><p>text</p></article></div>", "text"),
        ("<div id=search-results><main><p>text</p></main></div>", "text"),
        ("<form><div class=no-comments><div><article>text</article></div></div></form><p>after", "text"),
        ("<div class=comments>two<article class=comment>first!</article></div><p>text", "text"),
    ],
)
def test_only_what_is_aside_goes(page, text):
    assert html.main_text(page) == text


LONG = "many words of the one text that this page is for " * 5


@pytest.mark.parametrize(
    "page, text",
    [
        (f"<div class='layout with-sidebar'><p>{LONG}</p></div>", LONG.strip()),
        (f"<div id='search-results'><p>{LONG}</p><div class=sidebar>links</div></div><p>imprint</p>", f"{LONG.strip()}\nimprint"),
        (f"<p title=it's>a</p><p title=it's class=lead>{LONG}</p>", f"a\n{LONG.strip()}"),
        (f"<p data-x='a>b' title = \"it's\">a</p><p \">b</p>", "a\nb"),
        (f"<article><p>{LONG}</p><div class=alert>mind the gap</div><section class=related-work>others did</section><div class=related-posts>more</div></article>", f"{LONG.strip()}\nmind the gap\nothers did"),
        (f"<article><p>{LONG}</p><section class=comments>{LONG * 40}</section></article>", LONG.strip()),
        (f"<article>a box</article><p>{LONG}</p>", f"a box\n{LONG.strip()}"),
        (f"<main><article>a box</article><p>{LONG}</p></main><p>b", f"a box\n{LONG.strip()}"),
        (f"<div class=sidebar><p>only this</p></div>", "only this"),
        (f"<div class=ads>{LONG * 3}</div><p>{LONG}</p>", LONG.strip()),
    ],
)
def test_no_name_empties_a_page(page, text):
    assert html.main_text(page) == text


@pytest.mark.parametrize("part", ["<span>", "<p><span>x", "<b>x<div>", "<article>x", "<li>x<b>", "<div>x</b></i>", "<p>x</em>"])
def test_deep_pages_take_time_in_step_with_their_length(part):
    def seconds(n):
        begin = time.perf_counter()
        html.parse(part * n)
        return time.perf_counter() - begin

    seconds(1000)
    n = 1_000_000 // len(part)
    assert seconds(n) < 2 + 20 * seconds(n // 16) and seconds(n) < 15


def test_templates_against_brute_force(spark):
    """Every group's pages and subtrees counted in sets."""
    rows = []
    for i in range(60):
        parts = [f"<p>own {i}</p>", f"<div><p>third {i % 3}</p></div>", "<section>for all</section>" if i % 5 else "", f"<ul><li>kind {i % 2}</ul>"]
        rows.append((i, f"http://h{i % 2}.example.com/{'ab'[i % 4 // 2]}/{'cd'[i % 3 // 2]}/x", "".join(parts[i % 3 :] + parts[: i % 3])))
    pages = spark.createDataFrame(rows * 2, "page_id long, url string, html string")
    groups, cuts = {}, {}
    for _, url, page in rows:
        host = re.match("http://([^/]*)", url)[1]
        digest, paths, found = html.subtrees(page, host)
        cuts[digest] = min(cuts.get(digest, (url,)), (url,)) + (host, paths, found)
    for url, host, paths, found in (c[:1] + c[-3:] for c in cuts.values()):
        for g in html.sections(url, host):
            groups.setdefault(g, []).append(set(found))
        for path in paths:
            groups.setdefault(path, []).append({s for s, above in found.items() if above == path})
    want = set()
    for held in groups.values():
        for subtree in set().union(*held):
            n = sum(subtree in h for h in held)
            if n >= 5 and n >= 0.5 * len(held):
                want.add(subtree)
    got = {r.subtree for r in html.site_templates(pages, least_pages=5).collect()}
    assert got == want and len(want) > 4


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["<p>", "</p>", "<b>", "</b>", "<div class=x>", "</div>", "<script>", "</script>", "<!--", "-->", "<", ">", '"', "'", "&amp", "<li>", "<article>", "text ", "\n", "<a href='", "</", "<!x", "\x00"])).map("".join))
def test_broken_markup_ends(page):
    assert "\n\n" not in html.main_text(page)
    html.subtrees(page)


def test_site_templates_go(spark):
    rows = []
    for i in range(40):
        chrome = "<div><p>Call us any time</p><p>Our shops</p></div>"
        own = f"<p>story {i} about {i * 7}</p><p>{'a passage that is quoted in many stories of this site ' * 3}</p>"
        rows.append((i, "https://user@News.example.com:80/a", f"<body>{chrome}{own}<p>Read more</p>"))
        rows.append((100 + i, None, f"<body>{chrome if i % 5 == 0 else ''}<p>page {i}</p>"))
    rows += [(200 + i, "http://copies.example.com", "<p>the same page</p>") for i in range(40)]
    rows += [(300, "http://one.example.com", None), (300, "http://one.example.com", ""), (None, "x", "<p>y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'t' as text", "1 as host", "2 as template")
    found = html.extracted(pages)
    assert found.columns == ["page_id", "url", "host", "template", "text", "n_chars"]
    texts = {r.page_id: r.text for r in found.collect()}
    quoted = ("a passage that is quoted in many stories of this site " * 3).strip()
    assert texts[3] == f"story 3 about 21"  # what half of the pages share is template, outside of an article
    assert quoted not in texts[3]
    assert texts[101] == "page 1" and texts[105].startswith("Call us any time")
    assert texts[210] == "the same page" and texts[300] == "" and texts[None] == "y"
    articles = pages.filter("page_id < 100").selectExpr("page_id", "url", "replace(html, '<body>', '<article>') as html")
    # and within one as well: what all pages of a site have is no story's own, of whatever length
    assert {r.page_id: r.text for r in html.extracted(articles).collect()}[3] == "story 3 about 21"
    rare = articles.withColumn("html", F.when(F.col("page_id") % 4 > 0, F.replace("html", F.lit(quoted), F.lit(""))).otherwise(F.col("html")))
    assert {r.page_id: r.text for r in html.extracted(rare).collect()}[4] == f"story 4 about 28\n{quoted}"


NOTICE = "we keep our readers free of charge and so we ask all of you to write to us whenever you like"


def test_long_templates_go_wherever_they_stand(spark):
    rows = []
    for i in range(40):
        notice = f"<div><h2>Dear readers</h2><p>{NOTICE}</p></div>"
        quoted = f"<div><section><p>{NOTICE} too</p></section></div>" if i % 4 == 0 else ""
        rows.append((i, "http://a.example.com/x", f"<article><p>story {i}</p>{notice}{quoted}<section>{NOTICE}</section></article>"))
        rows.append((100 + i, "http://m.example.com/x", f"<main><p>{NOTICE}</p><div>{NOTICE} there</div><div><p>story {i}</p></div></main>"))
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.extracted(pages).collect()}
    assert texts[3] == "story 3" and texts[4] == f"story 4\n{NOTICE} too" and texts[103] == "story 3"


@pytest.mark.parametrize("broadcast", [0, html.BROADCAST_SUBTREES])
def test_templates_of_a_section_go(spark, monkeypatch, broadcast):
    """However many other pages the host has; a section is a folder of URLs, or a kind of page."""
    monkeypatch.setattr(html, "BROADCAST_SUBTREES", broadcast)
    rows = [(i, f"http://a.example.com/news/{i}", f"<div><p>page {i}</p></div>") for i in range(300)]
    rows += [(1000 + i, f"http://a.example.com/sport/ball/{i % 2}/x?{i}", f"<div><p>page {i} of balls</p><ul><li>{NOTICE}</ul></div>") for i in range(20)]
    rows += [(2000 + i, f"http://a.example.com/news/a{i}", f"<div id=shop><p>shop {i}</p><section>{NOTICE}</section></div>") for i in range(20)]
    rows += [(3000 + i, f"http://a.example.com/news/b{i}", f"<div><p>page b{i}</p><section>{NOTICE}</section></div>") for i in range(9)]
    rows += [(4000 + i, f"http://b.example.com/sport/{i}", f"<div><p>other {i}</p><ul><li>{NOTICE}</ul></div>") for i in range(9)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    texts = {r.page_id: r.text for r in html.extracted(pages).collect()}
    assert len(texts) == len(rows) and texts[7] == "page 7"
    assert texts[1003] == "page 3 of balls" and texts[2004] == "shop 4"
    assert texts[3001] == f"page b1\n{NOTICE}" and texts[4001] == f"other 1\n{NOTICE}"  # on too few pages


def test_empty_table(pages):
    assert html.extracted(pages.limit(0)).count() == 0
