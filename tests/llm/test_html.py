"""Main text against the articles that pages were made of, and templates of sites."""

import html
import re
import time

from tickertide.llm.html import extract_text, parse
from tickertide.llm.registry import table


def test_articles_of_the_pages(spark):
    pages = table(spark, "/root/testdata/sf0.01", "pages")
    raw = {r.page_id: r.html for r in pages.collect()}
    rows = extract_text(pages).collect()
    assert len(rows) == len(raw)
    for r in rows:
        article = re.search(r"<article>(.*)</article>", raw[r.page_id], re.S)[1].replace("<br>", " ")
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in re.split(r"</?(?:p|h1)>", article)]
        assert r.text == "\n".join(b for b in blocks if b)
        assert r.n_chars == len(r.text)


def page(i, body):
    return f"<html><head><title>t{i}</title><script>if (a<b) x='</p>'</script></head><body>{body}</body></html>"


def test_templates_and_odd_pages(spark):
    rows = [
        (i, f"http://site.example/{i}", page(i, f"<div id=top><p>Site of all things</p></div><div class=c{i}><p>Page {i} says &amp;lt; &eacute;&#233;&#x41;\n  <b>bold</b> things<br>here</p><p>second {i}</p></div><div><span>All rights reserved</span></div>"))
        for i in range(8)
    ]
    article = "<div class='Share-Bar'>share</div><article><header><h1>Title {0}</h1></header><div><p>Our newsletter is great</p></div><p>Repeated words</p><p>Own words {0}</p><div class=comments><p>first!</p></div><footer>by me</footer></article>"
    rows += [(100 + i, f"http://news.example/{i}", page(i, article.format(i))) for i in range(6)]
    # Copies of one page are no template.
    rows += [(200 + i, "http://copies.example/", page(0, "<div><p>Copied text</p><p>of one page</p></div>")) for i in range(9)]
    rows += [(300, None, None), (301, "http://e.example/", ""), (302, "http://e.example/", "no markup & a < b"), (303, "x", "<p>unclosed <i>all<p>two<!-- gone"),
             (304, "http://e.example/", "<p>" + "long " * 50000), (305, "http://e.example/", "<div>" * 3000 + "deep"), (306, "http://e.example/", "<nav>menu</nav><form>f</form>"),
             (0, rows[0][1], rows[0][2])]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "page_id bigint, url string, html string, text string").repartition(5)
    out = extract_text(docs).collect()
    assert len(out) == len(rows)
    got = {r.page_id: r.text for r in out}
    assert all(got[i] == f"Page {i} says &lt; ééA bold things here\nsecond {i}" for i in range(8))
    assert all(got[100 + i] == f"Title {i}\nRepeated words\nOwn words {i}" for i in range(6))
    assert all(got[200 + i] == "Copied text\nof one page" for i in range(9))
    assert got[300] == got[301] == got[306] == "" and got[302] == "no markup & a < b" and got[303] == "unclosed all\ntwo"
    assert got[304] == ("long " * 50000).strip() and got[305] == "deep"
    assert all(r.n_chars == len(r.text) for r in out)
    assert extract_text(docs.limit(0)).count() == 0


def test_wrappers_named_like_asides(spark):
    text = "<h1>Title {0}</h1><p>Own words of page {0} and more of them</p>"
    bodies = [
        "<div class='container has-sidebar'>" + text + "</div>",
        "<div class='content no-sidebar'><article class='post hentry category-social'>" + text + "</article></div>",
        "<article class='entry comments-open'>" + text + "</article><div id=comments><p>first</p></div>",
        "<div class='elementor-widget-theme-post-content'>" + text + "</div><div class='ad'>Buy {0}</div>",
        "<div class='widget'><div class='sidebar'>" + text + "</div></div><div class='related'><article>Other {0}</article></div>",
        "<form id=aspnetForm><div id='banner'><article class='sponsored'>" + text + "</article></div></form><div id=comments>" + "<p>so {0} many remarks</p>" * 20 + "</div>",
    ]
    rows = [(i, f"http://host{i}.example/", page(i, b.format(i))) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"Title {i}\nOwn words of page {i} and more of them" for i in range(len(bodies))}


def test_templates_of_a_large_host(spark):
    menu = "<ul><li><a href=/a>Home</a></li><li><a href=/b>All news</a></li></ul><div><p>This shop is closed over the holidays of the year</p></div>"
    rows = [(i, f"http://large.example/{i}", page(i, (menu if i % 25 == 0 else "") + f"<div><p>Own words {i}</p><p>{'Yes' if i % 25 == 1 else i}</p></div>")) for i in range(500)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"Own words {i}\n{'Yes' if i % 25 == 1 else i}" for i in range(500)}


def test_names_of_parts(spark):
    text = "<h1>Title {0}</h1><p>Own words of page {0} and more of them</p>"
    bodies = [
        "<article>" + text + "<div data-id='share' aria-menuid=menu data-role=search><p>Main words</p></div></article>",
        "<div>" + text + "<p>Main words</p></div><div class='comment-list'><p>first one {0}!</p></div><div id=site_footer>by me {0}</div>",
        "<div class='sidebar-left'>left {0}</div><ul class='nav-menu'><li>menu {0}</ul><div>" + text + "<p class='comments-open'>Main words</p></div>",
        "<article class='site-post'>" + text + "<p>Main words</p></article><section ID = 'comments-2'><p>so {0}</p></section>",
    ]
    rows = [(i, f"http://host{i}.example/", page(i, b.format(i))) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == {i: f"Title {i}\nOwn words of page {i} and more of them\nMain words" for i in range(len(bodies))}


def test_broken_markup(spark):
    bodies = {
        "<p>one</p><a title=\"x>two</a><p>three</p>": "one\ntwo\nthree",
        "<p>one <a href='a>b'>two</a> <i": "one two <i",
        "<p>a < b <!-- <p>no</p> --> c</p><!doctype html><p>d": "a < b c\nd",
        "<p>one</p></div></x><p>two</section>": "one\ntwo",
    }
    rows = [(i, f"http://host{i}.example/", b) for i, b in enumerate(bodies)]
    got = {r.page_id: r.text for r in extract_text(spark.createDataFrame(rows, "page_id bigint, url string, html string")).collect()}
    assert got == dict(enumerate(bodies.values()))


def test_parser_is_linear():
    """Megabytes of broken markup are parsed in seconds."""
    n = 200_000
    for text in ("<a \"" * n, "<a \">\" " * n, "<a '>" * n, "<a" * n, "<div>" * n + "</p>" * n, "<article>" + "<div>" * n + "</section>" * n,
                 "<section><article>" + "<b>" * n + "</section>" * n, "<p " + "x " * n + ">", "<!--" * n, "<ul>" * n + "<li>" * n):
        begin = time.process_time()
        parse(text)
        assert time.process_time() - begin < 15, text[:20]
