"""Main text: blocks, priors, importance of tree nodes, broken markup, edge cases."""

import math

import pytest

from tillroll.llm import style_tree as st

ARTICLE = "<article><h1>Head &amp; more</h1><p>One\n two<br>three <b>bold</b><p>x &lt; y &copy; &#233;</p></article>"
TEXT = "Head & more\n\nOne two three bold\n\nx < y © é"


def page(article=ARTICLE, before="", after=""):
    return ("<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t='</p><article>x';</script></head>"
            f"<body><nav><ul><li><a href='/a'>A</a></li></ul></nav><!-- ad <p>no</p> -->{before}{article}{after}"
            "<footer>&copy; x</footer></body></html>")


@pytest.mark.parametrize("html,want", [
    (page(), TEXT), (page(before="<div class='ad'>Buy</div>", after="<aside>side</aside><form>f</form>"), TEXT),
    (page(after="<article class='comment'><p>first!</p></article>"), TEXT), ("", ""), ("plain text", "plain text"),
    ("<p>a<p>b", "a\n\nb"), ("<p>a</p>b<div>c<div>d</div>e</div>", "a\n\nb\n\nc\n\nd\n\ne"), ("a < b <", "a < b <"),
    ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\n\nb\n\nc"), ("<b><p>x</b>y</p>z", "xy\n\nz"), ("<p>&am &amp &lt</p>", "&am & <"),
    ("<article><p>a</article></p></div>", "a"), ("<article><p>cut off &am", "cut off &am"), ("<a href='>'>x</a>", "x"),
    ("<a href=\"x>y</a><p>z", "y\n\nz"), ("<script>x", ""), ("<article><script>a</script><p>b</p></article>", "b"),
    ("<main><p>a</p></main><p>b</p>", "a"), ("<article><header><h1>T</h1></header><p>b</p></article>", "T\n\nb"),
    ("<article><div class='share-bar'>s</div><p>b</p><section id='comments'>c</section></article>", "b"),
    ("<body class='nav ad'><p>a</p></body>", "a"), ("<p hidden>x</p><p>y</p>", "y"), ("<P>Up</P>", "Up"),
    ("<body><header><h1>Site</h1></header><div><p>a</p></div></body>", "a"),
    ("<div class='cookie-notice'>We use</div><ins class='adsbygoogle'>Buy</ins><p>a</p>", "a"),
    ("<article>one</article><article>two</article>", "one\n\ntwo"), ("x<!-- open", "x"), ("a\u00a0 b&nbsp;c", "a b c"),
])
def test_blocks(html, want):
    assert st.extract(html, "h", None) == want


def test_importance_by_hand(spark):
    pages = [(i, "http://h/x", f"<body><div class='box'>{'same' if i < 6 else 'other'}</div><p>text {i}</p></body>")
             for i in range(8)]
    table = spark.createDataFrame(pages, "page_id long, url string, html string")
    got = {r.node: r.importance for r in st.importances(table).collect()}
    nodes = {n.sig: st._signed(n.key) for n in st.keyed(st.parse(pages[0][2]), "h")}
    entropy = -(6 / 8) * math.log(6 / 8) - (2 / 8) * math.log(2 / 8)
    spread = 1 - (6 * math.log(6) + 2 * math.log(2)) / (8 * math.log(8))
    assert spread == pytest.approx(entropy / math.log(8))
    assert got[nodes["div.box"]] == pytest.approx(spread, abs=1e-6)
    assert nodes["p"] not in got and got[nodes["body"]] == pytest.approx(0, abs=1e-6)


def test_same_boxes_go_and_copied_articles_stay(spark):
    rows = []
    for i in range(12):
        box = "<div class='x1'>Read all about our offers here</div>"
        rows.append((i, "http://Shop.com/a", f"<body><article><h1>T{i}</h1>{box}<p>own words {i}</p></article></body>"))
        rows.append((100 + i, "http://copy.com/b", "<article><h1>Same</h1><div class='x1'><p>for all</p></div></article>"))
        rows.append((200 + i, "http://plain.com/c", f"<body><div class='y'>stays put</div><div><p>varied {i}</p></div></body>"))
    rows += [(300, None, None), (301, "http://shop.com/z", ""), (None, "http://shop.com/a", rows[0][2]), (0, rows[0][1], rows[0][2]),
             (302, "http://long.com", "<article><p>" + "long " * 200000 + "</p></article>")]
    table = spark.createDataFrame([(*r, "x") for r in rows], "page_id long, url string, html string, text string").repartition(4)
    for size in (st.PART, 2):
        got = {r.page_id: r for r in st.main_text(table, part_size=size).collect()}
        assert got[3].text == "T3\n\nown words 3" and got[105].text == "Same\n\nfor all" and got[207].text == "varied 7"
        assert got[300].text == "" and got[300].n_chars == 0 and got[301].text == "" and got[None].text == "T0\n\nown words 0"
        assert got[302].n_chars == 999999
    assert st.main_text(table).count() == len(rows) and st.main_text(table.limit(0)).count() == 0


def test_copied_text_beside_a_small_varying_part_stays(spark):
    same, rows = "The same long report, sentence after sentence. " * 40, []
    for i in range(6):
        rows.append((i, "http://a.com/x", f"<html><body><p>{same}</p><div class=x>date {i}</div></body></html>"))
        rows.append((10 + i, "http://b.com/x", f"<article><time>{i} May</time><div class=body><p>{same}</p></div></article>"))
        parts = "".join(f"<div class=p{c}>{c * 3} {same[:600]}</div>" for c in "abc")
        rows.append((20 + i, "http://c.com/x", f"<body><div id=wrap>{parts}<p>date {i}</p></div></body>"))
        rows.append((30 + i, "http://d.com/x", f"<article><h1>T{i}</h1><time>{i} May</time><div class=body><p>same text</p></div></article>"))
    got = {r.page_id: r.text for r in st.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[3] == same.strip() + "\n\ndate 3" and same.strip() in got[13] and got[13].startswith("3 May")
    assert all(c * 3 + " The same" in got[23] for c in "abc") and got[23].endswith("date 3")
    assert got[33] == "T3\n\n3 May\n\nsame text"


LONG = "Own words of this very page, one after another. " * 8


@pytest.mark.parametrize("html,want", [
    ("<div class='page has-sidebar'><article><h1>T</h1><p>b</p></article></div>", "T\n\nb"),
    ("<div class='layout with-header'><main><p>b</p></main></div>", "b"),
    ("<div class='page has-sidebar comments-open'><p>plain</p></div>", "plain"),
    ("<article><header class='entry-header'><h1>T</h1></header><p>b</p></article>", "T\n\nb"),
    ("<article><div class='share'><h2>Share</h2></div><h1 class='banner'>T</h1><p>b</p></article>", "T\n\nb"),
    (f"<article><p>{LONG}</p><section class='social-history'>{LONG}</section></article>", f"{LONG.strip()}\n\n{LONG.strip()}"),
    (f"<article><p>{LONG}</p><section class='comments'>{LONG}</section><div class='related'>Next</div></article>", LONG.strip()),
])
def test_names_are_a_prior(html, want):
    assert st.extract(html, "h", None) == want


def test_named_boxes_go_by_what_the_host_shows(spark):
    rows = [(i, "http://h.com/x", f"<article><h1>T{i}</h1><p>{i} {LONG}</p><section class='related-work'>{i} {LONG}</section>"
             f"<section class='info-notice'>{LONG}</section></article>") for i in range(6)]
    got = {r.page_id: r.text for r in st.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[4] == f"T4\n\n4 {LONG.strip()}\n\n4 {LONG.strip()}"


def test_a_teaser_beside_the_content_is_not_the_article(spark):
    html = f"<body><div id=content><p>{LONG * 8}</p></div><article class=teaser>Read next</article></body>"
    assert LONG.strip() in st.extract(html, "h", None)
    rows = [(i, "http://h.com/x", html.replace("Own", f"Page {i} own")) for i in range(6)]
    got = {r.page_id: r.text for r in st.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[2].startswith("Page 2 own words")


def test_the_tree_finds_the_short_article_among_shared_text(spark):
    """Without the style tree the long text that all pages show counts as content."""
    shared = "".join(f"<div class=b{c}><p>{c} {LONG}</p></div>" for c in "abcd")
    rows = [(i, "http://h.com/x", f"<body><div>{shared}</div><article><h1>T{i}</h1><p>short words {i}</p></article></body>") for i in range(8)]
    got = {r.page_id: r.text for r in st.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert got[5] == "T5\n\nshort words 5"
    assert st.extract(rows[5][2], "h.com", None) != got[5]


def test_recall_on_planted_pages(spark):
    """Words of the planted articles that come back, and words that should not:
    pages of three layouts, two without any article element."""
    rows, want = [], {}
    for i in range(90):
        body = [f"Word{i}x{k} says number {i * 7 + k} of {k * k + i} things." for k in range(3 + i % 9)]
        paragraphs = "".join(f"<p>{b}</p>" for b in body)
        menu = "<div class=m1>" + "".join(f"<a href=/{k}>Section {k}</a> " for k in range(8)) + "</div>"
        legal = "<div class=z9><p>All rights reserved by the house, see the terms of use.</p></div>"
        layout = (f"<body>{menu}<article><h1>Title {i}</h1>{paragraphs}</article>{legal}</body>",
                  f"<body>{menu}<div class=content><h1>Title {i}</h1>{paragraphs}</div>{legal}</body>",
                  f"<table><tr><td>{menu}</td><td><h1>Title {i}</h1>{paragraphs}</td></tr><tr><td>{legal}</td></tr></table>")[i % 3]
        rows.append((i, f"http://host{i % 3}.com/{i}", layout))
        want[i] = "\n\n".join([f"Title {i}", *body])
    got = {r.page_id: r.text for r in st.main_text(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    kept = sum(len(set(want[i].split()) & set(got[i].split())) for i in want)
    recall = kept / sum(len(set(w.split())) for w in want.values())
    extra = sum("rights reserved" in t or "Section 3" in t for t in got.values())
    assert recall == 1.0 and extra == 0
    assert got == want
