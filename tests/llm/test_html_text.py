from __future__ import annotations

import random

from basketwork.llm import html_text as h

PAGES = "page_id long, url string, html string"


def texts(spark, rows, parts=1):
    return {r.page_id: r.text for r in h.extracted(spark.createDataFrame(rows, PAGES).repartition(parts)).collect()}


def test_marked_zones(spark):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p><article>";</script></head><body>
    <header>Site</header><nav><ul><li>One</li></ul></nav><div class="cookie-notice">We use <b>cookies</b></div><!-- ad --><div class="ad">Buy</div>
    <article><h1>Head &amp; tail</h1><p>A&nbsp;b<b>c</b>&#33;<br>d <p>unclosed <i>e</i><aside>Side</aside><form>Name<input></form>
    <div class="shadow">f &lt;g&gt; &am</div><section id="comments"><p>Reader</p></section></article><footer>&copy; F</footer>"""
    assert texts(spark, [(1, "http://a/x", page)])[1] == "Head & tail A bc! d unclosed e f <g> &am"


def test_shared_lines_of_the_nearest_page_go(spark):
    page = "<body><div>Site menu</div><p>own {0}</p><div>Read on</div><p>last &amp; {0}</p><div>Imprint</div></body>"
    rows = [(i, f"https://h.org/n/{i:03}.html?x={i}", page.format(i)) for i in range(60)]
    for parts in (1, 7):
        found = texts(spark, rows, parts)
        assert all(found[i] == f"own {i} last & {i}" for i in range(60))


def test_shared_units_of_articles_go(spark):
    page = "<nav>Menu</nav><article><h1>Same head</h1><p>Same first line</p><div class='x7'>Get our app<ul id=k2><li>Here</li></ul></div><p>own text of the page {0}</p><div class='x8'>Seen by {0}</div></article>"
    rows = [(i, f"https://h.org/n/{i:03}", page.format(i)) for i in range(60)] + [(99, "https://alone.org/n", page.format(99))]
    for parts in (1, 7):
        found = texts(spark, rows + rows[:5], parts)
        assert all(found[i] == f"Same head Same first line own text of the page {i} Seen by {i}" for i in range(60))
        assert found[99] == "Same head Same first line Get our app Here own text of the page 99 Seen by 99"


def test_copies_of_an_article_stay_whole(spark):
    page = "<article><h1>Head {0}</h1><div class='body'><p>the same long text</p><p>on two addresses</p></div></article>"
    found = texts(spark, [(i, f"https://h.org/{i}", page.format(i)) for i in range(3)])
    assert all(found[i] == f"Head {i} the same long text on two addresses" for i in range(3))


def test_same_path_is_no_partner(spark):
    rows = [(1, "http://h/a?p=1", "<p>one</p><p>two</p>"), (2, "http://h/a?p=2", "<p>one</p><p>two</p>"), (3, "http://other/b", "<p>one</p>")]
    assert texts(spark, rows) == {1: "one two", 2: "one two", 3: "one"}


def test_names_of_layouts_are_no_furniture(spark):
    rows = [
        (1, "http://a/1", "<div class='layout has-sidebar'><article>Text one</article></div>"),
        (2, "http://b/2", "<div class='entry-content comments-open'><p>Text two</p></div><div class='sidebar'>Side</div>"),
        (3, "http://c/3", "<div class='page sidebar'><p>Text three is long</p></div><p>x</p>"),
        (4, "http://d/4", "<div id=wrap role='main'>Text four<div class='share-buttons'>Share</div></div><p>Outside</p>"),
        (5, "http://e/5", "<p>Text five</p><section class='comments'><p>Readers write at length about this and that</p></section>"),
        (6, "http://f/6", "<main><header>Head</header>Text six<div class='related-posts'>More</div><div class='entry-header'>!</div></main>"),
    ]
    words = {1: "one", 2: "two", 3: "three is long x", 4: "four", 5: "five", 6: "six !"}
    assert texts(spark, rows) == {i: f"Text {w}" for i, w in words.items()}


def test_pages_without_a_host_have_no_partner(spark):
    rows = [(1, None, "<p>same</p><p>a</p>"), (2, "http://[bad", "<p>same</p><p>b</p>"), (3, "", "<p>same</p>"), (4, "no host", "<p>same</p><p>c</p>")]
    assert texts(spark, rows) == {1: "same a", 2: "same b", 3: "same", 4: "same c"}


def test_many_named_elements_take_linear_time():
    page = "<div class='box ad-x'>" * 3000 + "text" + "</div>" * 3000 + "<div class='ad'>buy</div>" * 20000 + "long text " * 30000
    import time

    start = time.process_time()
    assert h.page_lines(page)
    assert time.process_time() - start < 10


def test_common_lines_are_longest():
    rng = random.Random(2)
    for _ in range(300):
        a, b = (rng.choices(range(5), k=rng.randint(0, 12)) for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        at = h.common_lines(a, b)
        assert len(at) == table[-1][-1] and at == sorted(set(at))
        it = iter(b)
        assert all(a[i] in it for i in at)


def test_odd_and_empty(spark):
    rows = [(None, None, None), (1, "", ""), (2, "http://[", "<div>x"), (3, "u", "plain < text"), (4, "http://h/z", "<p>" * 3000 + "deep"), (4, "http://h/z", "<p>again")]
    frame = spark.createDataFrame(rows, PAGES).selectExpr("*", "1 AS text", "2 AS rid", "'x' AS host", "3 AS n_chars")
    out = h.extracted(frame)
    assert out.columns == ["page_id", "url", "text", "n_chars"] and out.count() == 6
    assert {(r.page_id, r.text, r.n_chars) for r in out.collect()} >= {(None, "", 0), (1, "", 0), (2, "x", 1), (4, "deep", 4)}
    assert h.extracted(frame.limit(0)).count() == 0
