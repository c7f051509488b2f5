import random
import time

from parlato.llm.html_text import common_lines, extract, lines, main_text

SCHEMA = "page_id long, url string, html string, text string"


def run(spark, rows, **given):
    df = spark.createDataFrame([(*r, "clash") for r in rows], SCHEMA)
    return {(r["page_id"], r["url"]): r["text"] for r in extract(df, **given).collect()}


def test_markup():
    page = (
        '<html><head><title>t</title></head><body class="nav-open"><header><h1>Site</h1></header>'
        '<div id=cookie-notice>We use</div><ul class="menu"><li>A<li>B</ul><main><p>Intro<article><header><h1>Head &amp; tail</h1>'
        '</header><p class="lead">One<br>two&nbsp;three <b>b</b>old<p class="ad">Buy<p>Next &lt;p&gt; 5 < 6<ul><li>i1<li>i2</ul>'
        '<script>if(a<b){"</p>"}</script><section id="comments"><p>nice!</section></article></main><aside>x</aside><footer>f'
    )
    assert main_text(lines(page), None) == "Head & tail\nOne two three bold\nNext <p> 5 < 6\ni1\ni2"
    assert lines("<div>a<div>b</div>c</div><p>d") == [("open", x) for x in "abcd"]
    assert lines(None) == lines("") == lines("<script>x") == lines("<!-- x") == []
    assert lines("<p>x<scr") == [("open", "x")]
    assert lines("</p></div>a &eacute; &am b") == [("open", "a é &am b")]
    assert lines('<p title="a>b" hidden>x</p><p>y') == [("chrome", "x"), ("open", "y")]


def text_of(page, near=None):
    return main_text(lines(page), None if near is None else lines(near))


def test_nothing_of_an_article_is_lost():
    assert text_of("<article><p title=it's>Hello</p><p>World</p><p>it's fine</p></article>") == "Hello\nWorld\nit's fine"
    page = (
        '<article><h2 id="related-work">Work</h2><section id="search-algorithms"><p>Algorithms</p></section><p class="share-price">Price'
        '<p>x <math><mi>a</mi></math> b <span class="ad">buy</span> c<div class="shareButtons">S</div><div class="related-posts">R</div></article>'
    )
    assert text_of(page) == "Work\nAlgorithms\nPrice\nx a b c"
    assert text_of("<main><p>Long main text</p><article><p>teaser card</p></article></main>") == "Long main text\nteaser card"
    assert text_of('<article>a <span class="ad">b<div>c</div>d</span> e</article><p>f') == "a e"
    assert text_of('<p>a<p title="no end>b<p>c') == "a\nb\nc"


def test_alignment_decides_what_markup_leaves_open():
    page = '<main><p>{0} has text enough of its own</p><p>Read our terms</p><article>{0} card <i>x</i></article></main>'.format
    assert text_of(page("one"), page("two")) == "one has text enough of its own\none card x"
    page = '<article><p>{0} text</p><p>All may copy this</p><div class="price-alert">{1}</div></article>'.format
    assert text_of(page("one", "Join us"), page("two", "Join us")) == "one text\nAll may copy this"
    assert text_of(page("one", "Up by 3"), page("two", "Down by 4")) == "one text\nAll may copy this\nUp by 3"
    page = "<main><p>{0}</p><p>the same long text in both versions</p></main>".format
    assert text_of(page("one"), page("two")) == "one\nthe same long text in both versions"


def test_markup_takes_linear_time():
    n = 100_000
    pages = ["<a " * n + '"', "<" * n, "<b>" * n + "</i>" * n, "<a " + "b" * n + ">", '<a b="' * n, "<a b='c" * n + '"', "<p class=" + " " * n + "x>"]
    start = time.monotonic()
    for page in [*pages, "<a" + " b  " * n + ">", "<!--" * n, "<title>" * n, "<b>" * n + "</b>" * n]:
        lines(page)
    assert time.monotonic() - start < 60


def test_against_plain_pages():
    """Pages made of blocks whose part is known, against the blocks that belong to the text."""
    rng = random.Random(3)
    around = ['<nav><a href="/{0}">{0}</a></nav>', '<div class="ad-slot">{0}</div>', "<footer>{0}", "<form>{0}</form>", '<section id="comments"><p>{0}</section>']
    inside = ["<p>{0}</p>", "<p>{0}", '<h2 id="menu-{1}">{0}</h2>', "<ul><li>{0}</ul>", "<div>{0}<script>{1}</script></div>", "<p title={1}'>{0}</p>"]
    for _ in range(200):
        words = [f"w{rng.randrange(10**6)} &amp; v" for _ in range(20)]
        wanted, page = [], ["<article>"]
        for word in words:
            if rng.random() < 0.7:
                wanted.append(word.replace("&amp;", "&"))
                page.append(rng.choice(inside).format(word, rng.randrange(9)))
            else:
                part = rng.choice(around).format(word)
                page.append(part + "</footer>" * part.startswith("<footer"))
        assert text_of("".join(page)) == "\n".join(wanted)


def test_common_lines_are_longest():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.choice("abcd") for _ in range(rng.randrange(10))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(common_lines(a, b))
        rest = iter(b)
        assert len(found) == table[-1][-1] and all(a[k] in rest for k in found)


def test_differencing_with_nearest_url(spark):
    page = "<div>Welcome to the site</div><div>{}</div><div>All rights reserved</div>".format
    rows = [(k, f"http://h{k % 3}.org/a/{k // 3:03d}?q=1", page(f"text of page {k}")) for k in range(90)]
    rows += [(100, "http://alone.org/x", page("single")), (101, None, None), (102, "not a url", "<p>z"), (None, "http://h0.org/a", page("no id"))]
    for size in (4, 1000):
        found = run(spark, rows, range_rows=size)
        assert len(found) == len(rows)
        assert all(found[k, u] == f"text of page {k}" for k, u, _ in rows[:90])
        assert found[100, "http://alone.org/x"] == "Welcome to the site\nsingle\nAll rights reserved"
        assert found[101, None] == "" and found[102, "not a url"] == "z" and found[None, "http://h0.org/a"] == "no id"


def test_copies_keep_their_text(spark):
    article = "<nav>m</nav><article><p>same text</p><p>more</p></article>"
    rows = [(k, "http://a.org/p", article) for k in range(40)] + [(50, "http://a.org/q", "<div>only line</div>"), (51, "http://a.org/q", "<div>only line</div>")]
    found = run(spark, rows, range_rows=8)
    assert found[3, "http://a.org/p"] == "same text\nmore" and found[50, "http://a.org/q"] == "only line"


def test_long_page_and_no_rows(spark):
    page = "<article>" + "".join(f"<p>line {k}" for k in range(20_000)) + "</article>"
    found = run(spark, [(1, "http://a.org/1", page), (2, "http://a.org/2", page)])
    assert found[1, "http://a.org/1"].count("\n") == 19_999
    assert run(spark, []) == {}
