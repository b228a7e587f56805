"""Blocks and main texts of hand-made pages; alignment and pairing against plain versions."""

import html as H
import random
import re

import pytest

from rillmart.llm import html_blocks, html_diff


def lcs(a, b):
    n = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            n[i + 1][j + 1] = n[i][j] + 1 if x == y else max(n[i][j + 1], n[i + 1][j])
    return n[-1][-1]


@pytest.mark.parametrize("listed", [200_000, 0])
def test_alignment(monkeypatch, listed):
    monkeypatch.setattr(html_diff, "LISTED_PAIRS", listed)
    r = random.Random(1)
    for _ in range(400):
        a, b = ([r.randrange(k) for _ in range(r.randrange(25))] for k in (r.choice([2, 6, 30]),) * 2)
        places = html_diff.shared_lines(a, b)
        assert places == sorted(set(places)) and len(places) == lcs(a, b)
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in places)


def main(page, neighbour=None):
    return html_diff.main_lines(html_blocks.blocks(page), neighbour and html_diff.line_codes(html_blocks.blocks(neighbour)))


def test_furniture_goes():
    page = """<!DOCTYPE html><html><head><title>t</title><style>p{}</style><script>var t="</p>";</script></head>
    <body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a>Home</a></ul></nav><!-- <p>no</p> --><div class="ad">Buy</div>
    <div class="content-sidebar"><article><header><h1>Title &amp; <i>more</i></h1></header><p>One &lt;tag&gt;&nbsp;
    and&#33;<br>two<p title="a>b">Three<aside>Aside</aside><ul><li>x<li>y</ul><table><tr><td>c1<td>c2</table><pre> a
     b</pre><form><input>Name</form><p class="sponsored">Ad</p><div hidden>Gone</div><section id="comments"><article>Reader</article></section>
    </article></div><aside>Side</aside><div id="cookie-notice">Cookies</div><div role="contentinfo">Foot</div><footer>&copy;</footer>"""
    assert main(page) == ["Title & more", "One <tag> and! two", "Three", "x", "y", "c1", "c2", "a b"]


def test_shared_lines_go_where_no_article_says_better():
    a = "<body><div>Brand</div><div>Topics</div><div>The first story.</div><p>It is long.</p><div>All rights</div>"
    b = "<body><div>Brand</div><div>Topics</div><div>Another story.</div><p>Other words.</p><div>All rights</div>"
    assert main(a, b) == ["The first story.", "It is long."] and main(b, a) == ["Another story.", "Other words."]
    assert len(main(a, a)) == 5  # a copy tells nothing
    x, y = (p.replace("<body>", "<body><article>") for p in (a, b))
    assert len(main(x, y)) == 5


def test_broken_markup():
    assert main("a < b & c") == ["a < b & c"] and main("") == [] and main("<") == ["<"]
    assert main("<p>x<script>never closed") == ["x"] and main("<p>x<!-- never closed") == ["x"]
    assert main("</div></p>text</b>") == ["text"] and main('<p class="x>unclosed quote</p><p>y') != []
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    assert main(deep) == ["deep"]
    assert main("<p>" + "w " * 200_000) == [("w " * 200_000).strip()]


def test_only_closed_elements_hide_text():
    for x in ("<svg/>", '<svg class="a" viewBox="0 0 1 1" />', "<math/>", "<iframe/>", "<video-player></video-player>", "<svg-icon></svg-icon>", "<title-bar></title-bar>",
              "<select-box>", "<video src=a>", "<object>", "<svg>", "<canvas><video></video>", "<svg><svg><title>t</title></svg><p>x</p></svg>", "<iframe><p>x</p></iframe>"):
        assert main(f"<article><p>one</p>{x}<p>two</p><p>three</p></article>") == ["one", "two", "three"], x
    assert main("<p>If <math><mi>x</mi><mo>=</mo><mn>2</mn></math> holds <svg><text>no</text></svg>here.") == ["If x=2 holds here."]
    assert main("<video><p>one</p><video>no</video><p>two</p>") == ["one", "two"]
    assert main("<script>'<svg>'</script><p>one</p><!-- <svg> --><p>two</p><svg>no</svg>") == ["one", "two"]


def test_layout_and_topic_names_are_no_furniture():
    for x in ("article class='post category-social'", "article class='post tag-notices'", "article class='teaser'", "main class='has-sidebar'", "main class='sidebar'",
              "div id=content class='no-sidebar'", "div class='withSidebar without-comments'"):
        assert main(f"<body class='sidebar'><{x}><p>one</p></{x.split()[0]}>") == ["one"], x
    assert main("<div class='content-sidebar'><article class='category-social'><p>one</p></article></div>") == ["one"]
    assert main("<article><p>one</p><article class='comment'>Reader</article></article><div id=comments><article class=comment>Reader</article></div>") == ["one"]
    assert main("<p>one</p><div class='notice'>Notice</div><div class='sidebar no-print'>Side</div>") == ["one"]


def test_inline_furniture_goes_without_ending_the_block():
    for x in ('<span class="share-links">Share this</span>', '<a class="ad">Buy now</a>', "<button>Click</button>", "<span hidden>secret</span>",
              '<i aria-hidden="true">icon <b>deep</b></i>', '<span class="ad">never closed', '<label style="display: none">x</label>'):
        assert main(f"<article><p>one {x} two</p><p>three</p></article>")[-1] == "three", x
        want = ["one", "three"] if "never" in x else ["one two", "three"]
        assert main(f"<article><p>one {x} two</p><p>three</p></article>") == want, x
    assert main("<p>a<b>b</b>c <a class=ad>no</a>d<br>e</p>") == ["abc d e"]
    assert main("<p>one <span role=article>two</span> three") == ["two"]
    assert main("<article>one<span class=ad>no<p>no</p></span>two</article>") == ["one", "two"]


def test_names_about_the_text_are_no_furniture():
    for x in ("class='social-history'", "class='notice-of-death'", "class='reply-quote'", "class='share-prices'", "class='menu-of-the-day'", "id='navigation-at-sea'",
              "id='cookie-recipe'", "class='adMinistration' id='menuPlan'"):
        for tag in ("p", "h2", "div", "section", "table", "span"):
            inner = "<tr><td>one</table>" if tag == "table" else f"one</{tag}>"
            assert main(f"<article><{tag} {x}>{inner}<p>two</p></article>") in (["one", "two"], ["onetwo"]), (tag, x)
    for x in ("id='user-feedback'", "class='share-links'", "class='cookie-banner'", "class='adUnit'", "class='post-share-buttons'", "id=comments", "class='x related-posts'"):
        assert main(f"<article><p>one</p><div {x}>no</div><p>two</p></article>") == ["one", "two"], x


def test_main_text_lies_where_the_text_is():
    card = "<article class='card'>other story</article>"
    assert main(f"<div>Top</div><main><p>story of many more words</p>{card}</main>") == ["story of many more words", "other story"]
    assert main("<div>Top</div><main><p>date</p><article>story of many more words</article></main>") == ["story of many more words"]


def rows_of(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.withColumns({c: F.lit("own") for c in ("row", "near", "lines", "text", "k", "part")})


def test_edges(spark):
    page = "<body><div>Top</div><p>{}</p><div>End</div>"
    rows = [(1, "http://a.org/x/1", page.format("one")), (2, "http://a.org/x/2?q", page.format("two")), (2, "http://a.org/x/2?q", page.format("two")),
            (3, "http://b.org/y", page.format("alone")), (4, None, None), (5, None, ""), (None, "http://a.org/x/3", page.format("three")),
            (6, "not a url", "<p>z"), (7, "http://A.org/x/1", page.format("same path"))]
    got = html_diff.main_texts(rows_of(spark, rows)).collect()
    want = {1: "one", 2: "two", 3: "Top\nalone\nEnd", 4: "", 5: "", None: "three", 6: "z", 7: "same path"}
    assert sorted((str(r.page_id), r.text) for r in got) == sorted((str(i), want[i]) for i, _, _ in rows)
    assert all(r.n_chars == len(r.text) for r in got)
    assert html_diff.main_texts(rows_of(spark, rows).filter("false")).collect() == []


def test_pairs(spark):
    r = random.Random(4)
    urls = [f"http://h{r.randrange(3)}.org/" + "/".join(str(r.randrange(4)) for _ in range(r.randrange(1, 5))) + f"/p{i}" for i in range(200)]
    pages = rows_of(spark, [(i, u, f"<p>{i}") for i, u in enumerate(urls)])
    keyed = {x.row: x.url for x in pages.select(html_diff._row_key().alias("row"), "url").collect()}
    parts = {k: re.match(r"http://([^/]*)(.*)", u).groups() for k, u in keyed.items()}
    order = sorted(parts, key=lambda k: (*parts[k], k))

    def near(a, b):
        if a is None or b is None or parts[a][0] != parts[b][0]:
            return -1
        x, y = parts[a][1].split("/"), parts[b][1].split("/")
        return next((i for i, (s, t) in enumerate(zip(x, y)) if s != t), min(len(x), len(y)))

    want = {}
    for i, k in enumerate(order):
        b, a = (order[i - 1] if i else None), (order[i + 1] if i + 1 < len(order) else None)
        want[k] = None if max(near(k, b), near(k, a)) < 0 else b if near(k, b) >= near(k, a) else a
    assert {x.row: x.near for x in html_diff.nearest_pages(pages).collect()} == want


def test_copies_are_passed_over(spark):
    """Against a plain scan; long runs of copies fill whole range partitions."""
    r = random.Random(5)
    rows, i = [], 0
    for host in ("a", "b", "c"):
        for _ in range(14):
            text = r.randrange(3)
            for _ in range(r.choice([1, 1, 2, 30])):
                rows.append((i, f"http://{host}.org/{i // 7:03}/{i:04}", f"<article><p>text {text}</article><footer>{i}</footer>"))
                i += 1
    pages = rows_of(spark, rows)
    row = {x.page_id: x.row for x in pages.select("page_id", html_diff._row_key().alias("row")).collect()}
    parts = [(u.split("/")[2], u.split("/", 3)[3].split("/"), h.split("<footer>")[0]) for _, u, h in rows]
    want = {}
    for i, (host, path, text) in enumerate(parts):
        def near(j):
            return -1 if j is None else next((n for n, (x, y) in enumerate(zip(path, parts[j][1])) if x != y), 2)

        b = next((j for j in range(i - 1, -1, -1) if parts[j][0] == host and parts[j][2] != text), None)
        a = next((j for j in range(i + 1, len(parts)) if parts[j][0] == host and parts[j][2] != text), None)
        want[row[i]] = None if a is None and b is None else row[b] if near(b) >= near(a) else row[a]
    assert {x.row: x.near for x in html_diff.nearest_pages(pages).collect()} == want


def test_differencing_inside_articles_and_beside_near_copies(spark):
    page = "<body><article><p>Share this story</p><p>Story {}</p><p>{}</p><p>Read more</p></article>"
    said = ["The same sentence", "The same sentence", "A third", "A fourth", "A fifth"]
    rows = [(i, f"http://a.org/{i}", page.format(i, x)) for i, x in enumerate(said)]
    # A copy at another address hides no template.
    rows += [(10, "http://a.org/0/copy", page.format(0, said[0]))]
    # A template of nearly all lines of a page without an article.
    template = "<body>" + "".join(f"<div>Line {k}</div>" for k in range(9))
    rows += [(20 + i, f"http://b.org/{i}", f"{template}<p>Story {i}</p>") for i in range(4)]
    # Two texts alone do not tell what is common.
    rows += [(30 + i, f"http://c.org/{i}", page.format(i, "x")) for i in range(2)]
    got = {r.page_id: r.text.split("\n") for r in html_diff.main_texts(rows_of(spark, rows)).collect()}
    assert [got[i] for i in range(5)] == [[f"Story {i}", x] for i, x in enumerate(said)] and got[10] == got[0]
    assert [got[20 + i] for i in range(4)] == [[f"Story {i}"] for i in range(4)]
    assert got[30] == ["Share this story", "Story 0", "x", "Read more"]


def test_pages_hold_their_documents(spark):
    """The articles of the table are documents of the corpus, so each text must be one of them after its title."""
    folder = "/root/testdata/sf0.1"
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    texts = {"\n".join(x for x in (" ".join(y.split()) for y in r.text.split("\n")) if x) for r in spark.read.parquet(f"{folder}/documents.parquet").select("text").collect()}
    titles = {r.page_id: " ".join(H.unescape(re.search(r"<h1>(.*?)</h1>", r.html, re.S)[1]).split()) for r in pages.select("page_id", "html").collect()}
    for r in html_diff.main_texts(pages).collect():
        title, _, rest = r.text.partition("\n")
        assert title == titles[r.page_id] and rest in texts
