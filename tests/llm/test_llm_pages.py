"""Main texts of hand-made pages, of the given ones, and what hosts repeat."""

from __future__ import annotations

import re

import numpy as np
import pytest

from dispensa.llm import pages

SCHEMA = "page_id long, url string, html string"


def article(page):
    marked, found = pages.blocks(page)
    assert marked
    return "\n".join(t for kind, t in found if kind == "article")


CASES = {
    "<article><h1>Top</h1><p>One  two\n<b>three</b><p>Four</article><p>out": "Top\nOne two three\nFour",
    "<body><nav>Menu</nav><article>a<br>b&amp;c &lt;p&gt; &#233;&nbsp;&eacute;</article><footer>f</footer>": "a b&c <p> é é",
    "<article><p>x<script>var t='</p>';</script> y<style>p{}</style>z</article>": "x y z",
    "<article>in<aside>side</aside>deep<div class='ad'>buy<div>now</div></div>end</article>": "in\ndeep\nend",
    '<article><p class="cookie-notice">We use cookies<p>Kept<section id="comments"><p>me too</section></article>': "Kept",
    "<article><header><h1>Title</h1></header><p>Text</p><form>Name <input></form></article>": "Title\nText",
    "<main><p>Story</p><div role='navigation'>go</div></main>": "Story",
    "<article><ul><li>a<li>b</ul><table><tr><td>c</td><td>d</td></tr></table></article>": "a\nb\nc\nd",
    "<article><p>cut off &am": "cut off &am",
    "<article><p>a < b and c<d</p><!-- no --><p>e</p></article>": "a < b and c\ne",
    "<ARTICLE><P>Big</P></ARTICLE>": "Big",
    "<article><p hidden>x</p><p style='display: none'>y</p><p>z</p></article>": "z",
    "<article><p>One</p></article><article class='comment'><p>Reader</p></article><article><p>Two</p></article>": "One\nTwo",
    "<article><p>é 漢 \U0001f600</p></article>": "é 漢 \U0001f600",
    "<div class=ad>x</div><article><p>t<span class='share-buttons'>Share</span>u</p></article>": "tu",
    "<article><blockquote><p>q</p></blockquote><pre>a\n  b</pre></article>": "q\na b",
    "<article></article>": "",
    # Sections of an article whose names hold a word that names furniture elsewhere.
    '<article><p>a</p><section id="social-history"><p>b</p></section><h2 id="related-work">c</h2><div id="search-trees">d</div></article>': "a\nb\nc\nd",
    '<article><h2 id="search">Search</h2><p class="skip-list">x</p><p class="banner-ads-2">ad</p><div id="ad1">y</div></article>': "Search\nx",
    '<article><div class="social share-links">s</div><ul id="related-links"><li>r</ul><p id="share">kept</p></article>': "kept",
    "<article><p>A &am<b>p;</b> B &amp;amp; C</p></article>": "A &amp; B &amp; C",
    "<article><p>a<b x <i>c</i></p></article>": "ac",
}


@pytest.mark.parametrize("page", CASES)
def test_articles(page):
    assert article(page) == CASES[page]


def test_given_pages(spark, folder):
    """The template of the given pages, read by a plain pattern."""
    import html

    rows = spark.read.parquet(f"{folder}/pages.parquet")
    got = {r["page_id"]: r["text"] for r in pages.main_texts(rows).collect()}
    assert len(got) == rows.count()
    for r in rows.collect():
        inner = re.search(r"<article>(.*?)(?:</article>|\Z)", r["html"], re.S).group(1)
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", re.sub(r"<br>", " ", p))).split()) for p in re.split(r"</?(?:p|h1)>", inner)]
        assert got[r["page_id"]] == "\n".join(p for p in parts if p)


def open_page(k, story):
    return f"<body><div>Home News Sport Weather and the rest of our menu</div><p>{story}</p><div>All of it is ours {k}, see the terms of use of this site before copying</div></body>"


def test_hosts_repeat_their_boilerplate(spark):
    rows = [(k, f"http://H.net/{k}", open_page(k, f"Story number {k} tells of thing {k * 7}")) for k in range(9)]
    rows += [(100 + k, f"http://other.net/{k}", open_page(k, f"Lonely story {k} with its own words")) for k in range(2)]
    rows += [(200, "http://marked.net/", "<nav>menu</nav><article><p>Marked</p></article>"), (201, None, "<p>alone</p>"), (202, "http://H.net/", None)]
    got = {r["page_id"]: r["text"] for r in pages.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    for k in range(9):
        assert got[k] == f"Story number {k} tells of thing {k * 7}\nAll of it is ours {k},"
    assert got[100] == "Lonely story 0 with its own words\nAll of it is ours 0,"  # two pages are enough
    assert (got[200], got[201], got[202]) == ("Marked", "alone", "")


def test_a_hot_host_is_dealt_into_groups(spark):
    rows = [(k, "http://h.net/", open_page(k, f"Tale {k}")) for k in range(400)]
    out = pages.main_texts(spark.createDataFrame(rows, SCHEMA), group_bytes=8000)
    assert {r["page_id"]: r["text"].split("\n")[0] for r in out.collect()} == {k: f"Tale {k}" for k in range(400)}


@pytest.mark.parametrize("seed", range(5))
def test_repeats_against_all_stretches(seed):
    rng = np.random.default_rng(seed)
    streams = [rng.integers(0, 3, rng.integers(0, 40)) for _ in range(12)]
    owner = rng.integers(0, 6, 12)
    owner = np.unique(owner, return_inverse=True)[1]
    for depth, least in ((3, 2), (5, 3), (8, 2), (1, 2)):
        seen: dict[tuple, set] = {}
        for s, p in zip(streams, owner):
            for i in range(len(s) - depth + 1):
                seen.setdefault(tuple(s[i : i + depth]), set()).add(p)
        for s, got in zip(streams, pages.repeated(streams, owner, depth, least)):
            want = np.zeros(len(s), dtype=bool)
            for i in range(len(s) - depth + 1):
                if len(seen[tuple(s[i : i + depth])]) >= least:
                    want[i : i + depth] = True
            assert (got == want).all()


def test_other_columns_repeats_and_nothing(spark):
    schema = SCHEMA + ", text int, host string, page string, marked int, blocks string"
    rows = [(1, "http://a.net/", "<article>x</article>", 7, "h", "p", 1, "b")] * 2 + [(2, None, "", 8, None, None, None, None)]
    table = spark.createDataFrame(rows, schema)
    out = pages.main_texts(table)
    assert out.columns == ["page_id", "url", "host", "page", "marked", "blocks", "text"]
    assert sorted((r["page_id"], r["text"], r["host"]) for r in out.fillna("-").collect()) == [(1, "x", "h"), (1, "x", "h"), (2, "", "-")]
    assert pages.main_texts(table.limit(0)).collect() == []


def test_groups_of_a_host_change_nothing(spark):
    """A notice on few of a host's pages is counted over all its groups; equal pages count once and all get their text."""
    notice = "This old page of ours is kept for the record and is not updated any more"
    rows = []
    for k in range(300):
        story = " ".join(f"w{k}x{i}" for i in range(12))
        parts = [f"<p>Tale {k} {story}</p>"] + [f"<div>{notice}</div>"] * (k % 50 == 0) + ["<div>only two pages have these eight words here</div>"] * (k in (3, 7))
        rows.append((k, f"http://{'H' if k % 2 else 'h'}.net/{k}", "<body>" + "".join(parts) + "</body>"))
    rows += [(1000 + k, "http://h.net/same", "<p>The very same page again and again, with more than eight words</p>") for k in range(40)]
    rows += [(2000, "http://h.net/m", f"<article><p>Marked</p></article><div>{notice}</div>"), (2001, "http://small.net/", f"<div>{notice}</div>")]
    table = spark.createDataFrame(rows, SCHEMA)
    want = {r["page_id"]: r["text"] for r in pages.main_texts(table).collect()}
    assert len(want) == len(rows) and want[0].startswith("Tale 0 w0x0") and "\n" not in want[0] and want[2000] == "Marked"
    assert "eight words" not in want[3] and want[1000].startswith("The very same") and want[2001] == notice
    for size in (3000, 20000):
        out = pages.main_texts(table, group_bytes=size).collect()
        assert len(out) == len(rows) and {r["page_id"]: r["text"] for r in out} == want


def test_an_article_without_text_marks_nothing(spark):
    empty = '<body><main id="app"></main><div><p>The story is here.</p></div></body>'
    assert pages.blocks(empty)[0] is False
    rows = [(1, "http://one.net/", empty), (2, "http://two.net/", "<main></main>")]
    got = {r["page_id"]: r["text"] for r in pages.main_texts(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: "The story is here.", 2: ""}


@pytest.mark.parametrize(
    "page",
    [
        "<article>" + "<b x " * 200_000,
        "<article>" + "<b x='" * 170_000,
        "<article>" + '<b x="\'' * 150_000,
        "<article>" + "<div>" * 100_000 + "</i>" * 100_000,
        "<article>" + "<script " * 120_000,
        "<article>" + "<!" * 300_000,
    ],
)
def test_broken_pages_of_a_megabyte_take_no_longer(page):
    import time

    begin = time.process_time()
    pages.blocks(page)
    assert time.process_time() - begin < 3


def boxed_page(k, story, box="<div class='x7'><p>Read this story and more in our new app</p><p>It costs nothing</p></div>"):
    """An article with a box that no name tells, words of its own in a class, a paragraph and a section."""
    return (
        f"<div class=ad>Buy number {k}</div><article><h1>Title {k}</h1><div class='para'>{story}</div>{box}"
        f"<p>As said before, all of this is well known.</p><div class='para'>End of {k} here</div></article><footer>Foot {k}</footer>"
    )


@pytest.mark.parametrize("group_bytes", [pages.GROUP_BYTES, 2000])
def test_the_host_decides_on_boxes_in_marked_articles(spark, group_bytes):
    story = {k: " ".join(f"w{k}x{i}" for i in range(20)) for k in range(60)}
    rows = [(k, "http://h.net/", boxed_page(k, story[k])) for k in range(50)]
    # A shared text of a class whose words differ elsewhere stays, and so does the box of a host that shows it once.
    rows += [(k, "http://H.net/", boxed_page(k, story[k], "<div class='para'>Short and shared</div>")) for k in (50, 51)]
    rows += [(52, "http://once.net/", boxed_page(52, story[52]))]
    # A copy of an article, with a title of its own, keeps its text and loses the box.
    rows += [(53, "http://h.net/", boxed_page(53, story[5]))]
    # Two addresses of one article, one of them with a newer title: a copy repeats no host's box, and loses nothing.
    copy = "<article><h1>News{}</h1><section class='body'><p>One of it</p><p>Two of it</p></section></article>"
    rows += [(60, "http://copy.net/a", copy.format("")), (61, "http://copy.net/b", copy.format("")), (62, "http://copy.net/c", copy.format(" 2"))]
    # An equal section is one page's own where its name stands once; without a name it is text like a paragraph.
    rows += [(63, "http://own.net/", "<article><p>x y z</p><div><p>Shared</p></div></article>")]
    rows += [(64, "http://own.net/", "<article><p>u v w q</p><div><p>Shared</p></div><section id='social-history'><p>s</p></section></article>")]
    got = {r["page_id"]: r["text"] for r in pages.main_texts(spark.createDataFrame(rows, SCHEMA), group_bytes=group_bytes).collect()}
    assert len(got) == len(rows)
    said, box = "As said before, all of this is well known.", "Read this story and more in our new app\nIt costs nothing\n"
    for k in range(50):
        assert got[k] == f"Title {k}\n{story[k]}\n{said}\nEnd of {k} here"
    assert got[53] == f"Title 53\n{story[5]}\n{said}\nEnd of 53 here"
    for k in (50, 51):
        assert got[k] == f"Title {k}\n{story[k]}\nShort and shared\n{said}\nEnd of {k} here"
    assert got[52] == f"Title 52\n{story[52]}\n{box}{said}\nEnd of 52 here"
    assert [got[k] for k in (60, 61, 62)] == ["News\nOne of it\nTwo of it"] * 2 + ["News 2\nOne of it\nTwo of it"]
    assert (got[63], got[64]) == ("x y z\nShared", "u v w q\nShared\ns")


def test_streams_hold_tags_with_class_and_id():
    page = "<nav id=n>m</nav><article><div class='b a'><ul><li>x</ul></div><aside><div class=c>y</div></aside><section id=s>z"
    assert pages.stream(page)[1] == [
        ("tag", "nav id=n"), ("furniture", "m"), ("end", "nav"), ("box", "div class=a b"), ("tag", "ul"), ("article", "x"),
        ("end", "ul"), ("end", "div"), ("tag", "aside"), ("tag", "div class=c"), ("furniture", "y"), ("end", "div"),
        ("end", "aside"), ("box", "section id=s"), ("article", "z"), ("end", "section"),
    ]


def brute_boxes(streams, span, least):
    """The words of ``_gone``'s rule, read page by page from all stretches."""
    on = {}
    for i, s in enumerate(streams):
        for d in (1, span):
            for a in range(len(s) - d + 1):
                on.setdefault(tuple((k in ("box", "tag"), k == "end", t) for k, t in s[a : a + d]), set()).add(i)
    pages_of = lambda s, a, d: len(on[tuple((k in ("box", "tag"), k == "end", t) for k, t in s[a : a + d])])
    texts = []
    for s in streams:
        gone, open_ = set(), []
        article = [i for i, (kind, _) in enumerate(s) if kind == "article"]
        letters = sorted(pages_of(s, i, 1) for i in article for _ in s[i][1])
        usual = letters[(len(letters) + 1) // 2 - 1]
        for at, (kind, _) in enumerate(s):
            if kind in ("box", "tag"):
                open_.append(at)
            elif kind == "end":
                a = open_.pop()
                whole = at - a + 1 >= span and all(pages_of(s, x, span) >= least for x in range(a, at - span + 2))
                if s[a][0] == "box" and whole and pages_of(s, a, span) > usual and 2 * pages_of(s, a, span) >= pages_of(s, a, 1):
                    gone |= set(range(a, at))
        texts.append("\n".join(s[i][1] for i in article if i not in gone))
    return texts


def test_boxes_against_all_stretches(spark):
    rng = np.random.default_rng(5)

    def part(depth):
        out = ""
        for _ in range(rng.integers(1, 4)):
            if depth and rng.random() < 0.5:
                tag, name = [("div", " class=k1"), ("section", " class=k2"), ("ul", " id=k3"), ("div", "")][rng.integers(4)]
                out += f"<{tag}{name}>{part(depth - 1)}</{tag}>"
            else:
                out += f"<p>{rng.choice(['aa bb', 'c'], p=[0.9, 0.1])}</p>"
        return out

    made = [f"<article><p>{'own ' * int(rng.integers(2, 12))}{k}</p>{part(2)}</article><div class=k1>{part(1)}</div>" for k in range(80)]
    rows = [(k, f"http://{'ab'[k % 2]}.net/", html) for k, html in enumerate(made)]
    want = {}
    for site in range(2):
        mine = range(site, 80, 2)
        want |= dict(zip(mine, brute_boxes([pages.stream(made[k])[1] for k in mine], pages.SPAN, pages.PAGES)))
    whole = {k: article(html) for k, html in enumerate(made)}
    assert 5 < sum(want[k] != whole[k] for k in want) < 75
    for size in (pages.GROUP_BYTES, 1500):
        out = pages.main_texts(spark.createDataFrame(rows, SCHEMA), group_bytes=size).collect()
        assert {r["page_id"]: r["text"] for r in out} == want
