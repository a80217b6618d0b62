"""URL rules and their spread over aliases."""

from __future__ import annotations

import random

import duckdb
import pytest

from dispensa.llm import urls
from dispensa.llm.queries import QUERIES
from tests.test_oracle import compare

SCHEMA = "page_id long, url string, html string"


@pytest.fixture()
def rules(spark):
    return spark.createDataFrame(urls.RULES, urls.RULE_SCHEMA)


def judged(spark, rules, staging, rows):
    out = urls.judged(spark.createDataFrame(rows, SCHEMA), rules, staging).collect()
    assert len(out) == len(rows)
    return {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in out}


def test_hosts_paths_and_the_longest_rule(spark, rules, staging):
    cases = {
        "https://a.Example.ORG/es/1?x#y": ("a.example.org", "/es/1", "example.org/es/", "block"),
        "http://example.org/en/17": ("example.org", "/en/17", "example.org/en/1", "block"),
        "http://example.org/en/7": ("example.org", "/en/7", "org/", "allow"),
        "http://myexample.org/es/": ("myexample.org", "/es/", "org/", "allow"),
        "http://x.com/fr/a": ("x.com", "/fr/a", "com/fr/", "allow"),
        "http://x.com/de/": ("x.com", "/de/", "com/de/", "block"),
        "http://x.com/DE/": ("x.com", "/DE/", None, "allow"),
        "http://x.com": ("x.com", "", None, "allow"),
        "http://x.org": ("x.org", "", None, "allow"),
        "http://x.org?q=/": ("x.org", "", None, "allow"),
        "x://y.net/a://b.com/de/": ("y.net", "/a://b.com/de/", None, "allow"),
        "no scheme.org/": ("", "", None, "allow"),
        "http://É.com/de/": ("É.com", "/de/", "com/de/", "block"),
        "http://a\nb.com/de/\n": ("a\nb.com", "/de/\n", "com/de/", "block"),
        "": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
    }
    got = judged(spark, rules, staging, [(i, u, None) for i, u in enumerate(cases)])
    assert got == dict(enumerate(cases.values()))


def page(to=None, link=None):
    head = f'<meta http-equiv="refresh" content="0; url={to}">' if to else ""
    return f'<html><head>{head}<LINK href="{link}" rel="canonical"></head></html>' if link else f"<html><head>{head}</head></html>"


ALIASES = [
    (1, "http://a.net/1", page(to="https://b.net/2")),
    (2, "http://b.net/2#top", page(link="http://www.example.org/es/9")),
    (3, "http://c.net/3", page(link="http://d.net/")),
    (4, "http://d.net/", page(to="http://x.com/de/")),
    (5, "http://e.net/5", page(link="http://d.net/")),
    (6, "http://f.net/6", page(to="/7")),
    (7, "http://f.net/7", page(to="//G.net/8")),
    (8, "https://g.net/8", page(link="http://x.com/fr/")),
    (9, "http://h.net/9", page(link="http://x.com/de/1")),
    (10, "http://x.com/de/2", page(link="http://h.net/9")),
    (11, "http://ok.org/1", page(link="http://h.net/9")),
    (12, "http://far.net/", page(to="relative.html")),
    (13, None, page(to="http://x.com/de/")),
    (14, "http://self.net/", page(link="http://self.net/")),
]


def test_aliases(spark, rules, staging):
    got = {k: v[3] for k, v in judged(spark, rules, staging, ALIASES).items()}
    # 1 - 2 reach a blocked page; 3, 4, 5 too; 6 - 7 - 8 an allowed one. In the component of 9, 10 and 11
    # rules block and allow: 9 has none and the allowing one precedes, 10 and 11 keep their own.
    assert [got[i] for i in range(1, 15)] == ["block"] * 2 + ["block"] * 3 + ["allow"] * 3 + [
        "allow", "block", "allow", "allow", "allow", "allow",
    ]


def test_a_hub_with_many_aliases(spark, rules, staging):
    rows = [(i, f"http://s{i}.net/", page(link="http://x.com/de/hub")) for i in range(1500)]
    assert {v[3] for v in judged(spark, rules, staging, rows).values()} == {"block"}


def test_rule_lists_of_any_length(spark, staging):
    rng = random.Random(1)
    table = [(f"h{rng.randrange(300)}.net", rng.choice(["/", "/a", "/a/b"]), rng.choice(["allow", "block"])) for _ in range(900)]
    rows = [(i, f"http://w.h{rng.randrange(400)}.net{rng.choice(['/', '/a/', '/a/b/c', '/x'])}", None) for i in range(500)]
    got = judged(spark, spark.createDataFrame(table, urls.RULE_SCHEMA), staging, rows)
    for i, u, _ in rows:
        host, path = u[7:].split("/", 1)
        path = "/" + path
        fits = [(len(h + p), v == "allow", h + p, v) for h, p, v in table if host.endswith("." + h) and path.startswith(p)]
        best = max(fits, default=(0, 0, None, "allow"))
        assert got[i] == (host, path, best[2], best[3])


def test_other_columns_repeats_and_nothing(spark, rules, staging):
    schema = SCHEMA + ", verdict string, node string, page int, component string"
    rows = [(1, "http://x.com/de/", "", "v", "n", 3, "c"), (1, "http://x.com/de/", "", "v", "n", 3, "c"), (None, None, None, None, None, None, None)]
    pages = spark.createDataFrame(rows, schema)
    out = urls.judged(pages, rules, staging)
    assert out.columns == ["page_id", "url", "node", "page", "component", "host", "path", "rule", "verdict", "origin"]
    assert sorted(r["verdict"] for r in out.collect()) == ["allow", "block", "block"]
    assert urls.judged(pages.limit(0), rules, staging).collect() == []
    assert {r["verdict"] for r in urls.judged(pages, rules.limit(0), staging).collect()} == {"allow"}


def test_sql_twin_on_aliases(spark, rules, staging):
    con = duckdb.connect()
    con.execute("create table pages (page_id bigint, url varchar, html varchar)")
    more = [
        (101, "http://n.net/1", page(to="http://n.net/1", link="http://x.com/de/1")),
        (102, "http://two.net/", page(to="http://calm.net/", link="http://x.com/de/2")), (103, "http://calm.net/", None),
        (104, "http://t.net/", page(link="http://t.net/") + page(link="http://x.com/de/3")), (105, "http://r.net/a/b?q", page(to="page2")),
        (106, "http://r.net/a/page2", page(link="http://x.com/de/4")), (107, "http://q.net/s", page(to="?p=1")),
        (108, "http://q.net/s?p=1", page(link="http://x.com/de/")), (109, "http://mail.net/", page(link="mailto:x@x.com")),
        (110, "http://up.net/a/b/c", page(link="../x/./y/..")), (111, "http://up.net/a/x/", page(link="//x.com/de/5")),
        (112, "http://amp.net/?a=1&b=2", page(link="http://x.com/de/6")), (113, "http://w.net/", page(link="http://amp.net/?a=1&amp;b=2")),
    ]
    rows = [*ALIASES, *more]
    con.executemany("insert into pages values (?, ?, ?)", rows)
    out = urls.judged(spark.createDataFrame(rows, SCHEMA), rules, staging)
    compare(out.select("page_id", "host", "path", "rule", "verdict"), con, QUERIES["op7_url_filter"].sql)


def test_no_python_in_the_plan(spark, rules, staging):
    plan = urls.judged(spark.createDataFrame(ALIASES, SCHEMA), rules, staging)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_query_against_its_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{folder}/pages.parquet'")
    assert compare(QUERIES["op7_url_filter"].run(spark, folder), con, QUERIES["op7_url_filter"].sql)


def test_all_targets_of_a_page_are_edges(spark, rules, staging):
    """Redirects beside canonical links, a page that reloads itself, several tags, and relative targets."""
    both = page(to="http://n.net/1", link="http://x.com/de/1")
    rows = [
        (1, "http://n.net/1", both), (2, "http://two.net/", page(to="http://calm.net/", link="http://x.com/de/2")), (3, "http://calm.net/", None),
        (4, "http://t.net/", page(link="http://t.net/") + page(link="http://x.com/de/3")), (5, "http://r.net/a/b?q", page(to="page2")),
        (6, "http://r.net/a/page2", page(link="http://x.com/de/4")), (7, "http://q.net/s", page(to="?p=1")), (8, "http://q.net/s?p=1", page(link="http://x.com/de/")),
        (9, "http://mail.net/", page(link="mailto:x@x.com")),
    ]
    got = {k: v[3] for k, v in judged(spark, rules, staging, rows).items()}
    assert got == {k: "allow" if k == 9 else "block" for k in range(1, 10)}


def test_relative_targets(spark):
    cases = {
        "page2": "h.net/a/b/page2", "./x": "h.net/a/b/x", "../x?y=1#z": "h.net/a/x?y=1", "../../../x": "h.net/x", "..": "h.net/a/",
        "?p=1": "h.net/a/b/c?p=1", "/r/../s/.": "h.net/s/", "//o.net/k": "o.net/k", "k?u=http://x.com/": "h.net/a/b/k?u=http://x.com/",
        "#top": None, "javascript:go()": None, "HTTPS://O.net/K": "o.net/K",
    }
    rows = [(k, f"http://h.net/a/b/c?q={k}", page(link=to)) for k, to in enumerate(cases)] + [(99, "http://bare.net", page(link="up"))]
    got = {r["a"]: r["b"] for r in urls.edges(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {f"h.net/a/b/c?q={k}": b for k, b in enumerate(cases.values()) if b} | {"bare.net/": "bare.net/up"}
    assert got == want
