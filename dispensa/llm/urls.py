"""URL decisions by host and path rules, spread over redirects and canonical links.

A rule (host, path, verdict) fits its host and all subdomains where the url's path starts with its path; the
longest rule wins, of equally long ones an allowing one. Rules meet the distinct hosts, each cut into its
suffixes, in an equi-join, so a list of millions of rules works too.

A page's canonical links and its redirects are edges between urls (without scheme and fragment), all of them, and
relative ones are resolved against the page's url. In a connected
component a page without a rule of its own is blocked if any url there is blocked by a rule and none is
allowed by one; a page with a rule keeps its verdict. Everything else is allowed.

Only DataFrame functions are used. Defined results: a null url or one without ``://`` has empty host and path
and no rule, and is allowed; a null page has no links; repeated rows and urls are judged alike; targets
of other schemes without ``//`` are no edges, and a ``base`` element is not read; without rules all is allowed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.llm.components import connected
from dispensa.sources.staging import Staging

#: (host, path, verdict)
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
RULE_SCHEMA = "rule_host string, rule_path string, verdict string"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HEAD = r"(?s)^.*?://([^/?#]*)"


def host(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _HEAD, 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _HEAD + r"([^?#]*)", 2), F.lit(""))


def _node(url: Column) -> Column:
    """The url without scheme and fragment; null if it has no host."""
    rest = F.regexp_extract(url, _HEAD + r"([^#]*)", 2)
    rest = F.when(F.startswith(rest, F.lit("/")), rest).otherwise(F.concat(F.lit("/"), rest))
    return F.when(host(url) != "", F.concat(host(url), rest))


def _targets(html: Column) -> Column:
    """Where the page redirects and its canonical links, as an array."""
    refresh = F.regexp_extract_all(html, F.lit(r"""(?is)<meta\s[^>]*http-equiv\s*=\s*["']?refresh\b[^>]*>"""), F.lit(0))
    to = F.transform(refresh, lambda m: F.regexp_extract(m, r"""(?is)\burl\s*=\s*['"]?([^'">\s]+)""", 1))

    def href(link: Column) -> Column:
        found = F.regexp_extract(link, r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"']+))""", 0)
        return F.regexp_replace(F.regexp_replace(found, r"(?is)^href\s*=\s*", ""), """^["']|["']$""", "")

    links = F.regexp_extract_all(html, F.lit(r"""(?is)<link\s[^>]*rel\s*=\s*["']?canonical\b[^>]*>"""), F.lit(0))
    found = F.transform(F.concat(to, F.transform(links, href)), lambda t: F.replace(F.trim(t), F.lit("&amp;"), F.lit("&")))
    return F.array_distinct(F.filter(found, lambda t: F.length(t) > 0))


def _without_dots(place: Column) -> Column:
    """A path from ``/`` on, without the segments ``.`` and ``..``."""
    parts = F.split(place, "/")
    above = lambda done: F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
    kept = F.aggregate(
        F.slice(parts, F.lit(2), F.size(parts)), F.array().cast("array<string>"),
        lambda done, part: F.when(part == "..", above(done)).when(part == ".", done).otherwise(F.concat(done, F.array(part))),
    )
    folder = F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))
    return F.concat(F.lit("/"), F.array_join(F.concat(kept, folder), "/"))


def _resolved(to: Column, url: Column) -> Column:
    """The target as a whole url, seen from the page's; null if it is none."""
    site = F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit("://"), host(url))
    place, rest = F.regexp_extract(to, r"(?s)^([^?#]*)(.*)$", 1), F.regexp_extract(to, r"(?s)^([^?#]*)(.*)$", 2)
    folder = F.regexp_replace(path(url), r"[^/]*$", "")
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(F.rlike(to, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://")), to)
        .when(F.startswith(to, F.lit("//")), F.concat(F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.lit(":"), to))
        .when(F.rlike(to, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*:")), F.lit(None).cast("string"))
        .when(F.startswith(to, F.lit("/")), F.concat(site, _without_dots(place), rest))
        .when(F.startswith(to, F.lit("?")), F.concat(site, path(url), to))
        .when(~F.startswith(to, F.lit("#")), F.concat(site, _without_dots(F.concat(folder, place)), rest))
    )


def edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): a page's url and one that it redirects to or names as canonical."""
    # Most pages have neither; the words are looked for before any pattern runs.
    text = F.col(html)
    marked = pages.where(F.contains(F.lower(text), F.lit("canonical")) | F.contains(F.lower(text), F.lit("refresh")))
    found = marked.select(F.col(url).alias("url"), F.explode(_targets(text)).alias("to"))
    whole = _resolved(F.col("to"), F.col("url"))
    return found.select(_node(F.col("url")).alias("a"), _node(whole).alias("b")).where("a <> b").distinct()


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """Rows with host and path, and the rule that wins there as struct ``won``: (rule, verdict), or null."""
    hosts = urls.select("host").distinct()
    labels = F.split("host", r"\.")
    places = F.sequence(F.lit(1), F.size(labels))
    suffix = F.transform(places, lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = hosts.select("host", F.explode(suffix).alias("rule_host"))
    fits = fits.join(rules.where("rule_host <> ''").distinct(), "rule_host")
    rule = F.concat("rule_host", "rule_path")
    # Of the rules for a host, the longest first; of equally long ones that of the longer host, then an allowing one.
    one = F.struct(
        F.length(rule).alias("size"), F.length("rule_host").alias("near"), (F.col("verdict") == "allow").alias("allows"),
        F.col("rule_path"), rule.alias("rule"), F.col("verdict"),
    )
    lists = fits.groupBy("host").agg(F.collect_list(one).alias("fits"))
    won = F.array_max(F.filter("fits", lambda r: F.startswith(F.col("path"), r["rule_path"])))
    return urls.join(lists, "host", "left").withColumn("won", won).drop("fits")


def judged(pages: DataFrame, rules: DataFrame, staging: Staging, url: str = "url", html: str = "html") -> DataFrame:
    """The pages' columns but html, with host, path, rule, verdict and the decision's origin (rule, alias, none)."""
    links = staging.keep(edges(pages, url, html), "edges")
    address = F.col(f"`{url}`")
    kept = [F.col(f"`{c}`") for c in pages.columns if c not in (html, "host", "path", "rule", "verdict", "origin")]
    rows = pages.select(
        F.struct(*kept).alias("page"), host(address).alias("host"), path(address).alias("path"), _node(address).alias("node")
    )
    rows = ruled(rows, rules)
    if links.isEmpty():  # no page stands for another
        spread = F.lit(None).cast("string")
    else:
        # Few urls have links; each gets its component, and the rules that hold there are gathered.
        parts = staging.keep(connected(links, staging), "components")
        address = F.concat(F.lit("x://"), F.col("node"))
        known = ruled(parts.select("component", host(address).alias("host"), path(address).alias("path")), rules)
        means = known.groupBy("component").agg(
            F.max(F.col("won.verdict") == "allow").alias("allows"), F.max(F.col("won.verdict") == "block").alias("blocks")
        )
        spread = F.when(F.col("allows"), "allow").when(F.col("blocks"), "block")
        decided = parts.join(means, "component").select("node", spread.alias("spread")).where("spread is not null")
        rows = rows.join(decided, "node", "left")
        spread = F.col("spread")
    own = F.col("won.verdict")
    return rows.select(
        "page.*", "host", "path", F.col("won.rule").alias("rule"),
        F.coalesce(own, spread, F.lit("allow")).alias("verdict"),
        F.when(own.isNotNull(), "rule").when(spread.isNotNull(), "alias").otherwise("none").alias("origin"),
    )
