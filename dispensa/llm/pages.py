"""Main text of web pages: marked articles, and for other pages what their host does not repeat.

A page is read as a stream of tags and texts. Elements that are never part of an article (menus, page headers,
footers, sidebars, notices, adverts, forms, comments, scripts, hidden ones) are known by their tag, role, class
or id. Where a page marks its article or main part, the text is all of that without such elements, and without the
containers that its host repeats. For these the streams of all pages of a host, whole pages as tokens for tags with
class and id and for blocks, go through the array of suffixes described below. A container with a class or id in an
article goes if it is covered by stretches of ``SPAN`` tokens, from its tag to its end, that each stand on ``PAGES``
distinct pages, and its beginning stands on half of the pages with its tag, class and id or more: a class whose words
differ holds text. It must also stand on more pages than half of the article's text does, so that copies of an article
lose none of it. Blocks that are in no such container stay, shared or not.

Where a page marks nothing, the host decides by words. The word streams of its pages, with a mark at each block's border, are
concatenated; the array of their suffixes, sorted to the depth of ``REPEAT`` tokens, brings equal stretches
together. Stretches that stand on ``PAGES`` distinct pages are boilerplate: blocks that they cover go, and runs
of ``REPEAT`` covered words in other blocks. The parts outside the articles of marked pages take part, so one unmarked page of a host is enough.
The pages of a host of more than ``GROUP_BYTES`` of html are dealt into groups by a hash, so that no host is one
task; equal pages are one before. Each group tells on how many pages its stretches stand and is answered with the
sum over the whole host (``packed``), so the result does not depend on the groups.

Inside a block character references are decoded and white space becomes one space; blocks are trimmed, empty
ones left out, and joined in page order by a newline. Defined results: a null or empty html has an empty
text; what an unclosed element holds reaches to the end; a page whose host repeats all of it has an empty
text; a null url is a host of its own; repeated rows are pages of their own, but count as one page for
repeats when their html is equal. Input columns named like a result are replaced by it.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dispensa.llm import packed
from dispensa.llm.batches import mapped
from dispensa.llm.urls import host
from dispensa.llm.words import mix

REPEAT = 8
SPAN = 3
PAGES = 2
GROUP_BYTES = 8 << 20

_RAW = "script|style|noscript|template|textarea|title|svg|math|iframe|object|select|button|canvas|video|audio"
_TOKENS = re.compile(
    rf"<!--.*?(?:-->|\Z)|<(?P<raw>{_RAW})\b(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    # A tag that another one begins in has no end of its own and says nothing.
    r"|<(?P<end>/?)(?P<tag>[a-z][a-z0-9:-]*)(?P<rest>(?:[^<>\"']|\"[^\"]*\"|'[^']*')*+)>|<[!?/][^>]*(?:>|\Z)"
    r"|(?P<broken></?[a-z][^<>]*>?)|[^<]+|<",
    re.S | re.I,
)
_ATTRIBUTE = re.compile(r"""([a-z-]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""", re.I)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q ruby rt rp s samp "
    "small span strike strong sub sup time tt u var wbr".split()
)
_ENDED_BY_BLOCKS = frozenset(["p"])
_ARTICLE = frozenset(["article", "main"])
_FURNITURE = frozenset("nav footer aside form dialog menu head".split())
_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
# Names in class and id that tell what is no article; a name is one of these words, or only such words and common ones.
_HINTS = frozenset(
    "ad ads advert advertisement adverts advertising sponsor sponsored promo promotion banner cookie cookies consent "
    "gdpr notice notices newsletter subscribe subscription signup menu nav navbar navigation breadcrumb breadcrumbs "
    "sidebar footer comment comments respond replies disqus share sharing social related recommended recommendations "
    "popup modal overlay login search widget toolbar pagination pager copyright disclaimer skiplink".split()
)
_COMMON = frozenset(
    "bar box block button buttons area container content wrapper wrap inner outer panel section list item items link links "
    "form thread reply icons icon top bottom left right main site page global primary secondary header unit slot".split()
)
#: Elements that an id can name as no article; others, as headings, have ids to be linked to.
_CONTAINERS = frozenset("div section ul ol table aside nav footer header form".split())
#: Of these, what a host can repeat inside of articles without any mark.
_BOXES = frozenset("div section ul ol".split())
# Low bits of a token: what it is, and whether it is in the article (of a tag: whether it is a box there).
_TEXT, _BEGIN, _END, _INSIDE = 0, 1, 2, 4


def _named(value: str, words: frozenset[str]) -> bool:
    """Whether one of the names is made of these words, with common ones beside them."""
    for name in value.split():
        parts = [x for x in re.split(r"[^a-z0-9]+|(?<=[a-z])(?=\d)|(?<=\d)(?=[a-z])", name) if x and not x.isdigit()]
        if any(x in words for x in parts) and all(x in words or x in _COMMON for x in parts):
            return True
    return False


def _furniture(tag: str, rest: str, inside: bool) -> bool:
    """Whether an element is never part of an article; its own header is part of it."""
    if tag in _FURNITURE or (tag == "header" and not inside):
        return True
    if "=" not in rest and "hidden" not in rest:
        return False
    for name, value in _ATTRIBUTE.findall(rest):
        name, value = name.lower(), value.strip("\"'").lower()
        if name == "hidden" or (name == "aria-hidden" and value == "true"):
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
        if name == "role" and value in _ROLES:
            return True
        if (name == "class" or (name == "id" and tag in _CONTAINERS)) and tag not in ("html", "body", "article", "main"):
            if _named(value, _HINTS) or (not inside and "header" in re.split(r"[^a-z0-9]+", value)):
                return True
        if name in ("class", "id") and tag == "article" and {"comment", "reply"} & set(re.split(r"[^a-z0-9]+", value)):
            return True
    return False


def _signature(tag: str, rest: str) -> tuple[str, bool]:
    """The tag with its class and id, and whether it has any."""
    pairs = _ATTRIBUTE.findall(rest) if "=" in rest else []
    found = {name.lower(): " ".join(sorted(value.strip("\"'").lower().split())) for name, value in pairs}
    named = [f"{name}={found[name]}" for name in ("class", "id") if found.get(name)]
    return " ".join([tag, *named]), bool(named)


def blocks(page: str) -> tuple[bool, list[tuple[str, str]]]:
    """Whether the page marks an article, and its blocks as (kind, text): article, furniture or open.

    An article without text, beside text that is nowhere, marks nothing.
    """
    marked, found = stream(page)
    return marked, [(kind, text) for kind, text in found if kind not in ("box", "tag", "end")]


def stream(page: str) -> tuple[bool, list[tuple[str, str]]]:
    """As ``blocks``, with the containers' tags and ends between them; a box is a named one in an article."""
    out: list[tuple[str, str]] = []
    parts: list[str] = []
    # Open elements: tag, in furniture, in an article, in furniture within a line, which no block holds.
    stack: list[tuple[str, bool, bool, bool]] = []
    top = ("", False, False, False)
    opened: Counter[str] = Counter()  # elements of the stack by tag
    marked = False

    def flush() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            parts.clear()
            if text:
                out.append(("furniture" if top[1] else "article" if top[2] else "open", text))

    for m in _TOKENS.finditer(page):
        tag = m["tag"]
        if tag is None:
            token = m[0]
            if top[3]:
                continue
            if token[0] != "<" or token == "<":
                parts.append(html.unescape(token))
            elif m["raw"]:
                parts.append(" ")
            continue
        tag = tag.lower()
        if tag not in _INLINE:
            flush()
        elif tag == "br":
            parts.append(" ")
        if tag in _VOID:
            continue
        if m["end"]:
            while opened[tag]:
                name, _, _, within = stack.pop()
                opened[name] -= 1
                if name in _CONTAINERS and not within:
                    out.append(("end", name))
                if name == tag:
                    break
        elif not m["rest"].endswith("/"):
            if stack and stack[-1][0] in _ENDED_BY_BLOCKS and tag not in _INLINE:
                opened[stack.pop()[0]] -= 1
                top = stack[-1] if stack else ("", False, False, False)
            away = _furniture(tag, m["rest"], top[2])
            # Paragraphs and inline elements need no place in the stack, unless they are furniture.
            if away or not (tag in _INLINE or tag in _ENDED_BY_BLOCKS or tag == "li"):
                within = top[3] or (away and tag in _INLINE)
                opened[tag] += 1
                stack.append((tag, top[1] or (away and not within), top[2] or (tag in _ARTICLE and not away), within))
                if tag in _CONTAINERS and not within:
                    shown, named = _signature(tag, m["rest"])
                    box = named and tag in _BOXES and top[2] and not (top[1] or away)
                    out.append(("box" if box else "tag", shown))
                marked |= tag in _ARTICLE and not (top[1] or away)
        top = stack[-1] if stack else ("", False, False, False)
    flush()
    out += [("end", name) for name, _, _, within in reversed(stack) if name in _CONTAINERS and not within]
    kinds = {kind for kind, _ in out}
    return marked and ("article" in kinds or "open" not in kinds), out


def _shape(marked: bool, found: list[tuple[str, str]]) -> bytes:
    """The page's tokens: a hash of each block or tag with the low bits of what it is, then the blocks' sizes."""
    bits = {"article": _TEXT | _INSIDE * marked, "box": _BEGIN | _INSIDE * marked, "tag": _BEGIN, "end": _END}
    # The hash tells a block from a tag, and not where it is.
    said = [f"{bits.get(kind, _TEXT) & ~_INSIDE}{text}".encode("utf-8", "surrogatepass") for kind, text in found]
    tokens = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=8).digest() for x in said), dtype="<u8")
    low = np.array([bits.get(kind, _TEXT) for kind, _ in found], dtype="<u8")
    return ((tokens & ~np.uint64(7)) | low).tobytes() + np.array([len(t) for _, t in found], dtype="<u4").tobytes()


def _marked(column: str):
    """Texts of marked pages, null for others, and the shapes."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [stream(page or "") for page in batch.column(column).to_pylist()]
        texts = ["\n".join(t for kind, t in b if kind == "article") if marked else None for marked, b in found]
        return {"text": pa.array(texts, pa.string()), "shape": pa.array([_shape(*x) for x in found], pa.binary())}

    return work


def _shaped(column: str):
    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        return {"shape": pa.array([_shape(*stream(page or "")) for page in batch.column(column).to_pylist()], pa.binary())}

    return work


def _parsed(column: str):
    """The blocks by which the hosts judge unmarked pages."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        found = [blocks(page or "") for page in batch.column(column).to_pylist()]
        # Of a marked page only what is outside of its article can be boilerplate.
        lists = [[t for kind, t in b if kind == "open" or (marked and kind == "furniture")] for marked, b in found]
        return {
            "marked": pa.array([marked for marked, _ in found]),
            "blocks": pa.array(lists, pa.list_(pa.string())),
        }

    return work


def _stretches(streams: list[np.ndarray], pages: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where stretches of ``depth`` tokens start in the concatenation, their numbers, and each number's distinct pages.

    Suffixes of the concatenation are ranked by their first 1, 2, 4, ... tokens; a stretch may not run into the
    next stream.
    """
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    tokens = np.concatenate(streams) if len(streams) else np.zeros(0, dtype=np.int64)
    n = len(tokens)
    _, rank = np.unique(tokens, return_inverse=True)
    rank, width = rank.astype(np.int64) + 1, 1
    while width < depth:
        step = min(width, depth - width)
        later = np.zeros(n, dtype=np.int64)
        later[:-step] = rank[step:]
        _, rank = np.unique(rank * (n + 2) + later, return_inverse=True)
        rank, width = rank + 1, width + step
    room = np.repeat(np.cumsum(sizes), sizes) - np.arange(n)
    starts = np.flatnonzero(room >= depth)
    _, stretch = np.unique(rank[starts], return_inverse=True)
    owner = np.repeat(pages, sizes)[starts]
    suffixes = np.lexsort((owner, stretch))  # the suffix array, equal stretches by page
    r, o = stretch[suffixes], owner[suffixes]
    new = np.ones(len(r), dtype=bool)
    new[1:] = (r[1:] != r[:-1]) | (o[1:] != o[:-1])
    return starts, stretch, np.bincount(r[new])


def _covered(streams: list[np.ndarray], hits: np.ndarray, depth: int) -> list[np.ndarray]:
    """For each stream, which of its tokens lie in a stretch that starts at one of the hits."""
    sizes = np.array([len(s) for s in streams], dtype=np.int64)
    covered = np.zeros(sizes.sum() + 1, dtype=np.int64)
    np.add.at(covered, hits, 1)
    np.add.at(covered, hits + depth, -1)
    return np.split(np.cumsum(covered)[:-1] > 0, np.cumsum(sizes)[:-1])


def repeated(streams: list[np.ndarray], pages: np.ndarray, depth: int, least: int) -> list[np.ndarray]:
    """For each token stream, which of its tokens lie in a stretch of ``depth`` tokens found on ``least`` pages.

    ``pages`` numbers the distinct pages.
    """
    starts, stretch, distinct = _stretches(streams, pages, depth)
    return _covered(streams, starts[distinct[stretch] >= least], depth)


def _unique_text(words: list[list[str]], covered: np.ndarray, depth: int) -> str:
    """What is left of the blocks; each block has a border mark before its words and one follows the last.

    A repeated stretch that only reaches into a block over its border takes nothing from it: removed are
    whole blocks and runs of ``depth`` words or more.
    """
    out, at = [], 1
    for block in words:
        gone = covered[at : at + len(block)].copy()
        if not gone.all():
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.view(np.int8), [0]]))).reshape(-1, 2)
            for a, b in edges:
                gone[a:b] = b - a >= depth
        left = [w for w, g in zip(block, gone) if not g]
        out += [" ".join(left)] if left else []
        at += len(block) + 1
    return "\n".join(out)


def _streams(words: list[list[list[str]]], numbers: dict[str, int]) -> list[np.ndarray]:
    """The pages' words as numbers, which are given out in ``numbers``, with the border mark 0 around each block."""
    streams = []
    for page in words:
        stream = [0]
        for block in page:
            stream += [numbers.setdefault(w, len(numbers)) for w in block] + [0]
        streams.append(np.array(stream, dtype=np.int64))
    return streams


def _host_texts(depth: int, least: int):
    def work(table: pa.Table) -> pa.Table:
        words = [[b.split() for b in page] for page in table["blocks"].to_pylist()]
        streams = _streams(words, {"": 0})
        _, pages = np.unique(np.array(table["name"].to_pylist(), dtype=np.int64), return_inverse=True)
        covered = repeated(streams, pages, depth, least)
        wanted = [i for i, marked in enumerate(table["marked"].to_pylist()) if not marked]
        texts = [_unique_text(words[i], covered[i], depth) for i in wanted]
        chosen = table.select(["page"]).take(pa.array(wanted, pa.int64()))
        return chosen.append_column("text", pa.array(texts, pa.string()))

    return work


class _Group:
    """Distinct pages of large hosts, the stretches on them, and names of these that hold in all groups of a host.

    Groups of two hosts may share a block; numbers of words are those of a host.
    """

    def __init__(self, table: pa.Table, depth: int):
        table = packed.ordered(table, ["host", "name"])
        self.hosts, self.names = table["host"].to_pylist(), table["name"]
        self.marked = table["marked"].to_pylist()
        self.words = [[b.split() for b in page] for page in table["blocks"].to_pylist()]
        self.streams, tokens = [], [np.zeros(0, dtype=np.uint64)]
        for site in dict.fromkeys(self.hosts):  # ordered, so a host's pages are neighbours
            numbers, base = {"": 0}, sum(map(len, tokens))
            pages = _streams([w for w, h in zip(self.words, self.hosts) if h == site], numbers)
            self.streams += [p + base for p in pages]
            digests = [hashlib.blake2b(f"{site}\0{w}".encode(), digest_size=8).digest() for w in numbers]
            tokens.append(np.frombuffer(b"".join(digests), dtype="<u8"))
        self.starts, self.stretch, self.distinct = _stretches(self.streams, np.arange(len(self.streams)), depth)
        _, first = np.unique(self.stretch, return_index=True)
        flat, named = np.concatenate([np.zeros(0, np.int64), *self.streams]), np.concatenate(tokens)
        self.hashes = np.zeros(len(first), dtype=np.uint64)
        for step in range(depth):
            self.hashes = mix(self.hashes * np.uint64(0x9E3779B97F4A7C15) + named[flat[self.starts[first] + step]])


def _ask(depth: int, parts: int):
    def work(block: int, table: pa.Table) -> pa.Table:
        group = _Group(table, depth)
        hashes, place = np.unique(group.hashes, return_inverse=True)
        held = np.bincount(place, weights=group.distinct, minlength=len(hashes))
        return packed.question(block, 0, hashes, held, parts)

    return work


def _group_texts(depth: int, least: int, parts: int):
    def work(block: int, table: pa.Table, told: pa.Table) -> pa.Table:
        group = _Group(table, depth)
        hashes, place = np.unique(group.hashes, return_inverse=True)
        held = packed.answers(told, 0, hashes, parts)[place]
        covered = _covered(group.streams, group.starts[held[group.stretch] >= least], depth)
        wanted = [i for i, marked in enumerate(group.marked) if not marked]
        return pa.table(
            {
                "host": pa.array([group.hosts[i] for i in wanted], pa.string()),
                "name": group.names.take(pa.array(wanted, pa.int64())),
                "text": pa.array([_unique_text(group.words[i], covered[i], depth) for i in wanted], pa.string()),
            }
        )

    return work


class _Shapes:
    """Shapes of a block's pages, and the stretches of one token and of ``span`` on them with names that hold anywhere."""

    def __init__(self, table: pa.Table, span: int):
        table = packed.ordered(table, ["host", "shape_name"])
        self.hosts, self.names = table["host"].to_pylist(), table["shape_name"]
        self.bits, self.sizes, self.streams = [], [], []
        salts = {h: np.frombuffer(hashlib.blake2b(h.encode(), digest_size=8).digest(), "<u8")[0] for h in set(self.hosts)}
        for site, raw in zip(self.hosts, table["shape"].to_pylist()):
            n = len(raw) // 12
            tokens = np.frombuffer(raw, "<u8", n)
            self.bits.append((tokens & np.uint64(7)).astype(np.uint8))
            self.sizes.append(np.frombuffer(raw, "<u4", n, 8 * n).astype(np.int64))
            self.streams.append(mix((tokens & ~np.uint64(7)) ^ salts[site]))
        flat = np.concatenate([np.zeros(0, np.uint64), *self.streams])
        self.starts, hashes, held = [], [], []
        for depth in (1, span):
            starts, stretch, distinct = _stretches(self.streams, np.arange(len(self.streams)), depth)
            _, first = np.unique(stretch, return_index=True)
            named = np.full(len(first), depth, dtype=np.uint64)
            for step in range(depth):
                named = mix(named * np.uint64(0x9E3779B97F4A7C15) + flat[starts[first] + step])
            self.starts.append(starts)
            hashes.append(named[stretch])
            held.append(distinct[stretch])
        self.hashes, place, self.place = np.unique(np.concatenate(hashes), return_index=True, return_inverse=True)
        self.held = np.concatenate(held)[place]

    def counts(self, held: np.ndarray) -> list[np.ndarray]:
        """For each depth the pages of the stretch that starts at a token, 0 where there is no room for one."""
        out, at = [], 0
        for starts in self.starts:
            counts = np.zeros(sum(map(len, self.streams)), dtype=np.int64)
            counts[starts] = held[self.place[at : at + len(starts)]]
            out.append(counts)
            at += len(starts)
        return out


def _gone(
    bits: np.ndarray, sizes: np.ndarray, alone: np.ndarray, spans: np.ndarray, span: int, least: int
) -> np.ndarray | None:
    """Which of the article's blocks are in boxes that the host repeats, if any.

    ``alone`` and ``spans`` are the pages of the stretches of one token and of ``span`` that start at each.
    """
    kind, inside = bits & 3, bits & _INSIDE > 0
    article = inside & (kind == _TEXT)
    if not (inside & (kind == _BEGIN)).any() or not article.any():
        return None
    order = np.argsort(alone[article], kind="stable")
    sums = np.cumsum(sizes[article][order])
    usual = alone[article][order][np.searchsorted(2 * sums, sums[-1])]  # on so many pages stands half of the text
    rare = np.concatenate([[0], np.cumsum(spans < least)])
    away, open_ = np.zeros(len(bits) + 1, dtype=np.int64), []
    for at in np.flatnonzero(kind != _TEXT):
        if kind[at] == _BEGIN:
            open_.append(at)
            continue
        begin = open_.pop()
        last = at - span + 2  # behind the last stretch inside
        whole = last > begin and rare[last] == rare[begin]
        if inside[begin] and whole and spans[begin] > usual and 2 * spans[begin] >= alone[begin]:
            away[begin] += 1
            away[at] -= 1
    gone = (np.cumsum(away)[:-1] > 0)[article]
    return gone if gone.any() else None


def _ask_boxes(span: int, parts: int):
    def work(block: int, table: pa.Table) -> pa.Table:
        shapes = _Shapes(table, span)
        return packed.question(block, 0, shapes.hashes, shapes.held, parts)

    return work


def _judged(shapes: _Shapes, held: np.ndarray, span: int, least: int) -> pa.Table:
    alone, spans = shapes.counts(held)
    cuts = np.cumsum([len(s) for s in shapes.streams])[:-1]
    pages = zip(shapes.bits, shapes.sizes, np.split(alone, cuts), np.split(spans, cuts))
    found = [_gone(*page, span, least) for page in pages]
    some = [i for i, gone in enumerate(found) if gone is not None]
    return pa.table(
        {
            "host": pa.array([shapes.hosts[i] for i in some], pa.string()),
            "shape_name": shapes.names.take(pa.array(some, pa.int64())),
            "gone": pa.array([found[i].tolist() for i in some], pa.list_(pa.bool_())),
        }
    )


def _host_boxes(span: int, least: int):
    def work(table: pa.Table) -> pa.Table:
        _, first = np.unique(table["shape_name"].to_numpy(), return_index=True)
        shapes = _Shapes(table.take(pa.array(first)), span)
        return _judged(shapes, shapes.held, span, least)

    return work


def _group_boxes(span: int, least: int, parts: int):
    def work(block: int, table: pa.Table, told: pa.Table) -> pa.Table:
        shapes = _Shapes(table, span)
        return _judged(shapes, packed.answers(told, 0, shapes.hashes, parts), span, least)

    return work


def main_texts(
    pages: DataFrame, page: str = "html", url: str = "url", depth: int = REPEAT, least: int = PAGES, group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """The pages' columns but the html, with ``text``, the main text."""
    kept = [c for c in pages.columns if c not in (page, "text")]
    rows = pages.select(
        F.struct(*[F.col(f"`{c}`") for c in kept]).alias("page"), F.col(f"`{page}`").alias("html"),
        host(F.col(f"`{url}`")).alias("host"),
    )
    # Large hosts, with the number of their groups: at most one row for each ``group_bytes`` of html.
    sizes = rows.groupBy("host").agg(F.ceil(F.sum(F.octet_length("html")) / group_bytes).alias("groups"))
    large = F.broadcast(sizes.where("groups > 1"))
    rows = rows.withColumn("name", F.xxhash64("html"))
    parts = packed.parts_of(pages)

    def dealt_by(name: str) -> Column:
        return F.pmod(F.xxhash64("host", F.pmod(name, "groups")), F.lit(2**31 - 1)).cast("int").alias("block")

    # Every page's tags and blocks take part in the array of its host; equal pages are one. Of a large host they ask.
    def shaped(some: DataFrame) -> DataFrame:
        out = mapped(some, "html", _shaped("html"), "shape binary").where("length(shape) > 0")
        return out.withColumn("shape_name", F.xxhash64("shape"))

    boxes = "host string, shape_name long, gone array<boolean>"
    own = shaped(rows.join(large, "host", "left_anti").select("host", "html")).select("host", "shape_name", "shape")
    own = own.groupBy("host").applyInArrow(_host_boxes(SPAN, least), boxes)
    shapes = shaped(rows.join(large, "host").select("host", "groups", "html")).groupBy("host", "shape_name").agg(
        F.first("groups").alias("groups"), F.first("shape").alias("shape")
    )
    shapes = shapes.select(dealt_by("shape_name"), "host", "shape_name", "shape")
    replies = packed.tallied(packed.each_block(shapes, _ask_boxes(SPAN, parts), packed.ASKED))
    shared = packed.with_answers(shapes, replies, _group_boxes(SPAN, least, parts), boxes)

    marked = mapped(rows.select("page", "host", "html"), "html", _marked("html"), "text string, shape binary")
    marked = marked.where("text is not null").select("page", "host", "text", F.xxhash64("shape").alias("shape_name"))
    left = F.filter(F.split("text", "\n"), lambda _, i: ~F.element_at("gone", i + 1))
    text = F.when(F.col("gone").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    marked = marked.join(own.unionByName(shared), ["host", "shape_name"], "left").select("page", text.alias("text"))

    def parsed(some: DataFrame) -> DataFrame:
        return mapped(some, "html", _parsed("html"), "marked boolean, blocks array<string>")

    small = parsed(rows.join(large, "host", "left_anti"))
    small = small.select("host", "marked", "blocks", "name", F.when(~F.col("marked"), F.col("page")).alias("page"))
    schema = StructType([rows.schema["page"]]).add("text", "string")
    judged = small.groupBy("host").applyInArrow(_host_texts(depth, least), schema)

    # Of a large host each distinct page is judged once, beside some others; then its rows get the text.
    dealt = rows.join(large, "host")
    kinds = parsed(dealt.select("host", "name", "groups", "html")).groupBy("host", "name").agg(
        F.first("groups").alias("groups"), F.first("marked").alias("marked"), F.first("blocks").alias("blocks")
    )
    kinds = kinds.select(dealt_by("name"), "host", "name", "marked", "blocks")
    replies = packed.tallied(packed.each_block(kinds, _ask(depth, parts), packed.ASKED))
    texts = packed.with_answers(kinds, replies, _group_texts(depth, least, parts), "host string, name long, text string")
    shared = dealt.select("host", "name", "page").join(texts, ["host", "name"]).select("page", "text")
    return marked.unionByName(judged).unionByName(shared).select("page.*", "text")
