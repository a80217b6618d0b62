"""Benchmark passages against a dictionary of all windows."""

from __future__ import annotations

import random
import re

import pytest

from dispensa.llm import decontaminate

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(docs, items, size=10):
    windows = {}
    for name, text in items:
        w = split(text)
        for i in range(max(1, len(w) - size + 1) if w else 0):
            windows.setdefault(tuple(w[i : i + size]), set()).add(name)
    out = {}
    for key, text in docs:
        w = split(text)
        hit, found = [False] * len(w), set()
        for n in {len(x) for x in windows}:
            for i in range(len(w) - n + 1):
                if (names := windows.get(tuple(w[i : i + n]))) is not None:
                    found |= names
                    hit[i : i + n] = [True] * n
        out[key] = (len(w), sum(hit), sorted(str(x) for x in found if x is not None))
    return out


def made(seed, short):
    rng = random.Random(seed)
    words = [f"t{i}" for i in range(25)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.randint(10, 40)))) for i in range(25)]
    items += [(25, items[3][1]), (26, "  --- "), (27, None), (28, ""), (None, " ".join(words[:12]))]
    items += [(29, "T1 t2, T3"), (30, "solo"), (31, "t2 t3")] if short else []
    docs = []
    for i in range(60):
        w = [rng.choice(words + ["other", "solo"]) for _ in range(rng.randint(0, 80))]
        if i % 2:
            source = split(rng.choice(items)[1])
            a = rng.randrange(max(1, len(source)))
            w[rng.randrange(len(w) + 1) : 0] = source[a : a + rng.randint(5, 30)]
        docs.append((i, rng.choice([" ", ", ", "\n-"]).join(w).replace("t1", "T1")))
    return docs + [(60, None), (61, ""), (62, "é漢 t1"), (63, " ".join(words[:12]))], items


@pytest.mark.parametrize("seed", range(3))
@pytest.mark.parametrize("short", [False, True])
@pytest.mark.parametrize("most", [10**6, 60])
def test_against_all_windows(spark, seed, short, most):
    """One automaton or many give the same; items of one word or of few too."""
    docs, items = made(seed, short)
    table = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.mark(table, bench, words_per_automaton=most).collect()
    want = brute(docs, [(k if k is None else str(k), t) for k, t in items])
    assert {r["doc_id"]: (r["n_words"], r["n_hit"], list(r["items"])) for r in out} == want and len(out) == len(docs)
    texts = dict(docs)
    for r in out:
        raw = (texts[r["doc_id"]] or "").encode()
        cut = b" ".join(raw[h["first"] : h["last"]] for h in r["hits"]).decode()
        assert len(split(cut)) == r["n_hit"]


def test_removal(spark):
    item = " ".join(f"q{i}" for i in range(12))
    docs = spark.createDataFrame(
        [(1, f"Before it. {item.upper()}! After é it, " + "word " * 30, 9), (2, f"x {item}", 9), (3, "clean é", 9), (4, None, 9)],
        "doc_id long, text string, n_hit int",
    )
    bench = spark.createDataFrame([(7, item, "z")], "item_id long, text string, doc_id string")
    got = {r["doc_id"]: r for r in decontaminate.remove_hits(docs, bench).collect()}
    assert got[1]["text"] == "Before it. ! After é it, " + "word " * 30 and list(got[1]["items"]) == ["7"]
    assert got[2]["text"] == "" and got[3]["text"] == "clean é" and got[4]["text"] is None
    assert [got[i]["n_hit"] for i in (1, 2, 3, 4)] == [12, 12, 0, 0]


def test_nothing(spark):
    docs = spark.createDataFrame([(1, "a b c")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    assert [r["n_hit"] for r in decontaminate.mark(docs, bench.limit(0)).collect()] == [0]
    assert decontaminate.mark(docs.limit(0), bench).collect() == []
