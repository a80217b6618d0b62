"""Repairs against a search that carries whole audits along, for chunks of any size, and the query against its SQL."""

from __future__ import annotations

import hashlib
import random
import re
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from dispensa.llm import conversations as cv
from dispensa.llm.queries import QUERIES
from tests.test_oracle import compare

SCHEMA = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
NAMES = {"u": "user", "a": "assistant"}


def _insertions(best):
    out, last = dict(best), best
    for _ in range(4):
        new = {}
        for state, (cost, audit, lines) in last.items():
            to = NEXT[state]
            new[to] = min(new.get(to, (99**9,)), (cost + 3, audit + "I", (*lines, NAMES[to] + ":")))
        for to, way in new.items():
            out[to] = min(out.get(to, (99**9,)), way)
        last = new
    return out


def plain(rows):
    """Gaps, blank, duplicate, truncated, illegal, cost, audit and lines of rows (turn, role, text) in order."""
    seen, faults = set(), []
    for _, role, text in rows:
        fault = "blank" if not text.strip(WHITE) else "duplicate" if (role, text) in seen else ""
        faults.append(fault or ("truncated" if text.rstrip(WHITE)[-1] not in ".!?" else ""))
        seen.add((role, text))
    initials = [r[1][:1] for r in rows]
    turns = [r[0] for r in rows if r[0] is not None]
    best = {"": (0, "", ())}
    for (_, role, text), fault in zip(rows, faults):
        new = {}

        def way(state, *found):
            new[state] = min(new.get(state, (99**9,)), found)

        for state, (cost, audit, lines) in _insertions(best).items():
            way(state, cost + 4, audit + "D", lines)
            if fault in ("blank", "duplicate"):
                continue
            cost += 3 * (fault == "truncated")
            to = NEXT[state]
            way(to, cost + 3, audit + "R", (*lines, f"{NAMES[to]}:{text}"))
            if role[:1] == to or (state == "" and role[:1] == "s"):
                way(role[:1], cost, audit + "K", (*lines, f"{role}:{text}"))
        best = new
    cost, audit, lines = min(way for state, way in _insertions(best).items() if state in ("", "a"))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    return (gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], illegal, cost, audit), lines


def in_order(rows, conv):
    mine = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()[:16])
    return sorted(mine, key=key)


def check(spark, staging, rows):
    repair = cv.Repair(spark.createDataFrame(rows, SCHEMA).repartition(3), staging)
    report = {r["conv_id"]: tuple(r)[1:] for r in repair.report().collect()}
    lines = {}
    for r in sorted(repair.rows().collect(), key=lambda r: (r["at"], r["step"])):
        lines.setdefault(r["conv_id"], []).append(f"{r['role']}:{r['text']}")
    digests = {r["conv_id"]: r["sha256"] for r in repair.digests().collect()}
    want = {c: plain(in_order(rows, c)) for c in {r[0] for r in rows}}
    assert report == {c: w[0] for c, w in want.items()}
    assert {c: tuple(x) for c, x in lines.items()} == {c: w[1] for c, w in want.items() if w[1]}
    assert digests == {c: hashlib.sha256("\n".join(w[1]).encode()).hexdigest() for c, w in want.items() if w[1]}
    initials = {c: "".join(x[0] for x in w[1]) for c, w in want.items()}
    assert all(re.fullmatch("(s?(ua)+)?", x) for x in initials.values())


def made(seed=2):
    rng = random.Random(seed)
    roles = ["user", "assistant", "user", "assistant", "system", "tool", None, "", "superuser"]
    rows = []
    for c in range(150):
        for t in range(rng.randint(1, 14)):
            text = rng.choice(["Hi.", "ok", "", " ", None, "What?", "a b. ", "x!", "same", f"q{t}.", f"w{t}", "two\nlines.\n"])
            rows.append((c or None, rng.choice([t, t, t, t, None, t + 3]), rng.choice(roles), text))
    long = [(999, t // 3, rng.choice(roles[:5]), rng.choice([f"A{t}.", f"b{t}", "", "same."])) for t in range(300)]
    return [*rows, *long, *[(5, 1, "user", "Hi.")] * 7, *[(777, None, "user", "again.")] * 40]


@pytest.mark.parametrize("chunk", [4096, 4, 3])
def test_repairs_in_chunks(spark, staging, monkeypatch, chunk):
    # With chunks of three rows the long conversation has five levels of groups.
    monkeypatch.setattr(cv, "CHUNK", chunk)
    check(spark, staging, made())


@settings(max_examples=300, deadline=None)
@given(kinds=st.text(alphabet="suaxSUAX-", max_size=24), cut=st.lists(st.integers(1, 5), max_size=20))
def test_joined_tables_cross_where_rows_do(kinds, cut):
    letters, _ = cv.solved(kinds)
    tables = [cv.row_table(k) for k in kinds]
    if not kinds:
        return
    runs, at = [], 0
    for n in [*cut, len(kinds)]:
        if at < len(kinds):
            runs.append(kinds[at : at + n])
            at += n
    joint = [cv.joined([cv.row_table(k) for k in r]) for r in runs]
    last = cv.last_state(joint, 0)
    assert last == cv.last_state(tables, 0)
    states = cv.crossings(joint, 0, last)
    apart = [cv.solved(r, a, b if i + 1 < len(runs) else None)[0] for i, (r, a, b) in enumerate(zip(runs, states, states[1:]))]
    assert tuple(x for run in apart for x in run) == letters


@settings(max_examples=300, deadline=None)
@given(kinds=st.text(alphabet="suaxSUAX-", max_size=14))
def test_least_cost_and_least_audit(kinds):
    names = {"s": "system", "u": "user", "a": "assistant", "x": "tool", "-": "user"}
    rows = [(i, names[k.lower()], "" if k == "-" else f"t{i}" + "." * k.islower()) for i, k in enumerate(kinds)]
    assert "".join(cv.solved(kinds)[0]) == plain(rows)[0][-1]


def test_empty_and_odd_columns(spark, staging):
    empty = cv.Repair(spark.createDataFrame([], SCHEMA + ", at string, key int"), staging)
    assert empty.report().collect() == [] and empty.rows().collect() == []
    rows = [("b", None, None, None, 1), ("b", 2, "user", "x" * 100_000 + ".", 2), (None, 1, "assistant", "Yes.", 3)]
    table = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string, chunk int")
    repair = cv.Repair(table, staging)
    got = {r["conv_id"]: (r["gaps"], r["blank"], r["cost"], r["audit"]) for r in repair.report().collect()}
    assert got == {"b": (0, 1, 7, "DKI"), None: (0, 0, 3, "IK")}
    assert {r["conv_id"] for r in repair.digests().collect()} == {"b", None}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = (" " if x is None else x for x in (role, text))
        if fault == 1:
            text = ""
        elif fault == 2:
            text = re.sub("[.!?]", "", text)
        elif fault == 4:
            role = "user"
        out += [(conv, turn, role, text)] * {0: 0, 3: 2}.get(fault, 1)
    return out


def test_damage(spark):
    rows = made(3)
    got = cv.damaged(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, damaged(rows)))


def test_query_against_plain_search(spark, folder):
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    hurt = damaged(rows)
    want = {}
    for conv in {r[0] for r in rows}:
        report, lines = plain(in_order(hurt, conv))
        want[conv] = (*report, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    got = QUERIES["op13_conversation_repair"].run(spark, folder).collect()
    assert {r["conv_id"]: tuple(r)[1:] for r in got} == want and len(got) == len(want)


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{folder}/conversations.parquet'")
    assert compare(QUERIES["op13_conversation_repair"].run(spark, folder), con, QUERIES["op13_conversation_repair"].sql)


def test_a_conversation_of_dropped_rows_is_returned(spark, tmp_path):
    turn = next(t for t in range(1000) if zlib.crc32(f"7:{t}".encode()) % 20 == 0)
    rows = [(7, turn, "user", "Gone."), (None, 1, "user", "Hi.")]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: tuple(r)[1:] for r in QUERIES["op13_conversation_repair"].run(spark, str(tmp_path)).collect()}
    assert got[7] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) and len(got) == 2
