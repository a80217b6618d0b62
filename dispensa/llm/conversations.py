"""Repair of conversations at least cost, by Hirschberg's divide and conquer over a four-state cost.

A conversation is its rows by turn (nulls first; rows of one turn by role, then by the hash of the text). Each row has
at most one fault, the first of: blank (nothing but white space), duplicate (its role and text stood earlier),
truncated (its last character that is not white space ends no sentence). A repair keeps a row (cost 0), gives it the
role user or assistant (3), deletes it (4; a must for blank and duplicate rows), or inserts an empty row of user or
assistant anywhere (3); a truncated row that stays costs 3 more. What remains must be nothing, or user and assistant in
turns from user to assistant, behind one system row perhaps. The audit has a letter for each edit, K, R, D or I, in
order; of the cheapest repairs the one whose audit is least in ASCII is taken. It fixes the roles too.

What has been emitted so far is one of four states: nothing, system, user, assistant. A row, or a run of rows, is a
4 x 4 table: the cost from the state before it to the state right behind it, and how the cheapest audits from one state
compare. (Audits over the same rows that end in different states differ, and none begins another, so they can be ranked
without being spelt out.) To find the repair of a run from one state to another, a forward vector of four costs runs to
its middle, and a backward vector of four costs comes from its end; of the states in which they meet at the least sum
the one with the least forward audit is the crossing, and both halves follow alike. Beside the rows only vectors of four
are held at a time.

Conversations of any length: rows are dealt into chunks of ``CHUNK`` rows by their position. A conversation of one chunk
is solved there. The tables of longer ones are joined upwards, ``CHUNK`` to one; from the top down each group's crossings
give its members their first and last states; then every chunk is solved alone. Rows travel without their texts, with a
hash of 16 bytes; equal rows of a turn are one with a count, as all but the first are duplicates. Texts are joined to the
edits once, by (conversation, turn, role, hash), which has no hot key.

Defined results: a null role or text counts as one space; a null conversation is one; a null turn comes first; a role
whose first letter is not s, u or a can't be kept. Conversations without rows have no repair. Columns but these four are
left out.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dispensa.llm.batches import mapped
from dispensa.llm.ship import shipped
from dispensa.operators.ordered import row_numbers
from dispensa.sources.staging import Staging

CHUNK = 4096
RETAINED = 100_000  # solved chunks that a worker remembers
KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
_COST = {KEEP: 0, REROLE: 3, DELETE: 4, INSERT: 3}
_TRUNCATED = 3
_FAR = 1 << 40
_NEXT = {0: 2, 1: 2, 2: 3, 3: 2}  # the state behind a user or assistant row: nothing, system, user, assistant
_ENDS = {0: "", 1: "II", 2: "I", 3: ""}  # what must be inserted behind the last row

#: A run's costs and ranks: ``cost[4 * a + b]`` from state a to state b, ``rank[4 * a + b]`` among the audits from a.
Table = tuple[tuple[int, ...], tuple[int, ...]]


# --- one row -------------------------------------------------------------------------------------


@functools.cache
def _row(kind: str) -> dict[tuple[int, int], tuple[int, str]]:
    """The cheapest way through one row, by the states before and behind it: cost and letters, least letters of equals.

    Kinds are s, u, a or x for the role, as capitals if truncated, and - for a row that must go.
    """
    role, extra = kind.lower(), _TRUNCATED * kind.isupper()
    found: dict[tuple[int, int], tuple[int, str]] = {}
    for a in range(4):
        before, at = "", a
        for _ in range(3):  # a third insertion would only lead round
            ways = [(DELETE, at)]
            if kind != "-":
                ways.append((REROLE, _NEXT[at]))
                if role in "ua" and _NEXT[at] == "ua".index(role) + 2:
                    ways.append((KEEP, _NEXT[at]))
                if role == "s" and at == 0:
                    ways.append((KEEP, 1))
            for letter, b in ways:
                cost = len(before) * _COST[INSERT] + _COST[letter] + (extra if letter != DELETE else 0)
                found[a, b] = min(found.get((a, b), (_FAR, "")), (cost, before + letter))
            before, at = before + INSERT, _NEXT[at]
    return found


@functools.cache
def row_table(kind: str) -> Table:
    ways = _row(kind)
    cost = tuple(ways[a, b][0] if (a, b) in ways else _FAR for a in range(4) for b in range(4))
    rank = []
    for a in range(4):
        order = sorted((ways[a, b][1], b) for b in range(4) if (a, b) in ways)
        places = {b: i for i, (_, b) in enumerate(order)}
        rank += [places.get(b, 4) for b in range(4)]
    return cost, tuple(rank)


# --- runs ----------------------------------------------------------------------------------------


def _forward(costs: list[int], ranks: list[int], table: Table) -> tuple[list[int], list[int]]:
    """The vector of four costs, and the order of their audits, one item further."""
    cost, rank = table
    best = []
    for b in range(4):
        best.append(min((costs[a] + cost[4 * a + b], ranks[a], rank[4 * a + b]) for a in range(4) if ranks[a] < 4))
    order = sorted((r, s, b) for b, (c, r, s) in enumerate(best) if c < _FAR)
    ranks = [4] * 4
    for i, (_, _, b) in enumerate(order):
        ranks[b] = i
    return [min(c, _FAR) for c, _, _ in best], ranks


def _backward(costs: list[int], table: Table) -> list[int]:
    cost = table[0]
    return [min(_FAR, min(cost[4 * a + b] + costs[b] for b in range(4))) for a in range(4)]


def _start(state: int) -> tuple[list[int], list[int]]:
    return [0 if s == state else _FAR for s in range(4)], [0 if s == state else 4 for s in range(4)]


def joined(tables: Sequence[Table]) -> Table:
    """The table of a run."""
    cost: list[int] = []
    rank: list[int] = []
    for a in range(4):
        costs, ranks = _start(a)
        for table in tables:
            costs, ranks = _forward(costs, ranks, table)
        cost += costs
        rank += ranks
    return tuple(cost), tuple(rank)


def _crossing(forward: tuple[list[int], list[int]], backward: list[int]) -> int:
    costs, ranks = forward
    return min((costs[s] + backward[s], ranks[s], s) for s in range(4))[2]


def last_state(tables: Sequence[Table], first: int) -> int:
    """The state behind the last row in the cheapest repair of a whole conversation."""
    forward = _start(first)
    for table in tables:
        forward = _forward(*forward, table)
    return _crossing(forward, [len(_ENDS[s]) * _COST[INSERT] for s in range(4)])


def crossings(tables: Sequence[Table], first: int, last: int) -> list[int]:
    """The states before, between and behind the items of a run in its cheapest, audit-least repair."""
    states = [first, *[0] * (len(tables) - 1), last]
    halves = [(0, len(tables))]
    while halves:
        lo, hi = halves.pop()
        if hi - lo < 2:
            continue
        middle = (lo + hi) // 2
        forward = _start(states[lo])
        for table in tables[lo:middle]:
            forward = _forward(*forward, table)
        backward = [0 if s == states[hi] else _FAR for s in range(4)]
        for table in reversed(tables[middle:hi]):
            backward = _backward(backward, table)
        states[middle] = _crossing(forward, backward)
        halves += [(lo, middle), (middle, hi)]
    return states


@functools.lru_cache(maxsize=RETAINED)
def solved(kinds: str, first: int = 0, last: int | None = None) -> tuple[tuple[str, ...], str]:
    """Each row's letters, and for each letter the role that it writes (u, a, or . for none), space-separated by row.

    Without a ``last`` state the run ends the conversation, and its last row has the closing insertions too.
    """
    if not kinds:
        return (), ""
    tables = [row_table(k) for k in kinds]
    states = crossings(tables, first, last_state(tables, first) if last is None else last)
    letters = [_row(k)[a, b][1] for k, a, b in zip(kinds, states, states[1:])]
    if last is None:
        letters[-1] += _ENDS[states[-1]]
    roles, at = [], first
    for kind, edits in zip(kinds, letters):
        written = ""
        for letter in edits:
            if letter == KEEP and kind in "sS":
                at, role = 1, "."
            elif letter == DELETE:
                role = "."
            else:
                at = _NEXT[at]
                role = "." if letter == KEEP else "..ua"[at]
            written += role
        roles.append(written)
    return tuple(letters), " ".join(roles)


def _pair(a: str, b: str) -> bool:
    return a + b in ("su", "ua", "au")


# --- tables of chunks ----------------------------------------------------------------------------

_NODE = "i bigint, costs array<bigint>, ranks array<int>"


def _summary(chunks: DataFrame) -> DataFrame:
    """The tables of chunks, as nodes (conv_id, i, costs, ranks)."""

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        tables = [joined([row_table(k) for k in kinds]) for kinds in batch.column("kinds").to_pylist()]
        return {
            "costs": pa.array([t[0] for t in tables], pa.list_(pa.int64())),
            "ranks": pa.array([t[1] for t in tables], pa.list_(pa.int32())),
        }

    made = mapped(chunks.select("conv_id", F.col("chunk").alias("i"), "kinds"), "kinds", work, "costs array<bigint>, ranks array<int>")
    return made.drop("kinds")


def _members(nodes: DataFrame) -> DataFrame:
    """Groups of up to ``CHUNK`` neighbours, as (conv_id, i, costs, ranks), the last two arrays of arrays in order."""
    entries = F.array_sort(F.collect_list(F.struct("i", "costs", "ranks")))
    groups = nodes.groupBy("conv_id", F.call_function("div", F.col("i"), F.lit(CHUNK)).alias("i")).agg(entries.alias("entries"))
    return groups.select(
        "conv_id",
        "i",
        F.transform("entries", lambda e: e["costs"]).alias("costs"),
        F.transform("entries", lambda e: e["ranks"]).alias("ranks"),
        F.lit("").alias("key"),
    )


def _tables(batch: pa.RecordBatch) -> Iterator[list[Table]]:
    for costs, ranks in zip(batch.column("costs").to_pylist(), batch.column("ranks").to_pylist()):
        yield [(tuple(c), tuple(r)) for c, r in zip(costs, ranks)]


def _given(nodes: DataFrame, staging: Staging) -> DataFrame:
    """The states before and behind each node (conv_id, i, first, last); no last state for a conversation's last node."""
    nodes = staging.keep(nodes, "tables")
    groups = staging.keep(_members(nodes), "groups")
    if groups.where("i > 0").isEmpty():
        groups = groups.withColumns({"first": F.lit(0), "last": F.lit(None).cast("int")})
    else:

        def up(batch: pa.RecordBatch) -> dict[str, pa.Array]:
            tables = [joined(t) for t in _tables(batch)]
            return {
                "costs": pa.array([t[0] for t in tables], pa.list_(pa.int64())),
                "ranks": pa.array([t[1] for t in tables], pa.list_(pa.int32())),
            }

        parents = mapped(groups, "key", up, "costs array<bigint>, ranks array<int>").select("conv_id", "i", "costs", "ranks")
        given = _given(parents, staging).select(F.col("conv_id").alias("_conv"), F.col("i").alias("_i"), "first", "last")
        groups = groups.join(given, F.expr("conv_id <=> _conv and i = _i")).drop("_conv", "_i")

    def down(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        out = []
        ends = zip(batch.column("first").to_pylist(), batch.column("last").to_pylist())
        for tables, (first, last) in zip(_tables(batch), ends):
            states = crossings(tables, first, last_state(tables, first) if last is None else last)
            if last is None:  # the last node ends the conversation
                states[-1] = -1
            out.append(states)
        return {"states": pa.array(out, pa.list_(pa.int32()))}

    states = mapped(groups, "key", down, "states array<int>").select("conv_id", "i", F.posexplode("states").alias("pos", "first"), "states")
    behind = F.get("states", F.col("pos") + 1)
    return states.where(F.col("pos") < F.size("states") - 1).select(
        "conv_id", (F.col("i") * CHUNK + F.col("pos")).alias("i"), "first", F.when(behind >= 0, behind).alias("last")
    )


# --- the operator --------------------------------------------------------------------------------


def _read(rows: DataFrame) -> DataFrame:
    text = F.coalesce("text", F.lit(" "))
    return rows.select(
        "conv_id",
        "turn",
        F.coalesce("role", F.lit(" ")).alias("role"),
        text.alias("text"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("key"),
    )


def _chunks(rows: DataFrame, staging: Staging) -> DataFrame:
    """The rows of each chunk in order, their kinds, and the chunk's sums."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    open_end = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    slim = rows.select("conv_id", "turn", "role", "key", blank.alias("blank"), open_end.alias("open_end"))
    slim = slim.groupBy(*slim.columns).agg(F.count("*").alias("copies"))
    order = [F.col(c) for c in ("turn", "role", "key")]
    placed = staging.keep(row_numbers(slim, order, "at", staging, ["conv_id"]), "order")
    first = placed.groupBy("conv_id", "role", "key").agg(F.min("at").alias("_at"))
    first = first.select(F.col("conv_id").alias("_conv"), "_at", F.lit(True).alias("_new"))
    found = placed.join(first, F.expr("conv_id <=> _conv and at = _at"), "left")
    fault = F.when(F.col("blank"), "b").when(F.col("_new").isNull(), "d").when(F.col("open_end"), "t").otherwise("")
    initial = F.left("role", F.lit(1))
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    kind = F.when(F.col("fault").isin("b", "d"), "-").when(F.col("fault") == "t", F.upper(letter)).otherwise(letter)
    found = found.withColumn("fault", fault).select(
        "conv_id", "turn", "role", "key", "copies", "at", "fault", letter.alias("letter"), kind.alias("kind")
    )
    entries = F.array_sort(F.collect_list(F.struct("at", "turn", "role", "key", "copies", "letter", "kind")))
    more = F.col("copies") - 1
    count = lambda c: F.coalesce(F.sum(c), F.lit(0))
    chunks = found.groupBy("conv_id", F.call_function("div", F.col("at") - 1, F.lit(CHUNK)).alias("chunk")).agg(
        entries.alias("entries"),
        count(F.when(F.col("fault") == "b", F.col("copies"))).alias("blank"),
        count(F.when(F.col("fault") == "d", F.col("copies")).when(F.col("fault") != "b", more)).alias("duplicate"),
        count(F.when(F.col("fault") == "t", 1)).alias("truncated"),
        F.sum(more).alias("more"),
        F.min("turn").alias("low"),
        F.max("turn").alias("high"),
    )
    joint = lambda field: F.array_join(F.transform("entries", lambda e: e[field]), "")
    turns = F.array_compact(F.transform("entries", lambda e: e["turn"]))
    return chunks.withColumns({"kinds": joint("kind"), "letters": joint("letter"), "turns": F.size(F.array_distinct(turns))})


def _solve(chunks: DataFrame, staging: Staging) -> DataFrame:
    """Add the edits of each row, their roles, the cost of those, and the illegal neighbours inside the chunk."""
    whole = (F.col("chunk") == 0) & (F.size("entries") < CHUNK)  # the others may belong to longer conversations
    ready = chunks.where(whole).withColumns({"first": F.lit(0), "last": F.lit(None).cast("int")})
    parts = chunks.where(~whole)
    if not parts.isEmpty():
        given = _given(_summary(parts), staging)
        given = given.select(F.col("conv_id").alias("_conv"), F.col("i").alias("_i"), "first", "last")
        ready = ready.unionByName(parts.join(given, F.expr("conv_id <=> _conv and chunk = _i")).drop("_conv", "_i"))

    def work(batch: pa.RecordBatch) -> dict[str, pa.Array]:
        edits, roles, costs, illegal = [], [], [], []
        letters = batch.column("letters").to_pylist()
        for i, kinds in enumerate(batch.column("kinds").to_pylist()):
            rows, written = solved(kinds, batch.column("first")[i].as_py(), batch.column("last")[i].as_py())
            edits.append(rows)
            roles.append(written)
            open_ends = sum(k.isupper() and DELETE not in r for k, r in zip(kinds, rows))
            costs.append(sum(_COST[x] for r in rows for x in r) + _TRUNCATED * open_ends)
            illegal.append(sum(not _pair(a, b) for a, b in zip(letters[i], letters[i][1:])))
        return {
            "edits": pa.array(edits, pa.list_(pa.string())),
            "roles": pa.array(roles, pa.string()),
            "cost": pa.array(costs, pa.int64()),
            "illegal": pa.array(illegal, pa.int64()),
        }

    made = "edits array<string>, roles string, cost bigint, illegal bigint"
    return staging.keep(mapped(ready, "kinds", work, made), "solved")


class Repair:
    """The repair of a table of conversations (conv_id, turn, role, text)."""

    def __init__(self, rows: DataFrame, staging: Staging):
        shipped(rows.sparkSession)
        self._rows = _read(rows)
        self._solved = _solve(staging.keep(_chunks(self._rows, staging), "chunks"), staging)

    def report(self) -> DataFrame:
        """One row for each conversation: gaps, blank, duplicate, truncated, illegal, cost, audit."""
        done = self._solved
        copied = F.zip_with("entries", "edits", _audit)
        by_chunk = done.withColumn("audit", F.array_join(copied, ""))
        # Where a conversation goes on in the next chunk: its pair of roles there, and a turn that both have.
        ends = done.select(
            "conv_id", "chunk", F.right("letters", F.lit(1)).alias("letter"), F.element_at("entries", -1)["turn"].alias("turn")
        )
        begins = done.where("chunk > 0").select(
            F.col("conv_id").alias("_conv"), (F.col("chunk") - 1).alias("_chunk"), F.left("letters", F.lit(1)).alias("_letter"),
            F.get("entries", F.lit(0))["turn"].alias("_turn"),
        )
        legal = F.concat("letter", "_letter").isin("su", "ua", "au")
        across = ends.join(begins, F.expr("conv_id <=> _conv and chunk = _chunk")).select(
            "conv_id",
            F.when(legal, 0).otherwise(1).alias("illegal"),
            F.when(F.col("turn") == F.col("_turn"), 1).otherwise(0).alias("same"),
        )
        across = across.groupBy(F.col("conv_id").alias("_conv")).agg(
            F.sum("illegal").alias("_illegal"), F.sum("same").alias("_same")
        )
        sums = by_chunk.groupBy("conv_id").agg(
            (F.max("high") - F.min("low") + 1 - F.sum("turns")).alias("gaps"),
            *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")],
            (F.sum("illegal") + F.sum("more")).alias("illegal"),
            (F.sum("cost") + F.sum("more") * _COST[DELETE]).alias("cost"),
            F.array_sort(F.collect_list(F.struct("chunk", "audit"))).alias("audits"),
        )
        return sums.join(across, F.expr("conv_id <=> _conv"), "left").select(
            "conv_id",
            F.coalesce(F.col("gaps") + F.coalesce("_same", F.lit(0)), F.lit(0)).alias("gaps"),
            "blank",
            "duplicate",
            "truncated",
            (F.col("illegal") + F.coalesce("_illegal", F.lit(0))).alias("illegal"),
            "cost",
            F.array_join(F.transform("audits", lambda a: a["audit"]), "").alias("audit"),
        )

    def _edits(self) -> DataFrame:
        """Each row's place, key, edits and the roles that they write."""
        zipped = F.arrays_zip("entries", "edits", F.split("roles", " ").alias("written"))
        return self._solved.select("conv_id", F.posexplode(zipped).alias("_", "r")).select(
            "conv_id", "r.entries.at", "r.entries.turn", "r.entries.role", "r.entries.key", "r.edits", "r.written"
        )

    def digests(self) -> DataFrame:
        """(conv_id, sha256): of the repaired rows of each conversation with some, as ``role:text``, joined by line feeds.

        A digest reads its lines one after the other, so each conversation goes to one task; edits and texts meet there,
        sorted by Spark, and stream through it, so that texts are shuffled once and no more than a batch is held.
        """
        none = F.lit(None).cast("string")
        edits = self._edits().select("conv_id", "turn", "role", "key", F.lit(0).alias("part"), "edits", "written", none.alias("text"))
        texts = self._rows.select("conv_id", "turn", "role", "key", F.lit(1).alias("part"), none.alias("edits"), none.alias("written"), "text")
        both = edits.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "key", "part")
        return _digests(both.select("conv_id", "edits", "written", "role", "text"))

    def rows(self) -> DataFrame:
        """The repaired rows: conv_id, at and step (their order), turn, role, text, edit (K, R or I).

        An inserted row has no turn and an empty text.
        """
        steps = self._edits().select(
            "conv_id", "at", "turn", "role", "key", "written", F.posexplode(F.split("edits", "")).alias("step", "edit")
        ).withColumn("written", F.substring("written", F.col("step") + 1, F.lit(1)))
        role = F.when(F.col("written") == "u", "user").when(F.col("written") == "a", "assistant").otherwise(F.col("role"))
        inserted = steps.where(F.col("edit") == INSERT).select(
            "conv_id", "at", "step", F.lit(None).cast(self._rows.schema["turn"].dataType).alias("turn"), role.alias("role"),
            F.lit("").alias("text"), "edit",
        )
        texts = self._rows.groupBy(*[F.col(c).alias(f"_{c}") for c in ("conv_id", "turn", "role", "key")]).agg(
            F.first("text").alias("text")
        )
        same = F.expr("conv_id <=> _conv_id and turn <=> _turn and role = _role and key = _key")
        stays = steps.where(F.col("edit").isin(KEEP, REROLE)).join(texts, same)
        return inserted.unionByName(stays.select("conv_id", "at", "step", "turn", role.alias("role"), "text", "edit"))


def _audit(entry: Column, edits: Column) -> Column:
    """The letters of a row and its copies. These are deleted right behind it, before what is inserted at the end."""
    more = F.repeat(F.lit(DELETE), (entry["copies"] - 1).cast("int"))
    own = F.regexp_extract(edits, "^I*[KRD]", 0)
    return F.concat(own, more, F.substring(edits, F.length(own) + 1, F.length(edits)))


def _digests(ordered: DataFrame) -> DataFrame:
    """(conv_id, sha256) of rows (conv_id, edits, written, role, text), dealt by conversation and sorted.

    Each row with edits is followed by its text, if any, once or several times; other texts are left out.
    """
    kind = ordered.schema["conv_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import hashlib

        from pyspark.sql.pandas.types import to_arrow_type

        arrow = to_arrow_type(kind)
        state, conv, waiting, lines = None, None, None, 0

        def told(edits: str, written: str, role: str, text: str | None) -> Iterator[str]:
            for edit, to in zip(edits, written):
                if edit != DELETE:
                    name = role if to == "." else "user" if to == "u" else "assistant"
                    yield f"{name}:{'' if edit == INSERT else text}"

        for batch in batches:
            ids, digests = [], []
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "edits", "written", "role", "text")]
            for row_conv, edits, written, role, text in zip(*columns):
                if state is None or row_conv != conv:
                    if lines:
                        ids.append(conv)
                        digests.append(state.hexdigest())
                    state, conv, waiting, lines = hashlib.sha256(), row_conv, None, 0
                if edits is not None:
                    # Its text comes next, if one of its edits needs it.
                    waiting = (edits, written, role) if KEEP in edits or REROLE in edits else None
                    if waiting is not None:
                        continue
                    new = told(edits, written, role, None)
                elif waiting is not None:
                    new, waiting = told(*waiting, text), None
                else:
                    continue
                for line in new:
                    state.update(f"\n{line}".encode() if lines else line.encode())
                    lines += 1
            yield pa.RecordBatch.from_arrays([pa.array(ids, arrow), pa.array(digests, pa.string())], names=["conv_id", "sha256"])
        if lines:
            yield pa.RecordBatch.from_arrays([pa.array([conv], arrow), pa.array([state.hexdigest()])], names=["conv_id", "sha256"])

    return ordered.mapInArrow(run, f"conv_id {kind.simpleString()}, sha256 string")


def damaged(rows: DataFrame) -> DataFrame:
    """Rows with faults that a checksum of conversation and turn decides: dropped, emptied, without sentence ends,
    repeated, or user's. Nulls count as one space, but for the conversation and the turn themselves."""
    shown = [F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")]
    fault = F.crc32(F.concat(shown[0], F.lit(":"), shown[1]).cast("binary")) % 20
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    hurt = rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(role).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        fault.alias("fault"),
    )
    copies = F.when(F.col("fault") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return hurt.where("fault <> 0").withColumn("_copy", F.explode(copies)).drop("_copy", "fault")
