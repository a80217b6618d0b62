"""Updates merged on read, against updates of plain rows."""

from __future__ import annotations

import os
import random

import pytest
from pyspark.sql import functions as F

from dispensa.plans import gate as g
from dispensa.sources.changes import ChangeTable

SCHEMA = "cycle_id int, account_id int, unit int, note string"
KEYS = ("cycle_id", "account_id")


@pytest.fixture()
def table(spark, tmp_path):
    return ChangeTable(spark, str(tmp_path / "log"), SCHEMA, KEYS)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def changed(rows, key, **values):
    return [
        (c, a, values.get("unit", u), values.get("note", n)) if (c, a) == key else (c, a, u, n) for c, a, u, n in rows
    ]


def test_the_latest_change_of_each_column_counts(spark, table):
    rows = [(1, 1, 5, "loaded"), (1, 1, 6, "loaded"), (1, 2, 7, "loaded"), (None, 2, 8, "loaded")]
    table.create(spark.createDataFrame(rows, SCHEMA))
    assert rows_of(table.read()) == sorted(rows, key=str)
    table.update(spark.createDataFrame([(1, 1, "first"), (1, 2, "other"), (9, 9, "nowhere")], "cycle_id int, account_id int, note string"))
    table.update(spark.createDataFrame([(1, 1, None)], "cycle_id int, account_id int, unit int"))
    table.update(spark.createDataFrame([(1, 1, "second"), (1, 2, None)], "cycle_id int, account_id int, note string"))
    want = changed(changed(rows, (1, 1), unit=None, note="second"), (1, 2), note=None)
    assert rows_of(table.read()) == sorted(want, key=str)
    assert rows_of(table.read(1)) == sorted(rows, key=str)  # as of older versions
    assert rows_of(table.read(2)) == sorted(changed(changed(rows, (1, 1), note="first"), (1, 2), note="other"), key=str)


def test_random_updates_with_compactions(spark, table):
    rng = random.Random(3)
    rows = [(rng.randint(1, 5), rng.randint(1, 4), rng.randint(0, 99), "loaded") for _ in range(200)]
    table.create(spark.createDataFrame(rows, SCHEMA))
    for step in range(6):
        keys = {(rng.randint(1, 6), rng.randint(1, 4)) for _ in range(4)}
        column, kind = rng.choice([("unit", "int"), ("note", "string")])
        new = [(*k, rng.choice([None, step if kind == "int" else f"step {step}"])) for k in sorted(keys)]
        table.update(spark.createDataFrame(new, f"cycle_id int, account_id int, {column} {kind}"))
        for c, a, value in new:
            rows = changed(rows, (c, a), **{column: value})
        if step in (2, 3):
            table.compact()
        assert rows_of(table.read()) == sorted(rows, key=str)
    kept = table.current()
    table.vacuum(keep=1)
    assert table.versions() == [kept] and rows_of(table.read()) == sorted(rows, key=str)
    assert len([n for n in table._names() if n.startswith("base-")]) == 1


def test_an_update_writes_rows_in_the_order_of_its_notes(spark, table):
    """The log is 100,000 rows long and stays as it is; two requests get a note."""
    log = spark.range(100_000).selectExpr("cast(id % 1000 as int) as cycle_id", "cast(id % 7 as int) as account_id", "1 as unit", "'loaded' as note")
    table.create(log)
    verdicts = spark.createDataFrame([(3, 3, 0, None, "too much"), (4, 4, 0, None, "too little"), (5, 5, 1, None, None)],
                                     "cycle_id int, account_id int, verdict int, message string, note string")
    base = {n for n in table._names() if n.startswith("base-")}
    table.update(g.note_changes(verdicts))
    folders = [n for n in table._names() if n.startswith("change-")]
    assert {n for n in table._names() if n.startswith("base-")} == base and len(folders) == 1
    assert spark.read.parquet(f"{table.root}/{folders[0]}").count() == 2
    size = sum(os.path.getsize(os.path.join(d, f)) for d, _, names in os.walk(f"{table.root}/{folders[0]}") for f in names)
    assert size < 20_000
    got = {(r["cycle_id"], r["account_id"]): r["note"] for r in table.read().where("note <> 'loaded'").collect()}
    assert got == {(3, 3): "too much", (4, 4): "too little"}
    want = g.write_notes(log, verdicts)
    assert table.read().exceptAll(want.select(table.read().columns)).isEmpty()


def test_changes_that_can_not_be_told_apart_are_refused(spark, table):
    table.create(spark.createDataFrame([(1, 1, 5, "loaded")], SCHEMA))
    notes = "cycle_id int, account_id int, note string"
    for bad in ([(1, 1, "a"), (1, 1, "b")], [(None, 1, "a")]):
        with pytest.raises(Exception, match="null or there twice"):
            table.update(spark.createDataFrame(bad, notes))
    with pytest.raises(ValueError, match="needs the keys"):
        table.update(spark.createDataFrame([(1, 1, 1)], "cycle_id int, account_id int, other int"))
    with pytest.raises(ValueError, match="nothing is set"):
        table.update(spark.createDataFrame([(1, 1)], "cycle_id int, account_id int"))
    assert table.versions() == [1] and rows_of(table.read()) == [(1, 1, 5, "loaded")]


def test_a_change_that_comes_during_a_compaction_stays(spark, table, monkeypatch):
    table.create(spark.createDataFrame([(1, 1, 5, "loaded")], SCHEMA))
    table.update(spark.createDataFrame([(1, 1, "first")], "cycle_id int, account_id int, note string"))
    advance = table._advance

    def late(change):
        monkeypatch.setattr(table, "_advance", advance)
        table.update(spark.createDataFrame([(1, 1, "late")], "cycle_id int, account_id int, note string"))
        return advance(change)

    monkeypatch.setattr(table, "_advance", late)
    table.compact()
    assert [n for n, _ in table.state()["changes"]] and rows_of(table.read()) == [(1, 1, 5, "late")]


def test_no_rows(spark, table):
    table.create(spark.createDataFrame([], SCHEMA))
    table.update(spark.createDataFrame([(1, 1, "x")], "cycle_id int, account_id int, note string").where(F.lit(False)))
    assert table.read().collect() == [] and table.read().columns == ["cycle_id", "account_id", "unit", "note"]
