"""Shredding of JSON payloads."""

from __future__ import annotations

import pytest

from dispensa.plans import feed


def payloads(spark, *bodies):
    return spark.createDataFrame([(b,) for b in bodies], "body string")


ENVELOPE = '<?xml version="1.0" encoding="utf-8"?>\n<a:Env xmlns:a="x"><a:Body><Result>{}</Result></a:Body></a:Env>\n'


def test_envelope_names_and_types(spark):
    body = ENVELOPE.format('[{"EventKod": 7, "P_Z": "E", "Iht": "<b>", "DrSabit": 3, "IlacCalismaSirasi": "2", "Ikili": "H", "X": 1}]')
    df = feed.shred_json(payloads(spark, body))
    assert df.columns == [column for _, column, _ in feed.VISIT_FIELDS] and len(df.columns) == 17
    row = df.first()
    assert (row["EventKod"], row["PlanliZiyaret"], row["iht"], row["DrSabit"], row["ikiliZiyaret"]) == ("7", "E", "<b>", 3, "H")
    assert row["Line"] is None


def test_plain_text_arrays_and_emptiness(spark):
    df = feed.shred_json(payloads(spark, '[{"Line":"a"},{"Line":"b"}]', "[]", ENVELOPE.format("[]"), None, '{"Line":"c"}'))
    assert sorted(r["Line"] for r in df.collect()) == ["a", "b", "c"]


def test_a_bad_integer_is_null_or_fails(spark):
    body = '[{"EventKod":"k","DrSabit":"many"}]'
    row = feed.shred_json(payloads(spark, body)).first()
    assert (row["EventKod"], row["DrSabit"]) == ("k", None)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        feed.shred_json(payloads(spark, body), strict=True).collect()


def test_long_payload_stays_whole(spark):
    n = 50000
    body = ENVELOPE.format("[" + ",".join(f'{{"EventKod":"{i}"}}' for i in range(n)) + "]")
    assert feed.shred_json(payloads(spark, body)).distinct().count() == n


def test_append_by_position(spark):
    target = spark.createDataFrame([(1, "a")], "id bigint, name string")
    rows = spark.createDataFrame([("2", 3)], "x string, y int")
    got = feed.append_by_position(target, rows)
    assert got.dtypes == target.dtypes and sorted(map(tuple, got.collect())) == [(1, "a"), (2, "3")]
    with pytest.raises(ValueError, match="1 columns given, 2 expected"):
        feed.append_by_position(target, rows.select("x"))


BROKEN = ['[{"Line":"a"},{"Line":"b', '[{"Line":"a"}] stray', "<a>[</a>", "{", "[1],[2]", "[]],[[", "]["]
EMPTY = ["", "  ", "<a></a>", ENVELOPE.format(" ")]
SCALARS = ["7", "<a>null</a>", '"text"']


@pytest.mark.parametrize("body", [*BROKEN, *EMPTY, *SCALARS])
def test_a_payload_that_is_not_well_formed_fails(spark, body):
    df = payloads(spark, '[{"Line":"good"}]', body)
    with pytest.raises(Exception, match="not well-formed"):
        feed.shred_json(df).collect()
    with pytest.raises(Exception, match="not well-formed"):
        feed.json_typed(df).collect()


def test_rejects_are_returned_with_their_reason_and_nothing_else(spark):
    good = ['[{"Line":"a"},{"Line":"b"}]', "[]", "<a>[]</a>", "{}"]
    df = payloads(spark, *good, *BROKEN, *EMPTY, *SCALARS, None)
    got = {}
    for r in feed.json_rejects(df).collect():
        got.setdefault(r["reason"], []).append(r["body"])
    assert {k: sorted(map(str, v)) for k, v in got.items()} == {
        "malformed": sorted(BROKEN), "empty": sorted(EMPTY), "scalar": sorted(SCALARS), "missing": ["None"],
    }
    assert sorted(r["Line"] or "" for r in feed.shred_json(df, skip_rejects=True).collect()) == ["", "a", "b"]


def test_elements_that_are_not_objects_give_a_row_of_nulls(spark):
    rows = feed.shred_json(payloads(spark, '[3, null, {"DrSabit": 99999999999}, {"DrSabit": "17"}]')).collect()
    assert [r["DrSabit"] for r in rows] == [None, None, None, 17]


def test_fields_of_any_name_and_kind(spark):
    body = '[{"a": "x", "b": 1.5, "c": null, "d": {"e": [1]}, "f g": [true], "h": false}, 5, {"a": 2}]'
    df = spark.createDataFrame([(1, body), (2, None), (3, "[]")], "id int, body string")
    got = [tuple(r) for r in feed.json_typed(df).collect()]
    assert got == [
        (1, 0, "a", "x", 1), (1, 0, "b", "1.5", 2), (1, 0, "c", None, 0), (1, 0, "d", '{"e":[1]}', 5),
        (1, 0, "f g", "[true]", 4), (1, 0, "h", "false", 3), (1, 2, "a", "2", 2),
    ]


def test_each_text_is_parsed_once(spark):
    df = payloads(spark, "[]")
    jobs = [feed.shred_json(df), feed.shred_json(df, skip_rejects=True), feed.json_rejects(df), feed.json_typed(df)]
    plans = [j._jdf.queryExecution().executedPlan().toString() for j in jobs]
    assert [p.count("parseJson") for p in plans] == [1] * 4
