"""The manifest against trees built by plain lists, and its query against its SQL."""

from __future__ import annotations

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from dispensa.llm import manifest
from dispensa.llm.queries import QUERIES
from tests.test_oracle import compare

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def levels(leaves):
    out = [leaves]
    while len(out[-1]) > 1:
        out.append([digest(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def path(tree, i):
    steps = []
    for level in tree[:-1]:
        run = level[i // 2 * 2 : i // 2 * 2 + 2]
        steps.append((i % 2 == 1, run[1 - i % 2] if len(run) > 1 else None))
        i //= 2
    return steps


def plain(rows):
    trees = {}
    for r in rows:
        trees.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, leaf(r), r))
    langs = sorted(trees, key=lambda k: (k is not None, (k or "").encode()))
    for k in langs:
        trees[k].sort(key=lambda x: x[:3])
    below = {k: levels([x[2] for x in trees[k]]) for k in langs}
    above = levels([below[k][-1][0] for k in langs])
    out = []
    for j, k in enumerate(langs):
        for i, x in enumerate(trees[k]):
            out.append((x[3][0], x[2], below[k][-1][0], above[-1][0], path(below[k], i) + path(above, j)))
    return out


def shown(rows):
    return sorted(str((r[0], r[1], r[2], r[3], [tuple(s) for s in r[4]])) for r in rows)


def made(n, seed=1):
    rng = random.Random(seed)
    langs = rng.choices(["en", "de", None, "", "é", "-", ":"], [60, 10, 5, 3, 2, 1, 1], k=n)
    return [
        (
            i if rng.random() < 0.95 else None, rng.choice(["a", None, "é"]), langs[i], rng.choice([None, 5, 77]),
            rng.choice(["x", None, "", "long" * 50]),
        )
        for i in range(n)
    ]


@pytest.mark.parametrize("block", [1, 2, 10])
def test_trees_and_proofs(spark, staging, monkeypatch, block):
    # A language with most rows, one with a single row, equal rows.
    monkeypatch.setattr(manifest, "BLOCK", block)
    rows = [*made(1200 if block > 1 else 150), (3, "a", "zz", 1, "t"), *[(9, "a", "en", 1, "same")] * 20]
    out = manifest.manifest(spark.createDataFrame(rows, SCHEMA).repartition(3), staging)
    out = out.withColumn("folded", manifest.folded(F.col("leaf"), F.col("proof")))
    out = out.withColumn("digest", manifest.proof_digest(F.col("proof")))
    got = out.collect()
    assert shown(got) == shown(plain(rows))
    assert all(r["folded"] == r["root"] for r in got)
    assert all(r["digest"] == digest(*[s["digest"] for s in r["proof"] if s["digest"]]) for r in got)
    wrong = out.select(manifest.folded(F.sha2("leaf", 256), F.col("proof")).alias("f"), "root").where("f = root")
    assert wrong.isEmpty()


@pytest.mark.parametrize("n", [0, 1, 2, 3, 5, 8, 9])
def test_small_tables(spark, staging, n):
    rows = [(i, None, "en", i, "t") for i in range(n)]
    got = manifest.manifest(spark.createDataFrame(rows, SCHEMA), staging).collect()
    assert shown(got) == shown(plain(rows) if rows else [])


def test_columns_of_any_name(spark, staging):
    rows = [(1, "a", "en", 1, "t", "l", 3, 4), (2, None, None, None, None, None, None, None)]
    docs = spark.createDataFrame(rows, SCHEMA + ", leaf string, tree int, `a b` int")
    out = manifest.manifest(docs, staging, kept=["doc_id", "leaf", "tree", "a b"])
    assert out.columns == ["doc_id", "tree", "a b", "leaf", "subroot", "root", "proof"]
    assert {(r["doc_id"], r["leaf"], r["a b"]) for r in out.collect()} == {(r[0], leaf(r[:5]), r[7]) for r in rows}


def test_fields_do_not_run_together(spark):
    rows = [(1, "a", "b", None, "c"), (1, "a", "b", None, "-"), (1, "a", "b", None, None), (1, "ab", "", None, "c")]
    leaves = spark.createDataFrame(rows, SCHEMA).select(manifest.leaf_digest().alias("x")).collect()
    assert [r["x"] for r in leaves] == [leaf(r) for r in rows] and len({r["x"] for r in leaves}) == 4


def test_no_python_and_no_broadcast_of_ancestors(spark, staging):
    docs = spark.createDataFrame(made(300), SCHEMA)
    plan = manifest.manifest(docs, staging)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "CartesianProduct" not in plan


def test_query_against_plain_lists(spark, folder):
    docs = [tuple(r) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "source", "lang", "n_chars", "text").collect()]
    got = QUERIES["op12_merkle_manifest"].run(spark, folder).collect()
    want = {r[0]: r for r in plain(docs)}
    changed = {r[0] for r in docs if zlib.crc32(str(r[0]).encode()) % 7 == 0 and r[3] is not None}
    assert len(got) == len(docs) and changed
    for r in got:
        _, own, subroot, root, steps = want[r["doc_id"]]
        assert (r["leaf"], r["subroot"], r["root"]) == (own, subroot, root)
        assert r["proof_sha256"] == digest(*[s for _, s in steps if s])
        assert r["verified"] == (r["doc_id"] not in changed) == (r["folded_root"] == root)


def test_query_against_sql(spark, folder):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{folder}/documents.parquet'")
    assert compare(QUERIES["op12_merkle_manifest"].run(spark, folder), con, QUERIES["op12_merkle_manifest"].sql)
