"""The registered queries by their names, on whole tables: against their SQL, a library, or plain counts."""

from __future__ import annotations

import base64
import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
import tiktoken

from dispensa.llm.queries import QUERIES, VOCABULARY
from tests.test_oracle import compare

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db(folder):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def docs(spark, folder):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


@pytest.mark.parametrize("key", [k for k, q in QUERIES.items() if q.sql])
def test_against_sql(key, spark, folder, db):
    assert compare(QUERIES[key].run(spark, folder), db, QUERIES[key].sql)


def test_which_have_no_sql():
    assert [k.split("_")[0] for k, q in QUERIES.items() if not q.sql] == ["op1", "op3", "op4", "op6", "op10", "op11"]


def test_op4_digests(spark, folder, docs):
    with open(public_tokenizers.path(VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = []
    for doc, text in docs:
        ids = library.encode_ordinary(text or "")
        raw = np.array(ids, dtype="<u4").tobytes()
        want.append((doc, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    got = QUERIES["op4_byte_bpe"].run(spark, folder)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert sorted(map(tuple, got.collect())) == sorted(want)


def test_op6_columns(spark, folder, docs):
    got = QUERIES["op6_quality_classifier"].run(spark, folder).collect()
    assert sorted(r["doc_id"] for r in got) == sorted(d for d, _ in docs)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_op10_counts_and_base(spark, folder, docs):
    lower = {i: i + 32 for i in range(65, 91)}
    words = {d: re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower)) for d, t in docs}
    held = {d: zlib.crc32(str(d).encode()) % 5 == 1 for d in words}
    counts = Counter(w for d, ws in words.items() if not held[d] for w in [*ws, None])
    n, v = sum(counts.values()), len(counts)
    for r in QUERIES["op10_class_language_model"].run(spark, folder).collect():
        tokens = [*words[r["doc_id"]], None]
        assert (r["held_out"], r["n_tokens"], r["train_tokens"]) == (held[r["doc_id"]], len(tokens), n)
        assert r["n_known"] == sum(counts[t] > 0 for t in tokens)
        base = math.fsum(math.log10((counts[t] + 0.5) / (n + 0.5 * (v + 1))) for t in tokens)
        assert math.isclose(r["base_score"], base, rel_tol=1e-9) and r["score"] < 0
