"""Licence notices: families, near misses, held-out variants, and odd inputs."""

from __future__ import annotations

import pytest

from dispensa.llm import licences


@pytest.fixture(scope="module")
def model(spark, folder):
    from dispensa.sources.staging import Staging

    return licences.fit(spark.read.parquet(f"{folder}/documents.parquet"), Staging(spark))


def best(spark, model, texts):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = licences.scan(table, model).collect()
    assert len(rows) == len(texts)
    return {r["doc_id"]: r for r in rows}


def test_templates_and_lines_of_documents(spark, model):
    lines = {
        "Released under the MIT License.": "mit",
        "Licensed under the Apache License, Version 2.0.": "apache-2.0",
        "This work is licensed under the GNU General Public License, version 3.": "gpl",
        "Licensed under CC BY-NC 4.0.": "cc-by-nc",
        "All rights reserved.": "proprietary",
    }
    texts = [f"Some words of the text come first.\n{line}\nAnd others after it." for line in lines]
    got = best(spark, model, texts)
    for i, family in enumerate(lines.values()):
        assert [(n["paragraph"], n["family"], n["confirmed"]) for n in got[i]["notices"]] == [(1, family, True)]
        assert (got[i]["licence"], got[i]["confirmed"], got[i]["n_paragraphs"]) == (family, True, 3)


def test_unseen_wordings(spark, model):
    texts = [
        "This software is released under the terms of the MIT license",
        "the files are LICENSED UNDER THE APACHE LICENSE, version 2.0",
        "This document is licensed under the GNU General Public License version 2 or later",
        "Copyright 2020 by the company. All rights reserved.",
    ]
    got = best(spark, model, texts)
    assert [got[i]["licence"] for i in range(4)] == ["mit", "apache-2.0", "gpl", "proprietary"]


def test_near_misses_and_plain_text_are_unknown(spark, model, folder):
    texts = [
        "He lost his driving licence under the bridge", "The public is free to use the general entrance of the work",
        "Released in May, the film has all it needs", "The rights of all people are equal", "version 2.0 of the report",
    ]
    got = best(spark, model, texts)
    assert [r["licence"] for r in got.values() if r["confirmed"]] == []
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    plain = docs.where("not text rlike '(?i)licen|rights reserved'")
    rows = licences.scan(plain, model).where("size(notices) > 0").count()
    assert rows <= 0.01 * plain.count()
    marked = docs.where("text rlike 'Licensed under|Released under|licensed under|All rights reserved'")
    assert licences.scan(marked, model).where("confirmed").count() == marked.count() > 0


def test_the_gate_loses_nothing(spark, model):
    """Without the gate all paragraphs would be scored; the winners are the same."""
    texts = [t for ts in licences.TEMPLATES.values() for t in ts] + licences.NEAR_MISSES
    got = best(spark, model, texts)
    open_gate = licences.Model(model.families, model.weights, model.bias, model.temperature, model.threshold)
    table = open_gate.table

    def opened(like):
        from pyspark.sql import functions as F

        return table(like).withColumn("gate", F.lit(1e9))

    open_gate.table = opened
    assert {i: r["notices"] for i, r in best(spark, open_gate, texts).items()} == {i: r["notices"] for i, r in got.items()}


def test_weights_are_sparse_and_the_plan_native(spark, model):
    zero = sum(w == 0 for ws in model.weights for w in ws)
    assert zero > 0.5 * len(model.weights) * licences.BUCKETS
    assert 0.5 <= model.threshold <= 0.95
    table = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    plan = licences.scan(table, model)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "CartesianProduct" not in plan


def test_odd_inputs(spark, model):
    schema = "doc_id long, text string, licence int, weights string, families string, `a b` int"
    line = "Licensed under CC BY-NC 4.0."
    rows = [(1, None, 1, "w", "f", 2), (2, "", 1, "w", "f", 2), (3, " \n\t\n", 1, "w", "f", 2), (4, line, 1, "w", "f", 2), (4, line, 1, "w", "f", 2),
            (None, "é漢 \n" + "word " * 20000 + "\n" + line, 1, None, None, None)]
    table = spark.createDataFrame(rows, schema)
    out = licences.scan(table, model)
    assert out.columns == ["doc_id", "weights", "families", "a b", "n_paragraphs", "notices", "licence", "probability", "confirmed"]
    got = sorted((r["doc_id"] or 0, r["n_paragraphs"], r["licence"] or "") for r in out.collect())
    assert got == [(0, 3, "cc-by-nc"), (1, 0, ""), (2, 0, ""), (3, 0, ""), (4, 1, "cc-by-nc"), (4, 1, "cc-by-nc")]
    assert licences.scan(table.limit(0), model).collect() == []


WRAPPED = {
    "mit": """/*
 * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal
 * in the Software without restriction, including without limitation the rights
 * to use, copy, modify, merge, publish, distribute, sublicense, and/or sell
 * copies of the Software
 */""",
    "bsd": """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions
# are met:""",
    "gpl": """    This program is free software: you can redistribute it and/or modify
    it under the terms of the GNU General Public License as published by
    the Free Software Foundation, either version 3 of the License, or
    (at your option) any later version.""",
    "lgpl": """// This library is free software; you can redistribute it and/or
// modify it under the terms of the GNU Lesser General Public
// License as published by the Free Software Foundation; either
// version 2.1 of the License, or (at your option) any later version.""",
    "apache-2.0": """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0""",
}


def test_notices_wrapped_over_lines(spark, model):
    texts = [f"A first line.\n\n{notice}\n\nAnd the text goes on here.\nFor some lines." for notice in WRAPPED.values()]
    got = best(spark, model, texts)
    assert {i: (got[i]["licence"], got[i]["confirmed"]) for i in range(len(texts))} == {
        i: (family, True) for i, family in enumerate(WRAPPED)
    }


def test_lines_far_from_a_notice_do_not_confirm_it(spark, model):
    parts = WRAPPED["mit"].split("\n")[1:-1]
    far = "\n".join(["\n".join(["Plain words of a story stand between."] * 20).join(["", p]) for p in parts])
    row = best(spark, model, [far])[0]
    assert not row["confirmed"]
