"""Sums kept across runs: what is read again, and that the results are those of a whole run."""

from __future__ import annotations

import re

import pytest

from dispensa.catalog import projection as catalog
from dispensa.plans import projection as pj
from dispensa.sources.partials import SourceChanged
from dispensa.sources.standins import standin

FACT = "customer_code string, pfc string, total_unit int, period string"


@pytest.fixture()
def fact(spark, tmp_path):
    path = str(tmp_path / "fact")

    def add(*rows):
        table = spark.createDataFrame([(f"{c:07d}", "0000002", u, p) for p, c, u in rows], FACT)
        table.write.mode("append").partitionBy("period").parquet(path)

    add(("201701", 1, 5), ("201701", 1, 6), ("201702", 1, 7), ("201703", 2, 8))
    return path, add


def held(sums):
    return sorted((r["period"], int(r["customer_code"]), r["total_unit"]) for r in sums.store.read().collect())


def noted(sums, monkeypatch):
    """The partitions that the scans of a refresh are left with, by their plans."""
    seen, source = [], sums.source

    def watched(values):
        rows = source(values)
        seen.append({re.search("period=([^/]+)", f).group(1) for f in rows.inputFiles()})
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"PartitionFilters: \[period#\d+ (IN|=)|PartitionFilters: \[isnotnull", plan)
        seen[-1] = {r[0] for r in rows.select("period").distinct().collect()}
        return rows

    monkeypatch.setattr(sums, "source", watched)
    return seen


def test_only_changed_partitions_are_read(spark, fact, tmp_path, monkeypatch):
    path, add = fact
    sums = pj.monthly_sums(spark, path, FACT, str(tmp_path / "sums"))
    seen = noted(sums, monkeypatch)
    assert sums.refresh().read == ("201701", "201702", "201703")
    assert held(sums) == [("201701", 1, 11), ("201702", 1, 7), ("201703", 2, 8)]
    assert sums.refresh().read == () and len(seen) == 1  # nothing changed, nothing read
    add(("201702", 1, 1), ("201704", 3, 9))  # a late correction, and a new month
    again = pj.monthly_sums(spark, path, FACT, str(tmp_path / "sums"))  # another run
    seen = noted(again, monkeypatch)
    done = again.refresh()
    assert done.read == ("201702", "201704") and seen == [{"201702", "201704"}] and done.version == 2
    assert held(again) == [("201701", 1, 11), ("201702", 1, 8), ("201703", 2, 8), ("201704", 3, 9)]
    assert sorted((r["period"], r["total_unit"]) for r in again.store.read(1).collect())[1] == ("201702", 7)


def test_a_month_that_is_gone_loses_its_sums(spark, fact, tmp_path):
    path, add = fact
    sums = pj.monthly_sums(spark, path, FACT, str(tmp_path / "sums"))
    sums.refresh()
    sums._fact._drop("period=201702")
    done = sums.refresh()
    assert (done.read, done.dropped) == ((), ("201702",))
    assert held(sums) == [("201701", 1, 11), ("201703", 2, 8)]
    assert sums.refresh().dropped == ()


def test_a_fact_that_changes_meanwhile_is_not_taken(spark, fact, tmp_path, monkeypatch):
    path, add = fact
    sums = pj.monthly_sums(spark, path, FACT, str(tmp_path / "sums"))
    write = sums.store.write

    def slow(rows):
        load = write(rows)
        add(("201702", 1, 1))
        return load

    monkeypatch.setattr(sums.store, "write", slow)
    with pytest.raises(SourceChanged, match="201702"):
        sums.refresh()
    assert sums.store.versions() == [] and sums.store._names("data") == []
    monkeypatch.setattr(sums.store, "write", write)
    sums.refresh()
    assert ("201702", 1, 8) in held(sums)


def test_a_projection_on_kept_sums_equals_a_whole_run(spark, folder, staging):
    whole = catalog.run(spark, folder)
    sellin = standin(spark, folder, "sellin")
    sellin.write.partitionBy("period").parquet(f"{staging.root}/sellin")
    sums = pj.monthly_sums(spark, f"{staging.root}/sellin", FACT, f"{staging.root}/sums")
    sums.refresh()
    inputs = catalog.inputs(spark, folder, staging)
    inputs.kept = sums.store.read()
    inputs.sellin = None  # the fact itself is not touched
    kept = pj.Projection(inputs, staging)
    assert sorted(map(str, kept.factors().collect())) == sorted(map(str, whole.factors().collect()))
    plan = kept.inputs.kept.where("period = '200001'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(period" in plan
