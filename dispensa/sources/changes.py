"""Updates of a large table without rewriting it: a change table by key, merged on read.

An update writes one small folder: the keys it concerns and the columns it sets, with as many rows as it has keys. A
reader joins the base with the latest change of each key and column; changes are few beside the base, and the planner
broadcasts them where they are small. ``compact`` writes the merged table as a new base, once changes have grown. What
belongs to the table is a numbered list of folders, switched by one rename, so updates and compaction are seen whole.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.sources.snapshots import Versions


class ChangeTable(Versions):
    """A table of which rows are updated by key; a key can have any number of rows, all of which are updated."""

    def __init__(self, spark: SparkSession, root: str, schema: str, keys: Sequence[str]):
        super().__init__(spark, root)
        self.schema, self.keys = schema, list(keys)
        self._columns = spark.createDataFrame([], schema).schema

    def create(self, rows: DataFrame) -> int:
        """The base of the table; replaces what was there."""
        name = f"base-{uuid.uuid4().hex}"
        rows.select(*self._columns.names).write.parquet(f"{self.root}/{name}")
        return self._advance(lambda _: {"base": name, "changes": []})

    def update(self, changes: DataFrame) -> int:
        """Set the columns that ``changes`` has beside the keys, also to null, in all rows of its keys.

        A key must not be null, and not be there twice, as it would not be told which one counts. Keys that the table
        doesn't have change nothing.
        """
        sets = [c for c in changes.columns if c not in self.keys]
        unknown = [c for c in (*self.keys, *sets) if c not in self._columns.names or c not in changes.columns]
        if unknown or not sets:
            raise ValueError(f"a change needs the keys and columns of the table: {unknown or 'nothing is set'}")
        typed = changes.select(*[F.col(c).cast(self._columns[c].dataType).alias(c) for c in (*self.keys, *sets)])
        values = F.struct(*[F.struct(F.col(c).alias("value")).alias(c) for c in sets])
        one = typed.groupBy(*self.keys).agg(F.count("*").alias("_n"), F.any_value(values).alias("_set"))
        sound = (F.col("_n") == 1) & F.array_position(F.array(*[F.col(k).isNull() for k in self.keys]), True).eqNullSafe(0)
        checked = F.when(sound, F.col("_set")).otherwise(F.raise_error(F.lit("a changed key is null or there twice")))
        name = f"change-{uuid.uuid4().hex}"
        one.select(*self.keys, checked.alias("_set")).select(*self.keys, "_set.*").write.parquet(f"{self.root}/{name}")
        return self._advance(lambda state: state | {"changes": [*state["changes"], [name, sets]]})

    def _latest(self, state: dict) -> DataFrame | None:
        """Per key, for each column the value that was set last, in a struct; null if none ever was."""
        parts = []
        for order, (name, sets) in enumerate(state["changes"]):
            kinds = [f"{k} {self._columns[k].dataType.simpleString()}" for k in self.keys]
            kinds += [f"{c} struct<value: {self._columns[c].dataType.simpleString()}>" for c in sets]
            rows = self.spark.read.schema(", ".join(kinds)).parquet(f"{self.root}/{name}")
            parts.append(rows.withColumn("_order", F.lit(order)))
        if not parts:
            return None
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part, allowMissingColumns=True)
        changed = [c for c in union.columns if c not in (*self.keys, "_order")]
        # A null order takes no part, so a column counts only where it was set.
        when = lambda c: F.when(F.col(c).isNotNull(), F.col("_order"))
        return union.groupBy(*self.keys).agg(*[F.max_by(c, when(c)).alias(f"_{c}") for c in changed])

    def read(self, version: int | None = None) -> DataFrame:
        """The table with its changes merged; as of an older version with its number."""
        state = self.state(version)
        base = self.spark.read.schema(self.schema).parquet(f"{self.root}/{state['base']}")
        latest = self._latest(state)
        if latest is None:
            return base
        changed = {c.removeprefix("_"): c for c in latest.columns if c not in self.keys}
        mine = latest.withColumnsRenamed({k: f"_key_{k}" for k in self.keys})
        joined = base.join(mine, [base[k] == mine[f"_key_{k}"] for k in self.keys], "left")
        new = lambda c: F.when(F.col(changed[c]).isNotNull(), F.col(changed[c])["value"]).otherwise(F.col(c)).alias(c)
        return joined.select(*[new(c) if c in changed else F.col(c) for c in self._columns.names])

    def compact(self) -> int:
        """Make the merged table the base. Changes that come meanwhile stay changes on top of it."""
        start = self.current()
        seen = self.state(start)["changes"]
        name = f"base-{uuid.uuid4().hex}"
        self.read(start).write.parquet(f"{self.root}/{name}")
        return self._advance(lambda state: {"base": name, "changes": state["changes"][len(seen) :]})

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forget all versions but the last ``keep`` and delete what none of them names; not for the time of an update."""
        versions = self.versions()
        for version in versions[: max(0, len(versions) - keep)]:
            self._drop("versions", f"{version:010d}")
        states = [self.state(v) for v in self.versions()]
        used = {s["base"] for s in states} | {name for s in states for name, _ in s["changes"]}
        stale = [n for n in self._names() if n.startswith(("base-", "change-")) and n not in used]
        for n in stale:
            self._drop(n)
        return stale
