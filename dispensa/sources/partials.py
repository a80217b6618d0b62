"""Sums of a partitioned fact that are kept across runs, and made anew only where the fact has changed.

A fact lies in folders ``<column>=<value>``. The sums of each folder's rows are a partition of a versioned table, with a
fingerprint of the files they were made from: names, sizes and times of change, as the file system lists them. The next
run compares fingerprints, reads the folders that are new or differ, drops those that are gone, and puts the new sums in
place with one switch. A late correction of one month so costs a read of that month.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.sources.snapshots import Snapshots, Versions


class SourceChanged(RuntimeError):
    """The fact changed while it was read."""


@dataclass(frozen=True)
class Refreshed:
    """What a refresh did: the values read, those dropped, and the version that holds the sums."""

    read: tuple[str, ...]
    dropped: tuple[str, ...]
    version: int


class PartialSums:
    """Sums per partition of a fact stored below ``fact``; ``make`` makes them from rows of any of its partitions."""

    def __init__(
        self, spark: SparkSession, fact: str, schema: str, store: Snapshots, make: Callable[[DataFrame], DataFrame]
    ):
        self.store, self.make = store, make
        self._fact = Versions(spark, fact)
        self._rows = spark.read.schema(schema).parquet(fact)

    def fingerprints(self) -> dict[str, str]:
        """A fingerprint of each partition's files."""
        by = self.store.by
        out = {}
        for folder in self._fact._names():
            if folder.startswith(f"{by}="):
                files = self._fact._fs.listStatus(self._fact._path(folder))
                told = sorted(f"{f.getPath().getName()} {f.getLen()} {f.getModificationTime()}" for f in files)
                out[folder.removeprefix(f"{by}=")] = hashlib.sha256("\n".join(told).encode()).hexdigest()
        return out

    def stale(self) -> tuple[dict[str, str], list[str]]:
        """The fingerprints of the partitions to read, and the values of those that are gone."""
        now, kept = self.fingerprints(), self.store.notes()
        return {v: f for v, f in now.items() if kept.get(v) != f}, [v for v in kept if v not in now]

    def source(self, values: list[str]) -> DataFrame:
        """The fact's rows of those partitions; the others are pruned."""
        spark = self._rows.sparkSession
        spark.catalog.refreshByPath(self._fact.root)  # files may have come since it was listed
        return spark.read.schema(self._rows.schema).parquet(self._fact.root).where(F.col(self.store.by).isin(values))

    def refresh(self) -> Refreshed:
        """Bring the sums up to date with the fact."""
        changed, gone = self.stale()
        if not changed and not gone:
            return Refreshed((), (), self.store.current())
        load = self.store.write(self.store.spread(self.make(self.source(list(changed)))))
        after = self.fingerprints()
        if any(after.get(v) != f for v, f in changed.items()):
            self.store.discard(load)
            raise SourceChanged(f"{', '.join(v for v, f in changed.items() if after.get(v) != f)} changed while it was read")
        # A partition whose rows make no sums has no folder in the load, and must not keep its old one.
        return Refreshed(tuple(sorted(changed)), tuple(sorted(gone)), self.store.commit(load, [*gone, *changed], changed))
