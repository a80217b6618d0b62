"""Intermediate tables, written to the cluster's shared folder.

A stage that several later steps read is written once as Parquet and read back. That cuts the
lineage, survives the loss of executors, and gives the optimizer true sizes, so that it
broadcasts a side only when the side is known to be small.
"""

from __future__ import annotations

import atexit
import contextlib
import functools
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local session without it."""
    folder = spark.conf.get(CHECKPOINT_DIR, None)
    if folder:
        return folder
    if not spark.conf.get("spark.master", "local").startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    return _local_folder()


@functools.cache
def _local_folder() -> str:
    folder = tempfile.mkdtemp(prefix="dispensa-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


class Staging:
    """Writes named stages of one run below ``<shared folder>/<run id>/``.

    As a context manager it deletes them at the end of the block; write the result inside of it.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_folder(spark).rstrip('/')}/{uuid.uuid4().hex}"
        self._tables: list[str] = []

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return the written table."""
        path = f"{self.root}/{name}-{uuid.uuid4().hex[:8]}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep_bucketed(self, df: DataFrame, name: str, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
        """Write ``df`` once dealt and sorted by the keys, and return the written table.

        Joins and groupings on these keys, also of several such tables, then need no exchange; ``subset_keys`` does the
        same for joins on more keys. Each bucket is one file; there are as many as shuffle partitions, or two for each
        core where these are fewer, as buckets are not joined to larger ones at run time.
        """
        cores = self.spark.sparkContext.defaultParallelism
        n = buckets or min(int(self.spark.conf.get("spark.sql.shuffle.partitions")), 2 * cores)
        mark = uuid.uuid4().hex
        table, path = f"stage_{name}_{mark}", f"{self.root}/{name}-{mark[:8]}"
        dealt = df.repartition(n, *keys)
        dealt.write.bucketBy(n, *keys).sortBy(*keys).option("path", path).saveAsTable(table)
        self._tables.append(table)
        return self.spark.table(table)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *failure: object) -> None:
        self.drop()

    def drop(self) -> None:
        """Delete the stages of this run, once its results are written elsewhere."""
        for table in self._tables:
            self.spark.sql(f"drop table if exists {table}")
        self._tables.clear()
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextlib.contextmanager
def subset_keys(spark: SparkSession) -> Iterator[None]:
    """Inside, a join runs where its sides lie if they are dealt by some of its keys.

    Only for steps that run inside the block, and for keys whose groups are bounded, as all rows of a group of these keys
    then stay in one task.
    """
    name = "spark.sql.requireAllClusterKeysForCoPartition"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)
