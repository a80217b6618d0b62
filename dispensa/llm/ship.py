"""Sends this package to the Python workers of a session."""

from __future__ import annotations

import atexit
import functools
import shutil
import tempfile
from pathlib import Path

from pyspark import SparkContext
from pyspark.sql import SparkSession


@functools.cache
def _archive() -> str:
    """An archive of the package; the driver serves it to executors as long as it lives."""
    folder = tempfile.mkdtemp(prefix="dispensa-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    package = Path(__file__).resolve().parent.parent
    tree = Path(folder, "tree")
    shutil.copytree(package, tree / package.name, ignore=shutil.ignore_patterns("__pycache__"))
    return shutil.make_archive(f"{folder}/{package.name}", "zip", tree, package.name)


@functools.cache
def _send(context: SparkContext) -> None:
    context.addPyFile(_archive())


def shipped(spark: SparkSession) -> None:
    """Make the package importable in the session's Python workers, wherever they run; once for each context."""
    _send(spark.sparkContext)
