"""Period tables whose columns grow: one declared schema over monthly folders written with earlier ones.

The family of period-suffixed tables is one folder ``<column>=<period>`` each. What a folder holds is read from the
footer of one of its files, as each is written in one go. Against the declared schema a column can be the same, missing
(null for those months), widened (stored in a narrower type that the declared one holds without loss), narrowed (the
declared type could lose values) or undeclared. The last two are refused, before any row is read. Folders with equal
schemas are read together, so the plan has as many scans as there were schemas, and filters on the period prune folders.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dispensa.sources.snapshots import Versions

SAME, MISSING, WIDENED, NARROWED, UNDECLARED = "same", "missing", "widened", "narrowed", "undeclared"

_WHOLE = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 20}


def holds(declared: T.DataType, stored: T.DataType) -> bool:
    """Whether every value of the stored type has the same value in the declared one."""
    if declared == stored:
        return True
    digits = _WHOLE.get(type(stored))
    if type(declared) in _WHOLE:
        return digits is not None and digits <= _WHOLE[type(declared)]
    if isinstance(declared, T.DoubleType):
        return isinstance(stored, T.FloatType) or (digits is not None and digits <= 10)
    if isinstance(declared, T.DecimalType):
        if isinstance(stored, T.DecimalType):
            return stored.scale <= declared.scale and stored.precision - stored.scale <= declared.precision - declared.scale
        return digits is not None and digits <= declared.precision - declared.scale
    return isinstance(declared, T.TimestampNTZType) and isinstance(stored, T.DateType)


def compared(declared: T.StructType, stored: T.StructType) -> dict[str, tuple[str | None, str | None, str]]:
    """For each column of either schema its stored type, its declared type and how they compare."""
    theirs = {f.name: f.dataType for f in stored.fields}
    out = {}
    for f in declared.fields:
        kind = theirs.pop(f.name, None)
        if kind is None:
            state = MISSING
        elif kind == f.dataType:
            state = SAME
        else:
            state = WIDENED if holds(f.dataType, kind) else NARROWED
        out[f.name] = (kind and kind.simpleString(), f.dataType.simpleString(), state)
    return out | {name: (kind.simpleString(), None, UNDECLARED) for name, kind in theirs.items()}


class SchemaRefused(ValueError):
    """A period's columns don't fit the declared ones."""


class PeriodTable(Versions):
    """Monthly folders below ``root`` under one declared schema, which does not name the period column."""

    def __init__(self, spark: SparkSession, root: str, schema: str, by: str = "period"):
        super().__init__(spark, root)
        self.by, self.declared = by, spark.createDataFrame([], schema).schema

    def _refuse(self, period: str, stored: T.StructType) -> None:
        bad = {c: t for c, t in compared(self.declared, stored).items() if t[2] in (NARROWED, UNDECLARED)}
        if bad:
            told = ", ".join(f"{c} is {state} (stored {s}, declared {d})" for c, (s, d, state) in bad.items())
            raise SchemaRefused(f"period {period}: {told}")

    def widen(self, schema: str) -> None:
        """Declare more columns, or wider types; a column that is left out or narrowed is refused."""
        wider = self.spark.createDataFrame([], schema).schema
        bad = {c: t for c, t in compared(wider, self.declared).items() if t[2] in (NARROWED, UNDECLARED)}
        if bad:
            raise SchemaRefused(f"not wider than before: {', '.join(bad)}")
        self.declared = wider

    def write(self, rows: DataFrame, period: str) -> None:
        """Replace a period. The rows may lack declared columns; others, or wider types, are refused."""
        rows = rows.drop(self.by)
        self._refuse(period, rows.schema)
        rows.write.mode("overwrite").parquet(f"{self.root}/{self.by}={period}")

    def periods(self) -> list[str]:
        return sorted(n.removeprefix(f"{self.by}=") for n in self._names() if n.startswith(f"{self.by}="))

    def stored(self) -> dict[str, T.StructType]:
        """The schema of each period, by the footer of one file."""
        return {p: self.spark.read.parquet(f"{self.root}/{self.by}={p}").schema for p in self.periods()}

    def report(self) -> DataFrame:
        """(period, column, stored, declared, state) of all periods and columns."""
        rows = [(p, c, *told) for p, schema in self.stored().items() for c, told in compared(self.declared, schema).items()]
        return self.spark.createDataFrame(rows, "period string, column string, stored string, declared string, state string")

    def read(self, periods: Sequence[str] | None = None) -> DataFrame:
        """All periods, or the given ones, in the declared columns and types, with the period first."""
        groups: dict[str, tuple[T.StructType, list[str]]] = {}
        for period, schema in self.stored().items():
            if periods is None or period in periods:
                self._refuse(period, schema)
                groups.setdefault(schema.json(), (schema, []))[1].append(period)
        parts = []
        for schema, members in groups.values():
            known = T.StructType([*schema.fields, T.StructField(self.by, T.StringType())])  # the period stays text
            reader = self.spark.read.schema(known).option("basePath", self.root)
            rows = reader.parquet(*[f"{self.root}/{self.by}={p}" for p in members])
            names = set(schema.names)
            columns = [
                (F.col(f"`{f.name}`") if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in self.declared.fields
            ]
            parts.append(rows.select(self.by, *columns))
        if not parts:
            return self.spark.createDataFrame([], T.StructType([T.StructField(self.by, T.StringType()), *self.declared.fields]))
        union = parts[0]
        for part in parts[1:]:
            union = union.unionByName(part)
        return union
