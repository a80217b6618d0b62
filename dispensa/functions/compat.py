"""Column helpers for the places where the source dialect and Spark disagree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def int_div(n: Column, d: Column) -> Column:
    """Integer quotient, truncated toward zero (Spark's ``/`` is fractional)."""
    return F.call_function("div", n, d)


def zero_pad(c: Column, width: int) -> Column:
    """First ``width`` characters of the text of ``c``, zero-filled on the left."""
    return F.lpad(c.cast("string"), width, "0")


def isnull(a: Column, b: Column, dtype: str) -> Column:
    """``a`` or, where it is null, ``b`` in the type of ``a``."""
    return F.coalesce(a, b.cast(dtype))


def live(flag: str = "is_deleted") -> Column:
    """Rows that are not soft-deleted: the flag is 0 or missing."""
    return F.coalesce(F.col(flag), F.lit(0)) == 0


def same_text(a: Column, b: Column) -> Column:
    """Equality that ignores trailing blanks, as blank-padded text types do."""
    return F.rtrim(a) == F.rtrim(b)


def trimmed(df: DataFrame, *columns: str) -> DataFrame:
    """``df`` without the trailing blanks of blank-padded key columns, so that they meet in joins and groups."""
    return df.withColumns({c: F.rtrim(c) for c in columns if c in df.columns})


def text_concat(*parts: Column) -> Column:
    """Concatenation that takes null for the empty text."""
    return F.concat_ws("", *[p.cast("string") for p in parts])


def round_to_int(c: Column) -> Column:
    """Nearest integer, halves away from zero."""
    return F.round(c, 0).cast("int")


def raise_unless(ok: Column, value: Column, message: str) -> Column:
    """``value`` where ``ok`` holds; the job fails with ``message`` where it does not."""
    return F.when(ok, value).otherwise(F.raise_error(F.lit(message)))
