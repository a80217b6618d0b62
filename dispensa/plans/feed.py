"""Shredding of a JSON feed of visits into a fact table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Name in the feed, column of the fact table, type; in the table's order.
VISIT_FIELDS = (
    ("EventKod", "EventKod", "string"),
    ("P_Z", "PlanliZiyaret", "string"),
    ("Line", "Line", "string"),
    ("Bolge", "Bolge", "string"),
    ("SNo", "SNo", "string"),
    ("UyeAd", "UyeAd", "string"),
    ("UniteAd", "UniteAd", "string"),
    ("Semt", "Semt", "string"),
    ("Brick", "Brick", "string"),
    ("Iht", "iht", "string"),
    ("Unvan", "Unvan", "string"),
    ("DrSabit", "DrSabit", "int"),
    ("DrAdSoyad", "DrAdSoyad", "string"),
    ("Tarih", "Tarih", "string"),
    ("Ilac", "Ilac", "string"),
    ("IlacCalismaSirasi", "Sira", "int"),
    ("Ikili", "ikiliZiyaret", "string"),
)

# Why a payload gives no rows.
MISSING, EMPTY, MALFORMED, SCALAR = "missing", "empty", "malformed", "scalar"

# Numbers of the kinds of a JSON value, by the first word of its type.
KINDS = {
    "VOID": 0, "STRING": 1, "BIGINT": 2, "DECIMAL": 2, "DOUBLE": 2, "FLOAT": 2, "BOOLEAN": 3, "ARRAY": 4, "OBJECT": 5,
}

_MARK = "end of payload"
_VISIT = "struct<" + ", ".join(f"{source}: string" for source, _, _ in VISIT_FIELDS) + ">"


def strip_envelope(body: Column) -> Column:
    """The text without the tags that open and close around it."""
    opened = F.regexp_replace(body, r"^(?:\s*+<[^>]*+>)+\s*+", "")
    return F.regexp_replace(opened, r"(?:</[^>]*+>\s*+)+$", "")


def _once(rows: DataFrame, into: str, value: Column) -> DataFrame:
    """Add a costly column that later steps use several times.

    As the output of a generator it is computed once a row; the optimizer would repeat a plain expression in every
    filter and column that uses it.
    """
    return rows.select("*", F.explode(F.array(value)).alias(into))


def _one(kind: str) -> Column:
    """The value of a boxed text as that type; null where it is another."""
    return F.try_variant_get("_value", "$[0]", kind)


def _elements(payloads: DataFrame, body: str, kind: str) -> DataFrame:
    """The payloads with ``_elements``, an array of that type, and ``_reason``. An object alone is one element.

    Each text is parsed once. The parser stops after a value, so the text is put in an array, before a mark: only behind
    one well-formed value does the mark come second.
    """
    text = strip_envelope(F.col(body))
    found = payloads.withColumn("_text", text)
    found = _once(found, "_value", F.try_parse_json(F.concat(F.lit("["), "_text", F.lit(f',"{_MARK}"]'))))
    alone = F.when(_one("map<string, variant>").isNotNull(), _one(kind))
    found = _once(found, "_elements", F.coalesce(_one(f"array<{kind}>"), F.when(alone.isNotNull(), F.array(alone))))
    whole = F.coalesce(F.try_variant_get("_value", "$[1]", "string") == _MARK, F.lit(False))
    reason = (
        F.when(F.col("_text").isNull(), MISSING)
        .when(F.trim("_text") == "", EMPTY)
        .when(~whole, MALFORMED)
        .when(F.col("_elements").isNull(), SCALAR)
    )
    return found.withColumn("_reason", reason).drop("_text", "_value")


def _checked(parsed: DataFrame, skip_rejects: bool) -> DataFrame:
    """Without rejects; they fail the job unless they are skipped. A payload that is missing has no rows either way."""
    if skip_rejects:
        return parsed.where(F.col("_reason").isNull())
    good = F.coalesce(F.col("_reason") == MISSING, F.lit(True))
    message = F.concat(F.lit("payload is not well-formed JSON: "), "_reason")
    return parsed.withColumn("_elements", F.when(good, F.col("_elements")).otherwise(F.raise_error(message)))


def shred_json(payloads: DataFrame, body: str = "body", strict: bool = False, skip_rejects: bool = False) -> DataFrame:
    """One row per array element, with the 17 declared columns.

    A missing field is null. A value that is not of its declared type is null too, or fails the
    job when ``strict``. A text that is empty or not well-formed fails the job; with ``skip_rejects`` it is
    left out here and ``json_rejects`` returns it. A payload that is null has no rows. Each text is parsed once.
    """
    rows = _checked(_elements(payloads, body, _VISIT), skip_rejects).select(F.inline("_elements"))

    def typed(source: str, kind: str) -> Column:
        value = F.col(source)
        if kind == "string":
            return value
        return value.cast(kind) if strict else value.try_cast(kind)

    return rows.select(*[typed(source, kind).alias(column) for source, column, kind in VISIT_FIELDS])


def json_rejects(payloads: DataFrame, body: str = "body") -> DataFrame:
    """The payloads that have no value to shred, with all their columns and the reason.

    Missing (null), empty (nothing inside the envelope), malformed, or scalar (neither an array nor an object).
    """
    found = _elements(payloads, body, _VISIT).where(F.col("_reason").isNotNull())
    return found.select(*[F.col(f"`{c}`") for c in payloads.columns if c != "reason"], F.col("_reason").alias("reason"))


def json_typed(payloads: DataFrame, body: str = "body", skip_rejects: bool = False) -> DataFrame:
    """One row per field of each array element, whatever its name: element, key, value, kind.

    For feeds whose fields are not declared. ``element`` counts from 0; the value is text (of arrays and objects their
    JSON), null for a JSON null; the kind is 0 null, 1 text, 2 number, 3 boolean, 4 array or 5 object. Elements that are
    not objects have no fields. Rejects are treated as by ``shred_json``.
    """
    spark = payloads.sparkSession
    elements = _checked(_elements(payloads, body, "variant"), skip_rejects)
    elements = elements.select(*payloads.columns, F.posexplode("_elements").alias("element", "_object")).drop(body)
    objects = elements.withColumn("_object", F.when(F.try_variant_get("_object", "$", "map<string, variant>").isNotNull(), F.col("_object")))
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("_object").outer()))
    word = F.regexp_extract(F.schema_of_variant("value"), "^[A-Z]+", 0)
    kinds = F.create_map(*[F.lit(x) for pair in KINDS.items() for x in pair])
    return fields.select(
        *[c for c in payloads.columns if c != body],
        "element",
        "key",
        F.try_variant_get("value", "$", "string").alias("value"),
        F.element_at(kinds, word).alias("kind"),
    )


def append_by_position(target: DataFrame, rows: DataFrame) -> DataFrame:
    """``target`` and ``rows`` together; columns are matched by position and cast to the target's."""
    if len(target.columns) != len(rows.columns):
        raise ValueError(f"{len(rows.columns)} columns given, {len(target.columns)} expected")
    typed = [F.col(c).cast(f.dataType).alias(f.name) for c, f in zip(rows.columns, target.schema, strict=True)]
    return target.unionAll(rows.select(*typed))
