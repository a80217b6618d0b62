"""From raw documents to token ids: each stage calls one operator of ``dispensa.llm`` and reads what the one before wrote.

All stages but the last return the columns of ``documents``; a stage that shortens texts sets n_chars anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.llm import decontaminate, jaccard, quality, substrings
from dispensa.llm.bpe import Codec
from dispensa.sources.staging import Staging

VOCABULARY = "byte_bpe_50k.tiktoken"


def _measured(docs: DataFrame, changed: str, like: DataFrame) -> DataFrame:
    """The columns of ``like``, with the length of the texts that changed."""
    length = F.when(F.expr(changed), F.length("text").cast("long")).otherwise(F.col("n_chars"))
    return docs.withColumn("n_chars", length).select(*like.columns)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, learnt from these documents' labels, accepts."""
    machine = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score(docs, machine).where("predicted = 1").select(*docs.columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: of the smallest identifier, a row without one only if all are.

    Rows are compared each by its own text, so repeated rows of a document are near copies too, and another
    text of the same identifier stays. Rows without words have no group and stay.
    """
    staging = Staging(spark)
    rows = staging.keep(docs.withColumn("row", F.monotonically_increasing_id()), "rows")
    groups = jaccard.similarity_components(rows, staging, key="row").selectExpr("doc_id as row", "component_id as component")
    order = F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), "row")
    members = rows.select("row", order.alias("order")).join(groups, "row")
    members = staging.keep(members, "members")
    first = members.groupBy("component").agg(F.min("order").alias("first"), F.count("*").alias("n")).where("n > 1")
    gone = members.join(first, "component").where("order <> first").select("row")
    return rows.join(gone, "row", "left_anti").select(*docs.columns)


def substring_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without long word sequences that occur elsewhere."""
    return _measured(substrings.remove_repeats(docs), "n_removed > 0", docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without the passages they share with benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return _measured(decontaminate.remove_hits(docs, items), "n_hit > 0", docs)


def byte_level_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' token ids, and whether they decode to the text."""
    codec = Codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    out = codec.encode(docs, decoded=True)
    same = F.col("decoded") == F.coalesce("text", F.lit("")).cast("binary")
    return out.select("doc_id", "lang", "source", "n_tokens", "ids", same.alias("round_trip"))


STAGES = [
    ("quality classifier", quality_classifier),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("substring dedup", substring_dedup),
    ("benchmark decontamination", benchmark_decontamination),
    ("byte-level BPE encoding and decoding", byte_level_bpe),
]

#: SQL has neither the trained classifier nor the tokenizer; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    staging = Staging(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = staging.keep(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return docs
