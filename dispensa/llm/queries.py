"""The registered queries of this folder. Each reads whole tables and applies one operator to them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dispensa.catalog import Query
from dispensa.llm import (
    conversations,
    decontaminate,
    embeddings,
    jaccard,
    language_model,
    licences,
    manifest,
    pages,
    quality,
    substrings,
    token_counts,
    twins,
    urls,
)
from dispensa.llm.bpe import Codec
from dispensa.sources.staging import Staging

VOCABULARY = "byte_bpe_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = licences.scan(docs, licences.fit(docs, Staging(spark)))
    confirmed = F.filter("notices", lambda n: n["confirmed"])
    names = lambda notices: F.array_join(F.array_sort(F.array_distinct(F.transform(notices, lambda n: n["family"]))), ",")
    return found.select(
        "doc_id", "n_paragraphs", F.size("notices").alias("n_notices"), F.size(confirmed).alias("n_confirmed"),
        names(confirmed).alias("families"), "licence", "probability", "confirmed",
    )


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    out = substrings.remove_repeats(_table(spark, folder, "documents").select("doc_id", "text"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op3_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    out = pages.main_texts(_table(spark, folder, "pages"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op4_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    codec = Codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    out = codec.encode(_table(spark, folder, "documents").select("doc_id", "text"), decoded=True)
    return out.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op5_ngram_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.similarity_components(_table(spark, folder, "documents"), Staging(spark))


def op6_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    out = quality.score(docs, quality.fit(docs, _table(spark, folder, "labels")))
    return out.select("doc_id", "held_out", "score", "predicted")


def op7_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    rules = spark.createDataFrame(urls.RULES, urls.RULE_SCHEMA)
    out = urls.judged(_table(spark, folder, "pages"), rules, Staging(spark))
    return out.select("page_id", "host", "path", "rule", "verdict")


def op8_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.near_duplicates(_table(spark, folder, "embeddings"), Staging(spark))


def op9_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    out = decontaminate.mark(docs, _table(spark, folder, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_class_language_model(spark: SparkSession, folder: str) -> DataFrame:
    return language_model.score(_table(spark, folder, "documents"), Staging(spark))


def op11_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    proven = token_counts.prove(token_counts.read_pieces(public_tokenizers.path(PIECES)))
    return token_counts.count_tokens(_table(spark, folder, "documents").select("doc_id", "text"), proven).drop("text")


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    # What a copy of the table holds in which some lengths were changed.
    changed = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    fields = [F.col("n_chars") + 1 if c == "n_chars" else c for c in manifest.FIELDS]
    docs = docs.withColumn("seen", F.when(changed, manifest.leaf_digest(fields)))
    out = manifest.manifest(docs, Staging(spark), kept=["doc_id", "seen"])
    out = out.withColumn("folded_root", manifest.folded(F.coalesce("seen", "leaf"), F.col("proof")))
    return out.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof_digest(F.col("proof")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    turns = _table(spark, folder, "conversations")
    repair = conversations.Repair(conversations.damaged(turns), Staging(spark))
    report = repair.report().withColumnRenamed("conv_id", "_r")
    digests = repair.digests().withColumnRenamed("conv_id", "_d")
    found = turns.select("conv_id").distinct().join(report, F.expr("conv_id <=> _r"), "left")
    found = found.join(digests, F.expr("conv_id <=> _d"), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return found.select(
        "conv_id", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def _url_rules_sql() -> str:
    """The rules one by one, and aliases by a recursive walk over the links."""
    host = "translate(regexp_extract({0}, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    path = "regexp_extract({0}, '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    rule = " ".join(
        f"when (host = '{h}' or ends_with(host, '.{h}')) and starts_with(path, '{p}') then '{h}{p}'"
        for h, p, _ in sorted(urls.RULES, key=lambda r: -len(r[0] + r[1]))
    )
    verdict = " ".join(f"when '{h}{p}' then '{v}'" for h, p, v in urls.RULES)
    node = f"""case when {host} <> '' then {host} ||
        case when starts_with(regexp_extract({{0}}, '(?s)://[^/?#]*([^#]*)', 1), '/') then '' else '/' end ||
        regexp_extract({{0}}, '(?s)://[^/?#]*([^#]*)', 1) end"""
    judged = f"select *, case {rule} end as rule from {{0}}"
    scheme = "regexp_extract(url, '(?s)^(.*?)://', 1)"
    site = f"{scheme} || '://' || {host.format('url')}"
    dots = """list_reduce(list_prepend('', string_split({0}, '/')[2:]), lambda done, x: case x when '..'
        then regexp_replace(done, '/[^/]*$', '') when '.' then done else done || '/' || x end)
        || case when string_split({0}, '/')[-1] in ('.', '..') then '/' else '' end"""
    folder = f"coalesce(nullif(regexp_replace({path.format('url')}, '[^/]*$', ''), ''), '/')"
    whole = f"""case when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*://') then t
        when starts_with(t, '//') then {scheme} || ':' || t
        when regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.-]*:') then null
        when starts_with(t, '/') then {site} || {dots.format('place')} || rest
        when starts_with(t, '?') then {site} || {path.format('url')} || t
        when not starts_with(t, '#') then {site} || {dots.format(f"({folder} || place)")} || rest end"""
    quoted = r"""(?is)\bhref\s*=\s*(?:"([^"]*)"|''([^'']*)''|([^\s>"'']+))"""
    return rf"""with recursive
        tag as (select url,
            regexp_extract_all(html, '(?is)<meta\s[^>]*http-equiv\s*=\s*["'']?refresh\b[^>]*>') as metas,
            regexp_extract_all(html, '(?is)<link\s[^>]*rel\s*=\s*["'']?canonical\b[^>]*>') as links from pages),
        target as (
            select url, regexp_extract(unnest(metas), '(?is)\burl\s*=\s*[''"]?([^''">\s]+)', 1) as t from tag union all
            select url, regexp_extract(m, '{quoted}', 1) || regexp_extract(m, '{quoted}', 2) || regexp_extract(m, '{quoted}', 3)
            from (select url, unnest(links) as m from tag)),
        named as (select url, replace(trim(t), '&amp;', '&') as t from target),
        cut as (select *, regexp_extract(t, '(?s)^([^?#]*)', 1) as place, regexp_extract(t, '(?s)^[^?#]*(.*)$', 1) as rest
                from named where t <> ''),
        linked as (select url, {whole} as target from cut),
        pair as (select {node.format('url')} as a, {node.format('target')} as b from linked),
        edge as (select a, b from pair where a <> b union select b, a from pair where a <> b),
        reach as (select a as x, a as y from edge union select x, b from reach join edge on a = y),
        spot as (select x, y, {host.format("('x://' || y)")} as host, {path.format("('x://' || y)")} as path from reach),
        marked as (select x, case rule {verdict} end as verdict from ({judged.format('spot')})),
        spread as (select x, case when bool_or(verdict = 'allow') then 'allow' when bool_or(verdict = 'block') then 'block' end
                   as verdict from marked group by x),
        row as (select page_id, {node.format('url')} as node, coalesce({host.format('url')}, '') as host,
                coalesce({path.format('url')}, '') as path from pages)
        select page_id, host, path, rule, coalesce(case rule {verdict} end, s.verdict, 'allow') as verdict
        from ({judged.format('row')}) left join spread s on x = node"""


QUERIES: dict[str, Query] = {
    "op1_license_scan": Query(op1_license_scan),
    "op2_substring_dedup": Query(op2_substring_dedup, twins.SUBSTRINGS),
    "op3_html_extraction": Query(op3_html_extraction),
    "op4_byte_bpe": Query(op4_byte_bpe),
    "op5_ngram_jaccard_join": Query(op5_ngram_jaccard_join, twins.JACCARD),
    "op6_quality_classifier": Query(op6_quality_classifier),
    "op7_url_filter": Query(op7_url_filter, _url_rules_sql()),
    "op8_embedding_near_dedup": Query(op8_embedding_near_dedup, twins.VECTORS),
    "op9_decontamination": Query(op9_decontamination, twins.DECONTAMINATION),
    "op10_class_language_model": Query(op10_class_language_model),
    "op11_token_counts": Query(op11_token_counts),
    "op12_merkle_manifest": Query(op12_merkle_manifest, twins.MANIFEST),
    "op13_conversation_repair": Query(op13_conversation_repair, twins.CONVERSATIONS),
}
