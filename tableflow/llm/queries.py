"""The registered queries of the subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableflow.llm import (backoff_lm, decontamination, filter_audit, license_scan, line_dedup, ngram_join, packing, quality_classifier,
                           quality_rules, sharding, simhash, sql, url_filter, vector_codes)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# Fixed values.
SHARDS = 40
URL_RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"),
             ("net/es/", "block"), ("net/fr/", "block"))


def query(name: str, check: str | None = None):
    def keep(job):
        QUERIES[name] = job
        if check is not None:
            SQL[name] = check
        return job
    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


@query("op1_sharding")
def op1_sharding(spark, folder):
    shuffled = sharding.shuffle_rows(table(spark, folder, "documents"))
    digest = shuffled.select(
        "doc_id", sharding.record_bytes(F.col("text")).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"),
        sharding.BUCKET, sharding.PLACE)
    return sharding.assign_shards(digest, SHARDS).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col(sharding.SHARD).alias("shard"),
        F.col(sharding.SLOT).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
        F.col(sharding.BUCKET).alias("bucket"))


@query("op3_url_filter", f"""
WITH rest AS (
  SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages),
parts AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest),
rules AS (
  SELECT rule, verdict, split_part(rule, '/', 1) AS rule_host, substr(rule, strpos(rule, '/')) AS rule_path
  FROM (VALUES {", ".join(f"('{r}', '{v}')" for r, v in URL_RULES)}) AS v(rule, verdict)),
fits AS (
  SELECT page_id, host, path, rule, verdict,
         row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host) DESC NULLS LAST, length(rule_path) DESC) AS place
  FROM parts LEFT JOIN rules
    ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM fits WHERE place = 1
""")
def op3_url_filter(spark, folder):
    return url_filter.judge_urls(table(spark, folder, "pages"), URL_RULES, keep=("page_id",))


@query("op10_quality_rules", sql.quality_rules_sql())
def op10_quality_rules(spark, folder):
    return quality_rules.judge_quality(table(spark, folder, "documents"), ["doc_id"])


@query("op9_packing")
def op9_packing(spark, folder):
    return packing.pack_documents(table(spark, folder, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query("op8_license_scan")
def op8_license_scan(spark, folder):
    return license_scan.scan_licenses(table(spark, folder, "documents"))


@query("op5_quality_classifier")
def op5_quality_classifier(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality_classifier.fit(docs, table(spark, folder, "labels"))
    return quality_classifier.score_documents(docs, model).select(
        "doc_id", (quality_classifier.remainder(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "predicted")


@query("op2_lm_scoring")
def op2_lm_scoring(spark, folder):
    held_out = quality_classifier.remainder(F.col("doc_id"), 10) == 0
    return backoff_lm.score_documents(table(spark, folder, "documents"), held_out)


@query("op7_ngram_jaccard_join", sql.NGRAM_JACCARD_JOIN)
def op7_ngram_jaccard_join(spark, folder):
    joined = ngram_join.join_similar(table(spark, folder, "documents"), k=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


@query("op4_line_dedup")
def op4_line_dedup(spark, folder):
    return line_dedup.dedup_lines(table(spark, folder, "documents").select("doc_id", "text"))


@query("op6_decontamination")
def op6_decontamination(spark, folder):
    found = decontamination.contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "item_id", "item_words", "covered_words", "n_tiles")


@query("op11_vector_codes", sql.vector_codes_sql())
def op11_vector_codes(spark, folder):
    return vector_codes.encode_vectors(table(spark, folder, "embeddings")).select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256")


@query("op12_filter_audit", sql.filter_audit_sql())
def op12_filter_audit(spark, folder):
    return filter_audit.audit_filters(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query("op13_simhash")
def op13_simhash(spark, folder):
    return simhash.near_duplicates(table(spark, folder, "documents"))
