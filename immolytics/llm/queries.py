"""Registered queries of the numbered operators and of the pipeline."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import table
from . import sql

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


@register("op9_best_fit_packing")
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pack_residual import pack_documents
    return pack_documents(table(spark, sf_dir, "documents"))


@register("op5_simhash_vptree")
def op5_simhash_vptree(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash_vptree import near_duplicates
    return near_duplicates(table(spark, sf_dir, "documents"), shingle=3, max_bits=3).drop("group")


@register("op10_winnowing", sql.WINNOWING)
def op10_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate_winnow import decontaminate
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("text_key")


@register("op1_quality_fm")
def op1_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold_of
    from .quality_fm import fit_quality, score_quality
    docs = table(spark, sf_dir, "documents")
    machine = fit_quality(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, machine).select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@register("op3_language_unigrams")
def op3_language_unigrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold_of
    from .lang_unigram import fit_languages, identify
    docs = table(spark, sf_dir, "documents")
    held_out = fold_of("doc_id", 4) == 2
    model = fit_languages(docs.where(~held_out))
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@register("op4_toxicity_gbt")
def op4_toxicity_gbt(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import fold_of
    from .toxicity_gbt import fit_toxicity, score_toxicity
    docs = table(spark, sf_dir, "documents")
    model = fit_toxicity(docs, table(spark, sf_dir, "labels"))
    return score_toxicity(docs, model).select("doc_id", (fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@register("op6_divergence_rules", sql.DIVERGENCE)
def op6_divergence_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_divergence import build_references, divergence_rules
    docs = table(spark, sf_dir, "documents")
    return divergence_rules(docs, build_references(docs))


@register("op8_secret_guess_cost")
def op8_secret_guess_cost(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secret_guess import scan_secrets
    return scan_secrets(table(spark, sf_dir, "documents"))


@register("op7_pii_semicrf")
def op7_pii_semicrf(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii_semicrf import find_pii, fit_pii
    docs = table(spark, sf_dir, "documents")
    return find_pii(docs, fit_pii(docs))


@register("op2_warc_index", """
WITH p AS (
  SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
), d AS (
  SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, sha1(payload) AS payload_digest FROM p
), w AS (
  SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) END AS last_id
  FROM d
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN last_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN last_id <> page_id THEN last_id END AS refers_to
FROM w
""")
def op2_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc_index import round_trip
    return round_trip(table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op11_phrase_misra_gries", sql.COLLOCATIONS)
def op11_phrase_misra_gries(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .phrase_misra_gries import collocations
    return collocations(table(spark, sf_dir, "documents")).drop("cut")


@register("op12_jaccard_adaptive", sql.JACCARD)
def op12_jaccard_adaptive(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .jaccard_adaptive import jaccard_components
    return jaccard_components(table(spark, sf_dir, "documents"))


@register("op13_search_k2treap", sql.SEARCH)
def op13_search_k2treap(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .search_k2treap import search
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@register("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)
