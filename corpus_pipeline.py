"""From raw documents to packed training sequences, in five stages.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. ``run`` applies them to the ``documents`` table and
writes each stage's result as Parquet before the next one reads it.

1. ``language``: documents whose language cannot be told go (no letters, or a
   posterior under ``LEAST_POSTERIOR``).
2. ``near_duplicates``: one document of each SimHash component stays, the one of
   smallest doc_id (a null id comes last; of equal rows one stays).
3. ``decontamination``: documents that hold a window of a benchmark item go.
4. ``secrets``: secrets are masked in the texts; n_chars follows.
5. ``packing``: the texts become pieces of token sequences.

Null and empty texts have no letters, so the first stage drops them. Extra
columns of ``docs`` pass through whatever their names; an empty table gives an
empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from immolytics.llm import decontaminate_winnow, lang_unigram, pack_residual, secret_guess, simhash_vptree
from immolytics.session import materialize
from immolytics.sources.tables import table

LEAST_POSTERIOR = 0.5


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the documents whose language is told; the models learn from the rows with a ``lang``."""
    model = lang_unigram.fit_languages(docs)
    rows = docs.select(F.struct(*docs.columns).alias("__row"), "text")
    told = lang_unigram.identify(rows, model, keep=("__row",))
    return told.where((F.col("lang_pred") != lang_unigram.UNDETERMINED) & (F.col("score") >= LEAST_POSTERIOR)).select("__row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each near-duplicate group."""
    keyed = docs.withColumn("__id", F.xxhash64("doc_id", "text")).withColumn("__key", F.xxhash64("text", F.lit(1)))
    groups = simhash_vptree.near_duplicates(keyed, shingle=3, max_bits=3, keep=("__id", "__key"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__id", "__key")).alias("first")
    chosen = groups.groupBy("group").agg(first).select("first.__id", "first.__key")
    # Join and removal of equal rows share one partitioning: documents are shuffled once.
    return keyed.join(chosen, ["__id", "__key"], "left_semi").dropDuplicates(["__id", "__key"]).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold a benchmark window."""
    found = decontaminate_winnow.decontaminate(docs, table(spark, sf_dir, "benchmark"))
    bad = (found.where("contaminated").select(F.col("doc_id").alias("__doc"), F.col("text_key").alias("__key")).distinct())
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.xxhash64("text") == F.col("__key"))
    return docs.join(bad, same, "left_anti")


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Mask secrets in the texts."""
    return secret_guess.mask_secrets(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pack the texts into sequences of tokens."""
    return pack_residual.pack_documents(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("decontamination", decontamination),
          ("secrets", secrets), ("packing", packing)]

# Language models, hashes, tokens and guess costs have no SQL form; the tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
