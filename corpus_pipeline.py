"""The corpus pipeline: five operators, each over all that the one before kept.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is
written as Parquet to the shared folder and read again for the next one.  All
but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.llm import lang_id, mixing, near_dup, packing, secret_scan
from regiostat.llm.common import free_name, saved, small_batches, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised stay, whatever their label.

    A document is rejected if it has no letters or no language is likely
    enough; the classifier learns from the labelled documents of its input.
    """
    small_batches(spark)
    model = lang_id.fit(docs)
    if not model.langs:  # no labelled text: only documents without letters are rejected
        return docs.where(F.col("text").rlike(r"\p{L}"))
    language = free_name(docs.columns, "language")
    out = lang_id.identify(docs, model, out=language)
    return out.where(lang_id.accepted(F.col(language))).select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays."""
    small_batches(spark)
    return near_dup.deduplicated(docs)


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are replaced in the text; every document stays."""
    small_batches(spark)
    found = secret_scan.without_secrets(docs)
    if "n_chars" in docs.columns:
        found = found.withColumn("n_chars", F.length("text").cast("long"))
    return found.select(docs.columns)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated and cut to the target weights of their sources."""
    small_batches(spark)
    return mixing.mixed_documents(docs)


def best_fit(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Which words of which document lie where in which bin."""
    small_batches(spark)
    return packing.pack(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("secret_redaction", secret_redaction),
          ("source_mix", source_mix), ("best_fit", best_fit)]

#: Trained models and hash-random orders have no SQL; tests/llm holds every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = saved(stage(spark, docs, sf_dir), f"stage-{name}")
    return saved(STAGES[-1][1](spark, docs, sf_dir), f"stage-{STAGES[-1][0]}")
