"""Operator 4: mix sources to target weights.

Every document gets a hash-random key; the (source, key) order is cut into
ranges, token counts are summed per range, range totals are accumulated per
source, and a source's budget ends at one exact word of one document.  A
budget above the source's size repeats whole epochs first.

Defined cases: a null text has size 0; null is a source of its own, ranked
last; documents of size 0 take nothing; an empty table gives no rows; repeated
rows are documents of their own (identical rows are interchangeable); extra
columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import free_name, lookup, partitions, saved, words

#: Weights by rank of the source in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: A target stops at so many times its source's size.
EPOCHS = 3
SEED = 20_240_229


@F.arrow_udf(T.LongType())
def word_count(texts: pa.Array) -> pa.Array:
    return pa.array([len(words(t)) for at in range(0, len(texts), 256) for t in texts.slice(at, 256).to_pylist()],
                    pa.int64())


def source_targets(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS) -> DataFrame:
    """One row per source: source_size and target.

    Sources in order of cap per weight fill up one after the other: with the
    caps of those before subtracted, the rest shares by weight; from the first
    source that stays below its cap on, that share is final.  The windows run
    over one row per source.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(W.orderBy(F.col("source").asc_nulls_last()))
    per = per.withColumn("rank", rank).withColumn(
        "weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") - 1) % len(weights) + 1))
    per = per.withColumn("cap", F.col("source_size") * epochs)
    by_ratio = W.orderBy(F.col("cap") / F.col("weight"), "rank")
    before = by_ratio.rowsBetween(W.unboundedPreceding, -1)
    whole = W.orderBy(F.lit(0)).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    level = ((F.sum("source_size").over(whole) - F.coalesce(F.sum("cap").over(before), F.lit(0)))
             / (F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    per = per.withColumn("level", level)
    open_level = F.when(F.col("cap") > F.col("level") * F.col("weight"), F.col("level"))
    per = per.withColumn("level", F.first(open_level, ignorenulls=True).over(
        by_ratio.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)))
    cap = F.col("cap").cast("double")
    return per.select("source", "source_size",
                      F.coalesce(F.least(cap, F.col("level") * F.col("weight")), cap).alias("target"))


def mix(sizes: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """``sizes`` has row_id, doc_id, source, size (long).

    Returns these with source_size, target, taken: the words that the mix takes
    of the document, repeats counted.  The table of documents holds four
    numbers a row and is written once; its range bounds are sampled once.
    """
    spark = sizes.sparkSession
    base = saved(sizes.select("row_id", "doc_id", "source", "size",
                              F.xxhash64(F.lit(seed), F.col("doc_id")).alias("key")), "mix-sizes")
    order = ["key", "doc_id", "size", "row_id"]
    ranged = base.repartitionByRange(partitions(spark), "source", *order)
    ranged = saved(ranged.withColumn("slice", F.spark_partition_id()), "mix-ranges")

    sources = saved(source_targets(ranged, weights, epochs), "mix-sources")
    parts = ranged.groupBy("source", "slice").agg(F.sum("size").alias("part"))
    earlier = W.partitionBy("source").orderBy("slice").rowsBetween(W.unboundedPreceding, -1)
    offsets = parts.select("source", "slice", F.coalesce(F.sum("part").over(earlier), F.lit(0)).alias("offset"))
    offsets = saved(offsets, "mix-offsets")  # at most one row for each range and source that meet

    inside = W.partitionBy("slice", "source").orderBy(*order).rowsBetween(W.unboundedPreceding, -1)
    out = ranged.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    out = lookup(out, offsets, {"source": "source", "slice": "slice"})
    out = lookup(out, sources, {"source": "source"})
    budget = F.round("target").cast("long")
    whole = F.when(F.col("source_size") > 0, F.floor(budget / F.greatest("source_size", F.lit(1)))).otherwise(0)
    out = out.withColumn("epochs", whole.cast("long")).withColumn("rest", budget - F.col("epochs") * F.col("source_size"))
    cut = F.greatest(F.lit(0), F.least("size", F.col("rest") - F.col("offset") - F.col("before")))
    return out.select("row_id", "doc_id", "source", "size", "source_size", "target",
                      (F.col("size") * F.col("epochs") + cut).cast("long").alias("taken"))


def sized(docs: DataFrame, text: str = "text") -> DataFrame:
    """row_id, doc_id, source and size of every document.

    Row ids follow the splits of one scan, and another scan may give others.
    """
    return _sizes(docs, F.monotonically_increasing_id(), text)


def _sizes(docs: DataFrame, row: Column, text: str = "text") -> DataFrame:
    return docs.select(row.alias("row_id"), "doc_id", "source", word_count(F.col(text)).alias("size"))


@F.arrow_udf(T.ArrayType(T.StringType()))
def _copies(texts: pa.Array, taken: pa.Array) -> pa.Array:
    out = []
    for text, n in zip(texts.to_pylist(), taken.to_pylist()):
        size = len(words(text))
        whole, rest = divmod(n, size) if size else (0, 0)
        out.append([text] * whole + ([b" ".join(words(text)[:rest]).decode("utf-8", "surrogatepass")] if rest else []))
    return pa.array(out, pa.list_(pa.string()))


def mixed_documents(docs: DataFrame, weights=WEIGHTS, epochs: int = EPOCHS, seed: int = SEED) -> DataFrame:
    """The mix itself: ``docs`` repeated and cut; other columns as they were.

    The one document at which a source's budget ends keeps its first words.
    The documents are written once with their row id, and both sides read that.
    """
    columns = docs.columns
    row, words_taken = free_name(columns, "mix_row"), free_name(columns, "mix_taken")
    own = saved(docs.withColumn(row, F.monotonically_increasing_id()), "mix-documents")
    taken = mix(_sizes(own, F.col(row)), weights, epochs, seed).where("taken > 0").select(
        F.col("row_id").alias(row), F.col("taken").alias(words_taken))
    out = own.join(saved(taken, "mix-taken"), row)
    out = out.withColumn("text", F.explode(_copies("text", words_taken)))
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(columns)
