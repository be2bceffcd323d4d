"""Mergeable column profiles (O-40f, O-41): sketches kept for each load partition.

The exact profile scans and shuffles the whole table.  Here every load
partition keeps one row per column: count, minimum, maximum, mean, squared
deviations, a quantile sketch and a distinct-count sketch.  A new or replaced
partition is scanned alone; the profile of any set of partitions is a merge of
their rows, which is as many rows as partitions and columns.

Count, minimum and maximum are exact, mean and standard deviation exact up to
rounding; a quantile is a value whose rank is off by at most ``RANK_ERROR``
with 99 % confidence, the distinct count by ``DISTINCT_ERROR`` (three sigma).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType, DoubleType, LongType, StringType, StructField, StructType,
)

from regiostat.sources.epochs import read_if_exists
from regiostat.sources.sinks import write_table

KLL_K = 400
RANK_ERROR = 0.01
HLL_K = 14
DISTINCT_ERROR = 0.025

SKETCH = StructType([StructField("column", StringType()), StructField("count", LongType()),
                     StructField("min", DoubleType()), StructField("max", DoubleType()), StructField("mean", DoubleType()),
                     StructField("m2", DoubleType()), StructField("quantiles", BinaryType()),
                     StructField("distinct", BinaryType())])


def sketch_columns(df: DataFrame, cols: Sequence[str], by: Sequence[str]) -> DataFrame:
    """One sketch row for each partition (``by``) and column; NULL and NaN are missing."""
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v")) for c in cols]))
    rows = df.select(*by, pairs.alias("_p")).select(*by, "_p.column", F.when(~F.isnan("_p.v"), F.col("_p.v")).alias("v"))
    # partial aggregation builds sketches map side: a task sends one row for each partition and column
    return rows.groupBy(*by, "column").agg(
        F.count("v").alias("count"), F.min("v").alias("min"), F.max("v").alias("max"), F.avg("v").alias("mean"),
        (F.var_pop("v") * F.count("v")).alias("m2"), F.kll_sketch_agg_double("v", KLL_K).alias("quantiles"),
        F.hll_sketch_agg(F.col("v").cast("string"), HLL_K).alias("distinct"))


def merge_sketches(sketches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Sketch rows of one column (and ``by``) merged into one."""
    keys = [*by, "column"]
    some = sketches.where("count > 0")
    total = some.groupBy(*keys).agg(
        F.sum("count").alias("n"), (F.sum(F.col("count") * F.col("mean")) / F.sum("count")).alias("all_mean"))
    both = some.join(total.withColumnsRenamed({k: f"_{k}" for k in keys}),
                     [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    shift = F.col("mean") - F.col("all_mean")
    merged = both.groupBy(*keys).agg(
        F.sum("count").alias("count"), F.min("min").alias("min"), F.max("max").alias("max"),
        F.first("all_mean").alias("mean"), F.sum(F.col("m2") + F.col("count") * shift * shift).alias("m2"),
        F.kll_merge_agg_double("quantiles").alias("quantiles"), F.hll_union_agg("distinct").alias("distinct"))
    # a column without values keeps its row, with count 0
    empty = sketches.groupBy(*keys).agg(F.max("count").alias("count")).where("count = 0")
    return merged.unionByName(empty, allowMissingColumns=True)


def profile_of(sketches: DataFrame, quantiles: Sequence[float] = (0.25, 0.5, 0.75)) -> DataFrame:
    """``describe()`` from merged sketches: (column, count, n_distinct, mean, std, min, p25, p50, p75, max)."""
    def quantile(q: float) -> Column:
        return F.kll_sketch_get_quantile_double("quantiles", F.lit(float(q))).alias(f"p{int(round(q * 100)):02d}")

    return merge_sketches(sketches).select(
        "column", "count", F.coalesce(F.hll_sketch_estimate("distinct"), F.lit(0).cast("long")).alias("n_distinct"), "mean",
        F.sqrt(F.try_divide("m2", (F.col("count") - 1).cast("double"))).alias("std"), "min",
        *[quantile(q) for q in quantiles], "max")


def update_profile(df: DataFrame, path: str, cols: Sequence[str], by: Sequence[str]) -> None:
    """Replace the stored sketches of the partitions that ``df`` holds, whole partitions each."""
    write_table(sketch_columns(df, cols, by), path, partition_by=by, dynamic_overwrite=True)


def stored_sketches(spark: SparkSession, path: str, by: StructType) -> DataFrame:
    return read_if_exists(spark, path, StructType([*SKETCH.fields, *by.fields]))
