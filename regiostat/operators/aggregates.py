"""Aggregations (O-40a..j, O-41) with pandas semantics.

All aggregates here are algebraic (partial + final), so a hot group is
pre-aggregated on the map side and never lands whole in one task.  The
exact profile quantiles avoid Spark's ``percentile`` (which buffers a whole
group) and instead rank distinct values through a range-partitioned scan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from regiostat.operators.filters import drop_null_keys
from regiostat.session import materialize

# (output name, function, input column)
AggSpec = Sequence[tuple[str, str, str]]


def agg_expr(fn: str, col: str) -> Column:
    """pandas named-aggregation function -> Spark aggregate."""
    c = F.col(col)
    if fn == "mean":
        return F.avg(c)
    if fn == "max":
        return F.max(c)
    if fn == "min":
        return F.min(c)
    if fn == "sum":  # pandas: the sum of an all-missing group is 0 (S2)
        return F.coalesce(F.sum(c), F.lit(0))
    if fn == "std":  # sample std, missing for a single row (S3)
        return F.stddev_samp(c)
    if fn == "count":
        return F.count(c)
    if fn == "size":
        return F.count(F.lit(1))
    if fn == "nunique":
        return F.count_distinct(c)
    raise ValueError(f"unknown aggregate {fn!r}")


def named_agg(df: DataFrame, keys: Sequence[str], spec: AggSpec,
              drop_missing_keys: bool = True) -> DataFrame:
    """``groupby(keys).agg(out=(col, fn), ...)`` (O-40a/b/c).

    pandas drops groups whose key is missing (S5); Spark would keep a NULL
    group, so such rows are filtered first unless ``drop_missing_keys=False``.
    """
    src = drop_null_keys(df, keys) if drop_missing_keys else df
    src = nan_to_null(src, {c for _, _, c in spec})
    return src.groupBy(*keys).agg(*[agg_expr(fn, c).alias(out) for out, fn, c in spec])


def nan_to_null(df: DataFrame, cols) -> DataFrame:
    """pandas treats NaN as missing; Spark aggregates would carry it (and
    ``max`` ranks NaN above every number).  Float columns only."""
    floats = {f.name for f in df.schema.fields if isinstance(f.dataType, (DoubleType, FloatType))}
    fix = {c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols if c in floats}
    return df.withColumns(fix) if fix else df


def weighted_mean(value: str, weight: str) -> Column:
    """Σ(x·w)/Σw with pandas' NULL rule (S20): missing x skipped in the numerator."""
    num = F.coalesce(F.sum(F.col(value) * F.col(weight)).cast("double"), F.lit(0.0))
    return F.try_divide(num, F.sum(F.col(weight)).cast("double"))


def first_by(col: str, order: str) -> Column:
    """``x[col].iloc[0]`` with an explicit order (O-40h, S18)."""
    return F.min_by(F.col(col), F.col(order))


def global_max(col: str) -> Column:
    """``df[col].max()`` (O-40i)."""
    return F.max(F.col(col))


def distinct_count(df: DataFrame, col: str, approximate: bool = False,
                   rsd: float = 0.01) -> DataFrame:
    """``nunique()`` over the whole frame, missing ignored (O-40f)."""
    fn = F.approx_count_distinct(col, rsd) if approximate else F.count_distinct(col)
    return df.agg(fn.alias("n_distinct"))


def observed_count(df: DataFrame, name: str = "rows"):
    """Row count as a metric of the job that consumes ``df`` (O-10, O-40j): no
    second pass.  Returns (observed DataFrame, Observation)."""
    from pyspark.sql import Observation
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


# ---------------------------------------------------------------------------
# Profile (O-41): count, mean, std, min, quartiles, max, distinct count.

def _ranked(vc: DataFrame, partitions: int | None) -> DataFrame:
    """Each distinct (column, v) with its first rank ``_lo`` among the column's
    sorted values.  Range-partitioned by (column, v): each task ranks one
    contiguous slice; slice totals are prefix-summed over the (few) slices.
    Distinct values are unique keys, so range partitioning balances even when
    one value holds a third of the rows (its count is one row here)."""
    n = partitions or vc.sparkSession.sparkContext.defaultParallelism
    # materialized: values and slice totals must see the same sampled bounds
    ranged = materialize(vc.repartitionByRange(n, "column", "v").withColumn("_pid", F.spark_partition_id()))
    w_local = Window.partitionBy("column", "_pid").orderBy("v").rowsBetween(Window.unboundedPreceding, -1)
    local = ranged.withColumn("_before", F.coalesce(F.sum("_c").over(w_local), F.lit(0)))
    slices = ranged.groupBy("column", "_pid").agg(F.sum("_c").alias("_slice"))
    w_slice = Window.partitionBy("column").orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    slices = slices.select("column", "_pid", F.coalesce(F.sum("_slice").over(w_slice), F.lit(0)).alias("_off"))
    # one row per (column, slice): bounded by columns x partitions
    out = local.join(F.broadcast(slices), ["column", "_pid"])
    return out.select("column", "v", "_c", (F.col("_off") + F.col("_before")).alias("_lo"))


def profile(df: DataFrame, cols: Sequence[str], quantiles: Sequence[float] = (0.25, 0.5, 0.75),
            std_scale: int | None = None, mean_scale: int | None = None,
            partitions: int | None = None, cut_lineage: bool = True) -> DataFrame:
    """``describe()`` as a long table, one row per input column:
    (column, count, n_distinct, mean, std, min, p25, p50, p75, max).

    The table is scanned once, into per-column value counts (partial
    aggregation collapses repeated values); with ``cut_lineage`` that table is
    checkpointed to the cluster's checkpoint folder and every statistic is
    derived from it.  Mean and std are plain doubles, the std two-pass and of
    the sample; a ``mean_scale`` sums exactly as DECIMAL(38, mean_scale) and a
    ``std_scale`` rounds, for comparisons only; quantiles are exact
    with numpy's linear interpolation at position ``(count-1)*q`` (pandas).  No group is ever collected into one task.
    """
    from regiostat.functions.scalars import round_half_even
    from regiostat.session import checkpoint_root

    tags = [f"p{int(round(q * 100)):02d}" for q in quantiles]
    stack = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("v"))
                                for c in cols]))
    long_df = df.select(*cols).select(stack.alias("_s")).select(
        "_s.column", F.when(~F.isnan("_s.v"), F.col("_s.v")).alias("v"))
    vc = long_df.where(F.col("v").isNotNull()).groupBy("column", "v").agg(F.count(F.lit(1)).alias("_c"))
    if cut_lineage:
        checkpoint_root(df.sparkSession)
        vc = vc.checkpoint(eager=True)
    value = F.col("v") if mean_scale is None else F.col("v").cast(f"decimal(38,{mean_scale})")
    basic = vc.groupBy("column").agg(
        F.sum("_c").alias("count"), F.count(F.lit(1)).alias("n_distinct"),
        (F.sum(value * F.col("_c")).cast("double") / F.sum("_c")).alias("mean"),
        F.min("v").alias("min"), F.max("v").alias("max"))
    # per-column summary: one row per column, broadcast by construction
    b = F.broadcast(basic.select("column", "count", "mean"))
    sq = vc.join(b, "column").groupBy("column").agg(
        F.sum(F.col("_c") * (F.col("v") - F.col("mean")) * (F.col("v") - F.col("mean"))).alias("_ss"),
        F.first("count").alias("_n"))
    std = sq.select("column", F.sqrt(F.try_divide(F.col("_ss"), (F.col("_n") - F.lit(1)).cast("double")))
                    .alias("std"))
    # targets: one row per (column, quantile); positions from the counts
    qs = F.explode(F.array(*[F.struct(F.lit(t).alias("q"), F.lit(float(q)).alias("qf"))
                             for t, q in zip(tags, quantiles)]))
    targets = basic.select("column", "count", qs.alias("_q")).select(
        "column", "_q.q", ((F.col("count") - F.lit(1)).cast("double") * F.col("_q.qf")).alias("pos"))
    targets = targets.withColumns({"lo_i": F.floor("pos").cast("long"), "hi_i": F.ceil("pos").cast("long")})
    ranked = _ranked(vc, partitions)
    in_lo = (F.col("_lo") <= F.col("lo_i")) & (F.col("lo_i") < F.col("_lo") + F.col("_c"))
    in_hi = (F.col("_lo") <= F.col("hi_i")) & (F.col("hi_i") < F.col("_lo") + F.col("_c"))
    hits = ranked.join(F.broadcast(targets), "column").where(in_lo | in_hi)
    qv = hits.groupBy("column", "q", "pos", "lo_i").agg(
        F.max(F.when(in_lo, F.col("v"))).alias("lo_v"), F.max(F.when(in_hi, F.col("v"))).alias("hi_v"))
    # numpy's linear interpolation (pandas describe): a + (b-a)*t below t=0.5,
    # b - (b-a)*(1-t) from 0.5 on
    t = F.col("pos") - F.col("lo_i").cast("double")
    span = F.col("hi_v") - F.col("lo_v")
    qv = qv.select("column", "q", F.when(t >= F.lit(0.5), F.col("hi_v") - span * (F.lit(1.0) - t))
                   .otherwise(F.col("lo_v") + span * t).alias("qv"))
    qwide = qv.groupBy("column").agg(*[F.max(F.when(F.col("q") == t, F.col("qv"))).alias(t) for t in tags])
    # one row per requested column, also when it holds no value (count 0),
    # as describe() reports it
    names = df.sparkSession.createDataFrame([(c, i) for i, c in enumerate(cols)], "column string, _ord int")
    out = (F.broadcast(names).join(basic, "column", "left").join(std, "column", "left")
           .join(qwide, "column", "left")
           .withColumns({"count": F.coalesce("count", F.lit(0).cast("long")),
                         "n_distinct": F.coalesce("n_distinct", F.lit(0).cast("long"))}))
    if std_scale is not None:
        out = out.withColumn("std", round_half_even("std", std_scale))
    return out.select("column", "count", "n_distinct", "mean", "std", "min", *tags, "max")
