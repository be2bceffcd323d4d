"""Grouped series operators (O-43..O-48).

Window partitions here are bounded: period-over-period and diff operators
run on (key, period) aggregates, so a partition holds at most one row per
period.  Interpolation can also run on raw rows of a huge key: pass a
``block`` column (a coarse, monotone function of the order, e.g. the year or
``id div 4096``) and each window task then sees one block; block summaries
are prefix-scanned per key and joined back.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from regiostat.operators.joins import broadcast_if_small
from regiostat.session import materialize


def _keys_present(keys: Sequence[str]) -> Column:
    out = F.lit(True)
    for k in keys:
        out = out & F.col(k).isNotNull()
    return out


def _order_cols(order: Sequence[str]) -> list[Column]:
    # pandas sort_values puts missing last (S17)
    return [F.col(o).asc_nulls_last() for o in order]


def _reverse_cols(order: Sequence[str]) -> list[Column]:
    # looking ahead is looking back in the reversed order: a growing frame is
    # evaluated once per row, a shrinking one anew for each row
    return [F.col(o).desc_nulls_first() for o in order]


def pct_change(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str,
               out: str, periods: int = 1, scale: float = 100.0) -> DataFrame:
    """``groupby(keys)[value].pct_change(periods) * scale`` by row offset (O-44a/b, S14).

    x/0 and 0/0 give NULL (pandas gives ±inf/NaN, then replaces inf with NaN;
    S1, O-59).  Rows with a missing key get NULL (S6).
    """
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    prev = F.lag(F.col(value), periods).over(w)
    ratio = F.try_divide(F.col(value).cast("double"), prev.cast("double"))
    return df.withColumn(out, F.when(_keys_present(keys), (ratio - F.lit(1.0)) * F.lit(scale)))


def pct_change_calendar(df: DataFrame, keys: Sequence[str], value: str, out: str,
                        year: str = "year", month: str = "month", years_back: int = 1,
                        scale: float = 100.0) -> DataFrame:
    """Calendar-safe year-over-year change: the same month ``years_back`` years
    earlier through a self join (O-44b variant, O-38); a missing month gives NULL
    instead of silently comparing against the wrong row."""
    prev = df.select(*keys, (F.col(year) + F.lit(years_back)).alias(year), F.col(month),
                     F.col(value).alias("_prev"))
    j = df.join(prev, on=list(keys) + [year, month], how="left")
    ratio = F.try_divide(F.col(value).cast("double"), F.col("_prev").cast("double"))
    return j.withColumn(out, (ratio - F.lit(1.0)) * F.lit(scale)).drop("_prev")


def diff(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, out: str,
         periods: int = 1) -> DataFrame:
    """``groupby(keys)[value].diff()`` by row (O-45); compute before rounding (S16)."""
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    return df.withColumn(out, F.when(_keys_present(keys),
                                     F.col(value) - F.lag(F.col(value), periods).over(w)))


def count_over(df: DataFrame, key: str, out: str) -> DataFrame:
    """``groupby(key)[key].transform('count')`` (O-43) as aggregate + join back."""
    counts = df.groupBy(key).agg(F.count(F.col(key)).alias(out)).where(F.col(key).isNotNull())
    return df.join(broadcast_if_small(counts), on=[key], how="left")


def _interp_expr(v: str, pv: Column, pi: Column, nv: Column, ni: Column, i: Column) -> Column:
    return (F.when(F.col(v).isNotNull(), F.col(v))
             .when(pv.isNull(), F.lit(None))
             .when(nv.isNull(), pv)
             .otherwise(pv + (nv - pv) * (i - pi).cast("double") / (ni - pi).cast("double")))


def interpolate_linear(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       cols: Sequence[str], block: Column | None = None) -> DataFrame:
    """``groupby(keys)[cols].transform(lambda x: x.interpolate())`` (O-46, S13).

    Linear in row *position* (not time) inside each key's ordered series;
    interior gaps are filled, trailing gaps repeat the last value, leading gaps
    stay NULL.  Rows with a missing key become NULL (S6).

    ``order`` must be unique within a key.  With ``block`` the work per window
    task is bounded by one block instead of one key (see module doc).
    """
    keys, order = list(keys), list(order)
    # pandas treats NaN as missing; Spark would carry it as a value
    df = df.withColumns({c: F.when(~F.isnan(F.col(c)), F.col(c)) for c in cols})
    if block is None:
        return _interpolate_plain(df, keys, order, cols)
    return _interpolate_blocked(df, keys, order, cols, block)


def _interpolate_plain(df, keys, order, cols):
    w = Window.partitionBy(*keys).orderBy(*_order_cols(order))
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.partitionBy(*keys).orderBy(*_reverse_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    out = df.withColumn("_i", F.row_number().over(w))
    for c in cols:
        idx = F.when(F.col(c).isNotNull(), F.col("_i"))
        pv, pi = F.last(c, True).over(back), F.last(idx, True).over(back)
        nv, ni = F.last(c, True).over(fwd), F.last(idx, True).over(fwd)
        out = out.withColumn(c, F.when(_keys_present(keys), _interp_expr(c, pv, pi, nv, ni, F.col("_i"))))
    return out.drop("_i")


def _interpolate_blocked(df, keys, order, cols, block):
    bk = keys + ["_blk"]
    tagged = df.withColumn("_blk", block)
    present = _keys_present(bk)
    # rows with a missing key interpolate to NULL (S6) and need no window; the
    # rest feed both the rows and the block summaries through one identical
    # filtered subtree, so the shuffle is written once and reused
    missing = tagged.where(~present).withColumns({c: F.lit(None).cast(t) for c, t in df.dtypes if c in cols})
    src = tagged.where(present)
    w = Window.partitionBy(*bk).orderBy(*_order_cols(order))
    back = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    fwd = Window.partitionBy(*bk).orderBy(*_reverse_cols(order)).rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    loc = src.withColumn("_li", F.row_number().over(w))
    for c in cols:
        idx = F.when(F.col(c).isNotNull(), F.col("_li"))
        loc = loc.withColumns({
            f"_pv_{c}": F.last(c, True).over(back), f"_pi_{c}": F.last(idx, True).over(back),
            f"_nv_{c}": F.last(c, True).over(fwd), f"_ni_{c}": F.last(idx, True).over(fwd)})
    # one summary row per (key, block): size, last and first non-missing (value, local index)
    aggs = [F.count(F.lit(1)).alias("_n")]
    for c in cols:
        idx = F.when(F.col(c).isNotNull(), F.col("_li"))
        aggs += [F.max(idx).alias(f"_bl_i_{c}"), F.max_by(F.col(c), idx).alias(f"_bl_v_{c}"),
                 F.min(idx).alias(f"_bf_i_{c}"), F.min_by(F.col(c), idx).alias(f"_bf_v_{c}")]
    summ = loc.groupBy(*bk).agg(*aggs)
    ws = Window.partitionBy(*keys).orderBy(F.col("_blk").asc_nulls_last())
    before = ws.rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy(*keys).orderBy(F.col("_blk").desc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1)
    summ = summ.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    carry = {}
    for c in cols:
        g_last = F.col("_off") + F.col(f"_bl_i_{c}")
        g_first = F.col("_off") + F.col(f"_bf_i_{c}")
        summ = summ.withColumns({f"_gl_{c}": g_last, f"_gf_{c}": g_first})
        carry.update({
            f"_cpv_{c}": F.last(f"_bl_v_{c}", True).over(before),
            f"_cpi_{c}": F.last(f"_gl_{c}", True).over(before),
            f"_cnv_{c}": F.last(f"_bf_v_{c}", True).over(after),
            f"_cni_{c}": F.last(f"_gf_{c}", True).over(after)})
    summ = summ.withColumns(carry).select(*bk, "_off", *carry.keys())
    j = loc.join(summ, on=bk, how="inner")
    i = F.col("_off") + F.col("_li")
    out = j
    for c in cols:
        has_p = F.col(f"_pv_{c}").isNotNull()
        has_n = F.col(f"_nv_{c}").isNotNull()
        pv = F.when(has_p, F.col(f"_pv_{c}")).otherwise(F.col(f"_cpv_{c}"))
        pi = F.when(has_p, F.col("_off") + F.col(f"_pi_{c}")).otherwise(F.col(f"_cpi_{c}"))
        nv = F.when(has_n, F.col(f"_nv_{c}")).otherwise(F.col(f"_cnv_{c}"))
        ni = F.when(has_n, F.col("_off") + F.col(f"_ni_{c}")).otherwise(F.col(f"_cni_{c}"))
        out = out.withColumn(c, _interp_expr(c, pv, pi, nv, ni, i))
    return out.select(*df.columns).unionByName(missing.select(*df.columns))


def surrogate_ids(df: DataFrame, start_after: Column | int, order: Sequence[str], out: str = "id",
                  partitions: int | None = None) -> DataFrame:
    """``range(max_id+1, ...)`` in ``order`` (O-47), numbered without a
    single-partition window: rows are range-partitioned on ``order``, numbered
    inside each slice, and each slice is offset by the sizes of the slices
    before it (a prefix over one row per slice).  ``order`` must be unique.
    ``start_after`` may be a literal or a column already joined onto ``df``.
    The slices are materialized, so that the rows and the slice sizes see the
    same sampled range bounds.
    """
    n = partitions or df.sparkSession.sparkContext.defaultParallelism
    ranged = df.repartitionByRange(n, *[F.col(o).asc_nulls_last() for o in order]) \
               .withColumn("_pid", F.spark_partition_id())
    ranged = materialize(ranged)
    local = ranged.withColumn("_rn", F.row_number().over(
        Window.partitionBy("_pid").orderBy(*_order_cols(order))))
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(F.lit(0)).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    # one row per slice: bounded by the partition count
    numbered = local.join(F.broadcast(offsets), "_pid")
    base = F.lit(start_after) if isinstance(start_after, int) else start_after
    return numbered.withColumn(out, (base + F.col("_off") + F.col("_rn")).cast("long")) \
                   .drop("_pid", "_rn", "_off")


def keep_last(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """``drop_duplicates(subset=key, keep='last')`` with an explicit order (O-48, S18).

    An aggregate (``max_by`` of the whole row), so a hot key is combined map
    side instead of sorted in one task.
    """
    others = [c for c in df.columns if c != key]
    ordering = F.struct(*[F.col(o) for o in order])
    row = F.max_by(F.struct(*[F.col(c) for c in others]), ordering)
    return df.groupBy(key).agg(row.alias("_r")).select(key, *[F.col(f"_r.{c}").alias(c) for c in others])
