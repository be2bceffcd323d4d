"""Rule-based corrections (O-32, O-33) and the region merge (O-42, O-51, O-52).

Rules are data: a small DataFrame (size-checked before broadcast) joined to
the rows, never a driver-side loop over rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.functions.exact import q, sum_sql
from regiostat.functions.scalars import round_half_even
from regiostat.operators.filters import contains_literal
from regiostat.operators.joins import Bounded, broadcast_if_small, frame, is_small


def point_update(df: DataFrame, rules: DataFrame, match_col: str, target_col: str,
                 rule_match: str = "match", rule_value: str = "value") -> DataFrame:
    """``df.loc[df[match_col] == m, target_col] = v`` for every rule (m, v) (O-32).

    Rules must be unique on ``rule_match``; rows without a rule keep their value.
    """
    sel = frame(rules).select(F.col(rule_match).alias("_m"), F.col(rule_value).alias("_v"),
                              F.lit(True).alias("_hit"))
    r = broadcast_if_small(Bounded(sel, rules.rows) if isinstance(rules, Bounded) else sel)
    out = df.join(r, df[match_col] == r["_m"], "left")
    return (out.withColumn(target_col, F.when(F.col("_hit"), F.col("_v")).otherwise(F.col(target_col)))
               .drop("_m", "_v", "_hit"))


def same_period_override(df: DataFrame, rules: DataFrame, keys: Sequence[str],
                         value_cols: Sequence[str], year: str = "year", period: str = "month",
                         order_col: str | None = None, strict: bool = True) -> DataFrame:
    """Copy ``value_cols`` of (keys, src_year, month) onto (keys, dst_year, month) (O-33, O-38).

    ``rules`` has columns ``keys + [period, 'src_year', 'dst_year']``.  The
    source row is looked up in ``df`` itself (self join through the rules); with
    several source rows the first by ``order_col`` wins.  A matched NULL source
    value still overwrites.  Every matching target row is updated.  A rule whose
    source row is absent raises when ``strict`` (the reference fails on
    ``values[0]``), otherwise it is skipped.
    """
    keys = list(keys)
    rk = keys + [period]
    sel = frame(rules).select(*rk, "src_year", "dst_year")
    small = is_small(Bounded(sel, rules.rows) if isinstance(rules, Bounded) else sel)
    rules_b = F.broadcast(sel) if small else sel
    rules = frame(rules)
    src = df.join(rules_b.withColumnRenamed("src_year", year), on=rk + [year], how="inner")
    order = F.col(order_col) if order_col else F.lit(0)
    src = (src.groupBy(*rk, "dst_year")
              .agg(F.min_by(F.struct(*[F.col(c).alias(c) for c in value_cols]), order).alias("_src"))
              .select(*rk, F.col("dst_year").alias(year), F.col("_src"), F.lit(True).alias("_hit")))
    if strict:
        missing = rules.select(*rk, "dst_year").join(
            src.withColumnRenamed(year, "dst_year"), on=rk + ["dst_year"], how="left_anti").limit(1).collect()
        if missing:
            raise ValueError(f"same_period_override: no source row for rule {tuple(missing[0])}")
    # src holds at most one row per rule (grouped by the rule keys): the answer
    # of the rule table's size check holds for it too
    out = df.join(F.broadcast(src) if small else src, on=rk + [year], how="left")
    return (out.withColumns({c: F.when(F.col("_hit"), F.col(f"_src.{c}")).otherwise(F.col(c))
                             for c in value_cols})
               .drop("_src", "_hit").select(*df.columns))


def weighted_merge(df: DataFrame, name_col: str, needle: str, merged_name: str,
                   group: Sequence[str], weight: str, means: Sequence[str],
                   first_cols: Sequence[str] = (), order_col: str | None = None,
                   round_scales: dict[str, int] | None = None,
                   int_cols: Sequence[str] = ()) -> DataFrame:
    """Merge all rows whose ``name_col`` contains ``needle`` into one row per ``group``
    (O-42, O-40g, O-40h, O-53); returns only the merged rows.

    ``weight`` is summed; each of ``means`` becomes Σ(x·w)/Σw.  The numerator
    skips missing values and an all-missing numerator counts as 0 while the
    denominator keeps every weight (S20).  ``first_cols`` take the value of the
    first row by ``order_col`` (S18).  Products of floating values are floats and
    their sum is exact, so the result does not depend on row order.
    """
    part = df.where(contains_literal(name_col, needle, na=False))
    order = F.col(order_col) if order_col else F.lit(0)
    aggs = [F.sum(weight).alias(weight)]
    aggs += [F.min_by(F.col(c), order).alias(c) for c in first_cols]
    wsum = F.sum(F.col(weight))
    types = dict(df.dtypes)
    for m in means:
        x = F.col(m)
        total = F.sum(x * F.col(weight)).cast("double")
        if types[m] in ("double", "float"):  # float products, summed exactly
            xw = f"({q(m)} * CAST({q(weight)} AS DOUBLE))"
            total = F.expr(sum_sql(f"(CASE WHEN NOT isnan({xw}) THEN {xw} END)", "double"))
        num = F.coalesce(total, F.lit(0.0))
        aggs.append(F.try_divide(num, wsum.cast("double")).alias(m))
    merged = part.groupBy(*group).agg(*aggs).withColumn(name_col, F.lit(merged_name))
    for c, s in (round_scales or {}).items():
        merged = merged.withColumn(c, round_half_even(c, s))
    for c in int_cols:
        merged = merged.withColumn(c, F.col(c).cast("long"))
    return merged


def replace_matching(df: DataFrame, name_col: str, needle: str, new_rows: DataFrame) -> DataFrame:
    """Drop rows matching ``needle`` then append ``new_rows`` by name (O-52, O-51).

    The reference's ``str.contains`` without ``na=`` raises on a missing name
    (S9); here a missing name simply does not match and the row is kept.
    """
    kept = df.where(~contains_literal(name_col, needle, na=False))
    return kept.unionByName(new_rows, allowMissingColumns=True)
