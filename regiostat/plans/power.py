"""Household-power layers: bronze ingest (J-1), silver (J-2), fact (J-3).

Column names default to the reference's tables; every step is a parameter.
Shuffles: the city merge groups by (year, month) on the merged subset only;
interpolation partitions by district; MoM/YoY by (code, district); all of
them run on district-month grain, at most one row per month per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regiostat.functions.scalars import (
    inf_to_null, lenient_double, lenient_int, quarter_of, season_of, tariff_of,
)
from regiostat.operators.aggregates import global_max
from regiostat.operators.corrections import (
    replace_matching, same_period_override, weighted_merge,
)
from regiostat.operators.filters import null_out_invalid
from regiostat.operators.ingest import convert_payload, pending_slots, split_by_response
from regiostat.operators.joins import Bounded
from regiostat.operators.timeseries import interpolate_linear, pct_change, surrogate_ids
from regiostat.session import materialize

# ---------------------------------------------------------------------------
# The reference's data corrections.
# County whose January and February 2015 values are replaced by 2014's.
OVERRIDE_RULES = [
    ("전라남도", "영암군", 1, 2014, 2015),
    ("전라남도", "영암군", 2, 2014, 2015),
]
# City whose districts are merged into one row (name contains / merged name).
MERGE_CITY = "부천시"
# ---------------------------------------------------------------------------

FACT_COLUMNS = [
    "year", "month", "quarter", "season", "season_tariff", "sd_code", "sd_name", "sgg_name",
    "house_cnt", "avg_usage_kwh", "avg_bill_won", "total_usage_kwh", "total_bill_won",
    "unit_price", "usage_yoy_pct", "usage_mom_pct",
]


@dataclass
class SilverParams:
    override_rules: list[tuple] = field(default_factory=lambda: list(OVERRIDE_RULES))
    merge_city: str | None = MERGE_CITY
    clean_before_merge: bool = False  # S21: the reference nulls negatives after merging
    value_cols: Sequence[str] = ("power_usage", "bill")
    series_keys: Sequence[str] = ("sd_name", "sgg_name")
    order: Sequence[str] = ("year", "month")
    strict_override: bool = True  # a rule without its source row fails, as in the reference


def bronze_ingest(spark: SparkSession, landed: DataFrame, bronze: DataFrame | None,
                  slot_keys: Sequence[str] = ("year", "month", "sd_code")):
    """J-1: typed rows of landed responses, minus slots already stored, split
    into (good rows to append, rejected rows for the dead-letter table).

    A slot is what was requested (year, month, region): it is known even where
    the payload's own fields are invalid.  Good rows carry the payload's year
    and month, rejected rows the request's, for the retry.
    """
    typed = convert_payload(landed).withColumnsRenamed({"year": "data_year", "month": "data_month"})
    typed = typed.withColumns({"year": lenient_int("req_year").cast("int"),
                               "month": lenient_int("req_month").cast("int")}).drop("req_year", "req_month")
    no_slot = F.col("year").isNull() | F.col("month").isNull()
    typed = typed.withColumn("_bad", F.col("_bad") | no_slot)
    if bronze is not None:
        typed = pending_slots(typed, bronze, slot_keys)
    good, rejected = split_by_response(materialize(typed), slot_keys)
    good = good.drop("year", "month", "response", "unreadable").withColumnsRenamed({"data_year": "year", "data_month": "month"})
    rejected = rejected.withColumn("file", F.col("response.file")).drop("data_year", "data_month", "response")
    return good, rejected


def power_silver(bronze: DataFrame, params: SilverParams | None = None) -> DataFrame:
    """J-2: override -> city merge -> numeric -> negatives NULL -> interpolate."""
    p = params or SilverParams()
    spark = bronze.sparkSession
    df = bronze
    vals = list(p.value_cols)
    # "first row" (S18) follows the insert id; bronze landed without one is
    # ordered by (year, month, code, district) and merged rows get no id
    has_id = "id" in df.columns
    order_col = "id" if has_id else "_ord"
    if not has_id:
        df = df.withColumn("_ord", F.struct("year", "month", "sd_code", "sgg_name"))
    if p.override_rules:
        rules = Bounded.literal(spark, p.override_rules,
                                "sd_name string, sgg_name string, month int, src_year int, dst_year int")
        df = same_period_override(df, rules, ["sd_name", "sgg_name"], vals, order_col=order_col,
                                  strict=p.strict_override)
    if p.clean_before_merge:
        df = null_out_invalid(_to_numeric(df, vals), vals)
    if p.merge_city:
        merged = weighted_merge(
            df, "sgg_name", p.merge_city, p.merge_city, group=["year", "month"], weight="house_cnt",
            means=vals, first_cols=["sd_code", "sd_name"], order_col=order_col,
            round_scales={vals[0]: 2, vals[1]: 0}, int_cols=[vals[1]])
        if has_id:
            # one scalar to the driver: the current largest id
            max_id = df.agg(global_max("id")).first()[0] or 0
            merged = surrogate_ids(merged, int(max_id), ["year", "month"])
        df = replace_matching(df, "sgg_name", p.merge_city, merged.select(*[c for c in df.columns if c in merged.columns]))
    df = _to_numeric(df, vals)
    df = null_out_invalid(df, vals)
    out = interpolate_linear(df, list(p.series_keys), list(p.order), vals)
    return out if has_id else out.drop("_ord")


def _to_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``to_numeric(errors='coerce')``: strings parsed leniently, numbers cast."""
    types = dict(df.dtypes)
    return df.withColumns({c: lenient_double(c) if types[c] == "string" else F.col(c).cast("double")
                           for c in cols})


def power_fact(silver: DataFrame, keys: Sequence[str] = ("sd_code", "sgg_name")) -> DataFrame:
    """J-3: calendar dimensions, totals, unit price, MoM and 12-row YoY."""
    df = silver.withColumnsRenamed({"power_usage": "avg_usage_kwh", "bill": "avg_bill_won"})
    df = df.withColumns({
        "quarter": quarter_of("month"),
        "season": season_of("month"),
        "season_tariff": tariff_of("month"),
        "total_usage_kwh": F.col("house_cnt") * F.col("avg_usage_kwh"),
        "total_bill_won": F.col("house_cnt") * F.col("avg_bill_won"),
        "unit_price": F.try_divide(F.col("avg_bill_won").cast("double"), F.col("avg_usage_kwh").cast("double")),
    })
    if "id" in df.columns:
        df = df.drop("id")
    order = ["year", "month"]
    df = pct_change(df, list(keys), order, "avg_usage_kwh", "usage_mom_pct", periods=1)
    df = pct_change(df, list(keys), order, "avg_usage_kwh", "usage_yoy_pct", periods=12)
    df = df.withColumns({c: inf_to_null(c) for c in ("unit_price", "usage_mom_pct", "usage_yoy_pct")})
    return df.select(*[c for c in FACT_COLUMNS if c in df.columns])
