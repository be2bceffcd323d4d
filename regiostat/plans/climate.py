"""Regional-climate layers: raw (J-4), transform (J-5), silver (J-6) and the
three facts (J-7 trend, J-8 regional compare, J-9 extremes).

Facts are two-stage: station-level aggregates first, then a mean (or max/min)
over stations per province, which removes the bias of provinces with many
stations.  Both stages are partial+final hash aggregates; the year-over-year
diff is a window over province-years (one row per year per partition).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regiostat.functions.exact import mean_sql, q, sum_sql
from regiostat.functions.names import clean_headers
from regiostat.functions.scalars import first_token, lenient_double, strict_int, year_month_parts
from regiostat.operators.aggregates import AggSpec
from regiostat.operators.corrections import point_update
from regiostat.operators.filters import drop_contains, month_bitmask_count, prune_single_closed
from regiostat.operators.joins import Bounded, assert_unique, lookup_join, unmatched
from regiostat.operators.projections import rename, round_float_columns, select_columns
from regiostat.operators.timeseries import diff, keep_last

# ---------------------------------------------------------------------------
# Fixed values from the reference.
# Station-name rule: the station whose address is missing gets this address.
META_FIX = ("서청주(예)", "충청북도 청주시")
# Address marker of mountain stations, removed (literal, not a pattern).
MOUNTAIN_MARKER = "(산지)"
# Stations with a single record closed on or before this date are removed.
CLOSED_CUTOFF = "2000-12-31"
# The 22 silver columns (names after header cleaning).
SILVER_COLUMNS = [
    "지점", "지점명", "일시",
    "평균기온_C", "평균최고기온_C", "평균최저기온_C",
    "최고기온_C", "최저기온_C",
    "평균해면기압_hPa",
    "평균수증기압_hPa",
    "평균이슬점온도_C",
    "평균상대습도",
    "월합강수량_00_24h만_mm",
    "일최다강수량_mm",
    "평균풍속_m_s", "최대풍속_m_s",
    "최다풍향_16방위",
    "평균운량_1_10",
    "합계_일조시간_hr",
    "합계_일사량_MJ_m2",
    "최심적설_cm",
    "평균지면온도_C",
]
# Non-numeric silver columns; every other silver column is parsed as a double.
TEXT_COLUMNS = ["지점", "지점명", "일시", "최다풍향_16방위"]
# ---------------------------------------------------------------------------


@dataclass
class ClimateCols:
    """Column roles; defaults are the reference's cleaned names."""
    station: str = "지점"
    station_name: str = "지점명"
    address: str = "지점주소"
    closed: str = "종료일"
    period: str = "일시"
    avg_temp: str = "평균기온_C"
    avg_max_temp: str = "평균최고기온_C"
    avg_min_temp: str = "평균최저기온_C"
    max_temp: str = "최고기온_C"
    min_temp: str = "최저기온_C"
    pressure: str = "평균해면기압_hPa"
    humidity: str = "평균상대습도"
    precip: str = "월합강수량_00_24h만_mm"
    max_daily_precip: str = "일최다강수량_mm"
    wind: str = "평균풍속_m_s"
    max_wind: str = "최대풍속_m_s"
    cloud: str = "평균운량_1_10"
    sunshine: str = "합계_일조시간_hr"
    solar: str = "합계_일사량_MJ_m2"
    snow: str = "최심적설_cm"
    ground_temp: str = "평균지면온도_C"


def fix_meta(meta: DataFrame, station_name: str = "지점명", address: str = "지점주소",
             rule: tuple[str, str] = META_FIX) -> DataFrame:
    """O-32 as a one-rule table."""
    rules = Bounded.literal(meta.sparkSession, [rule], "match string, value string")
    return point_update(meta, rules, station_name, address)


def climate_transform(raw: DataFrame, meta: DataFrame, c: ClimateCols | None = None):
    """J-5: fix meta, prune single closed stations, drop mountain stations,
    clean both headers.  Returns (raw, meta)."""
    c = c or ClimateCols()
    m = fix_meta(meta, c.station_name, c.address)
    m = prune_single_closed(m, c.station, c.closed, CLOSED_CUTOFF)
    m = drop_contains(m, c.address, MOUNTAIN_MARKER)
    return clean_headers(raw), clean_headers(m)


def station_map(meta: DataFrame, alias: DataFrame, c: ClimateCols | None = None,
                order: str | None = None):
    """Meta -> (station, sd_code) plus the unmatched report (O-32, O-27, O-48,
    O-57, O-34a, O-39, O-28).

    ``keep='last'`` needs an order: by default the closing date with an open
    station (NULL) as the latest record; of equal closing dates the greatest
    address is the last, so that the result doesn't depend on row order.
    """
    c = c or ClimateCols()
    m = fix_meta(meta, c.station_name, c.address)
    if dict(m.dtypes)[c.station] == "string":  # CSV-landed meta: type the id like the raw side
        m = m.withColumn(c.station, strict_int(c.station, c.station))
    m = drop_contains(m, c.address, MOUNTAIN_MARKER)
    by = [order]
    if order is None:
        m = m.withColumn("_ord", F.coalesce(F.col(c.closed), F.lit("9999-12-31")))
        by = ["_ord", c.address]
    m = keep_last(m, c.station, by)
    m = m.withColumn("sd_raw", first_token(c.address))
    assert_unique(alias, ["sd_name_alias"], "sd_name_alias")
    mapped = lookup_join(m, alias, "sd_raw", "sd_name_alias", how="left")
    report = unmatched(mapped, "sd_code", [c.station, c.station_name, "sd_raw"])
    stations = mapped.select(c.station, "sd_code").dropna(subset=["sd_code"]) \
                     .withColumn("sd_code", F.col("sd_code").cast("int"))
    return stations, report


def climate_silver(raw: DataFrame, stations: DataFrame, std: DataFrame,
                   c: ClimateCols | None = None, columns: Sequence[str] = SILVER_COLUMNS,
                   text_columns: Sequence[str] = TEXT_COLUMNS) -> DataFrame:
    """J-6: 22 columns, typed, year/month, station -> province -> standard name."""
    c = c or ClimateCols()
    df = select_columns(raw, columns)
    df = df.withColumns({x: lenient_double(x) for x in columns if x not in text_columns})
    df = df.withColumn(c.station, strict_int(c.station, c.station))
    y, mth = year_month_parts(c.period)
    df = df.withColumns({"year": strict_int(y, "year"), "month": strict_int(mth, "month")})
    df = lookup_join(df, stations, c.station, how="inner")
    df = lookup_join(df, std, "sd_code", how="left")
    return rename(df, {"sd_name": "sd_name_std"})


def two_stage(df: DataFrame, station: str, group: Sequence[str], period: str,
              stage1: AggSpec, derive: dict | None, stage2: AggSpec,
              diffs: Sequence[tuple[str, str]] = (), complete_only: bool = False,
              month: str = "month", scale: int = 2, exact: bool = True) -> DataFrame:
    """Station-level aggregate, derived columns, province aggregate, row-based
    diffs over ``period`` (computed before rounding, S16), then every float
    column rounded half-to-even (S4).

    ``complete_only`` keeps station-periods holding all 12 months (O-31/O-35,
    D1); it is evaluated inside the station aggregate (a month bitmask), so no
    join back to the rows is needed.

    ``exact`` (default) sums decimals (:mod:`regiostat.functions.exact`), so
    results do not depend on row order; means, differences and the one rounding
    at the end are pandas' float arithmetic.  Standard deviations are plain
    double aggregates.  ``exact=False`` sums doubles (order-dependent in the
    last bits).
    """
    st = station_stage(df, station, group, period, stage1, derive, complete_only, month, exact)
    fact = province_stage(st, group, period, stage2, exact)
    for src_col, out in diffs:
        fact = diff(fact, [group[0]], [period], src_col, out)
    return round_float_columns(fact, scale)


def station_stage(df: DataFrame, station: str, group: Sequence[str], period: str, stage1: AggSpec,
                  derive: dict | None, complete_only: bool = False, month: str = "month",
                  exact: bool = True) -> DataFrame:
    """First stage of :func:`two_stage`: one row per station and period."""
    keys = [station, *group, period]
    src = df.dropna(subset=keys)
    extra = [month_bitmask_count(month).alias("_months")] if complete_only else []
    types = dict(src.dtypes)
    st = src.groupBy(*keys).agg(*[_stage_agg(types, fn, col, exact).alias(out) for out, fn, col in stage1], *extra)
    if complete_only:
        st = st.where(F.col("_months") == 12).drop("_months")
    return st.withColumns(derive) if derive else st


def province_stage(st: DataFrame, group: Sequence[str], period: str, stage2: AggSpec, exact: bool = True) -> DataFrame:
    """Second stage of :func:`two_stage`, before differences and rounding."""
    st = st.dropna(subset=[*group, period])
    types = dict(st.dtypes)
    return st.groupBy(*group, period).agg(*[_stage_agg(types, fn, col, exact, raw=False).alias(out)
                                            for out, fn, col in stage2])


def _stage_agg(types: dict, fn: str, col: str, exact: bool, raw: bool = True):
    """One named aggregate with pandas semantics (NaN is missing, an
    all-missing sum is 0).  ``raw`` inputs become doubles in exact mode."""
    c = q(col)
    if types[col] in ("double", "float"):
        c = f"(CASE WHEN NOT isnan({c}) THEN {c} END)"
    if exact and fn in ("mean", "sum"):
        total = mean_sql if fn == "mean" else sum_sql
        out = total(c, types[col], strict=raw)
        return F.expr(out if fn == "mean" else f"coalesce({out}, 0D)")
    if exact and raw and fn in ("max", "min"):
        return F.expr(f"CAST({fn}({c}) AS DOUBLE)")
    return F.expr({"mean": f"avg({c})", "max": f"max({c})", "min": f"min({c})",
                   "sum": f"coalesce(CAST(sum({c}) AS DOUBLE), 0D)", "std": f"stddev_samp({c})",
                   "count": f"count({c})", "size": "count(1)", "nunique": f"count(DISTINCT {c})"}[fn])


def fact_climate_trend(silver: DataFrame, c: ClimateCols | None = None,
                       complete_years_only: bool = True) -> DataFrame:
    """J-7 (province x year)."""
    c = c or ClimateCols()
    stage1 = [
        ("avg_temp", "mean", c.avg_temp), ("avg_max_temp", "mean", c.avg_max_temp),
        ("avg_min_temp", "mean", c.avg_min_temp), ("year_max_temp", "max", c.max_temp),
        ("year_min_temp", "min", c.min_temp), ("total_precip_mm", "sum", c.precip),
        ("avg_humidity_pct", "mean", c.humidity), ("avg_pressure_hpa", "mean", c.pressure),
        ("total_sunshine_hr", "sum", c.sunshine), ("avg_ground_temp", "mean", c.ground_temp),
    ]
    derive = {"avg_temp_range": F.col("avg_max_temp") - F.col("avg_min_temp")}
    stage2 = [
        ("avg_temp", "mean", "avg_temp"), ("avg_max_temp", "mean", "avg_max_temp"),
        ("avg_min_temp", "mean", "avg_min_temp"), ("year_max_temp", "max", "year_max_temp"),
        ("year_min_temp", "min", "year_min_temp"), ("total_precip_mm", "mean", "total_precip_mm"),
        ("avg_humidity_pct", "mean", "avg_humidity_pct"), ("avg_pressure_hpa", "mean", "avg_pressure_hpa"),
        ("total_sunshine_hr", "mean", "total_sunshine_hr"), ("avg_ground_temp", "mean", "avg_ground_temp"),
        ("avg_temp_range", "mean", "avg_temp_range"),
    ]
    return two_stage(silver, c.station, ["sd_code", "sd_name_std"], "year", stage1, derive, stage2,
                     diffs=[("avg_temp", "temp_yoy_diff")], complete_only=complete_years_only)


def fact_regional_compare(silver: DataFrame, c: ClimateCols | None = None) -> DataFrame:
    """J-8 (province x calendar month, over all years)."""
    c = c or ClimateCols()
    df = silver.withColumn("_daily_range", F.col(c.avg_max_temp) - F.col(c.avg_min_temp))
    stage1 = [
        ("avg_temp", "mean", c.avg_temp), ("avg_max_temp", "mean", c.avg_max_temp),
        ("avg_min_temp", "mean", c.avg_min_temp), ("avg_daily_range", "mean", "_daily_range"),
        ("avg_precip_mm", "mean", c.precip), ("precip_stddev", "std", c.precip),
        ("avg_humidity_pct", "mean", c.humidity), ("avg_wind_speed", "mean", c.wind),
        ("avg_cloud_cover", "mean", c.cloud), ("avg_sunshine_hr", "mean", c.sunshine),
        ("avg_solar_mj", "mean", c.solar), ("avg_ground_temp", "mean", c.ground_temp),
    ]
    stage2 = [(o, "mean", o) for o, _, _ in stage1]
    return two_stage(df, c.station, ["sd_code", "sd_name_std"], "month", stage1, None, stage2)


def fact_extreme_weather(silver: DataFrame, c: ClimateCols | None = None,
                         complete_years_only: bool = False) -> DataFrame:
    """J-9 (province x year)."""
    c = c or ClimateCols()
    stage1 = [
        ("year_max_temp", "max", c.max_temp), ("year_min_temp", "min", c.min_temp),
        ("max_daily_precip", "max", c.max_daily_precip), ("max_monthly_precip", "max", c.precip),
        ("total_precip_mm", "sum", c.precip), ("max_wind_speed", "max", c.max_wind),
        ("max_snowfall_cm", "max", c.snow),
    ]
    derive = {"year_temp_range": F.col("year_max_temp") - F.col("year_min_temp")}
    stage2 = [
        ("year_max_temp", "max", "year_max_temp"), ("year_min_temp", "min", "year_min_temp"),
        ("year_temp_range", "max", "year_temp_range"), ("max_daily_precip", "max", "max_daily_precip"),
        ("max_monthly_precip", "max", "max_monthly_precip"), ("total_precip_mm", "mean", "total_precip_mm"),
        ("max_wind_speed", "max", "max_wind_speed"), ("max_snowfall_cm", "max", "max_snowfall_cm"),
    ]
    return two_stage(silver, c.station, ["sd_code", "sd_name_std"], "year", stage1, derive, stage2,
                     diffs=[("max_daily_precip", "max_daily_precip_yoy_diff"),
                            ("year_max_temp", "max_temp_yoy_diff")],
                     complete_only=complete_years_only)
