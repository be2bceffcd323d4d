"""Climate layers on a FIXTURES F4-F7 style fixture."""

import numpy as np
import pandas as pd
import pytest

from regiostat.functions.names import clean_column_name
from regiostat.plans.climate import (
    SILVER_COLUMNS, climate_silver, climate_transform, fact_climate_trend, fact_extreme_weather,
    fact_regional_compare, station_map,
)

RAW_HEADERS = {  # cleaned name -> raw CSV header
    "지점": "지점", "지점명": "지점명", "일시": "일시", "평균기온_C": "평균기온(°C)",
    "평균최고기온_C": "평균최고기온(°C)", "평균최저기온_C": "평균최저기온(°C)", "최고기온_C": "최고기온(°C)",
    "최저기온_C": "최저기온(°C)", "평균해면기압_hPa": "평균해면기압(hPa)", "평균수증기압_hPa": "평균수증기압(hPa)",
    "평균이슬점온도_C": "평균이슬점온도(°C)", "평균상대습도": "평균상대습도(%)",
    "월합강수량_00_24h만_mm": "월합강수량(00~24h만)(mm)", "일최다강수량_mm": "일최다강수량(mm)",
    "평균풍속_m_s": "평균풍속(m/s)", "최대풍속_m_s": "최대풍속(m/s)", "최다풍향_16방위": "최다풍향(16방위)",
    "평균운량_1_10": "평균운량(1/10)", "합계_일조시간_hr": "합계 일조시간(hr)",
    "합계_일사량_MJ_m2": "합계 일사량(MJ/m2)", "최심적설_cm": "최심적설(cm)", "평균지면온도_C": "평균지면온도(°C)",
}


# one rounding unit: summation order may move a value across a .xx5 boundary
TOL = 0.0100001


def pround(x, n=2):
    """pandas ``Series.round`` (scale, rint, unscale)."""
    return float(pd.Series([x]).round(n).iloc[0])


def test_headers_invert():
    assert all(clean_column_name(raw) == c for c, raw in RAW_HEADERS.items())
    assert list(RAW_HEADERS) == SILVER_COLUMNS


def _raw(spark):
    rng = np.random.default_rng(11)
    rows = []
    # station 101, 102 in 서울 (unequal row counts), 201 in 부산, 301 mountain, 401 unmapped
    plan = {101: [(2000, m) for m in range(1, 13)] + [(2001, m) for m in range(1, 13)],
            102: [(2000, m) for m in range(1, 12)],
            201: [(2000, m) for m in range(1, 13)] + [(2001, m) for m in range(1, 13)],
            301: [(2000, 1)], 401: [(2000, 1)], 501: [(2000, 1)]}
    for st, months in plan.items():
        for y, m in months:
            vals = {c: f"{rng.normal(10, 5):.1f}" for c in SILVER_COLUMNS[3:]}
            vals["최다풍향_16방위"] = "NW"
            if st == 102:
                vals["평균기온_C"] = f"{30 + rng.normal(0, 1):.1f}"
                vals["월합강수량_00_24h만_mm"] = ""      # all precipitation missing -> sum 0 (S2)
                vals["최저기온_C"] = "x"                  # bad numeric
            rows.append({"지점": str(st), "지점명": f"st{st}", "일시": f"{y}-{m:02d}", **vals})
    pdf = pd.DataFrame(rows)[SILVER_COLUMNS].rename(columns=RAW_HEADERS)
    pdf["extra col(x)"] = "1"
    return spark.createDataFrame(pdf.astype(str))


def _meta(spark):
    rows = [(101, "서울", "서울특별시 종로구", None), (102, "관악", "　서울특별시 관악구", "2010-01-01"),
            (201, "부산", "부산광역시 중구", None), (301, "산", "강원도 (산지)", None),
            (401, "섬", "독도 울릉", None), (501, "서청주(예)", None, None),
            (601, "폐쇄", "경기도 어딘가", "1999-12-31"),
            (102, "관악", "서울특별시 관악구", None)]
    return spark.createDataFrame(rows, "`지점` int, `지점명` string, `지점주소` string, `종료일` string")


def _lookups(spark):
    alias = spark.createDataFrame([("서울특별시", 11), ("서울", 11), ("부산광역시", 26), ("충청북도", 43)],
                                  "sd_name_alias string, sd_code int")
    std = spark.createDataFrame([(11, "서울특별시"), (26, "부산광역시")], "sd_code int, sd_name string")
    return alias, std


def _silver(spark):
    raw, meta = climate_transform(_raw(spark), _meta(spark))
    alias, std = _lookups(spark)
    stations, report = station_map(meta, alias)
    return climate_silver(raw, stations, std), stations, report, meta


def test_transform_and_station_map(spark):
    raw, meta = climate_transform(_raw(spark), _meta(spark))
    assert "extra_col_x" in raw.columns and "평균기온_C" in raw.columns
    ids = sorted(r["지점"] for r in meta.collect())
    assert 601 not in ids and 301 not in ids and ids.count(102) == 2
    silver, stations, report, _ = _silver(spark)
    st = {r["지점"]: r.sd_code for r in stations.collect()}
    assert st == {101: 11, 102: 11, 201: 26, 501: 43}
    assert sorted(r["지점"] for r in report.collect()) == [401]
    cols = set(silver.columns)
    assert {"year", "month", "sd_code", "sd_name_std"} <= cols
    s = silver.toPandas()
    assert set(s["지점"]) == {101, 102, 201, 501} and s[s["지점"] == 501].sd_name_std.isna().all()
    assert s[s["지점"] == 102]["최저기온_C"].isna().all()


def _pandas_two_stage(s, keys2, stage1, stage2):
    s = s.dropna(subset=["sd_name_std"])
    st = s.groupby(["지점", "sd_code", "sd_name_std", keys2]).agg(**stage1).reset_index()
    return st


def test_fact_trend_mean_of_means(spark):
    silver, *_ = _silver(spark)
    fact = fact_climate_trend(silver, complete_years_only=False).toPandas().set_index(["sd_code", "year"])
    s = silver.toPandas()
    s = s[s.sd_name_std.notna()]
    st = s.groupby(["지점", "year"]).agg(t=("평균기온_C", "mean"), p=("월합강수량_00_24h만_mm", "sum"))
    seoul00 = st.loc[[(101, 2000), (102, 2000)]]
    assert fact.loc[(11, 2000), "avg_temp"] == pytest.approx(pround(seoul00.t.mean(), 2), abs=TOL)
    raw_mean = s[(s.sd_code == 11) & (s.year == 2000)]["평균기온_C"].mean()
    assert abs(seoul00.t.mean() - raw_mean) > 0.1  # two-stage differs from one mean
    assert fact.loc[(11, 2000), "total_precip_mm"] == pytest.approx(pround(seoul00.p.mean(), 2), abs=TOL)
    assert np.isnan(fact.loc[(11, 2000), "temp_yoy_diff"])
    t = fact.loc[(11, 2001), "avg_temp"]
    assert fact.loc[(11, 2001), "temp_yoy_diff"] == pytest.approx(
        pround(st.loc[[(101, 2001)]].t.mean() - seoul00.t.mean(), 2), abs=TOL)
    complete = fact_climate_trend(silver, complete_years_only=True).toPandas().set_index(["sd_code", "year"])
    # station 102 has 11 months in 2000: only 101 remains for Seoul
    assert complete.loc[(11, 2000), "avg_temp"] == pytest.approx(pround(st.loc[(101, 2000)].t, 2), abs=TOL)


def test_fact_compare_and_extreme(spark):
    silver, *_ = _silver(spark)
    cmp_ = fact_regional_compare(silver).toPandas()
    assert len(cmp_) == 12 + 12  # Seoul and Busan, 12 months each
    s = silver.toPandas()
    s = s[s.sd_name_std.notna()]
    jan = s[(s.month == 1) & (s.sd_code == 26)]
    assert cmp_[(cmp_.sd_code == 26) & (cmp_.month == 1)].precip_stddev.iloc[0] == pytest.approx(
        pround(jan["월합강수량_00_24h만_mm"].std(), 2), abs=TOL)
    ext = fact_extreme_weather(silver).toPandas().set_index(["sd_code", "year"])
    st = s.groupby(["지점", "sd_code", "year"]).agg(mx=("최고기온_C", "max"), mn=("최저기온_C", "min"))
    st["rg"] = st.mx - st.mn
    exp_rg = st.xs((11, 2000), level=("sd_code", "year")).rg.max()
    assert ext.loc[(11, 2000), "year_temp_range"] == pytest.approx(pround(exp_rg, 2), abs=TOL)
    assert np.isnan(ext.loc[(26, 2000), "max_temp_yoy_diff"])
