"""Scalar functions against pandas behaviour (S4, S11, S12, S19, D9)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regiostat.functions import (
    clean_column_name, first_token, lenient_double, quarter_of, round_half_even, season_of,
    strict_int, tariff_of, year_month_parts, zero_pad, code_prefix, inf_to_null,
)


def test_round_half_even_matches_pandas(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.uniform(-1000, 1000, 2000).round(3), [0.125, 0.285, 2.5, -0.125, 1.005]])
    df = spark.createDataFrame(pd.DataFrame({"x": vals}))
    got = df.select(round_half_even("x", 2).alias("r")).toPandas()["r"].to_numpy()
    exp = pd.Series(vals).round(2).to_numpy()
    assert np.array_equal(got, exp)
    z = df.select(round_half_even("x", 0).alias("r")).toPandas()["r"].to_numpy()
    assert np.array_equal(z, pd.Series(vals).round(0).to_numpy())


def test_round_examples(spark):
    row = spark.range(1).select(round_half_even(F.lit(0.125), 2).alias("a"),
                                round_half_even(F.lit(0.285), 2).alias("b")).first()
    assert (row.a, row.b) == (0.12, 0.28)


def test_lenient_double_matches_to_numeric(spark):
    raw = ["12", " 3.5 ", "-4e2", ".5", "x", "", None, "1.0d", "NaN", "Infinity", "1,000", "7."]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r.v for r in df.select(lenient_double("s").alias("v")).collect()]
    exp = pd.to_numeric(pd.Series(raw, dtype=object), errors="coerce")
    exp = [None if pd.isna(v) else float(v) for v in exp]
    # pandas reads 'NaN' as NaN (missing) and 'Infinity' as inf; both are not data here
    exp = [None if (v is not None and not np.isfinite(v)) else v for v in exp]
    assert got == exp


def test_strict_int_raises_on_null(spark):
    df = spark.createDataFrame([("1",), (None,)], "s string")
    with pytest.raises(Exception):
        df.select(strict_int("s", "s")).collect()
    with pytest.raises(Exception):
        spark.createDataFrame([("x",)], "s string").select(strict_int("s")).collect()
    assert spark.createDataFrame([("12",)], "s string").select(strict_int("s").alias("v")).first().v == 12


def test_first_token_unicode_blanks(spark):
    raw = ["서울특별시 종로구", "　충청북도 청주시", "  경기도", "", "   ", None, "강원도　춘천시"]
    df = spark.createDataFrame([(r,) for r in raw], "s string")
    got = [r.t for r in df.select(first_token("s").alias("t")).collect()]
    exp = pd.Series(raw, dtype=object).str.split().str[0]
    exp = [None if (isinstance(v, float) or v is None) else v for v in exp]
    assert got == exp


def test_calendar_maps(spark):
    df = spark.range(1, 13).select(F.col("id").cast("int").alias("m"))
    rows = df.select("m", quarter_of("m").alias("q"), season_of("m").alias("s"),
                     tariff_of("m").alias("t"), zero_pad("m").alias("p")).orderBy("m").collect()
    assert [r.q for r in rows] == [(m - 1) // 3 + 1 for m in range(1, 13)]
    assert rows[10].s == "겨울" and rows[6].s == "여름" and rows[3].s == "봄" and rows[8].s == "가을"
    assert [r.t for r in rows if r.t == "하계"] == ["하계", "하계"] and rows[6].t == "하계"
    assert rows[0].p == "01" and rows[11].p == "12"
    assert spark.range(1).select(season_of(F.lit(13)).alias("s")).first().s is None


def test_year_month_and_prefix(spark):
    df = spark.createDataFrame([("2000-01", "1100000000")], "ym string, code string")
    y, m = year_month_parts("ym")
    r = df.select(y.alias("y"), m.alias("m"), code_prefix("code").alias("c")).first()
    assert (r.y, r.m, r.c) == (2000, 1, "11")


def test_inf_to_null(spark):
    df = spark.createDataFrame([(float("inf"),), (float("-inf"),), (float("nan"),), (1.5,)], "x double")
    assert [r.v for r in df.select(inf_to_null("x").alias("v")).collect()] == [None, None, None, 1.5]


@pytest.mark.parametrize("name,exp", [
    ("평균기온(°C)", "평균기온_C"),
    ("월합강수량(00~24h만)(mm)", "월합강수량_00_24h만_mm"),
    ("평균풍속(m/s)", "평균풍속_m_s"),
    ("평균운량(1/10)", "평균운량_1_10"),
    ("합계 일사량(MJ/m2)", "합계_일사량_MJ_m2"),
    ("최다풍향(16방위)", "최다풍향_16방위"),
    ("평균상대습도(%)", "평균상대습도"),
    ("지점", "지점"),
])
def test_clean_column_name(name, exp):
    assert clean_column_name(name) == exp
