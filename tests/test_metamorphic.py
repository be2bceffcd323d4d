"""Metamorphic checks: partitioning never changes results; with
one station per province the province fact equals the station fact."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL, have
from __spark_entry__ import queries
from regiostat.operators.projections import round_float_columns
from regiostat.plans.climate import two_stage

DETERMINISTIC = ["region_year_trend", "region_month_normals", "region_year_extremes", "acctbal_interpolate",
                 "weighted_merge", "power_silver", "profile", "keep_last_per_key", "station_prune"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.skipif(not have(SF_SMALL), reason="test tables absent")
@pytest.mark.parametrize("name", DETERMINISTIC)
def test_shuffle_partitions_do_not_change_results(spark, name):
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        out = []
        for n in ("3", "11"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            out.append(_rows(queries()[name](spark, SF_SMALL)))
        assert out[0] == out[1]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_single_station_province_equals_station_level(spark):
    # values on a quarter grid: every mean is exact in binary, so rounding is unambiguous
    rows = [(s, s * 10, "p", y, m, float(s * 100 + y % 7 + m / 4)) for s in range(1, 4)
            for y in (2001, 2002) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "st int, sd int, nm string, year int, month int, v double")
    spec1 = [("m", "mean", "v"), ("t", "sum", "v"), ("hi", "max", "v")]
    spec2 = [("m", "mean", "m"), ("t", "mean", "t"), ("hi", "max", "hi")]
    prov = two_stage(df, "st", ["sd", "nm"], "year", spec1, None, spec2)
    direct = df.groupBy("sd", "nm", "year").agg(F.avg("v").alias("m"), F.sum("v").alias("t"),
                                                F.max("v").alias("hi"))
    assert _rows(prov.select("sd", "nm", "year", "m", "t", "hi")) == _rows(round_float_columns(direct, 2))
