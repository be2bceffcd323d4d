"""Power layers on a FIXTURES F1-F3 style fixture with the planted traps."""

import json

import numpy as np
import pytest

from regiostat.operators.ingest import (
    FIRST_MONTH, LAST_MONTH, REGION_CODES, next_period, retry_queue, slot_grid,
)
from regiostat.plans.power import SilverParams, bronze_ingest, power_fact, power_silver
from regiostat.session import scratch_path
from regiostat.sources.landing import read_landing

SCHEMA = ("id long, sd_code int, year int, month int, sd_name string, sgg_name string, "
          "house_cnt long, power_usage double, bill long")


def _bronze(spark):
    rows = []
    i = 0

    def add(sd, sdn, sgg, y, m, h, p, b):
        nonlocal i
        i += 1
        rows.append((i, sd, y, m, sdn, sgg, h, p, b))

    for m in (1, 2):  # three districts of one city: a negative value, zero households
        add(41, "경기도", "부천시 원미구", 2020, m, 100, 300.0, 40000)
        add(41, "경기도", "부천시 소사구", 2020, m, 300, -1.0 if m == 1 else 200.0, 30000)
        add(41, "경기도", "부천시 오정구", 2020, m, 0, 500.0, 50000)
    for y in (2014, 2015):  # override county
        for m in (1, 2, 3):
            add(46, "전라남도", "영암군", y, m, 50, 100.0 * y / 2014 + m, 1000 * m)
    # gaps: leading, interior of 2, trailing (negative -> NULL)
    series = [-5.0, 10.0, -1.0, -1.0, 40.0, 50.0, -3.0]
    for k, v in enumerate(series, start=1):
        add(11, "서울특별시", "종로구", 2021, k, 10, v, 100 * k)
    return spark.createDataFrame(rows, SCHEMA)


def test_power_silver(spark):
    out = power_silver(_bronze(spark)).toPandas()
    bu = out[out.sgg_name == "부천시"].sort_values("month")
    # negatives are nulled after the merge (S21): month 1 keeps -1 in the weighted mean
    exp1 = (300.0 * 100 + -1.0 * 300 + 500.0 * 0) / 400
    assert bu.power_usage.tolist()[0] == pytest.approx(round(exp1, 2))
    assert bu.house_cnt.tolist() == [400, 400]
    assert bu.bill.tolist() == [32500.0, 32500.0]
    assert sorted(bu.id.tolist()) == [int(_bronze(spark).toPandas().id.max()) + 1,
                                      int(_bronze(spark).toPandas().id.max()) + 2]
    assert not out.sgg_name.str.contains("부천시 ").any()
    ya = out[(out.sgg_name == "영암군")].set_index(["year", "month"]).sort_index()
    assert ya.loc[(2015, 1), "power_usage"] == ya.loc[(2014, 1), "power_usage"]
    assert ya.loc[(2015, 2), "bill"] == ya.loc[(2014, 2), "bill"]
    assert ya.loc[(2015, 3), "power_usage"] == pytest.approx(100.0 * 2015 / 2014 + 3)
    jr = out[out.sgg_name == "종로구"].sort_values("month").power_usage.tolist()
    assert np.isnan(jr[0]) and jr[1:] == [10.0, 20.0, 30.0, 40.0, 50.0, 50.0]


def test_power_silver_clean_before_merge(spark):
    out = power_silver(_bronze(spark), SilverParams(clean_before_merge=True)).toPandas()
    bu = out[(out.sgg_name == "부천시") & (out.month == 1)]
    assert bu.power_usage.iloc[0] == pytest.approx(300.0 * 100 / 400)


def test_power_fact(spark):
    rows = [(1, 11, y, m, "서울특별시", "종로구", 10, float(u), 1000)
            for (y, m, u) in [(2020, 7, 0.0), (2020, 8, 5.0), (2020, 11, 10.0), (2021, 1, 20.0)]]
    fact = power_fact(spark.createDataFrame(rows, SCHEMA)).toPandas().sort_values(["year", "month"])
    assert fact.season.tolist() == ["여름", "여름", "겨울", "겨울"]
    assert fact.season_tariff.tolist() == ["하계", "하계", "기타", "기타"]
    assert fact.quarter.tolist() == [3, 3, 4, 1]
    assert np.isnan(fact.unit_price.iloc[0]) and fact.unit_price.iloc[1] == 200.0
    mom = fact.usage_mom_pct.tolist()
    assert np.isnan(mom[0]) and np.isnan(mom[1]) and mom[2:] == [100.0, 100.0]  # 0 base -> NULL
    assert fact.total_usage_kwh.tolist() == [0.0, 50.0, 100.0, 200.0]
    assert "id" not in fact.columns and fact.usage_yoy_pct.isna().all()


def test_slot_grid_reference_bounds(spark):
    regions = spark.createDataFrame([(r,) for r in REGION_CODES], "code string")
    grid = slot_grid(regions, "code", FIRST_MONTH, LAST_MONTH)
    assert grid.count() == 151 * 17
    assert grid.agg({"sd_code": "min"}).first()[0] == 11


def _land(spark, path, payloads):
    import os
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    with open(f"{path.replace('file:', '')}/part-0.json", "w", encoding="utf-8") as f:
        for p in payloads:
            f.write(json.dumps(p, ensure_ascii=False) + "\n")


def _row(y, m, city, h, u, b):
    return {"year": str(y), "month": f"{m:02d}", "metro": "서울특별시", "city": city,
            "houseCnt": h, "powerUsage": u, "bill": b}


def test_bronze_ingest_slot_atomicity(spark):
    path = scratch_path(spark, "test-landing")
    _land(spark, path, [
        {"year": "2020", "month": "01", "metroCd": "11", "data": [_row(2020, 1, "종로구", "10", "1.5", "100"),
                                                                   _row(2020, 1, "중구", "20", "2.5", "200")]},
        {"year": "2020", "month": "02", "metroCd": "11", "data": [_row(2020, 2, "종로구", "x", "1.5", "100"),
                                                                   _row(2020, 2, "중구", "20", "2.5", "200")]},
        {"year": "2020", "month": "03", "metroCd": "11", "data": []},
        {"year": "2020", "month": "04", "metroCd": "11"},
        {"year": "2020", "month": "05", "metroCd": "11", "data": [_row(2020, 5, "종로구", "1", "1", "1")]},
    ])
    landed = read_landing(spark, path)
    existing = spark.createDataFrame([(2020, 5, 11)], "year int, month int, sd_code int")
    good, rejected = bronze_ingest(spark, landed, existing)
    g = good.toPandas()
    assert sorted(g.sgg_name) == ["종로구", "중구"] and set(g.month) == {1}
    r = rejected.toPandas()
    assert len(r) == 2 and set(r.month) == {2} and "invalid value" in set(r.reason)
    assert g.dtypes["house_cnt"] == np.int64 and g.power_usage.tolist() != []


def test_bronze_ingest_faulty_responses(spark):
    """A bad year, a response cut off in the middle, one without its request key, a slot landed twice."""
    path = scratch_path(spark, "test-landing")
    good = {"year": "2020", "month": "01", "metroCd": "11", "data": [_row(2020, 1, "종로구", "10", "1.5", "100"),
                                                                      _row(2020, 1, "중구", "20", "2.5", "200")]}
    bad_year = {"year": "2020", "month": "02", "metroCd": "11", "data": [_row("bad", 2, "종로구", "10", "1.5", "100"),
                                                                          _row(2020, 2, "중구", "20", "2.5", "200")]}
    no_year = {"month": "03", "metroCd": "11", "data": [_row(2020, 3, "종로구", "10", "1.5", "100")]}
    mended = {**bad_year, "data": bad_year["data"][1:]}
    _land(spark, path, [good, bad_year, good, no_year, mended])
    cut = json.dumps({**good, "month": "04"}, ensure_ascii=False)[:70]
    with open(f"{path.replace('file:', '')}/part-1.json", "w", encoding="utf-8") as f:
        f.write(json.dumps(good, ensure_ascii=False) + "\n" + cut + "\n")
    rows, rejected = bronze_ingest(spark, read_landing(spark, path), None)
    assert sorted((r.year, r.month, r.sgg_name) for r in rows.collect()) == [
        (2020, 1, "종로구"), (2020, 1, "중구"), (2020, 2, "중구")]
    r = rejected.collect()
    assert sorted((x.month or 0, x.reason) for x in r) == [
        (0, "unreadable response"), (2, "invalid value"), (2, "slot rejected"), (3, "invalid value")]
    assert [x.unreadable for x in r if x.unreadable] == [cut]


def test_retry_and_next_period(spark):
    fails = spark.createDataFrame([(2020, 1, 11)] * 10 + [(2020, 2, 11)] * 3, "year int, month int, sd_code int")
    got = {r.month: (r.attempts, r.status) for r in retry_queue(fails, ["year", "month", "sd_code"]).collect()}
    assert got == {1: (10, "dead_letter"), 2: (3, "retry")}
    col = spark.createDataFrame([(2025, 11, 11), (2025, 12, 11), (2024, 3, 26)], "year int, month int, sd_code int")
    nxt = {r.sd_code: (r.next_year, r.next_month) for r in next_period(col, ["sd_code"]).collect()}
    assert nxt == {11: (2026, 1), 26: (2024, 4)}
