"""Exact sums, pandas rounding and order independence of two-stage facts."""

import math

import numpy as np
import pandas as pd
import pytest

from regiostat.operators.corrections import weighted_merge
from regiostat.plans.climate import two_stage


def _mean(spark, values, dtype="double", **kw):
    df = spark.createDataFrame([(i, 1, "p", 2000, 1, v) for i, v in enumerate(values)],
                               f"st int, sd int, nm string, year int, month int, v {dtype}")
    spec = [("m", "mean", "v")]
    return two_stage(df, "st", ["sd", "nm"], "year", spec, None, [("m", "mean", "m")], **kw).collect()[0].m


@pytest.mark.parametrize("values", [[0.57, 0.58], [1.005], [2.5, 2.51], [0.125, 0.135], [-0.57, -0.58]])
def test_ties_round_as_in_pandas(spark, values):
    assert _mean(spark, values) == pd.Series(values).mean().round(2)


def test_tie_of_the_review(spark):
    assert _mean(spark, [0.57, 0.58]) == 0.57


def test_small_values_survive(spark):
    assert _mean(spark, [4e-7, 4e-7], scale=9) == 4e-7


@pytest.mark.parametrize("values", [[1e40, 1.0], [1.2345e-17, 2e-17], [math.inf, 1.0], [9e19, 9e19, 9e19], [-math.inf, None]])
def test_values_that_do_not_fit_follow_pandas(spark, values):
    got, want = _mean(spark, values, scale=25 if values[0] < 1 else 2), pd.Series(values, dtype=float).mean()
    assert got == want or got == pytest.approx(want, rel=1e-12)


def test_one_group_that_does_not_fit_leaves_others_exact(spark):
    rows = [(0, 1, "p", 2000, 1, 1e40), (0, 2, "q", 2000, 1, 0.57), (1, 2, "q", 2000, 1, 0.58)]
    df = spark.createDataFrame(rows, "st int, sd int, nm string, year int, month int, v double")
    out = two_stage(df, "st", ["sd", "nm"], "year", [("m", "mean", "v"), ("t", "sum", "v")], None,
                    [("m", "mean", "m"), ("t", "sum", "t")]).collect()
    assert {r.sd: (r.m, r.t) for r in out} == {1: (1e40, 1e40), 2: (0.57, 1.15)}


def test_nan_is_missing(spark):
    assert _mean(spark, [math.nan, 2.0, None, 4.0]) == 3.0
    assert _mean(spark, [math.nan, None]) is None


def test_integers(spark):
    assert _mean(spark, [1, 2], "long") == 1.5


def test_two_stage_independent_of_partitioning(spark):
    rng = np.random.default_rng(9)
    rows = [(int(s), int(s % 3), "p", int(y), int(m), float(round(rng.normal(100, 30), 2)))
            for s in range(12) for y in (2000, 2001) for m in range(1, 13)]
    df = spark.createDataFrame(rows, "st int, sd int, nm string, year int, month int, v double")
    spec1 = [("m", "mean", "v"), ("t", "sum", "v"), ("hi", "max", "v"), ("dev", "std", "v")]
    spec2 = [("m", "mean", "m"), ("t", "mean", "t"), ("hi", "max", "hi"), ("dev", "mean", "dev")]
    outs = []
    for n in (1, 3, 7):
        f = two_stage(df.repartition(n), "st", ["sd", "nm"], "year", spec1, None, spec2,
                      diffs=[("m", "m_diff")])
        outs.append(sorted(tuple(r) for r in f.collect()))
    assert outs[0] == outs[1] == outs[2]
    want = pd.DataFrame(rows, columns=["st", "sd", "nm", "year", "month", "v"]).groupby(["sd", "year", "st"]).v.mean()
    want = want.groupby(["sd", "year"]).mean().round(2)
    assert all(abs(r[3] - want[r[0], r[2]]) < 1e-9 for r in outs[0])


def test_weighted_merge_keeps_small_values(spark):
    df = spark.createDataFrame([("a", 1, 4e-7, 1), ("a", 1, 4e-7, 3), ("a", 1, math.nan, 2)], "nm string, g int, v double, w long")
    got = weighted_merge(df, "nm", "a", "all", ["g"], "w", ["v"]).collect()[0]
    assert got.v == pytest.approx(1.6e-6 / 6, rel=1e-12) and got.w == 6
