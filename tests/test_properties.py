"""Property-based checks (hypothesis) against pandas on random small inputs."""

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regiostat.operators.aggregates import profile
from regiostat.operators.timeseries import interpolate_linear

SETTINGS = settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))


@st.composite
def series(draw):
    n = draw(st.integers(1, 40))
    keys = draw(st.lists(st.sampled_from([0, 1, 2, None]), min_size=n, max_size=n))
    vals = draw(st.lists(st.one_of(st.none(), st.integers(-50, 50).map(float)), min_size=n, max_size=n))
    width = draw(st.integers(1, 9))
    return keys, vals, width


@SETTINGS
@given(series())
def test_interpolation_blocked_plain_pandas_agree(spark, data):
    keys, vals, width = data
    rows = [(k, i, v) for i, (k, v) in enumerate(zip(keys, vals))]
    df = spark.createDataFrame(rows, "k int, t int, v double")
    plain = {r.t: r.v for r in interpolate_linear(df, ["k"], ["t"], ["v"]).collect()}
    blocked = {r.t: r.v for r in interpolate_linear(df, ["k"], ["t"], ["v"],
                                                    block=F.floor(F.col("t") / width)).collect()}
    pdf = pd.DataFrame(rows, columns=["k", "t", "v"]).astype({"v": float})
    exp = pdf.groupby("k", dropna=True)["v"].transform(lambda x: x.interpolate())
    want = {t: (None if pd.isna(e) else float(e)) for t, e in zip(pdf.t, exp)}
    assert plain == blocked
    for t, e in want.items():
        g = plain[t]
        assert (g is None and e is None) or (g is not None and e is not None and abs(g - e) < 1e-9), (t, g, e)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.integers(-1000, 1000).map(lambda x: x / 4)), min_size=1, max_size=60))
def test_profile_matches_describe(spark, vals):
    pdf = pd.DataFrame({"x": pd.Series(vals, dtype=float)})
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    r = profile(df, ["x"], partitions=3, cut_lineage=False).first()
    s = pdf["x"].dropna()
    if s.empty:
        assert r is None or r["count"] in (None, 0)
        return
    d = s.describe()
    assert r["count"] == d["count"] and r.n_distinct == s.nunique()
    for k, q in [("min", "min"), ("p25", "25%"), ("p50", "50%"), ("p75", "75%"), ("max", "max")]:
        assert r[k] == d[q], (k, r[k], d[q])
    assert r.mean == d["mean"] or abs(r.mean - d["mean"]) < 1e-9
    if len(s) > 1:
        assert abs(r["std"] - d["std"]) < 1e-6


def _exact_sum(values):
    """Sum of the decimal texts, as a float: what the order of rows cannot change."""
    from decimal import Decimal
    return float(sum(Decimal(repr(v)).quantize(Decimal(1).scaleb(-18)) for v in values))


@st.composite
def station_data(draw):
    n = draw(st.integers(1, 30))
    rows = []
    for _ in range(n):
        st_id = draw(st.integers(1, 4))
        year = draw(st.sampled_from([2000, 2001]))
        v = draw(st.one_of(st.none(), st.integers(-5000, 5000).map(lambda x: x / 100)))
        rows.append((st_id, st_id % 2, year, v))
    return rows


@SETTINGS
@given(station_data())
def test_two_stage_matches_float_means(spark, rows):
    from regiostat.plans.climate import two_stage
    df = spark.createDataFrame(rows, "st int, sd int, year int, v double").withColumn("nm", F.lit("p"))
    spec1 = [("m", "mean", "v"), ("t", "sum", "v"), ("hi", "max", "v")]
    spec2 = [("m", "mean", "m"), ("t", "mean", "t"), ("hi", "max", "hi")]
    got = {(r.sd, r.year): (r.m, r.t, r.hi) for r in
           two_stage(df, "st", ["sd", "nm"], "year", spec1, None, spec2).collect()}
    stations = {}
    for s_, sd, y, v in rows:
        stations.setdefault((sd, y, s_), []).append(v)
    prov = {}
    for (sd, y, _), vals in stations.items():
        has = [v for v in vals if v is not None]
        prov.setdefault((sd, y), []).append((_exact_sum(has) / len(has) if has else None, _exact_sum(has) if has else 0.0,
                                             max(has, default=None)))
    for key, parts in prov.items():
        means = [p[0] for p in parts if p[0] is not None]
        highs = [p[2] for p in parts if p[2] is not None]
        want = (_exact_sum(means) / len(means) if means else None, _exact_sum([p[1] for p in parts]) / len(parts),
                max(highs, default=None))
        want = tuple(None if w is None else round(w * 100) / 100 for w in want)
        assert got[key] == want, (key, got[key], want)
