"""Growing series, mergeable profiles, checked CSV, clustered files, stream metrics."""

import glob
import os

import numpy as np
import pandas as pd
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from regiostat.operators.aggregates import profile
from regiostat.operators.series_store import SeriesStore
from regiostat.operators.sketches import (
    DISTINCT_ERROR, RANK_ERROR, profile_of, stored_sketches, update_profile,
)
from regiostat.operators.timeseries import interpolate_linear
from regiostat.session import scratch_path
from regiostat.sources.landing import csv_headers, read_csv_checked, unparsed_values
from regiostat.sources.layout import file_ranges, range_bounds, range_rank, write_clustered, z_value
from regiostat.streaming.metrics import MetricsListener, batch_metrics, observed

# --------------------------------------------------------- growing series
SERIES = "k string, t long, v double, block long"


def series_rows(seed, n=60, missing=.5):
    rng = np.random.default_rng(seed)
    rows = []
    for k in ("a", "b", "only gaps", "ends in a gap", None):
        for t in range(n):
            gap = rng.random() < missing or k == "only gaps" or (k == "ends in a gap" and t > n // 3)
            rows.append((k, t, None if gap else float(rng.integers(0, 100)), t // 5))
    return rows


def rows_of(df):
    return sorted(((r.k or "", r.t, r.v) for r in df.collect()), key=str)


@pytest.mark.parametrize("cuts", [[60], [1, 2, 30, 60], [20, 40, 60], [7, 8, 9, 33, 34, 60]])
def test_appends_equal_one_pass(spark, cuts):
    rows = series_rows(len(cuts))
    whole = spark.createDataFrame(rows, SERIES)
    store = SeriesStore(spark, scratch_path(spark, "series-test"), whole.schema, ["k"], "t", "v")
    low = 0
    for n, high in enumerate(cuts):
        part = [r for r in rows if low <= r[1] < high]
        store.append(spark.createDataFrame(part, SERIES), f"run{n}")
        upto = spark.createDataFrame([r for r in rows if r[1] < high], SERIES)
        assert rows_of(store.read()) == rows_of(interpolate_linear(upto, ["k"], ["t"], ["v"]))
        low = high
    assert store.append(whole, "run0") is None  # committed already


def test_only_affected_blocks_are_read_and_written(spark):
    store = SeriesStore(spark, scratch_path(spark, "series-blocks"), spark.createDataFrame([], SERIES).schema, ["k"], "t", "v")
    one = [("a", t, 1.0 if t != 12 else None, t // 5) for t in range(40)] + [("b", t, 1.0 if t < 22 else None, t // 5) for t in range(40)]
    assert store.append(spark.createDataFrame(one, SERIES), "one") == list(range(8))

    def stamps():
        return {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{store.root}/rows/**/*.parquet".replace("file:", ""), recursive=True)}

    before = stamps()
    assert store.append(spark.createDataFrame([("a", 40, 2.0, 8)], SERIES), "two") == [8]  # b's gap stays open
    assert {f: t for f, t in stamps().items() if f in before} == before
    assert store.append(spark.createDataFrame([("b", 43, 5.0, 8)], SERIES), "three") == [4, 5, 6, 7, 8]
    assert {f for f in before if f in stamps()} == {f for f in before if any(f"block={b}/" in f for b in range(4))}
    got = {r.t: r.v for r in store.read().where("k = 'b'").collect()}
    # 21 holds 1.0, then 18 rows are missing, then 5.0: nineteen steps by position
    assert got[22] == pytest.approx(1 + 4 / 19) and got[39] == pytest.approx(1 + 4 * 18 / 19) and got[43] == 5.0


def test_lost_append_is_replayed(spark, monkeypatch):
    rows = series_rows(9, 20)
    whole = spark.createDataFrame(rows, SERIES)
    store = SeriesStore(spark, scratch_path(spark, "series-lost"), whole.schema, ["k"], "t", "v")
    store.append(whole.where("t < 8"), "one")
    from regiostat.operators import series_store
    real = series_store.write_run
    monkeypatch.setattr(series_store, "write_run", lambda *a: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        store.append(whole.where("t >= 8 AND t < 15"), "two")
    monkeypatch.setattr(series_store, "write_run", real)
    store.append(whole.where("t >= 8 AND t < 15"), "two")
    store.append(whole.where("t >= 15"), "three")
    assert rows_of(store.read()) == rows_of(interpolate_linear(whole, ["k"], ["t"], ["v"]))
    with pytest.raises(ValueError, match="before the end"):
        store.append(spark.createDataFrame([("a", 3, 1.0, 0)], SERIES), "late")


# ------------------------------------------------------ mergeable profiles
def test_sketched_profile_against_the_exact_one(spark):
    rng = np.random.default_rng(2)
    n = 40_000
    df = pd.DataFrame({"part": rng.integers(0, 7, n), "normal": rng.normal(1e6, 3, n), "few": rng.integers(0, 5, n).astype(float),
                       "skew": np.exp(rng.normal(0, 3, n)), "gaps": np.where(rng.random(n) < .3, np.nan, rng.random(n))})
    data = spark.createDataFrame(df).withColumns({"none": F.lit(None).cast("double"), "part": F.col("part").cast("int")})
    cols = ["normal", "few", "skew", "gaps", "none"]
    path = scratch_path(spark, "sketch-test")
    update_profile(data.where("part < 4").withColumn("few", F.lit(99.0)), path, cols, ["part"])
    files = set(glob.glob(f"{path}/part=*/*"))
    update_profile(data.where("part = 0 OR part > 3"), path, cols, ["part"])
    assert {f for f in files if "part=0/" not in f} <= set(glob.glob(f"{path}/part=*/*"))  # other partitions are not rewritten
    update_profile(data.where("part > 0 AND part < 4"), path, cols, ["part"])
    by = StructType([data.schema["part"]])
    got = {r["column"]: r for r in profile_of(stored_sketches(spark, path, by)).collect()}
    want = {r["column"]: r for r in profile(data, cols).collect()}
    for c in cols:
        g, w = got[c], want[c]
        assert (g["count"], g["min"], g["max"]) == (w["count"], w["min"], w["max"])
        if not w["count"]:
            assert g["mean"] is None and g["n_distinct"] == 0 and g["p50"] is None
            continue
        assert g["mean"] == pytest.approx(w["mean"], rel=1e-9) and g["std"] == pytest.approx(w["std"], rel=1e-6)
        assert abs(g["n_distinct"] - w["n_distinct"]) <= max(1, DISTINCT_ERROR * w["n_distinct"])
        values = np.sort(df[c].dropna())
        for tag, q in (("p25", .25), ("p50", .5), ("p75", .75)):
            low, high = np.searchsorted(values, g[tag], "left") / len(values), np.searchsorted(values, g[tag], "right") / len(values)
            assert low - 2 * RANK_ERROR <= q <= high + 2 * RANK_ERROR


# ------------------------------------------------------------ checked CSV
def test_checked_csv(spark):
    folder = scratch_path(spark, "csv-checked").replace("file:", "") + "/in"
    os.makedirs(folder)
    texts = {
        "a.csv": "지점,지점명,일시\n1,서울,2000-01\n2,\"부산, 남\",2000-02\n3\n4,x,2000-04,zu viel\n5,,\n",
        "b.csv": "일시,지점,비고\n2001-01,7,n\n2001-02,8\n",
        "c.csv": "지점,지점명,일시\n",
        "d.csv": "지점,지점명,일시\n뷁,뷁,뷁\n",
    }
    for name, text in texts.items():
        with open(f"{folder}/{name}", "w", encoding="cp949") as f:
            f.write(text)
    rows, bad, drift = read_csv_checked(spark, folder, ["지점", "지점명", "일시"])
    got = sorted((r["지점"] or "", r["지점명"] or "", r["일시"] or "") for r in rows.collect())
    assert got == [("1", "서울", "2000-01"), ("2", "부산, 남", "2000-02"), ("5", "", ""), ("7", "", "2001-01"), ("뷁", "뷁", "뷁")]
    assert sorted((os.path.basename(r.file), r.line) for r in bad.collect()) == [
        ("a.csv", "3"), ("a.csv", "4,x,2000-04,zu viel"), ("b.csv", "2001-02,8")]
    assert all("not a line of 3 values" in r.reason for r in bad.collect())
    assert sorted((os.path.basename(r.file), r.kind, r.column) for r in drift.collect()) == [
        ("b.csv", "extra", "비고"), ("b.csv", "missing", "지점명")]
    assert {(r.column, r.value, r.rows) for r in unparsed_values(rows, ["지점", "일시"]).collect()} == {
        ("일시", "2000-01", 1), ("일시", "2000-02", 1), ("일시", "2001-01", 1), ("지점", "뷁", 1), ("일시", "뷁", 1)}
    assert csv_headers(spark, folder).count() == 4


def test_headers_that_repeat_a_column_are_refused(spark):
    folder = scratch_path(spark, "csv-repeat").replace("file:", "") + "/in"
    os.makedirs(folder)
    with open(f"{folder}/a.csv", "w") as f:
        f.write("a,a\n1,2\n")
    with pytest.raises(ValueError, match="repeats"):
        read_csv_checked(spark, folder, ["a"])


# -------------------------------------------------------- clustered files
def test_either_filter_skips_most_files(spark):
    df = spark.range(20_000).select(
        F.col("id"), F.concat(F.lit("name"), F.lpad((F.xxhash64("id") % 700 + 700).cast("string"), 4, "0")).alias("name"),
        F.pmod(F.xxhash64("id", F.lit(1)), F.lit(997)).alias("n"))
    df = df.withColumn("name", F.when(F.col("id") % 50 != 0, F.col("name")))
    path = scratch_path(spark, "clustered") + "/t"
    assert write_clustered(df, path, ["name", "n"], 32) == 20_000
    assert spark.read.parquet(path).exceptAll(df).count() == 0
    files = glob.glob(f"{path}/*.parquet".replace("file:", ""))
    assert 24 <= len(files) <= 32
    touched = {"name": 0, "n": 0}
    for f in files:  # what the footers say
        meta = pq.ParquetFile(f).metadata
        for c, v in (("name", "name0800"), ("n", 500)):
            at = meta.schema.to_arrow_schema().get_field_index(c)
            stats = [meta.row_group(g).column(at).statistics for g in range(meta.num_row_groups)]
            touched[c] += any(s.min <= v <= s.max for s in stats if s.has_min_max)
    assert max(touched.values()) <= len(files) * 0.45, touched
    ranges = file_ranges(spark.read.parquet(path), ["name", "n"])
    assert ranges.agg(F.sum("rows")).first()[0] == 20_000 and ranges.count() == len(files)


def test_hot_value_is_spread(spark):
    df = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("name"),
                                  F.lit(1).alias("one"))
    path = scratch_path(spark, "clustered-hot") + "/t"
    write_clustered(df, path, ["name", "one"], 9)
    assert file_ranges(spark.read.parquet(path), ["name"]).agg(F.max("rows")).first()[0] < 2500


def test_ranks_and_curve(spark):
    df = spark.createDataFrame([(v,) for v in [None, *range(100)]], "v int")
    bounds = range_bounds(df, ["v"], bits=3)["v"]
    got = {r.v: r.r for r in df.select("v", range_rank("v", bounds).alias("r")).collect()}
    assert got == {v: 0 if v is None else sum(b <= v for b in bounds) for v in got}
    pair = spark.createDataFrame([(a, b) for a in range(8) for b in range(8)], "a int, b int")
    for r in pair.select("a", "b", z_value([F.col("a"), F.col("b")], 3).alias("z")).collect():
        assert r.z == int("".join(f"{x}{y}" for x, y in zip(f"{r.a:03b}", f"{r.b:03b}")), 2)
    assert range_bounds(df.limit(0), ["v"]) == {"v": []}


# --------------------------------------------------------- stream metrics
def test_metrics_of_each_batch(spark):
    root = scratch_path(spark, "metrics-test")
    listener = MetricsListener(spark, f"{root}/metrics", {"metrics-test"})
    spark.streams.addListener(listener)
    try:
        for n, size in enumerate((5, 8)):
            spark.range(size).coalesce(1).write.parquet(f"{root}/in/{n}")
            s = observed(spark.readStream.schema("id long").parquet(f"{root}/in/*"), "landing",
                         {"landed": F.count(F.lit(1)), "rejected": F.count_if(F.col("id") > 4)})
            for name in ("metrics-test", "not-watched"):
                s.where("id <= 4").writeStream.queryName(name).format("parquet").option("path", f"{root}/{name}") \
                 .option("checkpointLocation", f"{root}/ckpt-{name}").trigger(availableNow=True).start().awaitTermination()
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
    finally:
        spark.streams.removeListener(listener)
    assert not listener.faults
    got = {(r.query, r.batch_id, r.metric): r.value for r in batch_metrics(spark, f"{root}/metrics").collect()}
    assert got == {("metrics-test", 0, "landed"): 5, ("metrics-test", 0, "rejected"): 0,
                   ("metrics-test", 1, "landed"): 8, ("metrics-test", 1, "rejected"): 3}
