"""Sources (S25 legacy charset, JSON landing) and metamorphic properties."""

import os

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from regiostat.operators.corrections import weighted_merge
from regiostat.operators.timeseries import interpolate_linear, keep_last
from regiostat.session import scratch_path
from regiostat.sources.landing import read_landing, read_legacy_csv
from regiostat.sources.sinks import write_table


def test_cp949_extended_syllable(spark):
    path = scratch_path(spark, "test-cp949").replace("file:", "")
    # '똠' exists in CP949 but not in plain EUC-KR
    text = "지점,지점명,평균기온(°C)\n108,서울똠,12.5\n159,부산,\n"
    with open(os.path.join(path, "raw.csv"), "wb") as f:
        f.write(text.encode("cp949"))
    df = read_legacy_csv(spark, path)
    assert df.columns == ["지점", "지점명", "평균기온(°C)"]
    rows = df.collect()
    assert rows[0]["지점명"] == "서울똠" and rows[0]["평균기온(°C)"] == "12.5"
    assert all(isinstance(v, (str, type(None))) for r in rows for v in r)  # bronze stays untyped


def test_landing_missing_and_empty_data(spark):
    path = scratch_path(spark, "test-json").replace("file:", "")
    with open(os.path.join(path, "a.json"), "w", encoding="utf-8") as f:
        f.write('{"year": "2020", "month": "01", "metroCd": "11"}\n')
        f.write('{"year": "2020", "month": "02", "metroCd": "11", "data": []}\n')
        f.write('{"year": "2020", "month": "03", "metroCd": "11", "data": [{"year": "2020", "month": "03", '
                '"metro": "서울특별시", "city": "종로구", "houseCnt": "5", "powerUsage": "1.5", "bill": "10"}]}\n')
    rows = read_landing(spark, path).collect()
    assert len(rows) == 1 and rows[0].city == "종로구" and rows[0].metroCd == "11"


def test_interpolation_keeps_present_values(spark):
    rng = np.random.default_rng(4)
    pdf = pd.DataFrame({"k": rng.integers(0, 4, 300), "t": np.arange(300),
                        "v": np.where(rng.random(300) < 0.3, None, rng.normal(0, 1, 300))})
    df = spark.createDataFrame(pdf, "k long, t long, v double")
    out = interpolate_linear(df, ["k"], ["t"], ["v"], block=F.floor(F.col("t") / 13)).toPandas()
    both = pdf.merge(out, on=["k", "t"], suffixes=("_in", "_out"))
    present = both[both.v_in.notna()]
    assert (present.v_in.astype(float) == present.v_out).all()
    # shuffled input order gives the same output
    again = interpolate_linear(df.repartition(5), ["k"], ["t"], ["v"]).toPandas()
    m = out.merge(again, on=["k", "t"])
    assert np.array_equal(m.v_x.to_numpy(dtype=float), m.v_y.to_numpy(dtype=float), equal_nan=True)


def test_merged_weight_is_sum_of_parts(spark):
    rng = np.random.default_rng(8)
    rows = [(y, m, f"시 {d}구", int(rng.integers(0, 500)), float(round(rng.uniform(100, 400), 1)))
            for y in (2020, 2021) for m in range(1, 13) for d in "가나다"]
    df = spark.createDataFrame(rows, "year int, month int, sgg_name string, house_cnt long, power_usage double")
    merged = weighted_merge(df, "sgg_name", "시 ", "시", ["year", "month"], "house_cnt", ["power_usage"])
    got = {(r.year, r.month): r.house_cnt for r in merged.collect()}
    exp = pd.DataFrame(rows, columns=["year", "month", "sgg", "h", "p"]).groupby(["year", "month"]).h.sum()
    assert got == {k: int(v) for k, v in exp.items()}


def test_keep_last_hot_key(spark):
    # one key holds a third of the rows: max_by aggregate, no window
    n = 3000
    df = spark.range(n).select(F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
                               F.col("id").alias("o"), (F.col("id") * 2).alias("v"))
    out = keep_last(df, "k", ["o"])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan
    assert out.where("k = 0").first().v == 2 * 2997


def test_write_table_counts_rows(spark):
    path = scratch_path(spark, "test-write")
    df = spark.range(10).select(F.col("id"), (F.col("id") % 2).alias("year"))
    assert write_table(df, path, partition_by=["year"], cluster_by=["id"]) == 10
    back = spark.read.parquet(path)
    assert back.count() == 10 and sorted(r.year for r in back.select("year").distinct().collect()) == [0, 1]


def test_bucketed_tables_join_without_exchange(spark):
    from conftest import SF_SMALL, have
    if not have(SF_SMALL):
        return
    from regiostat.sources.sinks import write_bucketed
    from regiostat.sources.tables import read_table
    root = scratch_path(spark, "test-bucketed")
    o = read_table(spark, SF_SMALL, "orders", ["o_orderkey", "o_custkey", "o_totalprice"])
    c = read_table(spark, SF_SMALL, "customer", ["c_custkey", "c_nationkey"])
    write_bucketed(o.withColumnRenamed("o_custkey", "custkey"), "t_orders_b", ["custkey"], 8, f"{root}/o")
    write_bucketed(c.withColumnRenamed("c_custkey", "custkey"), "t_customer_b", ["custkey"], 8, f"{root}/c")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        j = spark.table("t_orders_b").join(spark.table("t_customer_b"), "custkey")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == o.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.sql("DROP TABLE IF EXISTS t_orders_b")
        spark.sql("DROP TABLE IF EXISTS t_customer_b")


def test_range_bucket_partitioning(spark):
    from regiostat.sources.sinks import range_bucket
    path = scratch_path(spark, "test-range")
    df = spark.createDataFrame([(y, 1.0) for y in (2014, 2015, 2016, 2020, 2031)], "year int, v double")
    name, expr = range_bucket("year", 2016, 2030)
    assert write_table(df.withColumn(name, expr), path, partition_by=[name]) == 5
    back = spark.read.parquet(path)
    parts = sorted((r.year, r.year_range) for r in back.collect())
    assert parts == [(2014, None), (2015, None), (2016, 2016), (2020, 2020), (2031, None)]
    assert len([d for d in os.listdir(path.replace("file:", "")) if d.startswith("year_range=")]) == 3
