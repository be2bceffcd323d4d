"""The pipeline runner end to end on fixtures: power (landing -> bronze ->
silver -> fact) and climate (CP949 CSV -> raw -> transform -> facts)."""

import json
import os

from regiostat.cli import main
from regiostat.session import scratch_path

from test_climate import _lookups, _meta, _raw


def _row(y, m, city, h, u, b):
    return {"year": str(y), "month": f"{m:02d}", "metro": "서울특별시", "city": city,
            "houseCnt": str(h), "powerUsage": u, "bill": str(b)}


def test_power_pipeline(spark):
    root = scratch_path(spark, "cli-power")
    land = os.path.join(root.replace("file:", ""), "landing")
    os.makedirs(land)
    with open(os.path.join(land, "a.json"), "w", encoding="utf-8") as f:
        for m in range(1, 15):
            y, mm = 2020 + (m - 1) // 12, (m - 1) % 12 + 1
            usage = "-1" if m == 3 else f"{100 + m}.5"
            f.write(json.dumps({"year": str(y), "month": f"{mm:02d}", "metroCd": "11",
                                "data": [_row(y, mm, "종로구", 10, usage, 1000 + m)]}, ensure_ascii=False) + "\n")
        f.write(json.dumps({"year": "2021", "month": "03", "metroCd": "11",
                            "data": [_row(2021, 3, "종로구", "x", "1", 1)]}, ensure_ascii=False) + "\n")
    kw = dict(spark=spark)
    r = main(["power-ingest", "--landing", land, "--bronze", f"{root}/bronze", "--dead-letter", f"{root}/dead"], **kw)
    assert r == {"bronze_rows": 14, "dead_letter_rows": 1}
    # a second run over the same landing adds nothing to bronze
    r = main(["power-ingest", "--landing", land, "--bronze", f"{root}/bronze", "--dead-letter", f"{root}/dead"], **kw)
    assert r["bronze_rows"] == 0
    main(["power-silver", "--bronze", f"{root}/bronze", "--silver", f"{root}/silver",
          "--override-missing", "skip"], **kw)
    silver = spark.read.parquet(f"{root}/silver").orderBy("year", "month").collect()
    assert silver[2].power_usage == (102.5 + 104.5) / 2  # the negative reading was interpolated
    r = main(["power-fact", "--silver", f"{root}/silver", "--fact", f"{root}/fact"], **kw)
    assert r["fact_rows"] == 14
    fact = spark.read.parquet(f"{root}/fact").where("year = 2021 AND month = 1").first()
    assert fact.usage_yoy_pct is not None and fact.season == "겨울"


def test_climate_pipeline(spark):
    root = scratch_path(spark, "cli-climate").replace("file:", "")
    raw_pdf = _raw(spark).toPandas()
    raw_pdf.to_csv(os.path.join(root, "raw.csv"), index=False, encoding="cp949")
    _meta(spark).toPandas().to_csv(os.path.join(root, "meta.csv"), index=False, encoding="cp949")
    alias, std = _lookups(spark)
    alias.write.parquet(f"{root}/alias")
    std.write.parquet(f"{root}/std")
    kw = dict(spark=spark)
    r = main(["climate-raw", "--raw-csv", f"{root}/raw.csv", "--meta-csv", f"{root}/meta.csv",
              "--raw", f"{root}/raw", "--meta", f"{root}/meta"], **kw)
    assert r["raw_rows"] == len(raw_pdf)
    main(["climate-transform", "--raw", f"{root}/raw", "--meta", f"{root}/meta",
          "--raw-out", f"{root}/raw_t", "--meta-out", f"{root}/meta_t"], **kw)
    assert dict(spark.read.parquet(f"{root}/meta_t").dtypes)["지점"] == "string"  # bronze stays untyped
    r = main(["climate-facts", "--raw", f"{root}/raw_t", "--meta", f"{root}/meta_t", "--alias", f"{root}/alias",
              "--std", f"{root}/std", "--out", f"{root}/gold"], **kw)
    assert r["unmatched_stations"] == 1
    assert r["fact_regional_compare"] == 24 and r["fact_climate_trend"] >= 2
