"""Incremental ingest (O-19): idempotent re-runs and twice-landed slots."""

import pandas as pd

from regiostat.session import scratch_path
from regiostat.streaming.incremental import ingest_available

SCHEMA = "user_id long, day date, event_id long, value double"


def test_incremental_ingest_idempotent(spark):
    root = scratch_path(spark, "test-stream")
    landing, bronze, ckpt = f"{root}/landing", f"{root}/bronze", f"{root}/ckpt"
    d1 = pd.DataFrame({"user_id": [1, 1, 2], "day": pd.to_datetime(["2024-01-01"] * 3).date,
                       "event_id": [1, 2, 3], "value": [1.0, 2.0, 3.0]})
    d2 = pd.DataFrame({"user_id": [1, 3], "day": pd.to_datetime(["2024-01-02", "2024-01-01"]).date,
                       "event_id": [4, 5], "value": [4.0, 5.0]})
    schema = spark.createDataFrame(d1, SCHEMA).schema
    kw = dict(source_format="parquet", schema=schema, bronze_path=bronze, checkpoint=ckpt,
              slot_keys=["user_id", "day"])
    spark.createDataFrame(d1, SCHEMA).write.parquet(f"{landing}/a")
    ingest_available(spark, f"{landing}/*", **kw)
    assert spark.read.parquet(bronze).count() == 3
    ingest_available(spark, f"{landing}/*", **kw)  # nothing new
    assert spark.read.parquet(bronze).count() == 3
    spark.createDataFrame(d2, SCHEMA).write.parquet(f"{landing}/b")
    spark.createDataFrame(d1, SCHEMA).write.parquet(f"{landing}/c")  # slot landed twice
    ingest_available(spark, f"{landing}/*", **kw)
    got = sorted(r.event_id for r in spark.read.parquet(bronze).collect())
    assert got == [1, 2, 3, 4, 5]
