"""Counts of every micro-batch in a table (O-10), without a second pass.

The stream carries observed metrics; a listener receives them with the
progress of each batch and appends them to a table: one row for each batch
and metric.
"""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.listener import StreamingQueryListener
from pyspark.sql.types import LongType, StringType, StructField, StructType

from regiostat.sources.epochs import path_exists

METRICS = StructType([StructField("query", StringType()), StructField("batch_id", LongType()), StructField("name", StringType()),
                      StructField("metric", StringType()), StructField("value", LongType())])


def observed(stream: DataFrame, name: str, metrics: Mapping[str, Column]) -> DataFrame:
    """``stream`` with aggregates (of bigint) that each micro-batch reports under ``name``."""
    return stream.observe(name, *[F.coalesce(c, F.lit(0)).cast("long").alias(k) for k, c in metrics.items()])


class MetricsListener(StreamingQueryListener):
    """Appends the observed metrics of the named queries to a parquet table.

    A batch without rows is not reported.  A replayed batch is reported again
    under its batch id; :func:`batch_metrics` takes the last report.
    """

    def __init__(self, spark: SparkSession, path: str, queries: set[str] | None = None):
        self.spark, self.path, self.queries = spark, path, queries
        self.faults: list[str] = []

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        try:
            p = json.loads(event.progress.json)
            if (self.queries is not None and p["name"] not in self.queries) or not p.get("observedMetrics"):
                return
            if not sum(s.get("numInputRows", 0) for s in p["sources"]):
                return
            rows = [(p["name"], p["batchId"], name, metric, int(value))
                    for name, found in p["observedMetrics"].items() for metric, value in found.items()]
            self.spark.createDataFrame(rows, METRICS).coalesce(1).write.mode("append").parquet(self.path)
        except Exception as e:  # a listener must not end the stream; the fault is kept
            self.faults.append(f"{type(e).__name__}: {e}")

    def onQueryTerminated(self, event) -> None:
        pass


def batch_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(query, batch_id, name, metric, value), each once."""
    if not path_exists(spark, path):  # no batch had rows yet
        return spark.createDataFrame([], METRICS)
    rows = spark.read.schema(METRICS).parquet(path)
    latest = F.max_by("value", F.col("_metadata.file_modification_time"))
    return rows.groupBy("query", "batch_id", "name", "metric").agg(latest.alias("value"))
