"""Table scans (O-02, O-03).  Parquet is the storage; Catalyst prunes columns
and pushes filters into the scan, so callers select only what they use."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def read_table(spark: SparkSession, base: str, name: str,
               columns: Sequence[str] | None = None) -> DataFrame:
    """``select * from name`` or ``select cols from name`` over ``base/name.parquet``."""
    df = spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_catalog_table(spark: SparkSession, name: str, columns: Sequence[str] | None = None) -> DataFrame:
    """``select * from name`` over a catalog table (bucketing and partition
    metadata come with it)."""
    df = spark.table(name)
    return df.select(*columns) if columns else df


def read_jdbc(spark: SparkSession, url: str, table: str, properties: dict,
              partition_column: str | None = None, lower: int | None = None,
              upper: int | None = None, num_partitions: int | None = None) -> DataFrame:
    """An external relational table, read in parallel slices when a numeric
    partition column is given, instead of one whole-table fetch."""
    if partition_column:
        return spark.read.jdbc(url, table, column=partition_column, lowerBound=lower,
                               upperBound=upper, numPartitions=num_partitions, properties=properties)
    return spark.read.jdbc(url, table, properties=properties)
