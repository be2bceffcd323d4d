"""Sinks (O-06..O-10): append, replace, truncate-and-load, partitioned layout."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from regiostat.operators.aggregates import observed_count


def write_table(df: DataFrame, path: str, mode: str = "overwrite",
                partition_by: Sequence[str] = (), cluster_by: Sequence[str] = (),
                dynamic_overwrite: bool = False) -> int:
    """Write parquet and return the written row count from the same job (O-07,
    O-08, O-09, O-10, O-69).

    ``overwrite`` replaces data and schema (truncate-and-load);
    ``dynamic_overwrite`` replaces only the partitions present in ``df``.
    ``cluster_by`` sorts rows within each output file so row-group min/max
    statistics skip data on those columns.  With ``partition_by`` rows are
    first distributed by the partition columns with a REBALANCE hint: each task
    writes few files, and AQE splits a partition value holding a large share
    of the rows across several tasks instead of one.
    """
    out = df
    if partition_by:
        out = out.hint("rebalance", *partition_by)
    if cluster_by or partition_by:
        out = out.sortWithinPartitions(*partition_by, *cluster_by)
    out, obs = observed_count(out, "write")
    w = out.write.mode(mode)
    if dynamic_overwrite:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    return int(obs.get.get("rows", 0))


def range_bucket(col: str, start: int, end: int, name: str | None = None):
    """``RANGE_BUCKET(col, GENERATE_ARRAY(start, end, 1))`` partitioning
    (O-09): values in [start, end) are their own partition, everything else
    (including NULL) shares the default partition.  Returns (column name,
    expression) to add before ``write_table(partition_by=[name])``."""
    from pyspark.sql import functions as F
    c = F.col(col)
    return name or f"{col}_range", F.when((c >= start) & (c < end), c)


def append_batch(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> int:
    """``INSERT`` of a batch (O-06); an empty batch writes nothing."""
    return write_table(df, path, mode="append", partition_by=partition_by)


def write_bucketed(df: DataFrame, table: str, keys: Sequence[str], buckets: int, path: str,
                   mode: str = "overwrite") -> None:
    """Store ``df`` as a catalog table bucketed and sorted by ``keys`` at ``path``.

    Two tables bucketed the same way on their join key (e.g. orders and
    customer on the customer key) join with a sort-merge join that needs no
    exchange: the repeated big shuffle is paid once, at write time.
    """
    (df.write.mode(mode).bucketBy(buckets, *keys).sortBy(*keys)
       .option("path", path).saveAsTable(table))
