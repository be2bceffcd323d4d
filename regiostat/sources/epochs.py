"""One commit for several tables (O-06, O-19).

A run (a micro-batch, a scheduled job) writes its rows of every table into the
folder ``epoch=<n>`` of that table and only then one row into the commit
table.  Readers take the epochs of the commit table, so nothing of a run that
failed between two tables is seen, and its replay overwrites what it left.

An epoch is begun only after the one before is committed (one writer at a
time, as the driver of a stream is), so the committed epochs are those up to
the largest one, and reading them is one filter on a partition column.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from regiostat.operators.aggregates import observed_count

COMMIT_SCHEMA = "run string, counts map<string,long>, epoch long"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on whatever file system the path names."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_if_exists(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """A parquet table with a known schema; empty before its first write.  Any
    other fault (a wrong column, an unreadable file) still fails."""
    reader = spark.read.schema(schema)
    return reader.parquet(path) if path_exists(spark, path) else spark.createDataFrame([], schema)


class EpochLog:
    """The commit table: one row for each committed run."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def table(self) -> DataFrame:
        return read_if_exists(self.spark, self.path, COMMIT_SCHEMA)

    def last(self) -> int | None:
        return self.table().agg(F.max("epoch")).first()[0]

    def done(self, run: str) -> bool:
        return not self.table().where(F.col("run") == run).isEmpty()

    def commit(self, epoch: int, run: str, counts: Mapping[str, int]) -> None:
        row = self.spark.createDataFrame([(run, dict(counts))], "run string, counts map<string,long>")
        # one row, one file: the rename of that file is the commit
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/epoch={epoch}")


def write_run(log: EpochLog, run: str, tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> int | None:
    """Write the rows of a run into each table (path -> rows, partition columns)
    and commit them together.  A run that is committed already is skipped
    (None): a replayed micro-batch adds nothing."""
    if log.done(run):
        return None
    last = log.last()
    epoch = 0 if last is None else last + 1
    counts = {}
    for path, (rows, partition_by) in tables.items():
        rows, seen = observed_count(rows, "epoch")
        out = rows.hint("rebalance", *partition_by) if partition_by else rows
        out.write.mode("overwrite").partitionBy(*partition_by).parquet(f"{path}/epoch={epoch}")
        counts[path.rstrip("/").rsplit("/", 1)[-1]] = int(seen.get.get("rows", 0))
    log.commit(epoch, run, counts)
    return epoch


def read_committed(spark: SparkSession, path: str, schema: StructType, log: EpochLog) -> DataFrame:
    """Rows of the committed epochs, with the column ``epoch``."""
    full = StructType([*schema.fields, StructField("epoch", LongType())])
    last = log.last()
    if last is None:
        return spark.createDataFrame([], full)
    return read_if_exists(spark, path, full).where(F.col("epoch") <= F.lit(last))
