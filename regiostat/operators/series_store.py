"""Interpolation of a series that grows (O-46): only what changes is read.

New rows of a key change earlier values in one place only: the gap at the end
of its series, whose rows repeat the last value until a next one arrives.  An
index keeps for each key its last value, where that stands and where the
series ends.  Appending reads the blocks that hold open gaps which the new rows
close, and the blocks that the new rows fall into; all other blocks stay as
they are.  The result is that of interpolating the whole series anew.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from regiostat.operators.timeseries import interpolate_linear
from regiostat.session import materialize
from regiostat.sources.epochs import EpochLog, read_committed, read_if_exists, write_run
from regiostat.sources.sinks import write_table

RAW = "raw_value"


@dataclass
class SeriesStore:
    """A series below ``root``: ``keys``, one unique ``order`` column that grows, a double ``value``.

    Rows are partitioned by ``block``, a non-decreasing long function of the
    order (a year, an id range) computed by the caller as a column.
    """
    spark: SparkSession
    root: str
    schema: StructType
    keys: Sequence[str]
    order: str
    value: str
    block: str = "block"

    @property
    def log(self) -> EpochLog:
        return EpochLog(self.spark, f"{self.root}/commits")

    @property
    def _row_schema(self) -> StructType:
        return StructType([*self.schema.fields, StructField(RAW, DoubleType())])

    @property
    def _index_schema(self) -> StructType:
        order = self.schema[self.order].dataType
        return StructType([*(self.schema[k] for k in self.keys), StructField("_last", order), StructField("_value_at", order),
                           StructField("_value", DoubleType()), StructField("_value_block", LongType()),
                           StructField("_last_block", LongType())])

    def index(self) -> DataFrame:
        """One row a key, as of the last committed append."""
        rows = read_committed(self.spark, f"{self.root}/index", self._index_schema, self.log)
        last = self.log.last()
        return rows.where(F.col("epoch") == F.lit(last if last is not None else -1)).drop("epoch")

    def rows(self, blocks: list[int] | None = None) -> DataFrame:
        """Stored rows with their interpolated and raw values; of some blocks only, if they are named."""
        out = read_if_exists(self.spark, f"{self.root}/rows", self._row_schema)
        return out if blocks is None else out.where(F.col(self.block).isin(blocks))

    def read(self) -> DataFrame:
        return self.rows().select(*self.schema.names)

    def append(self, rows: DataFrame, run: str) -> list[int] | None:
        """Take in rows that follow all earlier ones of their key.  Returns the
        blocks that were read and written; None if ``run`` is committed already.

        A run that failed is replayed whole: rows it had written are replaced.
        Rows with a missing key are interpolated to NULL, as in one pass (S6);
        rows without order or before the end of their series are refused.
        """
        if self.log.done(run):
            return None
        keys, order, value, block = list(self.keys), self.order, self.value, self.block
        new = rows.select(*self.schema.names).withColumn(value, F.when(~F.isnan(value), F.col(value)))
        new = materialize(new.withColumn(RAW, F.col(value)))
        index = materialize(self.index())
        known = index.withColumnsRenamed({k: f"_k_{k}" for k in keys})
        same = [F.col(k) == F.col(f"_k_{k}") for k in keys]
        late = new.join(known, same, "left").where(F.col(order).isNull() | (F.col(order) <= F.col("_last")))
        if not late.isEmpty():
            raise ValueError(f"rows at or before the end of their series: {late.select(*keys, order).first()}")

        # keys with an open gap (a value, and missing rows after it) that the new rows close
        closing = new.where(F.col(RAW).isNotNull()).select(*keys).distinct()
        open_ = index.where(F.col("_value").isNotNull() & (F.col("_value_at") < F.col("_last"))).join(closing, keys, "left_semi")
        gaps = open_.select(F.explode(F.sequence("_value_block", "_last_block")).alias("b"))
        touched = gaps.unionByName(new.select(F.col(block).cast("long").alias("b"))).distinct()
        blocks = sorted(r["b"] for r in touched.collect())  # blocks, not rows
        stored = self.rows(blocks)
        # what a failed run of this append left behind
        stored = stored.join(new.select(*keys, order), [stored[c].eqNullSafe(new[c]) for c in [*keys, order]], "left_anti")
        stored = materialize(stored)

        gap = open_.withColumnsRenamed({k: f"_k_{k}" for k in keys}).select(*[f"_k_{k}" for k in keys], "_value_at")
        in_gap = stored.join(gap, [F.col(k) == F.col(f"_k_{k}") for k in keys]).where(F.col(order) > F.col("_value_at"))
        in_gap = in_gap.select(*stored.columns)
        # the last value of a key stands before its gap and its new rows
        anchor = index.where(F.col("_value").isNotNull()).join(new.select(*keys).distinct(), keys, "left_semi")
        anchor = anchor.select(*keys, F.col("_value_at").alias(order), F.col("_value").alias(RAW),
                               F.col("_value_block").alias(block), F.lit(True).alias("_anchor"))
        series = in_gap.unionByName(new).unionByName(anchor, allowMissingColumns=True)
        series = interpolate_linear(series.withColumn(value, F.col(RAW)), keys, [order], [value])
        # a key that stays in its gap: rows after its last value repeat it, which needs no earlier block
        changed = materialize(series.where(F.col("_anchor").isNull()).drop("_anchor"))
        moved = changed.select(*[F.col(c).alias(f"_m_{c}") for c in [*keys, order]])
        kept = stored.join(moved, [F.col(c).eqNullSafe(F.col(f"_m_{c}")) for c in [*keys, order]], "left_anti")
        write_table(kept.unionByName(changed.select(*kept.columns)), f"{self.root}/rows", partition_by=[block],
                    dynamic_overwrite=True)
        write_run(self.log, run, {f"{self.root}/index": (self._next_index(index, new), [])})
        return blocks

    def _next_index(self, index: DataFrame, new: DataFrame) -> DataFrame:
        order, block = F.col(self.order), F.col(self.block).cast("long")
        has = F.col(RAW).isNotNull()
        ends = new.dropna(subset=list(self.keys)).select(
            *self.keys, order.alias("_last"), F.when(has, order).alias("_value_at"), F.col(RAW).alias("_value"),
            F.when(has, block).alias("_value_block"), block.alias("_last_block"))
        both = index.unionByName(ends)
        at = F.col("_value_at")
        return both.groupBy(*self.keys).agg(
            F.max("_last").alias("_last"), F.max(at).alias("_value_at"), F.max_by("_value", at).alias("_value"),
            F.max_by("_value_block", at).alias("_value_block"), F.max("_last_block").alias("_last_block"))
