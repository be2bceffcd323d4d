"""Facts kept up to date from late and corrected slots (O-08 with J-7..J-9).

A fact is stored with what it was computed from, each level partitioned by
(province, period):

* ``silver``: the observations;
* ``station``: one row per station and period (first stage);
* ``province``: one row per province and period, not rounded (second stage);
* ``fact``: differences to the period before, rounded.

A delta touches some (province, period) partitions.  Of silver and station
only these are read and written again; of the fact also the next period that
the province has, because its differences look back.  Every write replaces
whole partitions (dynamic overwrite), so a repeated delta changes nothing and
files of other partitions stay as they are.

A partition that loses its last row keeps a marker row (a folder can't be
replaced by nothing); readers drop it.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from regiostat.operators.aggregates import AggSpec
from regiostat.operators.membership import partition_filter, touched_partitions
from regiostat.operators.projections import round_float_columns
from regiostat.operators.timeseries import diff
from regiostat.plans.climate import province_stage, station_stage
from regiostat.session import materialize
from regiostat.sources.epochs import read_if_exists
from regiostat.sources.sinks import write_table

EMPTY = "_empty"


@dataclass
class FactSpec:
    """What :func:`regiostat.plans.climate.two_stage` takes; ``row_keys`` name an observation."""
    station: str
    group: Sequence[str]
    period: str
    stage1: AggSpec
    stage2: AggSpec
    derive: dict | None = None
    diffs: Sequence[tuple[str, str]] = ()
    complete_only: bool = False
    row_keys: Sequence[str] = ("station", "year", "month")
    scale: int = 2

    @property
    def parts(self) -> list[str]:
        return [self.group[0], self.period]


@dataclass
class IncrementalFact:
    """A stored fact below ``root``; ``silver_schema`` is that of the observations."""
    spark: SparkSession
    root: str
    spec: FactSpec
    silver_schema: StructType
    _schemas: dict = field(default_factory=dict)

    def _station(self, silver: DataFrame) -> DataFrame:
        s = self.spec
        return station_stage(silver, s.station, s.group, s.period, s.stage1, s.derive, s.complete_only)

    def _province(self, station: DataFrame) -> DataFrame:
        return province_stage(station, self.spec.group, self.spec.period, self.spec.stage2)

    def _fact(self, province: DataFrame) -> DataFrame:
        s = self.spec
        for source, out in s.diffs:
            province = diff(province, [s.group[0]], [s.period], source, out)
        return province

    def schema(self, level: str) -> StructType:
        """Schema of a level, from the plan over no rows."""
        if not self._schemas:
            silver = self.spark.createDataFrame([], self.silver_schema)
            station = self._station(silver)
            province = self._province(station)
            self._schemas.update(silver=self.silver_schema, station=station.schema, province=province.schema,
                                 fact=self._fact(province).schema)
        return self._schemas[level]

    def read(self, level: str, partitions: list[tuple] | None = None) -> DataFrame:
        """Rows of a level; of some partitions only, if they are named."""
        full = StructType([*self.schema(level).fields, StructField(EMPTY, BooleanType())])
        rows = read_if_exists(self.spark, f"{self.root}/{level}", full)
        if partitions is not None:
            rows = rows.where(partition_filter(partitions, self.spec.parts))
        return rows.where(F.col(EMPTY).isNull()).drop(EMPTY)

    def _replace(self, level: str, rows: DataFrame, partitions: DataFrame) -> None:
        """Replace the partitions; each that has no row left gets a marker."""
        marked = partitions.withColumn(EMPTY, F.lit(True))
        out = rows.withColumn(EMPTY, F.lit(None).cast("boolean")).unionByName(marked, allowMissingColumns=True)
        write_table(out.select(*self.schema(level).names, EMPTY), f"{self.root}/{level}",
                    partition_by=self.spec.parts, dynamic_overwrite=True)

    def fact(self) -> DataFrame:
        return round_float_columns(self.read("fact"), self.spec.scale)

    def apply(self, delta: DataFrame) -> list[tuple]:
        """Take in new and corrected observations (a row replaces the one with
        its ``row_keys`` in its partition).  Returns the (province, period)
        partitions of the fact that were written.

        Rows without province or period belong to no partition and are left
        out, as in the full computation (S5).  The first load is a delta too.
        """
        s = self.spec
        parts = s.parts
        delta = materialize(delta.select(*self.silver_schema.names).dropna(subset=parts))
        touched = touched_partitions(delta, parts, most=1_000_000)  # provinces x periods
        if touched is None:
            raise ValueError(f"more than a million {parts} partitions in one delta")
        if not touched:
            return []
        part_schema = StructType([self.silver_schema[p] for p in parts])
        pairs = self.spark.createDataFrame(touched, part_schema)

        kept = self.read("silver", touched).join(delta.select(*s.row_keys).distinct(), list(s.row_keys), "left_anti")
        self._replace("silver", kept.unionByName(delta), pairs)
        self._replace("station", self._station(self.read("silver", touched)), pairs)
        self._replace("province", self._province(self.read("station", touched)), pairs)

        affected = self._with_next(touched)
        groups = sorted({g for g, _ in affected})
        # all periods of these provinces: one row each
        province = self.read("province").where(F.col(parts[0]).isin(groups))
        rows = self._fact(province).where(partition_filter(affected, parts))
        self._replace("fact", rows, self.spark.createDataFrame(affected, part_schema))
        return affected

    def _with_next(self, touched: list[tuple]) -> list[tuple]:
        """The touched partitions and, for each, the next period that its province has."""
        if not self.spec.diffs:
            return touched
        group, period = self.spec.parts
        touching = self.spark.createDataFrame(touched, StructType([self.silver_schema[group], self.silver_schema[period]]))
        held = self.read("province").select(group, period).withColumn("_here", F.lit(False))
        both = held.unionByName(touching.withColumn("_here", F.lit(True)))
        both = both.groupBy(group, period).agg(F.max("_here").alias("_here"), F.min("_here").alias("_gone"))
        # next existing period after each touched one; a touched one may have lost its rows
        later = Window.partitionBy(group).orderBy(F.desc(period)).rowsBetween(Window.unboundedPreceding, -1)
        nxt = F.last(F.when(~F.col("_gone"), F.col(period)), ignorenulls=True).over(later)
        rows = both.withColumn("_next", nxt).where("_here AND _next IS NOT NULL").select(group, F.col("_next")).distinct()
        return sorted(set(touched) | {tuple(r) for r in rows.collect()})  # at most one more for each touched one
