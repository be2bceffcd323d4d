"""J-1 as a closed loop: what to ask for, what came, what is given up.

    work list = slot grid - stored slots - dead slots

A run takes landed responses of slots on the work list only, validates them
slot by slot, and writes good rows to bronze and rejected ones to the dead
letter under one commit.  A slot that failed ``max_attempts`` times is dead
and asked for no more.  Bronze is partitioned by year and month, and the check
of what is stored reads only the months in question.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructField, StructType

from regiostat.functions.scalars import lenient_int
from regiostat.operators.ingest import MAX_ATTEMPTS, retry_queue
from regiostat.operators.membership import new_rows
from regiostat.plans.power import bronze_ingest
from regiostat.session import materialize
from regiostat.sources.epochs import EpochLog, read_committed, write_run

SLOT = ["year", "month", "sd_code"]
_ROW = [StructField("sd_code", IntegerType()), StructField("sd_name", StringType()), StructField("sgg_name", StringType()),
        StructField("house_cnt", LongType()), StructField("power_usage", DoubleType()), StructField("bill", LongType())]
_MONTH = [StructField("year", IntegerType()), StructField("month", IntegerType())]
BRONZE_SCHEMA = StructType([*_ROW, *_MONTH])
DEAD_SCHEMA = StructType([*_ROW, *(StructField(c, StringType()) for c in ("unreadable", "reason", "file")), *_MONTH])


@dataclass
class PowerStore:
    """Bronze and dead letter below ``root``, committed together."""
    spark: SparkSession
    root: str
    max_attempts: int = MAX_ATTEMPTS

    @property
    def log(self) -> EpochLog:
        return EpochLog(self.spark, f"{self.root}/commits")

    def bronze(self) -> DataFrame:
        return read_committed(self.spark, f"{self.root}/bronze", BRONZE_SCHEMA, self.log)

    def dead_letter(self) -> DataFrame:
        return read_committed(self.spark, f"{self.root}/dead_letter", DEAD_SCHEMA, self.log)

    def attempts(self) -> DataFrame:
        """Failed attempts and status of each slot that ever failed.  A run
        asks for a slot once, so a run with a rejected row is one attempt."""
        failed = self.dead_letter().dropna(subset=SLOT).select(*SLOT, "epoch").distinct()
        return retry_queue(failed, SLOT, self.max_attempts)

    def dead_slots(self) -> DataFrame:
        return self.attempts().where("status = 'dead_letter'").select(*SLOT)

    def wanted(self, slots: DataFrame) -> DataFrame:
        """The slots (a materialized table) that are neither stored nor dead."""
        fresh = new_rows(slots, self.bronze(), SLOT, partition_by=["year", "month"])
        return fresh.join(self.dead_slots(), on=SLOT, how="left_anti")

    def ingest(self, landed: DataFrame, run: str) -> int | None:
        """One run over landed payload rows (:func:`~regiostat.sources.landing.read_landing`).

        Responses of slots that are not wanted are passed over; responses that
        name no slot go to the dead letter.  A committed ``run`` is skipped;
        one that failed anywhere is replayed whole.
        """
        slot = {"year": lenient_int("req_year"), "month": lenient_int("req_month"), "sd_code": lenient_int("metroCd")}
        rows = materialize(landed.withColumns({f"_slot_{k}": v.cast("int") for k, v in slot.items()}))
        named = [f"_slot_{k}" for k in SLOT]
        asked = rows.select(*[F.col(f"_slot_{k}").alias(k) for k in SLOT]).dropna().distinct()
        wanted = self.wanted(materialize(asked)).select(*[F.col(k).alias(f"_slot_{k}") for k in SLOT])
        nameless = rows.where(" OR ".join(f"{c} IS NULL" for c in named))
        taken = rows.join(wanted, named, "left_semi").unionByName(nameless).drop(*named)
        good, rejected = bronze_ingest(self.spark, taken, None, SLOT)
        return write_run(self.log, run, {
            f"{self.root}/bronze": (good.select(*BRONZE_SCHEMA.names), ["year", "month"]),
            f"{self.root}/dead_letter": (rejected.select(*DEAD_SCHEMA.names), [])})

    def status(self, grid: DataFrame) -> DataFrame:
        """Each slot of the grid: stored, dead_letter, retry or pending, with its failed attempts."""
        stored = self.bronze().select(*SLOT).distinct().withColumn("_stored", F.lit(True))
        out = grid.join(stored, SLOT, "left").join(self.attempts().withColumnRenamed("status", "_failed"), SLOT, "left")
        status = F.when(F.col("_stored"), "stored").otherwise(F.coalesce("_failed", F.lit("pending")))
        return out.select(*SLOT, F.coalesce("attempts", F.lit(0).cast("long")).alias("attempts"), status.alias("status"))
