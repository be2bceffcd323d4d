"""Incremental bronze ingest (O-19, O-06).

A file-source stream over the landing folder, run with
``trigger(availableNow=True)`` (a scheduled "pick up what is new" run).  Each
micro-batch is typed, split by slot validity, anti-joined against the slots
already in bronze (so a slot landed twice adds nothing) and appended.  The
stream checkpoint records which files were processed, so re-running on the
same checkpoint adds no rows; the anti join makes a replayed batch
idempotent after a failure between write and commit.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from regiostat.sources.epochs import path_exists


def _stored_slots(spark: SparkSession, path: str, keys: list[str]) -> DataFrame | None:
    """Distinct slot keys already in bronze, or None before the first write.
    Only a missing table counts as that: a table without a key column fails."""
    return spark.read.parquet(path).select(*keys).distinct() if path_exists(spark, path) else None


def ingest_available(spark: SparkSession, source_dir: str, source_format: str, schema: StructType,
                     bronze_path: str, checkpoint: str, slot_keys: Sequence[str],
                     transform: Callable[[DataFrame], DataFrame] | None = None,
                     partition_by: Sequence[str] = ()) -> None:
    """Process every file that landed since the last run, then stop."""
    keys = list(slot_keys)

    def process(batch: DataFrame, epoch_id: int) -> None:
        rows = transform(batch) if transform else batch
        seen = _stored_slots(spark, bronze_path, keys)
        if seen is not None:
            rows = rows.join(seen, on=keys, how="left_anti")
        w = rows.write.mode("append")
        if partition_by:
            w = w.partitionBy(*partition_by)
        w.parquet(bronze_path)

    stream = spark.readStream.schema(schema).format(source_format).load(source_dir)
    q = (stream.writeStream.foreachBatch(process)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def ingest_landing_stream(spark: SparkSession, landing_dir: str, bronze_path: str, dead_letter_path: str,
                          checkpoint: str, slot_keys: Sequence[str] = ("year", "month", "sd_code")) -> None:
    """J-1 as an incremental stream over landed API responses (O-19 with O-01,
    O-12..O-15, O-36, O-06): each micro-batch is exploded and typed, slots
    already in bronze are skipped, a slot with any invalid value goes whole to
    the dead-letter table (with the batch id as attempt), good slots are
    appended to bronze."""
    from pyspark.sql import functions as F

    from regiostat.plans.power import bronze_ingest
    from regiostat.sources.landing import explode_payload, read_responses

    keys = list(slot_keys)

    def process(batch: DataFrame, epoch_id: int) -> None:
        landed = explode_payload(batch)
        good, rejected = bronze_ingest(spark, landed, _stored_slots(spark, bronze_path, keys), keys)
        good.write.mode("append").parquet(bronze_path)
        rejected = rejected.withColumn("attempt", F.lit(epoch_id + 1))
        # a replayed micro-batch (failure after the bronze append) logs nothing twice
        own = keys + ["file", "attempt"]
        logged = _stored_slots(spark, dead_letter_path, own)
        if logged is not None:
            # null-safe: an unreadable response has no slot
            logged = logged.withColumnsRenamed({k: f"_logged_{k}" for k in own})
            same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"_logged_{k}")) for k in own))
            rejected = rejected.join(logged, on=same, how="left_anti")
        rejected.write.mode("append").parquet(dead_letter_path)

    stream = read_responses(spark.readStream, landing_dir)
    q = (stream.writeStream.foreachBatch(process)
               .option("checkpointLocation", checkpoint)
               .trigger(availableNow=True).start())
    q.awaitTermination()


def collect_stream(spark: SparkSession, landing_dir: str, store, checkpoint: str, name: str = "collect") -> None:
    """The closed loop of J-1 as a stream: each micro-batch is one run of a
    :class:`~regiostat.plans.collect.PowerStore`, so bronze and dead letter are
    committed together, dead slots are passed over, only the months in
    question are looked up, and a replayed batch is skipped."""
    from regiostat.sources.landing import explode_payload, read_responses

    def process(batch: DataFrame, epoch_id: int) -> None:
        store.ingest(explode_payload(batch), run=f"{name}-{epoch_id}")

    stream = read_responses(spark.readStream, landing_dir)
    (stream.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
           .trigger(availableNow=True).start().awaitTermination())
