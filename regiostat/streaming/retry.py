"""Bounded retry as keyed stream state with timers (O-14, O-18).

Each slot holds one state: failed attempts so far, the time of the last one,
and when the slot is due again.  A failure moves the due time; when it has
passed, a timer hands the slot out for another attempt (``retry``).  From
``max_attempts`` failures on the slot is a ``dead_letter`` and has no timer.  A
success clears the state.

Attempts are counted and the last failure is a maximum, so the state of a slot
doesn't depend on how failures are dealt to micro-batches, and the checkpoint
carries it over a restart.  Each batch of rows is counted by slot before the
shuffle, so a slot that holds a third of all failures sends a few rows a task.

This is the one part of the library that needs Python workers: arbitrary state
with timers has no form in built-in functions.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence

import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import LongType, StringType, StructField, StructType, TimestampType

from regiostat.operators.ingest import MAX_ATTEMPTS

# executors need no installed copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: A failed slot is due again after this.
BACKOFF_SECONDS = 3600
PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class RetryState(StatefulProcessor):
    """attempts, last failure and due time (microseconds) of a slot."""

    def __init__(self, keys: Sequence[str], max_attempts: int, backoff: int):
        self.keys, self.most, self.backoff = list(keys), max_attempts, backoff

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.state = handle.getValueState("slot", "attempts long, last long, due long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        failed, last, stored = 0, -1, False
        for part in rows:
            failed += int(part["failed"].sum())
            last = max(last, int(part["last"].max()))
            stored = stored or bool(part["stored"].any())
        old = self.state.get() if self.state.exists() else None
        if old is not None and old[2] >= 0:
            self.handle.deleteTimer(old[2] // 1000)
        if stored:
            self.state.clear()
            return
        attempts, last = (failed, last) if old is None else (failed + old[0], max(last, old[1]))
        if attempts >= self.most:
            self.state.update((attempts, last, -1))
            yield self.row(key, attempts, "dead_letter", last, None)
        else:
            due = last + self.backoff
            self.state.update((attempts, last, due))
            self.handle.registerTimer(due // 1000)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if not self.state.exists():
            return
        attempts, last, due = self.state.get()
        if due >= 0 and due // 1000 == expiredTimerInfo.getExpiryTimeInMs():
            self.state.update((attempts, last, -1))
            yield self.row(key, attempts, "retry", last, due)

    def close(self) -> None:
        pass

    def row(self, key, attempts: int, status: str, last: int, due: int | None) -> pd.DataFrame:
        return pd.DataFrame({**{k: [v] for k, v in zip(self.keys, key)}, "attempts": [attempts], "status": [status],
                             "last_failed": [last], "due": pd.array([due], dtype="Int64")})


def _counted(keys: list[str]):
    """Failures of each slot in a part of a micro-batch."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            t = pa.Table.from_batches([batch]).group_by(keys).aggregate(
                [("failed", "sum"), ("last", "max"), ("stored", "max")])
            t = t.select([*keys, "failed_sum", "last_max", "stored_max"]).rename_columns([*keys, "failed", "last", "stored"])
            yield from t.to_batches()

    return count


def retry_stream(attempts: DataFrame, slot_keys: Sequence[str], failed_at: str, stored: str | None = None,
                 max_attempts: int = MAX_ATTEMPTS, backoff_seconds: int = BACKOFF_SECONDS) -> DataFrame:
    """A stream of attempts (one row each; ``stored`` true for a success) ->
    a stream of (slot, attempts, status, last_failed_at, due_at): ``retry``
    when a slot is due, ``dead_letter`` once it has failed too often.

    Attempts without a slot (a NULL key) name no slot to ask for again and are
    left out; an attempt without a time counts, and is due at once.
    """
    keys = list(slot_keys)
    success = F.coalesce(F.col(stored), F.lit(False)) if stored else F.lit(False)
    rows = attempts.dropna(subset=keys).select(
        *keys, (~success).cast("long").alias("failed"),
        F.coalesce(F.unix_micros(F.col(failed_at).cast("timestamp")), F.lit(0)).alias("last"), success.alias("stored"))
    rows = rows.mapInArrow(_counted(keys), rows.schema)
    out = StructType([*[rows.schema[k] for k in keys], StructField("attempts", LongType()), StructField("status", StringType()),
                      StructField("last_failed", LongType()), StructField("due", LongType())])
    states = rows.groupBy(*keys).transformWithStateInPandas(
        RetryState(keys, max_attempts, backoff_seconds * 1_000_000), outputStructType=out, outputMode="Append",
        timeMode="ProcessingTime")
    when = {c: F.timestamp_micros(c[:-3]).alias(c) for c in ("last_failed_at", "due_at")}
    return states.select(*keys, "attempts", "status", *when.values())


LOG_TYPES = [StructField("attempts", LongType()), StructField("status", StringType()),
             StructField("last_failed_at", TimestampType()), StructField("due_at", TimestampType())]


def run_retries(spark: SparkSession, attempts_dir: str, schema: StructType, slot_keys: Sequence[str], failed_at: str,
                log_path: str, checkpoint: str, stored: str | None = None,
                max_attempts: int = MAX_ATTEMPTS, backoff_seconds: int = BACKOFF_SECONDS,
                heartbeat_dir: str | None = None) -> None:
    """Process the attempts that landed since the last run; what became due or dead is appended to ``log_path``.

    Timers are looked at in every micro-batch, so one that becomes due while
    nothing lands waits for the next attempt.  With ``heartbeat_dir`` (a folder
    that the stream reads too) the run lands a row without a slot there, and
    so looks at the timers in any case.
    """
    if heartbeat_dir:
        spark.createDataFrame([tuple(None for _ in schema)], schema).coalesce(1).write.mode("append").parquet(heartbeat_dir)
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key, None)
    spark.conf.set(key, PROVIDER)  # keyed state with timers needs this store
    try:
        stream = spark.readStream.schema(schema).parquet(attempts_dir)
        out = retry_stream(stream, slot_keys, failed_at, stored, max_attempts, backoff_seconds)
        # one micro-batch: with clock timers, availableNow would run empty batches for ever
        out.writeStream.format("parquet").option("path", log_path).option("checkpointLocation", checkpoint) \
           .outputMode("append").trigger(once=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def current_status(log: DataFrame, slot_keys: Sequence[str]) -> DataFrame:
    """The latest word on each slot: the log row with most attempts."""
    rest = [c for c in log.columns if c not in slot_keys]
    latest = F.max_by(F.struct(*rest), F.struct("attempts", "last_failed_at"))
    return log.groupBy(*slot_keys).agg(latest.alias("_r")).select(*slot_keys, *[F.col(f"_r.{c}").alias(c) for c in rest])
