"""Surrogate keys that stay (O-47): a key dictionary that only grows.

Numbering the rows of a table anew gives a row another id whenever earlier
rows appear.  Here every key that was ever seen keeps its id in a dictionary
table; a run numbers only keys that are not in it, after the largest id, and
appends them under one commit.  Ids have no gaps and no duplicates, and a run
that failed leaves nothing behind.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from regiostat.operators.timeseries import surrogate_ids
from regiostat.session import materialize
from regiostat.sources.epochs import EpochLog, read_committed, write_run


class KeyDictionary:
    """Keys and their ids below ``path``; ``keys`` is the schema of the key columns."""

    def __init__(self, spark: SparkSession, path: str, keys: StructType, id_column: str = "id", start_after: int = 0):
        self.spark, self.path, self.keys = spark, path, keys
        self.id, self.start_after = id_column, start_after
        self.log = EpochLog(spark, f"{path}/commits")

    def table(self) -> DataFrame:
        schema = StructType([*self.keys.fields, StructField(self.id, LongType())])
        return read_committed(self.spark, f"{self.path}/keys", schema, self.log).drop("epoch")

    def extend(self, rows: DataFrame, run: str, order: Sequence[str] = ()) -> int:
        """Number the keys of ``rows`` that are new, ordered by ``order``
        (some of the key columns) and then by the others.  Returns how many; a committed run adds none.
        Rows without a complete key get no id."""
        names = self.keys.names
        known = self.table()
        new = rows.select(*names).dropna().distinct().join(known.select(*names), names, "left_anti")
        new = materialize(new)
        n = new.count()
        if not n:
            return 0
        last = known.agg(F.max(self.id)).first()[0]  # one number
        by = [*order, *(k for k in names if k not in order)]
        numbered = surrogate_ids(new, int(last if last is not None else self.start_after), by, out=self.id)
        done = write_run(self.log, run, {f"{self.path}/keys": (numbered.select(*names, self.id), [])})
        return 0 if done is None else n

    def ids(self, rows: DataFrame) -> DataFrame:
        """``rows`` with their ids; NULL for a key that is not in the dictionary."""
        return rows.join(self.table(), self.keys.names, "left")
