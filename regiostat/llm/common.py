"""Helpers shared by the operators: words, scratch tables, sized lookups."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from regiostat.session import checkpoint_root

#: Lookup tables up to this many rows are broadcast; larger ones are joined by
#: a shuffle, whose skewed partitions Spark's adaptive execution splits.
BROADCAST_ROWS = 20_000
#: Bytes of an Arrow batch.
BATCH_BYTES = 4 << 20


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8; none for a null.

    ``bytes.split`` cuts at exactly these six characters (``str.split`` would
    also cut at other Unicode spaces).
    """
    return text.encode("utf-8", "surrogatepass").split() if text else []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, size: int = BATCH_BYTES) -> None:
    """Rows go to Python in Arrow batches of at most ``size`` bytes from here on.

    A task holds a batch several times (Arrow buffers of both sides, Python
    strings, results), and Spark's own limit is 64 MB.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(size))


def free_name(taken: list[str], name: str) -> str:
    """``name``, with underscores until no column of ``taken`` has it (case ignored, as Spark does)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder name below the shared folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_root(spark)}/regiostat-llm/{name}-{uuid.uuid4().hex[:12]}"


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared scratch folder and read it again.

    It cuts the lineage: a lost executor costs the running stage only, and a
    table that several branches read is computed once.
    """
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def saved_counted(df: DataFrame, name: str) -> tuple[DataFrame, dict]:
    """:func:`saved`, and while writing the number of rows ``n`` and an order-free hash ``h`` of them."""
    seen = Observation()
    h = F.sum(F.xxhash64(*df.columns).cast("decimal(20,0)"))
    out = saved(df.observe(seen, F.count(F.lit(1)).alias("n"), h.alias("h")), name)
    return out, dict(seen.get)


def same_keys(left: DataFrame, right: DataFrame, keys: dict[str, str]):
    """Null-safe equality of ``left[k] = right[v]`` for each pair."""
    return reduce(lambda a, b: a & b, (left[k].eqNullSafe(right[v]) for k, v in keys.items()))


def lookup(df: DataFrame, side: DataFrame, keys: dict[str, str], how: str = "left",
           rows: int = BROADCAST_ROWS) -> DataFrame:
    """Join a lookup table on null-safe keys; ``side`` must be a saved table.

    At most ``rows`` rows are broadcast (counted first, the count stops
    there); a larger table is joined by a shuffle.
    """
    small = side.limit(rows + 1).count() <= rows
    on = same_keys(df, side, keys)
    joined = df.join(F.broadcast(side) if small else side.hint("merge"), on, how)
    return joined.drop(*[side[v] for v in keys.values()]) if how not in ("left_semi", "left_anti") else joined


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
