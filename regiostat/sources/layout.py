"""Clustering on several columns at once (O-09): files ordered along a Z-curve.

Sorting by (a, b) lets a filter on ``a`` skip files, but not one on ``b``.  On
a Z-curve rows near in both columns lie near each other, so either filter
skips most files by their statistics.  Columns enter by rank among bounds from
a sample, so strings, dates and skewed numbers take equal parts of the curve.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regiostat.operators.aggregates import observed_count

#: Bits of a rank: a column is cut into two to the power of so many ranges.
BITS = 5
#: Rows sampled for the bounds, in expectation (they go through the driver).
SAMPLE = 20_000


def range_bounds(df: DataFrame, cols: Sequence[str], bits: int = BITS, sample: int = SAMPLE, seed: int = 9) -> dict[str, list]:
    """Ascending bounds of each column from a sample: quantiles of its values.
    A value that many rows share is one bound, whose range is then only it."""
    n = df.count()
    rows = df.select(*cols)
    if n > sample:
        rows = rows.sample(min(1.0, sample / n), seed)
    rows = rows.collect()
    out = {}
    for c in cols:
        values = sorted(r[c] for r in rows if r[c] is not None)
        cut = [values[len(values) * i // (1 << bits)] for i in range(1, 1 << bits)] if values else []
        out[c] = sorted(set(cut))
    return out


def range_rank(col: str, bounds: Sequence) -> Column:
    """Number of bounds at or below the value: 0 to ``len(bounds)``; a missing value ranks lowest."""
    def search(lo: int, hi: int) -> Column:  # a balanced decision tree, as deep as the rank has bits
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(col) >= F.lit(bounds[mid]), search(mid + 1, hi)).otherwise(search(lo, mid))

    return search(0, len(bounds)).cast("int")


def z_value(ranks: Sequence[Column], bits: int = BITS) -> Column:
    """Bits of the ranks interleaved, the first column's above the second's."""
    parts = []
    for i in range(bits):
        for j, r in enumerate(ranks):
            to = i * len(ranks) + (len(ranks) - 1 - j)
            parts.append(F.shiftleft(F.shiftright(r.cast("long"), i).bitwiseAND(F.lit(1)), to))
    return reduce(lambda a, b: a.bitwiseOR(b), parts)


def write_clustered(df: DataFrame, path: str, cols: Sequence[str], files: int, bits: int = BITS) -> int:
    """Write ``df`` in about ``files`` files ordered along the Z-curve of ``cols``; returns the rows written.

    Rows of one cell of the curve are told apart by a hash, so that a cell
    holding a third of all rows is cut into several files.
    """
    ranks = [range_rank(c, b) for c, b in range_bounds(df, cols, bits).items()]
    z, salt = z_value(ranks, bits), F.xxhash64(*df.columns)
    ordered = df.withColumns({"_z": z, "_salt": salt}).repartitionByRange(files, "_z", "_salt")
    ordered = ordered.sortWithinPartitions("_z", *cols).drop("_z", "_salt")
    ordered, seen = observed_count(ordered, "clustered")
    ordered.write.mode("overwrite").parquet(path)
    return int(seen.get.get("rows", 0))


def file_ranges(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows and value ranges of each file behind ``df``: what its statistics let a filter skip."""
    file = F.col("_metadata.file_path").alias("file")
    ends = [e for c in cols for e in (F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}"))]
    return df.select(*cols, file).groupBy("file").agg(F.count(F.lit(1)).alias("rows"), *ends)
