"""Joins (O-34..O-39) and the size-checked broadcast every lookup goes through.

A lookup side is broadcast only after a bounded row count proves it small;
otherwise the join is left to the planner (sort-merge, with AQE free to
re-plan at run time and to split skewed partitions).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Lookups above this many rows, or above this many estimated bytes, are not
# broadcast.  The count stops reading at limit+1 rows, so the check itself is
# bounded.
BROADCAST_MAX_ROWS = 200_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024

_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4, "double": 8,
          "date": 4, "timestamp": 8, "timestamp_ntz": 8}


def row_width(df: DataFrame) -> int:
    """Estimated bytes per row from the schema (strings and nested values
    counted at 64 bytes, decimals at 16)."""
    total = 0
    for _, t in df.dtypes:
        total += _WIDTH.get(t, 16 if t.startswith("decimal") else 64)
    return total + 8


class Bounded:
    """A DataFrame whose row count is bounded by construction (literal rule
    rows, one row per rule key, ...): no count job is needed to prove it."""

    def __init__(self, df: DataFrame, rows: int):
        self.df, self.rows = df, rows

    @classmethod
    def literal(cls, spark, rows: list, schema: str) -> "Bounded":
        return cls(spark.createDataFrame(rows, schema), len(rows))


def is_small(df, max_rows: int = BROADCAST_MAX_ROWS, max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    frame_ = df.df if isinstance(df, Bounded) else df
    limit = min(max_rows, max_bytes // row_width(frame_))
    if isinstance(df, Bounded):
        return df.rows <= limit
    return frame_.limit(limit + 1).count() <= limit


def broadcast_if_small(df, max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """``broadcast(df)`` when its size is proven small (rows <= ``max_rows`` and
    rows x estimated width <= BROADCAST_MAX_BYTES): by a :class:`Bounded`
    bound, else by a count that stops at the limit + 1."""
    small = is_small(df, max_rows)
    df = df.df if isinstance(df, Bounded) else df
    return F.broadcast(df) if small else df


def frame(df) -> DataFrame:
    return df.df if isinstance(df, Bounded) else df


def assert_unique(df, keys: Sequence[str], what: str = "lookup"):
    """Fail when ``keys`` repeat (a duplicated alias would fan rows out, O-34a)."""
    # a NULL key joins nothing, so it cannot fan out
    dup = (frame(df).dropna(subset=list(keys))
             .groupBy(*keys).count().where(F.col("count") > 1).limit(5).collect())
    if dup:
        raise ValueError(f"{what}: duplicate keys {[tuple(r)[:-1] for r in dup]}")
    return df


def lookup_join(left: DataFrame, right: DataFrame, left_on: Sequence[str] | str,
                right_on: Sequence[str] | str | None = None, how: str = "left",
                max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Equi join to a lookup table; different key names allowed (O-34a/b/c).

    Plain ``=``: a NULL key never matches (the reference's pandas merge would
    pair NULL with NULL, which is never wanted for codes).
    """
    left_on = [left_on] if isinstance(left_on, str) else list(left_on)
    right_on = left_on if right_on is None else ([right_on] if isinstance(right_on, str) else list(right_on))
    right = broadcast_if_small(right, max_rows)
    if left_on == right_on:
        return left.join(right, on=left_on, how=how)
    cond = None
    for lk, rk in zip(left_on, right_on):
        c = left[lk] == right[rk]
        cond = c if cond is None else cond & c
    return left.join(right, on=cond, how=how)


def anti_join(df: DataFrame, existing: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of ``df`` whose key has no row in ``existing`` (O-36, O-05 set-based).

    ``existing`` is usually derived from much data, so it isn't counted first:
    that would compute it twice.  Its keys are shuffled once, and adaptive
    execution turns the join into a broadcast if they prove small.
    """
    return df.join(existing.select(*keys).distinct(), on=list(keys), how="left_anti")


def unmatched(df: DataFrame, key: str, report_cols: Sequence[str]) -> DataFrame:
    """Rows whose lookup produced no code: a data-quality table (O-39)."""
    return df.where(F.col(key).isNull()).select(*report_cols)

