"""Filters and predicates (O-26..O-31) with pandas' NULL behaviour made explicit."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def contains_literal(col: str, needle: str, na: bool | None = False) -> Column:
    """``str.contains(needle, regex=False, na=na)`` (O-27).

    ``na=False`` maps a missing value to False (S8); ``na=None`` keeps the
    three-valued result, and callers must decide (S9).
    """
    c = F.contains(F.col(col), F.lit(needle))
    return c if na is None else F.coalesce(c, F.lit(na))


def drop_contains(df: DataFrame, col: str, needle: str) -> DataFrame:
    """``df[~df[col].str.contains(needle, na=False)]``: missing values are kept."""
    return df.where(~contains_literal(col, needle, na=False))


def null_out_invalid(df: DataFrame, cols: Sequence[str], min_value: float = 0.0) -> DataFrame:
    """``where(col >= 0)``: invalid values become NULL, the row stays (O-29)."""
    return df.withColumns({c: F.when(F.col(c) >= F.lit(min_value), F.col(c)) for c in cols})


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropna(subset=keys)`` (O-28); also what pandas groupby does to keys (S5)."""
    return df.dropna(subset=list(keys))


def prune_single_closed(df: DataFrame, key: str | Sequence[str], closed_col: str,
                        cutoff: str = "2000-12-31") -> DataFrame:
    """Remove records that are the only one of their key *and* closed on or before
    ``cutoff`` (O-30, O-43, O-63, D6).

    pandas compares a missing date as False, so the negation keeps it (S7):
    the predicate is coalesced to False before negating.  The per-key count is
    an aggregate (partial, skew-tolerant), and only the keys that qualify for
    removal are joined back, as an anti join on the aggregate's own keys: it is
    computed once and dealt already.
    """
    keys = [key] if isinstance(key, str) else list(key)
    singles = (df.groupBy(*keys)
                 .agg(F.count(F.lit(1)).alias("_n"), F.max(F.col(closed_col)).alias("_closed"))
                 .where((F.col("_n") == 1) & F.coalesce(F.col("_closed") <= F.lit(cutoff), F.lit(False)))
                 .select(*keys))
    # pandas gives a missing key no count, so such rows are never pruned; in
    # the anti join a NULL key never matches, with the same effect.
    return df.join(singles, on=keys, how="left_anti")


def complete_groups(df: DataFrame, keys: Sequence[str], period: str,
                    expected: int = 12) -> DataFrame:
    """Keys of groups holding ``expected`` distinct periods (O-31, O-40e)."""
    return (df.groupBy(*keys).agg(F.count_distinct(period).alias("_cnt"))
              .where(F.col("_cnt") == expected).select(*keys))


def month_bitmask_count(month: str = "month") -> Column:
    """Distinct months 1..12 as an aggregate without a distinct-expand step:
    ``bit_count(bit_or(1 << month))``."""
    bit = F.call_function("shiftleft", F.lit(1), F.col(month).cast("int"))
    return F.bit_count(F.bit_or(bit))
