"""Projections (O-20..O-25) and sort/limit/set operations (O-49..O-52)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from regiostat.functions.scalars import round_half_even


def select_columns(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``df[cols]`` (O-20); a missing column fails like pandas."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"select_columns: missing {missing}")
    return df.select(*[F.col(f"`{c}`") for c in cols])


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """``rename(columns=...)`` (O-21); absent names are ignored, as in pandas."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def drop(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``drop(columns=...)`` (O-22)."""
    return df.drop(*cols)


def derive(df: DataFrame, exprs: Mapping[str, Column]) -> DataFrame:
    """Derived arithmetic columns in one projection (O-24)."""
    return df.withColumns(dict(exprs))


def round_float_columns(df: DataFrame, scale: int = 2) -> DataFrame:
    """``select_dtypes('float64')`` then ``round(scale)`` (O-25, O-58): every
    floating column in one projection; integer columns are untouched."""
    return df.select(*[
        round_half_even(f.name, scale).alias(f.name) if isinstance(f.dataType, (DoubleType, FloatType))
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def sort_nulls_last(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``sort_values(cols)`` with missing last (O-49, S17)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in cols])


def head(df: DataFrame, order: Sequence[str], n: int = 5) -> DataFrame:
    """``head(n)`` on an explicit order (O-50): a top-n, planned as
    TakeOrderedAndProject (no global sort)."""
    return sort_nulls_last(df, order).limit(n)


def concat(frames: Sequence[DataFrame]) -> DataFrame:
    """``pd.concat(ignore_index=True)``: UNION ALL by name (O-51)."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out
