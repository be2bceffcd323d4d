"""Order-independent sums for pandas-style means.

A sum of doubles depends on the order in which rows arrive, which varies
between runs of a distributed aggregate.  Sums therefore run over decimals:
a decimal or integer column at its own scale, a double at 18 decimals of its
shortest text.  The sum goes back to a double and is divided there, so a mean
follows the reference (float mean, rounded once at the end) and does not
depend on partitioning.

Nothing is cut and nothing refused: where a value or a sum does not fit
DECIMAL(38,18) (beyond 1e20, infinite, or an input below about 1e-9 that 18
decimals distort), that group's sum is the plain sum of its doubles.
"""

from __future__ import annotations

DOUBLE_AS = "DECIMAL(38,18)"


def q(name: str) -> str:
    """Quote a column name for SQL text."""
    return "`" + name.replace("`", "``") + "`"


def decimal_sql(x: str, dtype: str) -> str:
    """SQL: a decimal or integer value as a decimal."""
    return x if dtype.startswith("decimal") else f"CAST({x} AS DECIMAL(20,0))"


def sum_sql(x: str, dtype: str, strict: bool = True) -> str:
    """SQL: exact sum as a double, where the group's values fit one, else the
    sum of doubles; NULL without values."""
    if dtype not in ("double", "float"):
        return f"CAST(sum({decimal_sql(x, dtype)}) AS DOUBLE)"
    d = f"try_cast({x} AS {DOUBLE_AS})"
    off = f"{d} IS NULL"  # too large or infinite
    if strict:
        off += f" OR abs(CAST({d} AS DOUBLE) - {x}) > abs({x}) * 1e-9D"
    fits = f"NOT bool_or({x} IS NOT NULL AND ({off}))"
    return f"coalesce(CASE WHEN {fits} THEN CAST(try_sum({d}) AS DOUBLE) END, sum(CAST({x} AS DOUBLE)))"


def mean_sql(x: str, dtype: str, strict: bool = True) -> str:
    return f"try_divide({sum_sql(x, dtype, strict)}, CAST(count({x}) AS DOUBLE))"
