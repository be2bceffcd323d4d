"""Scalar column functions (O-53..O-64).  All are JVM-side expressions.

pandas semantics that differ from Spark and are reproduced here:
  * ``Series.round(n)`` scales, rounds half-to-even, unscales: ``rint(x*10^n)/10^n``
    (Spark's ``round`` is half-up and ``bround`` rounds the decimal expansion).
  * ``to_numeric(errors='coerce')`` gives missing for anything that is not a
    plain decimal/scientific literal; Spark's ``try_cast`` also accepts
    ``'1.0d'``, ``'NaN'`` and ``'Infinity'``, so a literal pattern guards it.
  * ``str.split().str[0]`` splits on any Unicode white space and skips leading
    blanks; an empty string gives missing.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's labels for identical results).
# Month -> season, as coded by the reference (November is winter).
SEASON_BY_MONTH = {
    1: "겨울", 2: "겨울", 3: "봄", 4: "봄", 5: "봄", 6: "여름",
    7: "여름", 8: "여름", 9: "가을", 10: "가을", 11: "겨울", 12: "겨울",
}
# Month -> electricity tariff season: July and August are summer, the rest other.
TARIFF_BY_MONTH = {
    1: "기타", 2: "기타", 3: "기타", 4: "기타", 5: "기타", 6: "기타",
    7: "하계", 8: "하계", 9: "기타", 10: "기타", 11: "기타", 12: "기타",
}
# ---------------------------------------------------------------------------

# A plain number as pandas.to_numeric reads it (optional sign, digits with an
# optional fraction, optional exponent, surrounding blanks allowed).
NUMERIC_LITERAL = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
INTEGER_LITERAL = r"^\s*[+-]?\d+\s*$"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def round_half_even(col, scale: int = 2) -> Column:
    """pandas ``round(scale)``: half-to-even on the scaled binary value (O-58)."""
    factor = float(10 ** scale)
    c = _c(col).cast("double")
    return F.rint(c * F.lit(factor)) / F.lit(factor)


def lenient_double(col) -> Column:
    """``pd.to_numeric(errors='coerce')``: bad or missing -> NULL (O-54, S11)."""
    s = _c(col).cast("string")
    return F.when(s.rlike(NUMERIC_LITERAL), F.trim(s).try_cast("double"))


def lenient_int(col) -> Column:
    """Lenient integer parse: non-integers -> NULL."""
    s = _c(col).cast("string")
    return F.when(s.rlike(INTEGER_LITERAL), F.trim(s).try_cast("long"))


def strict_int(col, name: str = "value") -> Column:
    """``astype(int)``: fail on a bad *or missing* value (O-55, S12).

    The ANSI cast raises on a bad string but passes NULL, so NULL raises here.
    """
    c = _c(col)
    return F.when(c.isNull(), F.raise_error(F.lit(f"strict_int: NULL in {name}"))) \
        .otherwise(c.cast("int"))


def first_token(col) -> Column:
    """``str.split().str[0]``: first Unicode-white-space token or NULL (O-57, S19)."""
    return F.nullif(F.regexp_extract(_c(col), r"(?U)^\s*(\S+)", 1), F.lit(""))


def year_month_parts(col):
    """``'YYYY-MM'`` -> (year int, month int) by position (O-56)."""
    c = _c(col)
    return F.substring(c, 1, 4).cast("int"), F.substring(c, 6, 2).cast("int")


def quarter_of(month) -> Column:
    """``(month-1)//3+1`` (O-60)."""
    return (F.floor((_c(month) - F.lit(1)) / F.lit(3)) + F.lit(1)).cast("int")


def map_month(month, mapping: dict[int, str]) -> Column:
    """Dict lookup; an unmapped key gives NULL like ``Series.map`` (O-61/O-62)."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*pairs), _c(month).cast("int"))


def season_of(month, mapping: dict[int, str] | None = None) -> Column:
    return map_month(month, mapping or SEASON_BY_MONTH)


def tariff_of(month, mapping: dict[int, str] | None = None) -> Column:
    return map_month(month, mapping or TARIFF_BY_MONTH)


def inf_to_null(col) -> Column:
    """``replace([inf, -inf], nan)`` for data produced elsewhere (O-59); NaN too."""
    c = _c(col)
    return F.when(F.isnan(c) | (F.abs(c) == F.lit(float("inf"))), F.lit(None)).otherwise(c)


def zero_pad(col, width: int = 2) -> Column:
    """``f'{m:02d}'`` (O-16)."""
    return F.lpad(_c(col).cast("string"), width, "0")


def code_prefix(col, length: int = 2) -> Column:
    """``code[:2]`` (O-16)."""
    return F.substring(_c(col).cast("string"), 1, length)
