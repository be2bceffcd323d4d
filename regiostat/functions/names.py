"""Header cleaning (O-23, O-64).  Pure metadata: runs on ``df.columns`` only."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame

# ---------------------------------------------------------------------------
# The header-cleaning patterns (they must equal the reference's
# to produce the same column names): a bracketed part, a character that is
# neither a word character nor a Hangul syllable, a run of underscores.
_PAREN = re.compile(r"\(([^)]+)\)")
_NON_WORD = re.compile(r"[^\w가-힣]")
_UNDERSCORES = re.compile(r"_+")
# ---------------------------------------------------------------------------


def clean_column_name(name: str) -> str:
    """``평균기온(°C)`` -> ``평균기온_C``: bracket body joins with ``_``, other
    non-word characters become ``_``, runs collapse, edges are stripped."""
    out = _PAREN.sub(lambda m: "_" + m.group(1), name)
    out = _NON_WORD.sub("_", out)
    out = _UNDERSCORES.sub("_", out)
    return out.strip("_")


def clean_headers(df: DataFrame) -> DataFrame:
    """Rename every column with :func:`clean_column_name`; reject collisions.

    ``toDF`` renames by position, so dotted or bracketed source names need no
    back-tick escaping.
    """
    new = [clean_column_name(c) for c in df.columns]
    dupes = sorted({c for c in new if new.count(c) > 1})
    if dupes:
        raise ValueError(f"clean_headers: names collide after cleaning: {dupes}")
    return df.toDF(*new)
