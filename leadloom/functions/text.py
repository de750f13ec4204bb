"""Comparison keys for text.

Text compares without regard to case and trailing blanks. The keys are lower-cased,
right-trimmed copies; the stored spelling stays available for display.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_SUFFIX = "_key"


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def ci(value: Column | str) -> Column:
    """The comparison key of one text column; null stays null."""
    return F.lower(F.rtrim(_column(value)))


def identity_key(value: Column | str) -> Column:
    """Comparison key in which null and blank are the same."""
    return F.coalesce(ci(value), F.lit(""))


def normalise_text(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Add ``<col>_key`` for each text column."""
    return df.withColumns({f"{c}{KEY_SUFFIX}": ci(c) for c in cols})
