"""Null handling."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import _column


def first_value_of(*values: Column | str) -> Column:
    """The first value that is not null."""
    return F.coalesce(*[_column(v) for v in values])


def null_label(value: Column | str, label: str) -> Column:
    """Name the null bucket of a text column."""
    return F.coalesce(_column(value), F.lit(label))


def net_amount(plus: Column | str, minus: Column | str) -> Column:
    """``plus - minus`` with null read as zero on either side."""
    return F.coalesce(_column(plus), F.lit(0)) - F.coalesce(_column(minus), F.lit(0))
