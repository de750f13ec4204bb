"""Date windows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def rolling_month_start(as_of: dt.date | Column | None = None, months: int = 24) -> Column:
    """First day of the month ``months`` before ``as_of`` (default: today).

    With a date literal the optimiser folds this to a constant, which prunes files.
    """
    if as_of is None:
        as_of = F.current_date()
    elif not isinstance(as_of, Column):
        as_of = F.lit(as_of)
    return F.trunc(F.add_months(as_of, -months), "MM")
