"""Column names that a given table does not have."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame


def unused(taken: DataFrame | Iterable[str], *names: str) -> list[str]:
    """The names, each with as many underscores behind it as it takes to meet no column, whatever its case."""
    columns = taken.columns if isinstance(taken, DataFrame) else taken
    known = {c.lower() for c in columns}
    result = []
    for name in names:
        while name.lower() in known:
            name += "_"
        known.add(name.lower())
        result.append(name)
    return result
