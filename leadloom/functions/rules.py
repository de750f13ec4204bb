"""Ordered rule tables as columns."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F


def case_map(rules: Sequence[tuple[Column, Any]], default: Any) -> Column:
    """The value of the first rule whose predicate holds, else ``default``.

    A predicate that is null does not hold. Values and the default may be columns.
    """
    if not rules:
        return _value(default)
    (predicate, value), *rest = rules
    chain = F.when(predicate, _value(value))
    for predicate, value in rest:
        chain = chain.when(predicate, _value(value))
    return chain.otherwise(_value(default))


def _value(value: Any) -> Column:
    return value if isinstance(value, Column) else F.lit(value)
