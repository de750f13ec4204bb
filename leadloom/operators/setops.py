"""Unions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .aggregates import row_count
from .joins import not_in_keys


def precedence_union(primary: DataFrame, fallback: DataFrame, key: str) -> DataFrame:
    """All primary rows, plus the fallback rows whose key is not among the primary keys.

    Membership follows ``NOT IN``: one null key among the primary rows leaves no fallback
    row. The primary rows are computed once: dealt out by a hash of the whole row, so that no
    key gathers, they are handed on from that shuffle, and one grouping of it by key tells which keys there are and
    whether one is null. A frequent fallback key can be split by adaptive execution.
    """
    # The hash needs every column, so all uses have the same shuffle below them.
    dealt = primary.repartition(F.xxhash64(*[F.col(f"`{c}`") for c in primary.columns]))
    known = dealt.groupBy(F.col(key).alias("_other_key")).agg(row_count().alias("_n"))
    return dealt.unionByName(not_in_keys(fallback, known, key))
