"""Grouped aggregates. All of them combine on the map side before they shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import ci


def any_flag(predicate: Column) -> Column:
    """1 if any row of the group meets the predicate, else 0; a null predicate is not met."""
    return F.max(F.when(predicate, 1).otherwise(0))


def count_where(predicate: Column, weight: Column | str | None = None) -> Column:
    """Number of rows that meet the predicate; with ``weight``, each row stands for so many."""
    if weight is None:
        weight = F.lit(1)
    elif isinstance(weight, str):
        weight = F.col(weight)
    return F.sum(F.when(predicate, weight).otherwise(0))


def row_count() -> Column:
    """Number of rows, whatever they hold."""
    return F.count(F.lit(1))


def mean(total: Column, n: Column) -> Column:
    """``total / n`` as double; null when there is nothing to average."""
    return F.try_divide(total.cast("double"), n)


def flag_any(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """One 0/1 column per named predicate: did any row of the key meet it?"""
    return df.groupBy(*keys).agg(*[any_flag(p).alias(name) for name, p in flags.items()])


def share_of_total(df: DataFrame, keys: Sequence[str], measures: Mapping[str, Column]) -> DataFrame:
    """Each grouped measure as a percentage of its sum over all groups.

    The totals are a scalar subquery over the grouped rows. It reads the shuffle of the
    grouping again instead of repeating the input, and no window gathers all groups in
    one task. A total of zero raises a division error; a null total gives null.
    """
    grouped = df.groupBy(*keys).agg(*[m.alias(name) for name, m in measures.items()])
    totals = grouped.agg(F.struct(*[F.sum(name).cast("double").alias(name) for name in measures])).scalar()
    shares = [
        (F.col(name).cast("double") * 100.0 / F.col("_totals").getField(name)).alias(name) for name in measures
    ]
    return grouped.withColumn("_totals", totals).select(*keys, *shares)


def distinct_slots(df: DataFrame, slot_keys: Sequence[str], keys: Sequence[str], name: str = "slots") -> DataFrame:
    """Number of different slots per key; rows that repeat a slot count once.

    ``keys`` must be among ``slot_keys``. Repeated bookings collapse on the map side, so a
    slot that holds most of the rows reaches the shuffle as one row per map task.
    """
    missing = set(keys) - set(slot_keys)
    if missing:
        raise ValueError(f"keys {sorted(missing)} are not part of the slot")
    return df.select(*slot_keys).distinct().groupBy(*keys).agg(row_count().alias(name))


def merge_spellings(
    grouped: DataFrame, keys: Sequence[str], text_keys: Sequence[str], sums: Sequence[str]
) -> DataFrame:
    """Add up groups whose text keys differ only in case or trailing blanks.

    Meant for rows that are grouped by the stored spelling already, which is a hash
    aggregate; the lowest spelling is shown. Taking the lowest string needs sorted input,
    so the rows are shuffled and sorted by one hash of the keys rather than by the texts.
    """
    text = {f"_key_{c}": ci(c) for c in text_keys}
    hashed = grouped.withColumns(text).withColumn("_hash", F.xxhash64(*keys, *text)).repartition("_hash")
    return (
        hashed.groupBy("_hash", *keys, *text)
        .agg(*[F.min(c).alias(c) for c in text_keys], *[F.sum(c).alias(c) for c in sums])
        .select(*keys, *text_keys, *sums)
    )
