"""Joins whose null rules or skew need care.

Broadcasting is left to the planner, which compares the size of a side with
``spark.sql.autoBroadcastJoinThreshold``; beyond it the join shuffles, and adaptive
execution splits a partition that a frequent key makes too big.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .aggregates import row_count

_SPREAD = "_spread"


def _all_equal(pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(x) == F.col(y) for x, y in pairs])


def _join_keeping_left(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    how: str,
    spread_by: Sequence[str] | None = None,
    residual: Column | None = None,
) -> DataFrame:
    """A left, semi or anti join in which left rows with a null key do not pile up.

    Such rows never match, yet a shuffle on the key alone would send all of them to one
    task. A second key spreads them: a hash of the key where there is one (equal on both
    sides), a hash of the row (or of its ``spread_by``) where there is none. It also gives each side a shuffle
    of its own, also where the right side is grouped by the key already; adaptive execution
    splits the partition of a frequent left key only then. ``residual`` is a further condition on matches.
    """
    for x, y in pairs:
        if left.schema[x].dataType != right.schema[y].dataType:
            raise TypeError(
                f"join keys differ in type: {x} {left.schema[x].dataType}, {y} {right.schema[y].dataType}"
            )
    left_keys = [F.col(x) for x, _ in pairs]
    right_keys = [F.col(y) for _, y in pairs]
    no_key = reduce(lambda a, b: a | b, [k.isNull() for k in left_keys])
    left = left.withColumn(
        _SPREAD, F.when(no_key, F.xxhash64(*(spread_by or left.columns))).otherwise(F.xxhash64(*left_keys))
    )
    right = right.withColumn(f"{_SPREAD}_right", F.xxhash64(*right_keys))
    match = _all_equal([*pairs, (_SPREAD, f"{_SPREAD}_right")])
    joined = left.join(right, match if residual is None else match & residual, how)
    return joined.drop(_SPREAD, f"{_SPREAD}_right")


def left_join(
    left: DataFrame,
    right: DataFrame,
    pairs: Sequence[tuple[str, str]],
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left outer join on ``(left column, right column)`` pairs, for keys that are often null.

    The right key columns are not in the result. The two sides must not share other names.
    Rows without a key are spread by a hash of all left columns; name a few varied ones in
    ``spread_by`` if the rows are wide.
    """
    renamed = right.withColumnsRenamed({y: f"_right_{y}" for _, y in pairs})
    clash = set(left.columns) & set(renamed.columns)
    if clash:
        raise ValueError(f"both sides have columns {sorted(clash)}")
    pairs = [(x, f"_right_{y}") for x, y in pairs]
    return _join_keeping_left(left, renamed, pairs, "left", spread_by).drop(*[y for _, y in pairs])


def hash_built(keys: DataFrame) -> DataFrame:
    """``keys``, a few columns wide, as the side of a join that is held as a hash table, unless it is small enough to broadcast.

    Without this the join sorts both sides, so a task holds its part of the wide other side in memory; so it holds its keys only.
    """
    planned = int(str(keys._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    small = planned <= keys.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return keys if small else keys.hint("shuffle_hash")


def semi_join(df: DataFrame, wanted: DataFrame, key: str, wanted_key: str) -> DataFrame:
    """Rows of ``df`` whose key is among the wanted ones; a null key is not. Only the wanted keys are held, see ``hash_built``.

    Where it shuffles, a grouping by the key behind it needs no shuffle of its own.
    """
    keys = hash_built(wanted.select(F.col(wanted_key).alias("_wanted")))
    return df.where(F.col(key).isNotNull()).join(keys, F.col(key) == F.col("_wanted"), "left_semi")


def not_in(df: DataFrame, other: DataFrame, key: str, other_key: str | None = None) -> DataFrame:
    """Rows of ``df`` for which ``key NOT IN (SELECT other_key FROM other)`` is true.

    A null in ``other`` leaves no row; a null key stays only if ``other`` is empty. Unlike
    SQL ``NOT IN``, the keys of ``other`` are not broadcast: this is an anti join with the groups of its
    keys, which also tell of nulls.
    """
    known = other.groupBy(F.col(other_key or key).alias("_other_key")).agg(row_count().alias("_n"))
    return not_in_keys(df, known, key)


def not_in_keys(df: DataFrame, known: DataFrame, key: str) -> DataFrame:
    """``not_in`` for keys that are grouped already: ``known`` has ``_other_key`` (null too, if there was one) and ``_n``."""
    # 0: no rows, every key passes; 1: no nulls, known keys pass; 2: a null, nothing passes.
    rule = F.when(row_count() == 0, 0).when(row_count() == F.count("_other_key"), 1).otherwise(2)
    strictness = known.agg(rule.alias("rule")).scalar()
    allowed = df.where(F.when(F.col(key).isNotNull(), 1).otherwise(0) >= strictness)
    present = known.where(F.col("_other_key").isNotNull()).select("_other_key")
    return _join_keeping_left(allowed, present, [(key, "_other_key")], "left_anti")


def exists_other(
    df: DataFrame, other: DataFrame, keys: Sequence[Column | str], differs: str, other_differs: str | None = None
) -> DataFrame:
    """Rows of ``df`` for which ``EXISTS`` a row of ``other`` with equal ``keys`` and ``differs <> other_differs``.

    ``keys`` are expressions on both tables. As in SQL, a null key equals none and a null on
    either side of ``<>`` is no difference; neither column need be unique. No pairs are formed:
    a key's lowest and highest value tell whether it has one that differs, so ``other`` reaches the
    semi join as one row per key, combined on the map side.
    """
    named = [f"_exists_{i}" for i in range(len(keys))]
    expressions = [F.col(k) if isinstance(k, str) else k for k in keys]
    value = F.col(other_differs or differs)
    grouped = other.where(value.isNotNull()).groupBy(*[k.alias(f"{n}_in") for k, n in zip(expressions, named)])
    bounds = grouped.agg(F.min(value).alias("_exists_low"), F.max(value).alias("_exists_high"))
    residual = (F.col("_exists_low") != F.col(differs)) | (F.col("_exists_high") != F.col(differs))
    keyed = df.withColumns(dict(zip(named, expressions)))
    pairs = [(n, f"{n}_in") for n in named]
    return _join_keeping_left(keyed, bounds, pairs, "left_semi", residual=residual).select(*df.columns)


def exclude_reversed(
    events: DataFrame,
    reversals: DataFrame,
    keys: Sequence[str],
    same_day: bool = False,
    event_date: str | None = None,
    reversal_date: str | None = None,
) -> DataFrame:
    """Events without a reversal that agrees on all ``keys`` (say subject and agent).

    The reversal may lie before the event. With ``same_day`` it must fall on the day of the
    event. A null in a key never agrees, so such events stay.
    """
    if not same_day:
        pairs = [(k, f"_reversal_{k}") for k in keys]
        columns = [F.col(k).alias(f"_reversal_{k}") for k in keys]
        done = reversals.select(*columns).dropna().distinct()
        return _join_keeping_left(events, done, pairs, "left_anti")
    if event_date is None or reversal_date is None:
        raise ValueError("same_day needs event_date and reversal_date")
    day = "_event_day"
    dated = events.withColumn(day, F.col(event_date).cast("date"))
    done = reversals.withColumn(day, F.col(reversal_date).cast("date"))
    return exclude_reversed(dated, done, [*keys, day]).drop(day)


def fallback_attribute(
    df: DataFrame, lookups: Sequence[tuple[DataFrame, str, str]], attrs: Sequence[str]
) -> DataFrame:
    """Add ``attrs`` from the first lookup that knows a value, tried in order.

    A lookup is ``(table, key column of df, key column of table)``. Each attribute falls
    back on its own.
    """
    result = df
    for i, (table, key, table_key) in enumerate(lookups):
        side = table.select(
            F.col(table_key).alias(f"_key_{i}"), *[F.col(a).alias(f"_{a}_{i}") for a in attrs]
        )
        result = left_join(result, side, [(key, f"_key_{i}")])
    n = range(len(lookups))
    return result.select(*df.columns, *[F.coalesce(*[F.col(f"_{a}_{i}") for i in n]).alias(a) for a in attrs])
