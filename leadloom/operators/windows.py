"""Rankings within a key.

A group may hold a large part of all rows. Where one row per key is wanted, the ranks are
cut on the map side. Where every row needs its number, a key is numbered in slices.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import identity_key
from .aggregates import row_count

_HASH = "_key_hash"
#: Slices that all rows are cut into; a key with a third of the rows is numbered in a third as many groups.
SLICES = 1024
#: Rows of the sample for each slice.
SAMPLED = 8


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark plans a group limit before the shuffle, so each map task hands on one row per key.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: Sequence[str], order_desc: str, tiebreak: str) -> DataFrame:
    """The newest row of each key; an unknown date is oldest, ties go to the lowest ``tiebreak``."""
    return first_per_key(df, keys, [F.col(order_desc).desc_nulls_last(), F.col(tiebreak).asc()])


def _slices(df: DataFrame, place: Column, order: Sequence[str]) -> DataFrame:
    """The slices of every key that a cut divides: ``_of`` (hash), ``_low`` and ``_high`` (places, null: open), ``_slice``.

    Cuts part all rows into about ``SLICES`` slices of equally many rows. A sample that a hash of the row picks, of
    about ``SLICES * SAMPLED`` rows whatever the size of the table, is sorted; every ``SAMPLED``-th place is a
    cut. The sample follows from values alone. There are at most two rows per cut.
    """
    n = df.agg(row_count().alias("n")).scalar()
    # Not the hash of the key, which is the first part of the place.
    share = F.shiftrightunsigned(F.xxhash64(F.lit("sample"), *order), 11) / F.lit(float(1 << 53))
    picked = df.where(share * n < SLICES * SAMPLED).agg(F.array_sort(F.collect_list(place)).alias("places"))
    cuts = picked.select(F.filter("places", lambda _, i: i % SAMPLED == SAMPLED - 1).alias("cuts"))

    def between(cut: Column, i: Column) -> Column:
        """The slice that begins at a cut, and for the first cut of a key the one that ends there."""
        earlier, later = F.get("cuts", i - 1), F.get("cuts", i + 1)
        of = cut[_HASH].alias("_of")
        here = [of, cut.alias("_low"), F.when(later[_HASH] == cut[_HASH], later).alias("_high"), (2 * i + 1).alias("_slice")]
        ahead = [of, F.lit(None).alias("_low"), cut.alias("_high"), (2 * i).alias("_slice")]
        opens = F.when(~earlier[_HASH].eqNullSafe(cut[_HASH]), F.struct(*ahead))
        return F.array(opens, F.struct(*here))

    slices = F.filter(F.flatten(F.transform("cuts", between)), lambda s: s.isNotNull())
    return cuts.select(F.explode(slices).alias("slice")).select("slice.*")


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str], name: str = "rn") -> DataFrame:
    """Number the rows of each key from 1, in ascending order with nulls first.

    ``order`` must end in a column that is unique, so that the numbering is repeatable.
    All rows, in the order of the key's hash and then of ``order``, are cut into slices of about equally
    many rows, wherever the values lie. A window numbers the rows of a key within a slice, so
    the rows of a frequent key spread over many groups. Only keys that a cut divides need the counts of their
    earlier slices. Slices and counts are broadcast: there are two rows per cut of each at most, as a cut divides
    one key. Cuts follow from values alone: a task that runs again finds the same ones.
    """
    hashed = df.withColumn(_HASH, F.xxhash64(*keys))
    place = F.struct(_HASH, *[F.col(c).alias(f"_{i}") for i, c in enumerate(order)])
    slices = F.broadcast(_slices(hashed.select(_HASH, *order), place, order))
    inside = (F.col("_low").isNull() | (F.col("_low") <= place)) & (F.col("_high").isNull() | (place < F.col("_high")))
    inside = (F.col(_HASH) == F.col("_of")) & inside
    columns = [*df.columns, _HASH, F.coalesce("_slice", F.lit(0)).alias("_slice")]
    sliced = hashed.join(slices, inside, "left").select(*columns)
    # The hash leads the sort of the window, so the texts are compared within a key only.
    w = W.partitionBy(_HASH, *keys, "_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    numbered = sliced.withColumn("_place", F.row_number().over(w))

    divided = hashed.join(slices, inside)
    counts = divided.groupBy(_HASH, *keys, "_slice").agg(row_count().alias("_n"))
    earlier = W.partitionBy(_HASH, *keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    before = counts.withColumn("_before", F.sum("_n").over(earlier)).where(F.col("_before").isNotNull())
    before = before.select("_before", *[F.col(c).alias(f"_same_{c}") for c in (_HASH, *keys, "_slice")])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_same_{c}")) for c in (_HASH, *keys, "_slice")])
    return numbered.join(F.broadcast(before), same, "left").select(
        *df.columns, (F.col("_place") + F.coalesce("_before", F.lit(0))).cast("long").alias(name)
    )


def _with_identity(df: DataFrame, identity_cols: Sequence[str]) -> tuple[DataFrame, list[str]]:
    keys = {f"_identity_{c}": identity_key(c) for c in identity_cols}
    return df.withColumns(keys), list(keys)


def duplicate_rank(
    df: DataFrame,
    id: str,
    identity_cols: Sequence[str],
    order_col: str,
    since: dt.date | Column | None = None,
    name: str = "rn",
) -> DataFrame:
    """The occurrence number of each record among those with the same identity.

    Null and blank identity fields are the same. With ``since``, only records from then on
    are ranked and returned. A rank above 1 marks a repeat.
    """
    if since is not None:
        df = df.where(F.col(order_col) >= since)
    keyed, keys = _with_identity(df, identity_cols)
    return rank_within(keyed, keys, [order_col, id], name).select(*df.columns, name)


def first_of_identity(df: DataFrame, id: str, identity_cols: Sequence[str], order_col: str) -> DataFrame:
    """The ids that ``duplicate_rank`` would give rank 1: one column, one row per identity."""
    keyed, keys = _with_identity(df.select(id, order_col, *identity_cols), identity_cols)
    order = [F.col(order_col).asc_nulls_first(), F.col(id).asc_nulls_first()]
    hashed = keyed.withColumn(_HASH, F.xxhash64(*keys))
    return first_per_key(hashed, [_HASH, *keys], order).select(id)


def has_duplicate(df: DataFrame, id: str, identity_cols: Sequence[str]) -> DataFrame:
    """Records for which another id has the same identity. Ids must be unique.

    No pairs are formed. An identity whose lowest and highest id agree has no duplicate;
    its record is dropped by an anti join on the id alone, so the join has no frequent key
    however large an identity is, and moves no identity.
    """
    keyed, keys = _with_identity(df.select(id, *identity_cols), identity_cols)
    single = (
        keyed.groupBy(*keys)
        .agg(F.min(id).alias("_single_id"), F.max(id).alias("_highest_id"))
        .where(F.col("_single_id") == F.col("_highest_id"))
        .select("_single_id")
    )
    return df.where(F.col(id).isNotNull()).join(single, F.col(id) == F.col("_single_id"), "left_anti")
