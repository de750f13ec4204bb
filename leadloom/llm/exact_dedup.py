"""Exact duplicates, with frequent texts split off by a Misra-Gries summary. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: Texts with at least this share of all rows are found for certain; at most its inverse are broadcast.
FREQUENT_SHARE = 0.001


def normalised_text(text: Column | str) -> Column:
    """Null as empty; each run of ASCII white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", " ")


def _keeper(id: Column | str = "doc_id") -> Column:
    """Orders the rows of a group: smallest id first, rows without an id last, repeated rows by place."""
    id = F.col(id) if isinstance(id, str) else id
    return F.struct(id.isNull().alias("no_id"), id.alias("id"), F.col("row").alias("row"))


def frequent_digests(digests: DataFrame, share: float = FREQUENT_SHARE) -> DataFrame:
    """``digest``, ``keeper`` and ``group_size`` of all digests in at least ``share`` of the rows, and perhaps some others.

    A Misra-Gries summary of 1 / ``share`` counters, merged over the tasks, holds every such
    digest. Its entries are candidates; an exact count verifies them. So the result has
    at most 1 / ``share`` rows whatever the size of the table, and may be broadcast.
    The summary reads digests as text: it compares byte arrays by identity, so equal ones would not add up.
    """
    entries = digests.select(F.hex("digest").alias("digest")).stat.freqItems(["digest"], share)
    candidates = entries.select(F.explode("digest_freqItems").alias("text")).select(F.unhex("text").alias("candidate"))
    found = digests.join(F.broadcast(candidates), F.col("digest") == F.col("candidate"), "left_semi")
    return _sizes(found)


def _sizes(digests: DataFrame) -> DataFrame:
    """``digest``, ``keeper`` and ``group_size`` of the digests of more than one row."""
    counted = digests.groupBy("digest").agg(F.min(_keeper()).alias("keeper"), F.count(F.lit(1)).alias("group_size"))
    return counted.where("group_size > 1")


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", share: float = FREQUENT_SHARE
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Texts are equal when they agree after ``normalised_text``; of equal texts the row with
    the smallest id is kept (of repeated rows one; rows without an id come last). Rows of
    frequent texts are settled on the map side against the broadcast winners. The others are
    grouped by digest, which combines on the map side, and meet the groups of more than one row in
    a join that holds one row per group: no task collects a group.
    Other columns are not read; an empty table gives no rows.
    """
    digest = F.unhex(F.sha2(normalised_text(F.col(text_col)).cast("binary"), 256))
    digests = stage(
        docs.select(F.col(id_col).alias("doc_id"), digest.alias("digest"), F.monotonically_increasing_id().alias("row"))
    )
    winners = stage(frequent_digests(digests, share).withColumnRenamed("digest", "winner"))
    same = F.col("digest") == F.col("winner")
    frequent = digests.join(F.broadcast(winners), same).drop("winner")
    rest = digests.join(F.broadcast(winners.select("winner")), same, "left_anti")
    groups = _sizes(rest).withColumnRenamed("digest", "shared")
    single = {
        "keeper": F.coalesce("keeper", _keeper()),
        "group_size": F.coalesce("group_size", F.lit(1).cast("long")),
    }
    rest = rest.join(groups, F.col("digest") == F.col("shared"), "left").drop("shared").withColumns(single)
    return frequent.select(*rest.columns).unionByName(rest).select(
        "doc_id",
        F.col("keeper.id").alias("keep_id"),
        "group_size",
        (F.col("keeper.row") == F.col("row")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
