"""Mixing sources to target weights by Pfair scheduling of their blocks."""

from __future__ import annotations

import heapq
import math
from collections.abc import Mapping

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import rank_within
from .naming import unused

#: Target parts per source of the registered query and the pipeline; sources not named have one part.
TARGET_WEIGHTS = {"src0": 3, "src1": 2, "src2": 2}
BLOCK_DOCS = 16


def one_period(weights: Mapping[str, int]) -> list[str]:
    """The source of each slot of one period, which has as many slots as the weights add up to.

    Block j (from 0) of a source of weight w in a period of p slots may not start before slot
    floor(j p / w) and must be done by slot ceil((j + 1) p / w). Of the released blocks the one
    with the earliest deadline goes first, ties by source. As the weights fill the period, every
    deadline holds, so after any number of slots a source is less than one block from its share.
    The schedule repeats after each period.
    """
    period = sum(weights.values())
    waiting = [(0, -(-period // w), s, 0) for s, w in weights.items()]  # release, deadline, source, block
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int]] = []
    slots = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, deadline, source, block = heapq.heappop(waiting)
            heapq.heappush(ready, (deadline, source, block))
        deadline, source, block = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError("a deadline was missed")
        slots.append(source)
        w = weights[source]
        if block + 1 < w:
            heapq.heappush(waiting, ((block + 1) * period // w, -(-(block + 2) * period // w), source, block + 1))
    return slots


def phases(blocks: Mapping[str, int], weights: Mapping[str, int]) -> list[tuple]:
    """Rows of a table from block numbers to slots.

    While all sources have blocks, the period of all of them repeats. Where a source runs out
    the rest goes on in a period of their own weights, whose shares of each other are
    the same. A row is (source, phase, first block of the phase, blocks of it in the phase,
    blocks per period, slots per period, first slot of the phase, place in the period of each
    block). There are at most as many phases as sources.
    """
    left = {s: n for s, n in blocks.items() if n > 0}
    done = dict.fromkeys(left, 0)
    rows, start, phase = [], 0, 0
    while left:
        common = math.gcd(*(weights[s] for s in left))
        active = {s: weights[s] // common for s in left}
        slots = one_period(active)
        places: dict[str, list[int]] = {s: [] for s in active}
        for place, source in enumerate(slots):
            places[source].append(place)
        period = len(slots)

        def slot_of(source: str, block: int) -> int:
            periods, rest = divmod(block, active[source])
            return periods * period + places[source][rest]

        # The phase ends after the last block of the source that runs out first.
        length = min(slot_of(s, n - 1) for s, n in left.items()) + 1
        periods, rest = divmod(length, period)
        for s in list(left):
            used = periods * active[s] + sum(p < rest for p in places[s])
            if used:
                rows.append((s, phase, done[s], used, active[s], period, start, places[s]))
            done[s] += used
            left[s] -= used
            if not left[s]:
                del left[s]
        start += length
        phase += 1
    return rows


_PHASES = pa.schema(
    [("source", pa.string()), ("phase", pa.int32())]
    + [(n, pa.int64()) for n in ("first_block", "n_blocks", "per_period", "period", "first_slot")]
    + [("places", pa.list_(pa.int32()))]
)


def _phase_table(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    """``phases`` as a table. Arrow goes to the planner as it is; a list of tuples would start Python workers that stay for a minute."""
    columns = [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * len(_PHASES), _PHASES.types)]
    return spark.createDataFrame(pa.Table.from_arrays(columns, schema=_PHASES))


def mix_sources(
    docs: DataFrame,
    weights: Mapping[str | None, int] | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """``docs`` with the order in which a training run should read them.

    Adds ``_block`` (number within the source), ``_slot`` (of the block in the schedule),
    ``_phase`` (how many sources had run out) and ``_position`` (slot times ``block_docs`` plus place in the
    block; it rises along the order, with gaps behind short last blocks); where ``docs`` has a column of
    such a name, an underscore follows (``schedule_names``). A block is
    ``block_docs`` documents of one source in the order of their ids (nulls first, ties by a hash of all columns).
    ``weights`` are whole target parts per source; sources without one have weight 1. Within a phase
    each source is less than one block from its share after any number of slots. All rows and columns
    stay, each once: repeated rows have places of their own, null is a source like any
    other, texts of any length and null ones are carried along, and an empty table gives no rows.

    A source may hold most rows: they are numbered by ``rank_within``, which spreads a
    frequent key over all tasks. Only one row per source comes to the driver.
    """
    spark = docs.sparkSession
    source = F.when(F.col(source_col).isNull(), "n").otherwise(F.concat(F.lit("s"), F.col(source_col).cast("string")))
    # The document is one column, so that its names cannot meet others.
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = docs.select(document.alias("doc"), source.alias("source"), F.col(id_col).alias("id"), F.xxhash64(document).alias("tie"))
    counts = {r["source"]: r["n"] for r in rows.groupBy("source").agg(F.count(F.lit(1)).alias("n")).collect()}
    given = {("n" if s is None else f"s{s}"): w for s, w in (weights or {}).items()}
    if any(w < 1 or w != int(w) for w in given.values()):
        raise ValueError("weights must be whole and at least 1")
    blocks = {s: -(-n // block_docs) for s, n in counts.items()}
    table = _phase_table(spark, phases(blocks, {s: given.get(s, 1) for s in blocks}))

    place = (F.col("rn") - 1).alias("place")
    placed = rank_within(rows, ["source"], ["id", "tie"], "rn").select("doc", "source", place)
    placed = placed.withColumn("block", F.floor(F.col("place") / block_docs))
    # One row per source and phase that it takes part in; sources are few against blocks.
    number = F.col("block") - F.col("in.first_block")
    in_phase = (F.col("source") == F.col("in.source")) & (number >= 0) & (number < F.col("in.n_blocks"))
    periods = F.floor(number / F.col("in.per_period"))
    turn = F.get("in.places", (number % F.col("in.per_period")).cast("int"))
    slot = F.col("in.first_slot") + periods * F.col("in.period") + turn
    scheduled = placed.join(table.select(F.struct(*table.columns).alias("in")), in_phase)
    position = F.col("slot") * block_docs + F.col("place") % block_docs
    values = scheduled.select("doc", "block", "place", slot.alias("slot"), F.col("in.phase").alias("phase")).select(
        "doc", *[c.alias(n) for c, n in zip([F.col("block"), F.col("slot"), F.col("phase"), position], schedule_names(docs))]
    )
    return values.select(*[F.col("doc")[c].alias(c) for c in docs.columns], *schedule_names(docs))


def schedule_names(docs: DataFrame) -> list[str]:
    """The names under which ``mix_sources`` adds block, slot, phase and position."""
    return unused(docs, "_block", "_slot", "_phase", "_position")


def in_mixed_order(docs: DataFrame, weights: Mapping[str | None, int] | None = None, **options) -> DataFrame:
    """``docs`` sorted by the schedule of ``mix_sources``, whose rules hold: written to files, these hold the order."""
    mixed, position = mix_sources(docs, weights, **options), schedule_names(docs)[-1]
    ordered = mixed.repartitionByRange(position).sortWithinPartitions(position)
    return ordered.select(*[F.col(f"`{c}`") for c in docs.columns])
