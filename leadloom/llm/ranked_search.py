"""Ranked lexical search of many items at once: terms that items share are added up once per document."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import pairwise
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import has_folder, new_folder, stage
from .bytesops import ALNUM_LOWER, text_slices, word_hashes, word_spans

TOP = 50
#: Bytes of different terms in a block of items, as planned: all that a task knows of the items at a time.
BLOCK_BYTES = 4 << 20
#: Bytes of accumulators that a task holds at a time.
ACCUMULATOR_BYTES = 32 << 20
#: Parts of the documents whose best are found before the best of all are.
PARTS = 64

_FILTER_BITS = 22


class SharingPlan(NamedTuple):
    """Sums to form, each once, and where each item's sum is found.

    Node i below ``n_terms`` is term i; node ``n_terms`` + k is the sum of the two nodes
    ``sums[k]``. ``items[j]`` is the node of item j, or -1 for an item without terms.
    """

    n_terms: int
    sums: list[tuple[int, int]]
    items: list[int]


def sharing_plan(items: Sequence[Sequence[int]], n_terms: int) -> SharingPlan:
    """Mine sets of terms that several items share, and build all items from them.

    ``items`` holds the different term numbers of each item. Terms of an item stand in one
    order for all, the most widely shared first. Neighbours that occur in two items or
    more become a node of their own, and so on with the nodes, until no two items share two neighbours.
    What is left of an item is chained up. Equal items end in the same node. Each round reads every item once.
    """
    spread = Counter(t for item in items for t in item)
    rows = [sorted(set(item), key=lambda t: (-spread[t], t)) for item in items]
    sums: list[tuple[int, int]] = []
    made: dict[tuple[int, int], int] = {}

    def node(pair: tuple[int, int]) -> int:
        if pair not in made:
            made[pair] = n_terms + len(sums)
            sums.append(pair)
        return made[pair]

    while True:
        pairs = Counter(p for row in rows for p in pairwise(row))
        shared = {p: n for p, n in pairs.items() if n > 1}
        if not shared:
            break
        merged = []
        for row in rows:
            result, i = [], 0
            while i < len(row):
                here = shared.get((row[i], row[i + 1]), 0) if i + 1 < len(row) else 0
                after = shared.get((row[i + 1], row[i + 2]), 0) if i + 2 < len(row) else 0
                if here and here >= after:
                    result.append(node((row[i], row[i + 1])))
                    i += 2
                else:
                    result.append(row[i])
                    i += 1
            merged.append(result)
        rows = merged
    ends = []
    for row in rows:
        total = row[0] if row else -1
        for other in row[1:]:
            total = node((total, other))
        ends.append(total)
    return SharingPlan(n_terms, sums, ends)


class _Vocabulary:
    """Exact lookup of words: a bit filter, then sorted hashes, then the bytes themselves."""

    def __init__(self, words: Sequence[bytes]):
        flat = np.frombuffer(b"".join(words), np.uint8)
        ends = np.cumsum([len(w) for w in words], dtype=np.int64) if words else np.zeros(0, np.int64)
        starts = np.concatenate([[0], ends[:-1]]).astype(np.int64) if words else ends
        hashes = word_hashes(flat, starts, ends)
        self.order = np.argsort(hashes, kind="stable")
        self.hashes = hashes[self.order]
        if len(np.unique(hashes)) != len(hashes):
            raise ValueError("two terms have the same hash")
        self.flat, self.starts, self.lengths = flat, starts, ends - starts
        self.filter = np.zeros(1 << _FILTER_BITS, bool)
        self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def find(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are known, and which they are."""
        hashes = word_hashes(data, starts, ends)
        at = np.flatnonzero(self.filter[(hashes >> np.uint64(64 - _FILTER_BITS)).astype(np.int64)])
        place = np.searchsorted(self.hashes, hashes[at])
        place = np.minimum(place, len(self.hashes) - 1)
        same = self.hashes[place] == hashes[at]
        at, term = at[same], self.order[place[same]]
        same = self.lengths[term] == (ends - starts)[at]
        at, term = at[same], term[same]
        sizes = self.lengths[term]
        inside = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        differ = data[np.repeat(starts[at], sizes) + inside] != self.flat[np.repeat(self.starts[term], sizes) + inside]
        wrong = np.unique(np.repeat(np.arange(len(at)), sizes)[differ])
        return np.delete(at, wrong), np.delete(term, wrong)


def item_terms(items: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``items`` that has a term: ``item_id``, ``terms`` (its different ones), ``bytes`` (of them)."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                mapped = ALNUM_LOWER[data]
                starts, ends, first = word_spans(mapped, offsets)
                found = [
                    sorted({mapped[starts[k] : ends[k]].tobytes() for k in range(first[i], first[i + 1])})
                    for i in range(len(offsets) - 1)
                ]
                ids = batch.column(0).slice(row, len(found))
                sizes = [sum(map(len, f)) for f in found]
                columns = [ids, pa.array(found, pa.list_(pa.binary())), pa.array(sizes, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "terms", "bytes"])

    narrow = items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(task, "item_id long, terms array<binary>, bytes long").where("size(terms) > 0")


def document_postings(docs: DataFrame, terms: Sequence[bytes], id_col: str, text_col: str) -> DataFrame:
    """Per document with a term of its own: ``doc_id``, ``n`` (all its terms), ``term`` and ``tf`` (arrays, of the given ones)."""
    shared = docs.sparkSession.sparkContext.broadcast(list(terms))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _Vocabulary(shared.value)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1)):
                mapped = ALNUM_LOWER[data]
                starts, ends, first = word_spans(mapped, offsets)
                word, term = known.find(mapped, starts, ends)
                text = np.searchsorted(first, word, "right") - 1
                pair, tf = np.unique(text * len(known.order) + term, return_counts=True)
                counts = np.diff(first)
                some = np.flatnonzero(counts)
                per_text = np.searchsorted(pair, np.append(some, len(counts)) * len(known.order)).astype(np.int32)
                per_text[-1] = len(pair)
                columns = [
                    batch.column(0).take(pa.array(row + some)),
                    pa.array(counts[some]),
                    pa.ListArray.from_arrays(pa.array(per_text), pa.array((pair % len(known.order)).astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(per_text), pa.array(tf.astype(np.int32))),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n", "term", "tf"])

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return narrow.mapInArrow(task, "doc_id long, n long, term array<int>, tf array<int>")


def _document_frequencies(postings: DataFrame, n_terms: int) -> np.ndarray:
    """Documents of each term. Tasks count theirs first, so a term has one row per task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(n_terms, np.int64)
        for batch in batches:
            counts += np.bincount(np.asarray(batch.column(0).flatten()), minlength=n_terms)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], ["term", "df"])

    rows = postings.select("term").mapInArrow(task, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    found = rows.toArrow()
    result = np.zeros(n_terms, np.int64)
    result[found["term"].to_numpy()] = found["df"].to_numpy()
    return result


def term_weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def accumulate(plan: SharingPlan, rows: dict[int, np.ndarray]) -> list[np.ndarray | None]:
    """Scores of all documents at hand for each item (None: all zero).

    ``rows`` has the contributions of the terms that occur. Each sum of the plan is formed once,
    and dropped when nothing further needs it.
    """
    uses = Counter(x for pair in plan.sums for x in pair) + Counter(x for x in plan.items if x >= 0)
    values: dict[int, np.ndarray] = dict(rows)

    def take(node: int) -> np.ndarray | None:
        uses[node] -= 1
        return values.get(node) if uses[node] else values.pop(node, None)

    for k, (a, b) in enumerate(plan.sums):
        left, right = take(a), take(b)
        total = right if left is None else left if right is None else left + right
        if total is not None:
            values[plan.n_terms + k] = total
    return [values.get(node) if node >= 0 else None for node in plan.items]


class _Best:
    """The highest scores of one item so far; equal ones by id, nulls last."""

    def __init__(self, top: int):
        self.top, self.floor = top, 1
        self.scores, self.ids, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, null: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.floor)
        if not len(at):
            return
        scores, ids, null = (np.concatenate([a, b[at]]) for a, b in ((self.scores, scores), (self.ids, ids), (self.null, null)))
        order = np.lexsort((ids, null, -scores))[: self.top]
        self.scores, self.ids, self.null = scores[order], ids[order], null[order]
        if len(order) == self.top:
            self.floor = int(self.scores[-1])


def _scores(
    postings: DataFrame, plan: SharingPlan, weights: np.ndarray, n_docs: int, n_words: int, top: int, block: int
) -> DataFrame:
    """The best documents of each task for each item of a block: ``block``, ``item``, ``doc_id``, ``score``."""
    shared = postings.sparkSession.sparkContext.broadcast((plan, weights))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan, weights = shared.value
        best: dict[int, _Best] = {node: _Best(top) for node in plan.items if node >= 0}
        first_item = {}
        for item, node in enumerate(plan.items):
            first_item.setdefault(node, item)
        step = max(1, ACCUMULATOR_BYTES // (8 * (plan.n_terms + len(plan.sums) + 1)))
        for batch in batches:
            ids = batch.column(0)
            null = ~np.asarray(ids.is_valid()) if ids.null_count else np.zeros(len(ids), bool)
            ids = np.asarray(ids.fill_null(0))
            length = np.asarray(batch.column(1))
            offsets = np.asarray(batch.column(2).offsets)
            term = np.asarray(batch.column(2).values)
            tf = np.asarray(batch.column(3).values).astype(np.int64)
            m = 100 - 50 + (50 * length * n_docs) // n_words
            for begin in range(0, len(ids), step):
                end = min(begin + step, len(ids))
                part = slice(offsets[begin], offsets[end])
                doc = np.repeat(np.arange(end - begin), np.diff(offsets[begin : end + 1]))
                gain = weights[term[part]] * ((1_000_000_000 * tf[part]) // (1000 * tf[part] + 20 * m[begin:end][doc]))
                order = np.argsort(term[part], kind="stable")
                names, starts = np.unique(term[part][order], return_index=True)
                rows = {}
                for name, a, b in zip(names.tolist(), starts, np.append(starts[1:], len(order))):
                    row = np.zeros(end - begin, np.int64)
                    row[doc[order[a:b]]] = gain[order[a:b]]
                    rows[name] = row
                found = accumulate(plan, rows)
                for node, item in first_item.items():
                    if node >= 0 and found[item] is not None:
                        best[node].add(found[item], ids[begin:end], null[begin:end])
        for item, node in enumerate(plan.items):
            if node >= 0 and len(best[node].scores):
                b = best[node]
                n = len(b.scores)
                columns = [
                    pa.array(np.full(n, block, np.int32)),
                    pa.array(np.full(n, item, np.int32)),
                    pa.array(b.ids, mask=b.null),
                    pa.array(b.scores),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["block", "item", "doc_id", "score"])

    return postings.mapInArrow(task, "block int, item int, doc_id long, score long")


def _block(
    docs: DataFrame, rows: list, block: int, top: int, id_col: str, text_col: str, totals: tuple[int, int] | None
) -> tuple[DataFrame | None, tuple[int, int]]:
    """Best documents per task for one block of items, and the numbers of documents and of their terms."""
    terms = sorted({bytes(t) for r in rows for t in r["terms"]})
    number = {t: i for i, t in enumerate(terms)}
    postings = stage(document_postings(docs, terms, id_col, text_col))
    if totals is None:
        found = postings.agg(F.count(F.lit(1)).alias("docs"), F.sum("n").alias("words")).first()
        totals = found["docs"], found["words"] or 0
    if not totals[0]:
        return None, totals
    df = _document_frequencies(postings, len(terms))
    weights = np.array([term_weight(totals[0], int(x)) for x in df], np.int64)
    plan = sharing_plan([[number[bytes(t)] for t in r["terms"]] for r in rows], len(terms))
    return _scores(postings, plan, weights, *totals, top, block), totals


def search(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The ``top`` highest-scoring documents of each item: ``item_id``, ``rank`` (from 1), ``doc_id``, ``score`` (above 0).

    Terms are runs of letters, digits and characters beyond ASCII, A-Z in lower case. A
    document's score adds up, over the different terms of the item, a weight that falls with the
    number of documents of the term, times a share that rises with its occurrences and falls
    with the length of the document; all of it in whole numbers. Equal scores rank by id, nulls last.

    Items come in blocks of about ``block_bytes`` bytes of terms. For a block each task knows all
    terms and one plan of sums: every whole text is read once, what it holds of the terms is
    stored, and each sum that items share is formed once per document. A task hands on its
    best documents only. Null and empty texts have no terms: such documents are not counted, such items have no
    rows. Every row of ``docs`` and of ``items`` stands for itself, also where rows or ids repeat. Other columns
    are not read. An empty table on either side gives no rows.
    """
    spark: SparkSession = docs.sparkSession
    schema = "item_id long, rank int, doc_id long, score long"
    wanted = item_terms(items, item_col, item_text_col)
    wanted = stage(wanted.withColumn("spread", F.xxhash64("item_id", "terms")))
    size = wanted.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    if not size:
        return spark.createDataFrame([], schema)
    blocks = -(-size // block_bytes)
    path, found_rows, totals = new_folder(spark) if has_folder(spark) else None, None, None
    for block in range(blocks):
        rows = wanted.where(F.pmod("spread", F.lit(blocks)) == block).orderBy("item_id", "spread").collect()
        if not rows:
            continue
        found, totals = _block(docs, rows, block, top, id_col, text_col, totals)
        if found is None:
            break
        names = spark.createDataFrame([(i, r["item_id"]) for i, r in enumerate(rows)], "i int, item_id long")
        # One row per item of the block.
        named = found.join(F.broadcast(names), F.col("item") == F.col("i")).drop("i")
        if path:
            named.write.mode("append").parquet(path)
        else:
            block_rows = stage(named)
            found_rows = block_rows if found_rows is None else found_rows.unionByName(block_rows)
    if not totals[0]:
        return spark.createDataFrame([], schema)
    found = spark.read.schema("block int, item int, doc_id long, score long, item_id long").parquet(path) if path else found_rows
    best = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    part = F.pmod(F.xxhash64("doc_id"), F.lit(PARTS))
    some = found.withColumn("place", F.row_number().over(W.partitionBy("block", "item", part).orderBy(*best)))
    place = F.row_number().over(W.partitionBy("block", "item").orderBy(*best))
    ranked = some.where(F.col("place") <= top).withColumn("rank", place).where(F.col("rank") <= top)
    return ranked.select("item_id", "rank", "doc_id", "score")
