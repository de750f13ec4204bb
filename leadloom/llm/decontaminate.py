"""Benchmark decontamination: containment search by size-partitioned MinHash sketches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .bytesops import ALNUM_LOWER, give_back, shingle_hashes, text_slices, word_hashes, word_spans
from .naming import unused

SHINGLE_WORDS = 5
#: Share of an item's different shingles that a document must hold, as tenths.
CONTAINMENT_TENTHS = 8
#: Bits of each filter of a size class; its size does not depend on the data.
FILTER_BITS = 22


def _needed(size: Column) -> Column:
    return F.ceil(size * CONTAINMENT_TENTHS / 10).cast("int")


class _Words:
    """The words of many texts, and their shingles of any length."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.mapped = ALNUM_LOWER[data]
        self.starts, self.ends, self.first = word_spans(self.mapped, offsets)
        self.hashes = word_hashes(self.mapped, self.starts, self.ends)
        self.counts = np.diff(self.first)

    def shingles(self, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, first word and text index of all shingles of exactly so many words."""
        hashes, at, text = shingle_hashes(self.hashes, self.first, size)
        whole = self.counts[text] >= size
        return hashes[whole], at[whole], text[whole]

    def shingle(self, word: int, size: int) -> str:
        spans = zip(self.starts[word : word + size], self.ends[word : word + size])
        return b" ".join(self.mapped[a:b].tobytes() for a, b in spans).decode("utf-8", "replace")


def item_shingles(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """The different shingles of every item, with its size class and MinHash sketch.

    ``item_id``, ``hash``, ``shingle``, ``length`` (words of a shingle: ``SHINGLE_WORDS``, or all of a shorter
    item), ``size`` (of the item), ``size_class`` (power of two at or below it), ``needed``, and ``sketched``. A sketch is the size - needed + 1 smallest hashes:
    a document that lacks all of them lacks too many shingles to contain the item.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_pylist()
            for row, data, offsets in text_slices(batch.column(1)):
                found = _Words(data, offsets)
                for size in range(1, SHINGLE_WORDS + 1):
                    hashes, at, text = found.shingles(size)
                    own = np.minimum(found.counts[text], SHINGLE_WORDS) == size
                    hashes, at, text = hashes[own], at[own], text[own]
                    texts = [found.shingle(w, size) for w in at.tolist()]
                    columns = [[ids[row + t] for t in text.tolist()], hashes.view(np.int64), texts, [size] * len(at)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.string(), pa.int32()))],
                        ["item_id", "hash", "shingle", "length"],
                    )

    narrow = benchmark.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("binary").alias("text"))
    rows = narrow.mapInArrow(task, "item_id long, hash long, shingle string, length int").distinct()
    item = W.partitionBy("item_id")
    size = F.count(F.lit(1)).over(item)
    place = F.row_number().over(item.orderBy("hash", "shingle"))
    rows = rows.withColumns({"size": size, "place": place}).withColumn("needed", _needed(F.col("size")))
    return rows.withColumns(
        {
            "size_class": F.floor(F.log2(F.col("size"))).cast("int"),
            "sketched": F.col("place") <= F.col("size") - F.col("needed") + 1,
        }
    ).drop("place")


def _filters(items: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per length of shingles and size class: the length, fewest shingles needed, and bit filters of the sketches and of all shingles.

    Each filter is 2 ** ``FILTER_BITS`` bits whatever the size of the benchmark; the rows that come
    to the driver are its 64-bit words. There are at most as many classes as powers of two,
    and one for each shorter length.
    """
    slot = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    bit = F.shiftright(slot, 0).bitwiseAND(63)
    one = F.expr("shiftleft(1L, cast(_bit as int))")
    rows = items.select("length", "size_class", "needed", "sketched", F.shiftright(slot, 6).alias("word"), bit.alias("_bit"))
    words = rows.groupBy("length", "size_class", "word").agg(
        F.min("needed").alias("needed"),
        F.bit_or(one).alias("all_bits"),
        F.bit_or(F.when(F.col("sketched"), one).otherwise(F.lit(0).cast("long"))).alias("sketch_bits"),
    )
    result = []
    for length, size_class in sorted(map(tuple, items.select("length", "size_class").distinct().collect())):
        arrow = words.where((F.col("length") == length) & (F.col("size_class") == size_class)).toArrow()
        filters = []
        for name in ("sketch_bits", "all_bits"):
            bits = np.zeros(1 << (FILTER_BITS - 6), np.int64)
            bits[arrow["word"].to_numpy()] = arrow[name].to_numpy()
            filters.append(np.unpackbits(bits.view(np.uint8), bitorder="little").view(bool))
        result.append((length, int(arrow["needed"].to_numpy().min()), *filters))
    return result


def _document_hits(docs: DataFrame, items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Shingles that may be an item's, of documents that may contain an item of some size class.

    ``doc_id``, ``text_hash``, ``hash``, ``shingle``. A document passes a class when it meets its
    sketches at least once and its shingles as often as its smallest item needs.
    """
    filters = docs.sparkSession.sparkContext.broadcast(_filters(items))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(2)):
                found = _Words(data, offsets)
                n = len(offsets) - 1
                for size in sorted({f[0] for f in filters.value}):
                    hashes, at, text = found.shingles(size)
                    slots = (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)
                    wanted = np.zeros(len(slots), bool)
                    for length, needed, sketch, whole in filters.value:
                        if length == size:
                            known = whole[slots]
                            enough = np.bincount(text[known], minlength=n) >= needed
                            met = np.bincount(text[sketch[slots]], minlength=n) > 0
                            wanted |= known & (enough & met)[text]
                    hit = np.flatnonzero(wanted)
                    texts = [found.shingle(w, size) for w in at[hit].tolist()]
                    owner = pa.array(row + text[hit], pa.int64())
                    columns = [batch.column(0).take(owner), batch.column(1).take(owner), pa.array(hashes[hit].view(np.int64))]
                    columns += [pa.array(texts, pa.string())]
                    yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "hash", "shingle"])
            give_back()

    narrow = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return narrow.mapInArrow(task, "doc_id long, text_hash long, hash long, shingle string").distinct()


def contaminated(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """Pairs of a document and an item that it contains: ``doc_id``, ``text_hash``, ``item_id``, ``item_shingles``, ``shared_shingles``.

    A document contains an item when it holds at least ``CONTAINMENT_TENTHS`` tenths of the item's
    different shingles of ``SHINGLE_WORDS`` words, wherever they stand in the whole text.
    Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case; an
    item of fewer words is one shingle of its own length, so it is found wherever its words stand
    one after another. Null and empty texts, and items without a word, match nothing; very long texts are searched whole.
    The sketches miss no pair; every pair they propose is
    counted on the shingles themselves. Rows that repeat an id and its text count once;
    other columns are not read; an empty table on either side gives no rows.
    """
    items = stage(item_shingles(benchmark, item_col, item_text_col))
    hits = stage(_document_hits(docs, items, id_col, text_col))
    sketches = items.where("sketched").select(F.col("hash").alias("h"), F.col("shingle").alias("s"), "item_id", "needed", "size")
    same = (F.col("hash") == F.col("h")) & (F.col("shingle") == F.col("s"))
    document = ["doc_id", "text_hash"]
    pairs = hits.join(sketches, same).select(*document, "item_id", "needed", "size").distinct()
    # Only proposed pairs are counted: each with the shingles of its item, against those of its document.
    wanted = pairs.join(items.select(F.col("item_id").alias("i"), "hash", "shingle"), F.col("item_id").eqNullSafe(F.col("i")))
    found = hits.select(*[F.col(c).alias(f"hit_{c}") for c in hits.columns])
    agree = F.lit(True)
    for c in ("hash", "shingle", "text_hash"):
        agree = agree & (F.col(c) == F.col(f"hit_{c}"))
    agree = agree & F.col("doc_id").eqNullSafe(F.col("hit_doc_id"))
    counted = wanted.join(found, agree).groupBy(*document, "item_id", "needed", "size").agg(F.count(F.lit(1)).alias("n"))
    return counted.where("n >= needed").select(
        *document, "item_id", F.col("size").alias("item_shingles"), F.col("n").alias("shared_shingles")
    )


def drop_contaminated(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` without the documents that contain an item of ``benchmark``, by the rules of ``contaminated``.

    Rows that share an id are told apart by their texts; repeated rows go or stay together. Null and
    empty texts stay, and so does everything where one of the tables is empty. All columns stay, whatever their names.
    """
    own = unused(docs, "_found_id", "_found_text")
    found = contaminated(docs, benchmark, id_col, text_col).select(
        F.col("doc_id").alias(own[0]), F.col("text_hash").alias(own[1])
    )
    same = F.col(id_col).cast("long").eqNullSafe(F.col(own[0])) & (F.xxhash64(text_col) == F.col(own[1]))
    return docs.join(stage(found.distinct()), same, "left_anti")
