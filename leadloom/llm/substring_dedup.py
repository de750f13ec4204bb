"""Repeated passages by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import stage
from .bytesops import ALNUM_LOWER, mix, text_slices, word_hashes, word_spans

#: A chunk ends behind a word whose rolling hash is the lowest among so many words on either side.
CUT_RADIUS = 3
#: Where no word stands out, as in a loop, chunks end after so many words.
MOST_WORDS = 24
#: Runs of repeated chunks with fewer words than this are not passages.
MIN_WORDS = 20

_WINDOW = 16  # bytes that the 16-bit gear hash looks back on: older ones are shifted out


def _gear_table() -> np.ndarray:
    table = mix(np.arange(1, 257, dtype=np.uint64)).astype(np.uint16)
    table[0] = 0  # padding between texts
    return table


_GEAR = _gear_table()
_SECOND = np.uint64(0x5851F42D4C957F2C)


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """h[i] = 2 h[i-1] + gear[data[i]] modulo 2**16, for all i at once."""
    h = _GEAR[data]
    step = 1
    while step < _WINDOW:
        shifted = h.copy()
        shifted[step:] += h[:-step] << np.uint16(step)
        h, step = shifted, 2 * step
    return h


def cut_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Whether a chunk ends behind each word. The last word of a text always ends one.

    The hash rolls over the bytes of the words without what is between them, anew for each text.
    """
    lengths = ends - starts
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    # Zeros before each text: its first hashes must not depend on the text before.
    at = np.cumsum(lengths) + _WINDOW * (text + 1)
    rolled = np.zeros(int(at[-1]) + 1 if len(at) else 0, np.uint8)
    rolled[np.arange(int(lengths.sum())) + np.repeat(_WINDOW * (text + 1), lengths)] = data[data != 0]
    value = gear_hashes(rolled)[at - 1].astype(np.int32) if len(at) else np.zeros(0, np.int32)
    lowest = np.ones(len(value), bool)
    for k in range(1, CUT_RADIUS + 1):
        if len(value) > k:
            same = text[k:] == text[:-k]
            lowest[k:] &= ~same | (value[k:] < value[:-k])
            lowest[:-k] &= ~same | (value[:-k] <= value[k:])
    counts = np.diff(first)
    ends_text = first[1:][counts > 0] - 1
    lowest[ends_text] = True
    chunk = np.concatenate([[0], np.flatnonzero(lowest)[:-1] + 1]) if len(value) else np.zeros(0, np.int64)
    place = np.arange(len(value)) - np.repeat(chunk, np.diff(np.append(chunk, len(value))))
    return lowest | (place % MOST_WORDS == MOST_WORDS - 1)


def _links(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """All pairs of neighbouring chunks of each text: text, key (two numbers), first and last word, first and last character."""
    mapped = ALNUM_LOWER[data]
    starts, ends, first = word_spans(mapped, offsets)
    hashes = word_hashes(mapped, starts, ends)
    last = np.flatnonzero(cut_words(mapped, starts, ends, first))
    if not len(last):
        return tuple(np.zeros(0, np.int64) for _ in range(7))
    begin = np.concatenate([[0], last[:-1] + 1])
    place = np.arange(len(hashes)) - np.repeat(begin, last - begin + 1)
    odd = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    digest = mix(np.add.reduceat(hashes * odd, begin))
    other = mix(np.add.reduceat(mix(hashes + odd) * (odd ^ _SECOND), begin))
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))[begin]
    pair = np.flatnonzero(text[1:] == text[:-1])
    # 128 bits: among the pairs of a large corpus, 64 would meet by chance.
    keys = [mix(d[pair] * np.uint64(0x9E3779B97F4A7C15) + d[pair + 1]).view(np.int64) for d in (digest, other)]
    chars = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    owner, a, b = text[pair], begin[pair], last[pair + 1]
    zero = chars[offsets[owner]]
    return owner, *keys, a - first[owner], b - first[owner], chars[starts[a]] - zero, chars[ends[b]] - zero


def _stored(df: DataFrame) -> DataFrame:
    """The rows, run once and kept in small files: chunks and texts are much of the corpus."""
    return stage(df, compression="zstd")


#: ``words`` and ``chars`` hold first and last word, and first and last character, in 32 bits each.
_LINKS = "row long, doc_id long, key long, key2 long, words long, chars long"


def chunk_links(numbered: DataFrame) -> DataFrame:
    """Every pair of neighbouring chunks of every text, with the digest of the pair and where it stands.

    ``numbered`` has ``row``, ``doc_id`` and ``text``. Pairs rather than single chunks are compared: a chunk may be a
    few frequent words, which meet by chance; eight words or more do not.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(2)):
                owner, key, key2, first, last, begin, stop = _links(data, offsets)
                rows = pa.array(owner + row)
                columns = [batch.column(0).take(rows), batch.column(1).take(rows)]
                columns += map(pa.array, (key, key2, first << 32 | last, begin << 32 | stop))
                yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in _LINKS.split(", ")])

    return numbered.select("row", F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(task, _LINKS)


def _with_key(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key is in ``keys`` (columns ``k``, ``k2`` and others); a key may have a large part of the rows."""
    return rows.join(keys, (F.col("key") == F.col("k")) & (F.col("key2") == F.col("k2"))).drop("k", "k2")


def _connected(rows: DataFrame, within: list[str], name: str) -> DataFrame:
    """``name`` numbers the runs of overlapping or adjoining spans ``begin`` to ``stop`` of each group ``within``."""
    order = W.partitionBy(*within).orderBy("begin", "stop")
    reached = F.max("stop").over(order.rowsBetween(W.unboundedPreceding, -1))
    opens = rows.withColumn("opens", F.when(reached >= F.col("begin"), 0).otherwise(1))
    return opens.withColumn(name, F.sum("opens").over(order.rowsBetween(W.unboundedPreceding, 0))).drop("opens")


def numbered_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored rows of ``docs`` (as one column ``doc``) with ``row``, ``doc_id`` and ``text``: stored, so that numbers stay."""
    document = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc")
    return _stored(docs.select(document).withColumn("row", F.monotonically_increasing_id())).select(
        "row", F.col("doc")[id_col].cast("long").alias("doc_id"), F.col("doc")[text_col].alias("text"), "doc"
    )


def repeated_passages(numbered: DataFrame, min_words: int = MIN_WORDS) -> DataFrame:
    """Passages of ``numbered_rows`` that stand more than once in the corpus, in pieces: ``row``, ``doc_id``, ``passage``, ``begin``, ``stop``, ``n_words``, ``first``, ``first_doc_id``, ``cut``.

    Texts are cut into chunks where the content says so; an insertion changes the chunks
    around it and no others. Two neighbouring chunks that occur again in the same order,
    anywhere, are repeated, and overlapping ones join to a passage. Passages of fewer than ``min_words`` words are
    left out. A passage falls into pieces, of characters [``begin``, ``stop``): those that stand there for the ``first`` time, by id
    (nulls last) and row, and those with an earlier copy, the lowest of whose ids is ``first_doc_id``. Of the latter, those
    of ``min_words`` words or more are to be ``cut``. Case, punctuation and white space do not
    count. A repeated passage loses a few words at each end, up to the next cut.
    """
    links = _stored(chunk_links(numbered))
    key = [F.col("key").alias("k"), F.col("key2").alias("k2")]
    counted = links.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    places = [("words", "first_word", "last_word"), ("chars", "begin", "stop")]
    halves = {n: F.shiftright(c, 32).cast("int") for c, n, _ in places} | {n: F.col(c).bitwiseAND(0xFFFF_FFFF).cast("int") for c, _, n in places}
    again = _with_key(links, _stored(counted.select("k", "k2")))
    # Only what is repeated is unpacked.
    again = _stored(again.select("row", "doc_id", "key", "key2", *[c.alias(n) for n, c in halves.items()]))
    place = F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row", "begin")
    lowest = _stored(again.groupBy(*key).agg(F.min(place).alias("lowest")))
    marked = _with_key(again, lowest).withColumn("first", F.col("lowest") == place).drop("key", "key2")
    runs = _connected(marked, ["row"], "passage")
    whole = W.partitionBy("row", "passage")
    words = F.max("last_word").over(whole) - F.min("first_word").over(whole) + 1
    long = runs.withColumn("words", words).where(F.col("words") >= min_words)
    runs = _connected(long, ["row", "passage", "first"], "piece")
    pieces = runs.groupBy("row", "doc_id", "passage", "first", "piece").agg(
        F.min("begin").alias("begin"),
        F.max("stop").alias("stop"),
        (F.max("last_word") - F.min("first_word") + 1).alias("n_words"),
        F.min("lowest.doc_id").alias("first_doc_id"),
    )
    return pieces.withColumn("cut", ~F.col("first") & (F.col("n_words") >= min_words)).drop("piece")


def _without(text: Column, spans: Column) -> Column:
    """``text`` without the characters of the sorted ``spans``, which do not overlap."""
    stops = F.concat(F.array(F.lit(0)), F.transform(spans, lambda s: s["stop"]))
    begins = F.concat(F.transform(spans, lambda s: s["begin"]), F.array(F.length(text)))
    pieces = F.zip_with(stops, begins, lambda a, b: F.substring(text, a + 1, b - a))
    return F.array_join(pieces, "")


def cut_repeats(numbered: DataFrame, min_words: int = MIN_WORDS, all_rows: bool = False) -> DataFrame:
    """Per row with a repeated passage (or, with ``all_rows``, per row): ``row``, ``doc_id``, ``doc``, its ``passages`` in order, and its ``kept`` text."""
    piece = F.struct("begin", "stop", "n_words", "first", "first_doc_id", "cut")
    found = repeated_passages(numbered, min_words).groupBy(F.col("row").alias("of")).agg(
        F.array_sort(F.collect_list(piece)).alias("passages")
    )
    joined = numbered.join(found, F.col("row") == F.col("of"), "left" if all_rows else "inner").drop("of")
    spans = F.filter("passages", lambda p: p["cut"])
    kept = F.when(F.size(spans) > 0, _without(F.col("text"), spans)).otherwise(F.col("text"))
    return joined.withColumn("kept", kept)


def drop_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS) -> DataFrame:
    """``docs`` with every repeated passage cut out of the texts but where it stands first.

    Rows are told apart as rows: of repeated ones the first keeps its text, whether or not they have an id or
    share one. Null and empty texts stay as they are; very long ones are searched whole; an empty table gives no
    rows. All other columns stay, whatever their names.
    """
    cut = cut_repeats(numbered_rows(docs, id_col, text_col), min_words, all_rows=True)
    return cut.select(*[F.col("kept" if c == text_col else "doc." + f"`{c}`").alias(c) for c in docs.columns])
