"""SimHash near-duplicates: fingerprints, links by deletion variants, and their components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from .bytesops import give_back, mix, text_slices
from .components import connected_components
from .naming import unused

SHINGLE_WORDS = 3
MAX_BITS = 2
#: Index keys with more fingerprints than this are linked through midpoints instead of pairs.
PAIRED_FINGERPRINTS = 16
#: Bits of the filter of index keys.
FILTER_BITS = 24

_BITS = 64
_HASH_SEED = 42


def _shingle_hashes(text: bytes, size: int) -> list[int]:
    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return []
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.cumsum(lengths + 1) - lengths - 1
    k = min(size, len(words))
    first = starts[: len(words) - k + 1].tolist()
    last = (starts + lengths)[k - 1 :].tolist()
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s:e], _HASH_SEED) for s, e in zip(first, last)]


def _fingerprints(texts: list[bytes], size: int) -> np.ndarray:
    """For each text, the bits that are set in over half of its shingle hashes."""
    hashes = [_shingle_hashes(t, size) for t in texts]
    counts = np.fromiter(map(len, hashes), np.int64, len(hashes))
    result = np.zeros(len(texts), np.uint64)
    filled = np.flatnonzero(counts)
    if not len(filled):
        return result
    flat = np.fromiter((h for one in hashes for h in one), np.uint64, int(counts.sum()))
    begin = (np.cumsum(counts) - counts)[filled]
    half = counts[filled]
    for bit in range(_BITS):
        set_ = np.add.reduceat(((flat >> np.uint64(bit)) & np.uint64(1)).astype(np.int64), begin)
        result[filled] |= (2 * set_ > half).astype(np.uint64) << np.uint64(bit)
    return result


def fingerprints(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS
) -> DataFrame:
    """``doc_id``, ``text_hash`` (long) and ``fingerprint`` (long) of every text.

    Words are runs without ASCII white space, A-Z in lower case; each shingle of
    ``shingle_words`` words counts as often as it occurs, by its XXH64 with seed 42. A
    shorter text is one shingle. Null and empty texts have fingerprint zero.
    """

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for row, data, offsets in text_slices(batch.column(2)):
                raw = data.tobytes()
                texts = [raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                parts.append(_fingerprints(texts, shingle_words).view(np.int64))
            values = np.concatenate(parts) if parts else np.zeros(0, np.int64)
            columns = [batch.column(0), batch.column(1), pa.array(values)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fingerprint"])
            give_back()

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        F.xxhash64(text_col).alias("text_hash"),
        F.col(text_col).cast("binary").alias("text"),
    )
    return rows.mapInArrow(task, "doc_id long, text_hash long, fingerprint long")


def _deletion_variants(fp: Column, max_bits: int) -> Column:
    """Index keys of a fingerprint: each segment with each of its bits struck out.

    With ``max_bits // 2 + 1`` segments, fingerprints within ``max_bits`` bits agree up to
    one bit in at least one segment, so they share the key that strikes out that bit.
    A key is the masked segment and a number for the segment and the bit.
    """
    segments = max_bits // 2 + 1
    keys = []
    for s in range(segments):
        low, high = _BITS * s // segments, _BITS * (s + 1) // segments
        part = F.shiftrightunsigned(fp, low).bitwiseAND(_as_long((1 << (high - low)) - 1))
        for bit in range(high - low):
            kept = part.bitwiseAND(_as_long(~(1 << bit) & ((1 << 64) - 1)))
            keys.append(F.struct(F.lit(low + bit).cast("byte").alias("struck"), kept.alias("rest")))
    return F.array(*keys)


def _as_long(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _midpoints(fp: Column) -> Column:
    """All values within one bit: the fingerprint and its 64 neighbours."""
    return F.array(fp, *[fp.bitwiseXOR(F.lit(_as_long(1 << b)).cast("long")) for b in range(_BITS)])


def _slots(struck: np.ndarray, rest: np.ndarray) -> np.ndarray:
    hashed = mix(rest.astype(np.uint64) ^ (struck.astype(np.uint64) << np.uint64(56)))
    return (hashed >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def _key_filter(keys: DataFrame) -> np.ndarray:
    """A bit filter of index keys; its size, and what comes to the driver, does not depend on their number."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            slots = _slots(batch.column(0).to_numpy().view(np.uint8), batch.column(1).to_numpy().view(np.uint64))
            yield pa.RecordBatch.from_arrays([pa.array(slots)], ["slot"])

    slots = keys.select("struck", "rest").mapInArrow(task, "slot long")
    bit = F.expr("shiftleft(1L, cast(slot & 63 as int))")
    words = slots.groupBy(F.shiftright("slot", 6).alias("word")).agg(F.bit_or(bit).alias("bits")).toArrow()
    result = np.zeros(1 << (FILTER_BITS - 6), np.int64)
    result[words["word"].to_numpy()] = words["bits"].to_numpy()
    return result.view(np.uint64)


def _filtered_variants(distinct: DataFrame, keys: DataFrame, max_bits: int) -> DataFrame:
    """``fingerprint``, ``struck``, ``rest`` of the deletion variants that may be in ``keys``."""
    shared = distinct.sparkSession.sparkContext.broadcast(_key_filter(keys))
    segments = max_bits // 2 + 1
    bounds = [(_BITS * s // segments, _BITS * (s + 1) // segments) for s in range(segments)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        one = np.uint64(1)
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for low, high in bounds:
                part = (fps >> np.uint64(low)) & np.uint64((1 << (high - low)) - 1)
                for bit in range(high - low):
                    rest = part & ~(one << np.uint64(bit))
                    struck = np.full(len(fps), low + bit, np.uint8)
                    slot = _slots(struck, rest)
                    known = (shared.value[slot >> 6] >> (slot & 63).astype(np.uint64)) & one
                    rows = np.flatnonzero(known)
                    columns = [fps[rows].view(np.int64), struck[rows].view(np.int8), rest[rows].view(np.int64)]
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["fingerprint", "struck", "rest"])

    return distinct.select("fingerprint").mapInArrow(task, "fingerprint long, struck byte, rest long")


def fingerprint_links(
    distinct: DataFrame, max_bits: int = MAX_BITS, paired: int = PAIRED_FINGERPRINTS
) -> DataFrame:
    """Links (``u``, ``v``) that tie together all fingerprints within ``max_bits`` (2) bits.

    Deletion variants are joined by equality and verified by their distance. Keys are
    counted first, which combines on the map side; two fingerprints that share a key
    alone are its lowest and highest. Only for keys of more fingerprints are the variants
    made again, behind a bit filter of these keys. A key that more than ``paired``
    fingerprints share would give a quadratic number of pairs; its fingerprints are tied
    to the values one bit away instead: two of them are within two bits exactly if they
    have such a value in common. A value has 65 fingerprints at most, so no group there is
    large, and no link is lost. ``distinct`` has one row per ``fingerprint``.
    """
    if max_bits != 2:
        raise ValueError("only fingerprints within 2 bits can be linked")
    # Dealt out first: a small table is few partitions, and each row becomes 64.
    spread = distinct.repartition(int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    index = spread.select("fingerprint", F.explode(_deletion_variants(F.col("fingerprint"), max_bits)).alias("k"))
    fp = F.col("fingerprint")
    shared = stage(
        index.groupBy("k.struck", "k.rest")
        .agg(F.count(F.lit(1)).alias("n"), F.min(fp).alias("u"), F.max(fp).alias("v"))
        .where("n > 1")
    )
    two = shared.where("n = 2").select("u", "v")

    several = shared.where("n > 2")
    # The hash gives both sides a shuffle that adaptive execution can split.
    spread = F.xxhash64("struck", "rest")
    keys = several.select(F.col("struck").alias("s"), F.col("rest").alias("r"), spread.alias("kh"), "n")
    same = (F.col("struck") == F.col("s")) & (F.col("rest") == F.col("r")) & (F.col("h") == F.col("kh"))
    variants = _filtered_variants(distinct, several, max_bits).withColumn("h", spread)
    members = stage(variants.join(keys, same).select("struck", "rest", "fingerprint", "n"))
    few = members.where(F.col("n") <= paired).drop("n")
    other = few.select("struck", "rest", F.col("fingerprint").alias("v"))
    joined = few.join(other, ["struck", "rest"]).where(fp < F.col("v")).select(fp.alias("u"), "v")
    close = F.bit_count(F.col("u").bitwiseXOR(F.col("v"))) <= max_bits
    pairs = two.unionByName(joined).where(close).distinct()

    many = members.where(F.col("n") > paired).select("fingerprint").distinct()
    near = stage(many.select("fingerprint", F.explode(_midpoints(fp)).alias("point")))
    lowest = near.groupBy("point").agg(F.min(fp).alias("v"), F.count(F.lit(1)).alias("n")).where("n > 1")
    hubs = near.join(lowest, "point").where("fingerprint != v").select(fp.alias("u"), "v").distinct()
    return pairs.unionByName(hubs)


def fingerprint_components(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``known``, ``root`` and ``component_id`` for each different ``fingerprint`` of ``prints``.

    ``root`` is the lowest fingerprint that links reach, ``component_id`` the smallest ``doc_id``.
    """
    distinct = stage(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("lowest")))
    roots = stage(connected_components(fingerprint_links(distinct, max_bits)))
    rooted = distinct.join(roots.hint("merge"), F.col("fingerprint") == F.col("node"), "left").select(
        "fingerprint", "lowest", F.coalesce("root", "fingerprint").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("lowest").alias("component_id"))
    ids = rooted.join(named.withColumnRenamed("root", "named_root"), F.col("root") == F.col("named_root"))
    # A row per fingerprint grows with the corpus, and takes many times its stored size in a broadcast: the same join at all sizes.
    return stage(ids.select(F.col("fingerprint").alias("known"), F.col("named_root").alias("root"), "component_id")).hint("merge")


def simhash_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """One row per document: ``doc_id``, ``fingerprint`` (long), ``component_id``.

    Documents whose fingerprints differ in at most ``max_bits`` bits are linked;
    ``component_id`` is the smallest id that links reach, the document's own included.
    Copies count once in the search. Rows without an id belong to a component but never
    name it. Other columns of ``docs`` are not read; an empty table gives no rows.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words))
    ids = fingerprint_components(prints, max_bits)
    return prints.join(ids, F.col("fingerprint") == F.col("known")).select("doc_id", "fingerprint", "component_id")


def drop_near_copies(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id, nulls last, ties by a hash of the text.

    Components are those of the texts, so rows that share an id but not a text are apart:
    each stays unless it is a near copy of another row. Of repeated rows one stays. All columns stay as they
    are, whatever their names; an empty table gives no rows.
    """
    prints = stage(fingerprints(docs, id_col, text_col, shingle_words))
    ids = fingerprint_components(prints, max_bits)
    rooted = prints.join(ids, F.col("fingerprint") == F.col("known"))
    rank = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "text_hash")
    first = rooted.groupBy("root").agg(F.min(rank).alias("first")).select("first.*")
    names = unused(docs, "_id", "_nameless", "_text", "_kept_id", "_kept_nameless", "_kept_text")
    own, kept = names[:3], names[3:]
    id = F.col(id_col).cast("long")
    keyed = docs.withColumns(dict(zip(own, [F.coalesce(id, F.lit(0)), id.isNull(), F.xxhash64(text_col)])))
    wanted = first.select(
        F.coalesce("doc_id", F.lit(0)).alias(kept[0]), F.col("nameless").alias(kept[1]), F.col("text_hash").alias(kept[2])
    )
    same = [F.col(a) == F.col(b) for a, b in zip(own, kept)]
    # The join has dealt the rows out by these columns, so that repeated ones need no further shuffle.
    return keyed.join(stage(wanted).hint("merge"), same, "left_semi").dropDuplicates(own).drop(*own)


def fingerprint_hex(fp: Column | str) -> Column:
    """16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))
