"""Interpolated modified Kneser-Ney bigrams: counted in Spark, stored as sorted arrays, mapped into memory by the workers."""

from __future__ import annotations

import math
import os
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..session import new_folder
from .bytesops import give_back, mix, text_slices, word_hashes, word_spans

#: Words of one vocabulary file, and of one file of their statistics.
FILE_WORDS = 1 << 20
#: Training tokens for which one shard of bigrams is planned.
SHARD_TOKENS = 2 << 20
#: Entries that a counting task holds before it hands them on.
HELD_ENTRIES = 2 << 20

_SLICE_BYTES = 1_000_000
#: Stands for the end of a text; the hash of a word is as good as never this.
_END = np.int64(0x5E0F_7E47)
_LOW = np.uint64(0xFFFF_FFFF)


def _words_table() -> np.ndarray:
    table = np.arange(256, dtype=np.uint8)
    table[0x41:0x5B] += 0x20
    table[0] = 0xFF  # a word byte like others, but 0 parts words here; UTF-8 never has 0xFF
    table[[0x20, *range(0x09, 0x0E)]] = 0
    return table


_WORD = _words_table()


def token_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the tokens of all texts, each text with its end, and the place of each text's first token."""
    mapped = _WORD[data]
    starts, ends, first = word_spans(mapped, offsets)
    n = len(offsets) - 1
    text = np.repeat(np.arange(n), np.diff(first))
    tokens = np.full(len(starts) + n, _END, np.int64)
    tokens[np.arange(len(starts)) + text] = word_hashes(mapped, starts, ends).view(np.int64)
    return tokens, first[:-1] + np.arange(n)


def is_held_out(id_col: str = "doc_id") -> Column:
    """Documents that nothing is learned from: crc32 of the id (as text) modulo 7 is 2."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 7 == 2, F.lit(False))


def _summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different keys in order, and their added counts."""
    order = np.argsort(keys)
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[starts], np.add.reduceat(counts[order], starts) if len(keys) else counts


def _added(held: list) -> tuple[np.ndarray, np.ndarray]:
    """Several sorted keys with their counts as one."""
    return _summed(*map(np.concatenate, zip(*held)))


def _packed(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """Sorted keys as differences, and whole numbers beside them, byte plane by byte plane, compressed."""
    steps = np.diff(keys, prepend=keys.dtype.type(0)).astype("<u8")
    planes = [c.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes() for c in (steps, *columns)]
    return len(keys).to_bytes(8, "little") + pa.compress(b"".join(planes), codec="zstd", asbytes=True)


def _unpacked(data: bytes, columns: int) -> list[np.ndarray]:
    n = int.from_bytes(data[:8], "little")
    raw = pa.decompress(data[8:], decompressed_size=8 * n * (1 + columns), codec="zstd", asbytes=True)
    planes = np.frombuffer(raw, np.uint8).reshape(1 + columns, 8, n)
    values = [np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes]
    return [np.cumsum(values[0], dtype=np.uint64), *[v.astype(np.int64) for v in values[1:]]]


@dataclass
class Files:
    """Where the arrays of a model are, and the few numbers that hold for all of it."""

    vocabulary: list[tuple[int, int, str]] = field(default_factory=list)  # lowest hash, words, file; in order
    statistics: dict[int, str] = field(default_factory=dict)  # part of the vocabulary -> file
    shards: dict[int, str] = field(default_factory=dict)
    n_shards: int = 1
    tokens: int = 0
    words: int = 0
    discounts: tuple[float, ...] = (0.0, 0.5, 1.0, 1.5)  # of bigrams seen 0, 1, 2 and more times
    low_discounts: tuple[float, ...] = (0.0, 0.5, 1.0, 1.5)  # of words by their different predecessors
    bigrams: int = 0
    low_left: float = 1.0  # what the discounts of words leave for the uniform distribution


def discounts(seen: list[int]) -> tuple[float, ...]:
    """Modified Kneser-Ney discounts for counts of 0, 1, 2 and 3 or more, from the numbers of entries seen 1, 2, 3 and 4 times.

    Half the count where the estimate does not exist or lies outside (0, count].
    """
    result = [0.0]
    y = seen[0] / (seen[0] + 2 * seen[1]) if seen[0] else 0.0
    for k in (1, 2, 3):
        d = k - (k + 1) * y * seen[k] / seen[k - 1] if seen[k - 1] else 0.0
        result.append(d if 0 < d <= k else k / 2)
    return tuple(result)


def _listed(spark: SparkSession, path: str) -> list[tuple[dict[str, int], str]]:
    """The files below ``path``, with what the names of their folders say."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = root.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(root):
        return []
    files, found = system.listFiles(root, True), []
    while files.hasNext():
        status = files.next()
        name = status.getPath().toString()
        if status.getPath().getName().startswith("part-"):
            says = dict(p.split("=") for p in name.split("/") if "=" in p)
            found.append(({k: int(v) for k, v in says.items()}, name))
    return found


def _write(rows: DataFrame, path: str, names: list[str]) -> list[tuple[dict[str, int], str]]:
    """Each row's bytes to a file of its own, in folders that hold the other columns. Returns all files, as ``_listed``."""
    written = Observation()
    counted = rows.observe(written, F.count(F.lit(1)).alias("n"))
    # The text writer puts the bytes down as they are, and one line feed behind them.
    counted.withColumn("data", F.col("data").cast("string")).write.partitionBy(*names).text(path)
    listed = _listed(rows.sparkSession, path)
    if len(listed) < written.get["n"]:
        raise OSError(f"{written.get['n']} files were written to {path}, and {len(listed)} are there: do all executors share it?")
    return listed


def _texts(docs: DataFrame, text_col: str) -> DataFrame:
    return docs.select(F.col(text_col).cast("binary").alias("text"))


def _train_vocabulary(spark: SparkSession, training: DataFrame, path: str, model: Files) -> None:
    """Sorted hashes of all words and their counts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0), _SLICE_BYTES):
                held.append(np.unique(token_hashes(data, offsets)[0], return_counts=True))
                size += len(held[-1][0])
                if size > HELD_ENTRIES // 2:
                    held = [_added(held)]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES // 4:
                        yield _columns(["word", "n"], held.pop())
                        size = 0
            give_back()
        if held:
            yield _columns(["word", "n"], _added(held))

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, counts = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            words = np.concatenate([words, np.asarray(batch.column(0))])
            counts = np.concatenate([counts, np.asarray(batch.column(1))])
            while len(words) >= FILE_WORDS:
                yield one(words[:FILE_WORDS], counts[:FILE_WORDS])
                words, counts = words[FILE_WORDS:], counts[FILE_WORDS:]
        if len(words):
            yield one(words, counts)

    def one(words: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        data = pa.array([words.astype("<i8").tobytes() + counts.astype("<i8").tobytes()], pa.binary())
        names = [pa.array([int(x)], pa.int64()) for x in (words[0], len(words), counts.sum())]
        return pa.RecordBatch.from_arrays([*names, data], ["lowest", "words", "tokens", "data"])

    words = training.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))
    ordered = words.repartitionByRange("word").sortWithinPartitions("word")
    rows = ordered.mapInArrow(store, "lowest long, words long, tokens long, data binary")
    listed = sorted(_write(rows, path, ["lowest", "words", "tokens"]), key=lambda x: x[0]["lowest"])
    model.vocabulary = [(says["lowest"], says["words"], name) for says, name in listed]
    model.tokens = sum(says["tokens"] for says, _ in listed)
    model.words = sum(says["words"] for says, _ in listed)
    if model.words >= (1 << 32) - 1:
        raise ValueError("pairs of words fit 64 bits for up to 2**32 - 2 different words")


def _columns(names: list[str], arrays) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(a) for a in arrays], names)


def shard_of(pairs: np.ndarray, n_shards: int) -> np.ndarray:
    return (mix(pairs.copy()) % np.uint64(n_shards)).astype(np.int64)


class Mapped:
    """The arrays of a model, mapped when they are first needed. One per worker and task."""

    def __init__(self, files: Files):
        self.files = files
        self._open: dict[str, np.ndarray] = {}
        self.lowest = np.array([x[0] for x in files.vocabulary], np.int64)
        self.before = np.concatenate([[0], np.cumsum([x[1] for x in files.vocabulary])]).astype(np.int64)

    def bytes(self, name: str) -> np.ndarray:
        if name not in self._open:
            if name.startswith("file:") or "://" not in name:
                path = "/" + name.removeprefix("file:").lstrip("/")
                self._open[name] = np.memmap(path, np.uint8, "r")
            else:  # a store that has no local path: read this file as a whole
                from pyarrow import fs

                system, path = fs.FileSystem.from_uri(name)
                self._open[name] = np.frombuffer(system.open_input_file(path).read(), np.uint8)
        return self._open[name]

    def vocabulary(self, part: int) -> tuple[np.ndarray, np.ndarray]:
        _, n, name = self.files.vocabulary[part]
        both = self.bytes(name)[: 16 * n].view("<i8")
        return both[:n], both[n:]

    def words(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers (-1: unknown) and counts of sorted word hashes."""
        number, count = np.full(len(hashes), -1, np.int64), np.zeros(len(hashes), np.int64)
        bounds = np.append(np.searchsorted(hashes, self.lowest), len(hashes))
        for part in range(len(self.lowest)):
            a, b = bounds[part], bounds[part + 1]
            if a < b:
                known, counts = self.vocabulary(part)
                place = np.minimum(np.searchsorted(known, hashes[a:b]), len(known) - 1)
                same = known[place] == hashes[a:b]
                number[a:b] = np.where(same, self.before[part] + place, -1)
                count[a:b] = np.where(same, counts[place], 0)
        return number, count

    def statistics(self, numbers: np.ndarray) -> np.ndarray:
        """Per sorted word number (none: -1): total and left-over mass as a context, and different predecessors."""
        result = np.zeros((3, len(numbers)))
        part = numbers // FILE_WORDS
        for p in np.unique(part[numbers >= 0]):
            if int(p) in self.files.statistics:
                at = slice(*np.searchsorted(part, [p, p + 1]))
                table = self.bytes(self.files.statistics[int(p)])
                table = table[: len(table) - len(table) % 24].view("<f8").reshape(3, -1)
                result[:, at] = table[:, numbers[at] - p * FILE_WORDS]
        return result

    def bigrams(self, pairs: np.ndarray) -> np.ndarray:
        """Counts of sorted pairs of word numbers."""
        result = np.zeros(len(pairs), np.int64)
        shard = shard_of(pairs, self.files.n_shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(self.files.n_shards + 1))
        for s, name in self.files.shards.items():
            at = order[bounds[s] : bounds[s + 1]]
            if len(at):
                known, counts = _bigram_file(self.bytes(name))
                place = np.minimum(np.searchsorted(known, pairs[at]), len(known) - 1)
                result[at] = np.where(known[place] == pairs[at], counts(place), 0)
        return result


def _bigram_file(data: np.ndarray):
    """Sorted pairs and a lookup of their counts: a byte each, and the larger ones apart."""
    n, large = data[:16].view("<i8").tolist()
    known = data[16 : 16 + 8 * n].view("<u8")
    places = data[16 + 8 * n : 16 + 8 * (n + large)].view("<i8")
    values = data[16 + 8 * (n + large) : 16 + 8 * (n + 2 * large)].view("<i8")
    small = data[16 + 8 * (n + 2 * large) :][:n]

    def counts(place: np.ndarray) -> np.ndarray:
        found = small[place].astype(np.int64)
        if large:
            over = found == 255
            found[over] = values[np.searchsorted(places, place[over])]
        return found

    return known, counts


def _bigram_bytes(pairs: np.ndarray, counts: np.ndarray) -> bytes:
    over = np.flatnonzero(counts >= 255)
    head = np.array([len(pairs), len(over)], "<i8")
    parts = [head, pairs.astype("<u8"), over.astype("<i8"), counts[over].astype("<i8"), np.minimum(counts, 255).astype(np.uint8)]
    return b"".join(p.tobytes() for p in parts)


def _pairs(mapped: Mapped, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Per token: number (-1: unknown) and count; number of the token before (that of a text's beginning is ``words``); and the starts."""
    tokens, starts = token_hashes(data, offsets)
    different, back = np.unique(tokens, return_inverse=True)
    number, count = mapped.words(different)
    number, count = number[back], count[back]
    before = np.empty_like(number)
    before[1:] = number[:-1]
    before[starts] = mapped.files.words
    return number, count, before, starts


def _train_bigrams(spark: SparkSession, training: DataFrame, path: str, model: Files) -> None:
    """Counts of all pairs of neighbours: tasks count theirs, shards by the hash of the pair add them up."""
    shared = spark.sparkContext.broadcast(model)
    n_shards = model.n_shards

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped, held, size = Mapped(shared.value), [], 0
        for batch in batches:
            for _, data, offsets in text_slices(batch.column(0), _SLICE_BYTES):
                number, _, before, _ = _pairs(mapped, data, offsets)
                pairs = (before.astype(np.uint64) << np.uint64(32)) | number.astype(np.uint64)
                held.append(np.unique(pairs, return_counts=True))
                size += len(held[-1][0])
                if size > HELD_ENTRIES:
                    held = [_added(held)]
                    size = len(held[0][0])
                    if size > HELD_ENTRIES // 2:
                        yield from dealt(*held.pop())
                        size = 0
            give_back()
        if held:
            yield from dealt(*_added(held))
        give_back()

    def dealt(pairs: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        shard = shard_of(pairs, n_shards)
        order = np.argsort(shard, kind="stable")
        bounds = np.searchsorted(shard[order], np.arange(n_shards + 1))
        for s in range(n_shards):
            at = order[bounds[s] : bounds[s + 1]]
            if len(at):
                data = pa.array([_packed(pairs[at], counts[at])], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array([s], pa.int64()), data], ["shard", "data"])

    names = ["shard", "entries", "one", "two", "three", "four"]

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, held in _groups(batches, 1):
            pairs, counts = _added(held)
            numbers = [shard, len(pairs), *[int((counts == k).sum()) for k in (1, 2, 3, 4)]]
            data = pa.array([_bigram_bytes(pairs, counts)], pa.binary())
            yield pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in numbers], data], [*names, "data"])

    dealt_out = training.mapInArrow(count, "shard long, data binary").repartition(n_shards, "shard")
    stored = dealt_out.sortWithinPartitions("shard").mapInArrow(store, ", ".join(f"{x} long" for x in names) + ", data binary")
    listed = _write(stored, path, names)
    model.shards = {says["shard"]: name for says, name in listed}
    model.bigrams = sum(says["entries"] for says, _ in listed)
    model.discounts = discounts([sum(says[x] for says, _ in listed) for x in names[2:]])


def _groups(batches: Iterator[pa.RecordBatch], columns: int) -> Iterator[tuple[int, list]]:
    """Rows sorted by their first column, with the arrays that their second one holds, group by group."""
    current, held, size = None, [], 0
    for batch in batches:
        for key, data in zip(batch.column(0).to_pylist(), batch.column(1)):
            if key != current and held:
                yield current, held
                held, size = [], 0
            current = key
            held.append(_unpacked(data.as_buffer().to_pybytes(), columns))
            size += len(held[-1][0])
            if columns == 1 and size > HELD_ENTRIES and len(held) > 1:  # what many tasks have seen counts once
                held = [_added(held)]
                size = 0
    if held:
        yield current, held


def _train_statistics(spark: SparkSession, shards: str, path: str, model: Files) -> None:
    """Per word: its total and left-over mass as a context, and how many different words it follows."""
    discount = np.array(model.discounts)
    words = model.words

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data in batch.column(0):
                known, counts = _bigram_file(np.frombuffer(data.as_buffer(), np.uint8))
                counts = counts(np.arange(len(known)))
                first, second = known >> np.uint64(32), np.sort(known & _LOW)
                starts = np.flatnonzero(np.concatenate([[True], first[1:] != first[:-1]]))
                contexts = [np.add.reduceat(x.astype(np.int64), starts) for x in (counts, counts == 1, counts == 2, counts >= 3)]
                follows, times = np.unique(second, return_counts=True)
                keys = np.union1d(first[starts], follows)
                table = np.zeros((5, len(keys)), np.int64)
                table[:4, np.searchsorted(keys, first[starts])] = contexts
                table[4, np.searchsorted(keys, follows)] = times
                part = (keys // np.uint64(FILE_WORDS)).astype(np.int64)
                for p in np.unique(part):
                    at = slice(*np.searchsorted(part, [p, p + 1]))
                    data = pa.array([_packed(keys[at], *table[:, at])], pa.binary())
                    yield pa.RecordBatch.from_arrays([pa.array([p], pa.int64()), data], ["part", "data"])

    names = ["part", "one", "two", "three", "four", "more"]

    def store(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, table = None, None

        def one() -> pa.RecordBatch:
            total, follows = table[0], table[4]
            left = discount[1:] @ table[1:4]
            numbers = [current, *[int((follows == k).sum()) for k in (1, 2, 3, 4)], int((follows >= 3).sum())]
            data = pa.array([np.array([total, left, follows], "<f8").tobytes()], pa.binary())
            return pa.RecordBatch.from_arrays([*[pa.array([x], pa.int64()) for x in numbers], data], [*names, "data"])

        for batch in batches:
            for part, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                if part != current:
                    if current is not None:
                        yield one()
                    current, table = part, np.zeros((5, min(FILE_WORDS, words + 1 - part * FILE_WORDS)), np.int64)
                keys, *columns = _unpacked(data.as_buffer().to_pybytes(), 5)
                table[:, keys.astype(np.int64) - part * FILE_WORDS] += np.array(columns)
        if current is not None:
            yield one()

    files = spark.read.format("binaryFile").load(shards).select("content")
    parts = words // FILE_WORDS + 1
    rows = files.mapInArrow(partial, "part long, data binary").repartition(parts, "part").sortWithinPartitions("part")
    listed = _write(rows.mapInArrow(store, ", ".join(f"{x} long" for x in names) + ", data binary"), path, names)
    model.statistics = {says["part"]: name for says, name in listed}
    seen = [sum(says[x] for says, _ in listed) for x in names[1:]]
    model.low_discounts = discounts(seen[:4])
    d = model.low_discounts
    # Every bigram is one predecessor of a word.
    model.low_left = (d[1] * seen[0] + d[2] * seen[1] + d[3] * seen[4]) / model.bigrams


def train(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Files:
    """Count the model on all rows of ``docs`` with an id that are not held out, and store its arrays.

    Three kinds of files below the staging folder, each of bounded size: sorted hashes of words with their
    counts; shards of sorted pairs of word numbers with their counts; and per word what it is as
    a context and how many words it follows. Nothing of them passes through the driver but their names.
    Workers map the files, so there must be a folder that all executors share.
    """
    spark = docs.sparkSession
    path, model = new_folder(spark, proven=True), Files()
    training = _texts(docs.where(F.col(id_col).isNotNull() & ~is_held_out(id_col)), text_col)
    _train_vocabulary(spark, training, f"{path}/words", model)
    if model.tokens:
        model.n_shards = -(-model.tokens // SHARD_TOKENS)
        _train_bigrams(spark, training, f"{path}/bigrams", model)
        _train_statistics(spark, f"{path}/bigrams", f"{path}/statistics", model)
    return model


def word_probability(model: Files, follows: np.ndarray) -> np.ndarray:
    """By the number of different words before it; a word of no training text follows none."""
    if not model.bigrams:
        return np.ones(len(follows))
    discount = np.array(model.low_discounts)[np.minimum(follows, 3).astype(np.int64)]
    return (follows - discount) / model.bigrams + model.low_left / (model.words + 1)


def _text_scores(mapped: Mapped, data: np.ndarray, offsets: np.ndarray) -> list[np.ndarray]:
    """Tokens, known tokens, base score and score of each text."""
    model = mapped.files
    number, count, before, starts = _pairs(mapped, data, offsets)
    different, back = np.unique(number, return_inverse=True)
    low = word_probability(model, mapped.statistics(different)[2])[back]
    contexts, back = np.unique(before, return_inverse=True)
    total, left, _ = mapped.statistics(contexts)[:, back]
    both = np.flatnonzero((number >= 0) & (before >= 0))
    pairs = (before[both].astype(np.uint64) << np.uint64(32)) | number[both].astype(np.uint64)
    pairs, back = np.unique(pairs, return_inverse=True)
    seen = np.zeros(len(number), np.int64)
    seen[both] = mapped.bigrams(pairs)[back]
    context = total > 0
    some = np.where(context, total, 1.0)
    high = (seen - np.array(model.discounts)[np.minimum(seen, 3)]) / some
    probability = np.where(context, high + left / some * low, low)
    base = np.log10((count + 1) / (model.tokens + model.words + 1))
    n = np.diff(np.append(starts, len(number)))
    return [n, np.add.reduceat(count > 0, starts, dtype=np.int64), np.add.reduceat(base, starts), np.add.reduceat(np.log10(probability), starts)]


def score(docs: DataFrame, model: Files, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score``, ``score``, ``perplexity``.

    Tokens are runs without ASCII white space, A-Z in lower case, and one end of the text.
    ``score`` is the log10 probability of the whole text in an interpolated modified Kneser-Ney model of word
    pairs, whose lower order counts the different words before a word and is interpolated
    with the uniform distribution over the vocabulary and one unknown word; the first word follows the
    beginning of a text. ``base_score`` is that of add-one unigrams. ``perplexity`` is per token.
    Null and empty texts have one token, their end. Rows without an id are scored, never learned
    from, and not held out; repeated rows are scored each, and learned from each. Where nothing was
    learned every probability is 1. Other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mapped = Mapped(shared.value)
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(1), _SLICE_BYTES):
                columns = _text_scores(mapped, data, offsets)
                yield _columns(names, [batch.column(0).slice(row, len(offsets) - 1), *columns])
            give_back()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    scored = rows.mapInArrow(task, "doc_id long, n_tokens long, n_known long, base_score double, score double")
    return scored.select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(model.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
        F.pow(F.lit(10.0), -F.col("score") / F.col("n_tokens")).alias("perplexity"),
    )


def perplexity(scored: DataFrame) -> float:
    """Of all rows of ``score`` together."""
    found = scored.agg(F.sum("score").alias("score"), F.sum("n_tokens").alias("n")).first()
    return math.pow(10, -found["score"] / found["n"]) if found["n"] else math.nan
