"""Token ids in flat binary files, with document boundaries in Elias-Fano form."""

from __future__ import annotations

import gc
import json
import math
import os
import struct
import zlib
from collections.abc import Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import has_folder, new_folder, stage
from .bytesops import give_back
from .elias_fano import EliasFano, encode
from .sizes import text_bytes
from .word_store import WordStore, ranges

END_ID = 2
#: Bytes of text for which one range of documents is planned, and the most ranges: beyond, ranges grow.
RANGE_BYTES, MAX_RANGES = 10 << 20, 10_000
#: A file is closed after so many ids; only a longer single document makes a larger one.
FILE_IDS = 4 << 20
#: Bytes of the words and ids that a worker keeps at hand.
KEPT_BYTES = 32 << 20
#: Bytes of text that are encoded together; a single longer text is one by itself.
SLICE_BYTES = 2 << 20

#: Marks that the tokenizer parts from the letters before them.
_MARKS = (".", ",", ";", ":", "!", "?")

_MAGIC = b"EFTOKEN1"
# Documents, those of them without an id, lowest document id, highest less lowest, ids, bytes per id.
# Where document ids fall, the highest less lowest is -1, and they follow as they are instead of in Elias-Fano form.
_HEADER = "<8s6q"
#: What is read from the files.
_DOCUMENTS = "doc_id long, start long, n_tokens long, ids_crc32 long"


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    lengths = np.fromiter(map(len, ids), np.int64, len(ids))
    return lengths, np.fromiter(chain.from_iterable(ids), np.int64, int(lengths.sum()))


class WordEncoder:
    """Encodes many texts by encoding each different piece between ASCII white space once.

    The tokenizer must never join what ASCII white space parts, and must drop the white
    space, which ``check`` finds in its description. Then the ids of a text are those of its
    pieces, one after another. Pieces met first are kept, up to ``KEPT_BYTES``; others are encoded
    once for each slice of texts.
    """

    _MARK = "\x01"
    #: Words by which the short way is held against the full pipeline.
    _PROBES = ("a", "the", "été", "naïve", "straße", "zzzz", "internationalization", "ÿþ")

    def __init__(self, description: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self._tokenizer = Tokenizer.from_str(description)
        self._lowers = '"Lowercase"' in json.dumps(json.loads(description).get("normalizer"))
        # The same model behind white space alone, for words that the full pipeline passes on whole.
        self._plain = Tokenizer(self._tokenizer.model)
        self._plain.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        mark = self._encode([self._MARK])[0]
        self._mark = mark[0] if len(mark) == 1 else None
        self.bytes_per_id = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._type = np.uint16 if self.bytes_per_id == 2 else np.uint32
        self._store = WordStore(self._type)
        self._mark_ids = [np.array(i, self._type) for i in self._encode(list(_MARKS))]
        self._short = self._short_way_holds()

    def _short_way_holds(self) -> bool:
        """Whether words of Latin letters, and the marks behind them, may be encoded apart from each other."""
        words = list(self._PROBES)
        lengths, ids = self._encode_plain(words)
        plain = np.split(ids, np.cumsum(lengths)[:-1])
        marked = [w + m for w in words for m in _MARKS] + [w.upper() for w in words[:4]]
        want = [[*p, *m] for p in plain for m in self._mark_ids] + [list(p) for p in plain[:4]]
        if not self._lowers:
            marked, want = marked[:-4], want[:-4]
        return [list(map(int, w)) for w in want] == self._encode(marked)

    @staticmethod
    def check(description: str) -> None:
        steps = json.loads(description).get("pre_tokenizer") or {}
        first = (steps.get("pretokenizers") or [steps])[0]
        pattern = (first.get("pattern") or {}).get("Regex", "")
        parts = first.get("behavior") == "Removed" and first.get("invert") and r"[^\s" in pattern and "|\\s" not in pattern
        if not parts:
            raise ValueError("this tokenizer's ids depend on white space; its pieces cannot be encoded apart")

    def _encode(self, texts: list[str]) -> list[list[int]]:
        result: list[list[int]] = []
        for i in range(0, len(texts), 4_000):  # an encoding holds much besides its ids
            result += [e.ids for e in self._tokenizer.encode_batch_fast(texts[i : i + 4_000], add_special_tokens=False)]
        return result

    def _encode_plain(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of words of letters, which go through the model in long rows, parted by a mark."""
        if self._mark is None:
            return _flat(self._encode(words))
        lengths, ids = [np.zeros(0, np.int64)], [np.zeros(0, self._type)]
        for i in range(0, len(words), 20_000):
            joined = [f" {self._MARK} ".join(words[k : k + 1000]) for k in range(i, min(i + 20_000, len(words)), 1000)]
            for encoded in self._plain.encode_batch_fast(joined, add_special_tokens=False):
                row = np.array(encoded.ids, np.int64)
                lengths.append(np.diff(np.concatenate([[-1], np.flatnonzero(row == self._mark), [len(row)]])) - 1)
                ids.append(row[row != self._mark].astype(self._type))
        assert sum(map(len, lengths)) == len(words)
        return np.concatenate(lengths), np.concatenate(ids)

    def _parts(self, piece: str) -> tuple[str, int]:
        """A piece as the model gets it without the mark behind it, and the number of that mark (-1: none), where its ids fall into these two.

        Only for pieces of Latin letters, which no normaliser changes otherwise and no
        pattern parts, with at most one such mark at the end. The first part is empty for others.
        """
        mark = _MARKS.index(piece[-1]) if piece[-1:] in _MARKS and piece else -1
        word = piece[:-1] if mark >= 0 else piece
        if not self._short or not word.isalpha() or not (word.isascii() or max(word) < "\u0250"):
            return "", -1
        word = word.lower() if self._lowers else word
        return (word, mark) if word.isalpha() else ("", -1)

    def _ids_of(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Lengths and ids of pieces that are not kept."""
        parts = [self._parts(p) for p in pieces]
        number: dict[str, int] = {}
        for word, _ in parts:
            if word:
                number.setdefault(word, len(number))
        words = list(number)
        raw = [w.encode() for w in words]
        bounds = np.concatenate([[0], np.cumsum([len(r) for r in raw], dtype=np.int64)]).astype(np.int64)
        known = self._store.find(np.frombuffer(b"".join(raw), np.uint8), bounds)
        at, size = np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        at[known >= 0] = self._store.begin[known[known >= 0]]
        size[known >= 0] = np.diff(self._store.begin)[known[known >= 0]]
        plain_lengths, plain_ids = self._encode_plain([words[k] for k in np.flatnonzero(known < 0)])
        rest = [p for p, (w, _) in zip(pieces, parts) if not w]
        rest_lengths, rest_ids = _flat(self._encode(rest))
        # All ids that a piece may be made of, one after another, and where each part stands among them.
        ids = np.concatenate([self._store.ids, plain_ids, rest_ids, *self._mark_ids]).astype(self._type)
        begin = len(self._store.ids) + np.cumsum(plain_lengths) - plain_lengths
        at[known < 0], size[known < 0] = begin, plain_lengths
        begin = len(self._store.ids) + len(plain_ids)
        rest_at = begin + np.cumsum(rest_lengths) - rest_lengths
        mark_size = np.array([*map(len, self._mark_ids), 0], np.int64)  # the last: no mark
        mark_at = begin + len(rest_ids) + np.cumsum(mark_size) - mark_size
        place = np.fromiter((number.get(w, -1) for w, _ in parts), np.int64, len(parts))
        mark = np.fromiter((m for _, m in parts), np.int64, len(parts))
        other = place < 0
        both_at, both_size = np.zeros((len(parts), 2), np.int64), np.zeros((len(parts), 2), np.int64)
        both_at[~other, 0], both_size[~other, 0] = at[place[~other]], size[place[~other]]
        both_at[other, 0], both_size[other, 0] = rest_at, rest_lengths
        both_at[:, 1], both_size[:, 1] = mark_at[mark], mark_size[mark]
        return both_size.sum(1), ids[ranges(both_at.ravel(), both_size.ravel())]

    def __call__(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and how many each has."""
        gc.disable()  # many small lists and no cycles: the collector would look at all of them in vain
        try:
            return self._encode_all(texts)
        finally:
            gc.enable()

    def _encode_all(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        pieces = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        words = pieces.flatten().dictionary_encode()
        spelled, store = words.dictionary, self._store
        _, bounds, data = spelled.buffers()
        bounds = np.frombuffer(bounds, np.int32)[spelled.offset : spelled.offset + len(spelled) + 1] if len(spelled) else np.zeros(1, np.int32)
        data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
        place = store.find(data, bounds)
        new = np.flatnonzero(place < 0)
        new_lengths, new_ids = self._ids_of(spelled.take(pa.array(new)).to_pylist())
        begin = np.concatenate([store.begin, (store.begin[-1] + np.cumsum(new_lengths)).astype(np.int32)])
        ids = np.concatenate([store.ids, new_ids.astype(self._type)])
        place[new] = len(store) + np.arange(len(new))
        word = place[words.indices.to_numpy()] if len(words) else np.zeros(0, np.int64)
        lengths = begin[word + 1] - begin[word]
        total = np.concatenate([[0], np.cumsum(lengths, dtype=np.int64)])
        ends = np.asarray(pieces.offsets)
        result = ids[ranges(begin[word], lengths)], np.diff(total[ends - ends[0]])
        if len(new) and store.nbytes < KEPT_BYTES:
            sizes = np.diff(bounds)[new].astype(np.int64)
            kept = np.concatenate([[0], np.cumsum(sizes)])
            store.add(data[ranges(bounds[:-1][new], sizes)], kept, new_lengths, new_ids)
        return result


_NO_ID = -(1 << 63)  # of a document, where ids follow as they are


def pack(doc_ids: list[int | None], lengths: np.ndarray, ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    unnamed = sum(i is None for i in doc_ids)
    named = np.array(doc_ids[unnamed:], object) if None not in doc_ids[unnamed:] else np.array([])
    named = named.astype(np.int64)
    sorted_ = len(named) == len(doc_ids) - unnamed and not (named[1:] < named[:-1]).any()
    if sorted_ and (not len(named) or int(named[-1]) - int(named[0]) < 1 << 62):
        lowest = int(named[0]) if len(named) else 0
        spread = int(named[-1]) - lowest if len(named) else 0
        names = encode(named - lowest)
    else:
        unnamed, lowest, spread = 0, 0, -1
        names = np.array([_NO_ID if i is None else i for i in doc_ids], "<i8").tobytes()
    header = struct.pack(_HEADER, _MAGIC, len(doc_ids), unnamed, lowest, spread, len(ids), ids.itemsize)
    bounds = np.concatenate([[0], np.cumsum(lengths)])
    return header + names + encode(bounds) + ids.astype(f"<u{ids.itemsize}").tobytes()


class TokenFile:
    """Random and bulk access to one file: ``ids(i)`` of document ``i``, ``doc_ids()``, ``starts``."""

    def __init__(self, data: bytes | pa.Buffer):
        view = memoryview(data)
        magic, n, unnamed, self._lowest, spread, self.n_ids, width = struct.unpack_from(_HEADER, view)
        if magic != _MAGIC:
            raise ValueError("not a token file")
        self.n_docs, self._unnamed = n, unnamed
        at = struct.calcsize(_HEADER)
        if spread >= 0:
            self._named = EliasFano(view[at:], n - unnamed, spread)
            at += self._named.size
        else:
            self._named = np.frombuffer(view, "<i8", n, at)
            at += 8 * n
        self.starts = EliasFano(view[at:], n + 1, self.n_ids)
        at += self.starts.size
        self.all_ids = np.frombuffer(view, f"<u{width}", self.n_ids, at)

    def doc_ids(self) -> list[int | None]:
        if isinstance(self._named, np.ndarray):
            return [None if i == _NO_ID else i for i in self._named.tolist()]
        return [None] * self._unnamed + (self._named.all() + self._lowest).tolist()

    def ids(self, i: int) -> np.ndarray:
        return self.all_ids[self.starts[i] : self.starts[i + 1]]


def _default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in slices of bounded size; a single longer text is one by itself."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
    row = 0
    while row < batch.num_rows:
        before = int(sizes[row - 1]) if row else 0
        end = int(np.searchsorted(sizes, before + SLICE_BYTES, "right"))
        end = min(max(end, row + 1), batch.num_rows)
        yield batch.slice(row, end - row)
        row = end


def packed_files(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    order: Sequence[str] | None = None,
    tokenizer_path: str | None = None,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode every whole text in the order of ``order``: one row per file, ``part``, ``file``, ``n_ids`` and ``data``, its bytes.

    ``order`` is the id column unless given. Ranges of the order go to one task each, ``MAX_RANGES`` at
    most; a task closes a file after ``FILE_IDS`` ids, so it holds one file's ids at most. Null texts are empty;
    null ids come first in their own order; repeated rows are all encoded; an empty table gives no file.
    """
    with open(tokenizer_path or _default_tokenizer(), encoding="utf-8") as file:
        description = file.read()
    WordEncoder.check(description)
    # Sent once to each Python worker, which also keeps its encoder there between tasks.
    shared = docs.sparkSession.sparkContext.broadcast({"description": description})

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        kept = shared.value
        encoder = kept.setdefault("encoder", None) or WordEncoder(kept["description"])
        kept["encoder"] = encoder
        part = pyspark.TaskContext.get().partitionId()
        names, lengths, ids, held, files = [], [], [], 0, 0

        def closed() -> pa.RecordBatch:
            data = pack(names, np.array(lengths, np.int64), np.concatenate(ids))
            columns = [pa.array([x], pa.int64()) for x in (part, files, held)]
            return pa.RecordBatch.from_arrays([*columns, pa.array([data], pa.binary())], ["part", "file", "n_ids", "data"])

        for batch in batches:
            for piece in _slices(batch):
                flat, counts = encoder(piece.column(1))
                ends = np.cumsum(counts)
                whole = np.insert(flat, ends, end_id)
                del flat
                give_back()
                names += piece.column(0).to_pylist()
                lengths += (counts + 1).tolist()
                ids.append(whole)
                held += len(whole)
                del whole
                if held >= FILE_IDS:
                    yield closed()
                    names, lengths, ids, held, files = [], [], [], 0, files + 1
                    give_back()
        if names:
            yield closed()

    order = [id_col] if order is None else list(order)
    n_ranges = min(max(1, math.ceil(text_bytes(docs, text_col) / RANGE_BYTES)), MAX_RANGES)
    rows = docs.select(*[F.col(c).alias(f"_order_{i}") for i, c in enumerate(order)], F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    keys = [f"_order_{i}" for i in range(len(order))]
    ranges = rows.repartitionByRange(n_ranges, *keys)
    ordered = ranges.sortWithinPartitions(*keys, "id", "text").select("id", "text")
    return ordered.mapInArrow(task, "part long, file long, n_ids long, data binary")


def write_token_files(docs: DataFrame, path: str, **options) -> None:
    """Write the files of ``packed_files`` (whose rules and ``options`` hold) below ``path``.

    The folders name range, file and number of ids, so the offset of each file is known without
    opening one. Spark's own writer commits them: a lost task leaves nothing behind, on
    any file system.
    """
    files = packed_files(docs, **options)
    # The text writer puts the bytes down as they are, and one line feed behind them.
    files.withColumn("data", F.col("data").cast("string")).write.partitionBy("part", "file", "n_ids").text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """``read_packed`` of the files below ``path``; the folder names say the sizes."""
    root = spark._jvm.org.apache.hadoop.fs.Path(path)
    found = root.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(
        spark._jvm.org.apache.hadoop.fs.Path(root, "part=*")
    )
    if not found:
        return spark.createDataFrame([], _DOCUMENTS)
    files = spark.read.format("binaryFile").load(path)
    return read_packed(files.withColumnRenamed("content", "data"))


def read_packed(files: DataFrame) -> DataFrame:
    """Per document, read from files (as ``packed_files`` gives them): ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32``.

    ``start`` counts the ids of all documents before it: those of the files before, from their
    sizes, and those within the file, from the boundaries.
    """
    # One row per file, without its bytes.
    before = W.orderBy("part", "file").rowsBetween(W.unboundedPreceding, -1)
    sizes = files.select("part", "file", F.col("n_ids").cast("long").alias("n"))
    offsets = sizes.select(
        F.col("part").alias("p"), F.col("file").alias("f"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset")
    )

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for offset, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                file = TokenFile(data.as_buffer())
                starts = file.starts.all()
                wide = file.all_ids.astype("<u4")
                sums = [zlib.crc32(wide[a:b]) for a, b in zip(starts[:-1].tolist(), starts[1:].tolist())]
                columns = [file.doc_ids(), starts[:-1] + offset, np.diff(starts), sums]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )
            give_back()

    # Sent to all tasks, else the bytes of the files would be shuffled to meet them.
    placed = files.join(F.broadcast(offsets), (F.col("part") == F.col("p")) & (F.col("file") == F.col("f")))
    return placed.select("offset", "data").mapInArrow(task, _DOCUMENTS)


def token_table(docs: DataFrame, path: str | None = None, **options) -> DataFrame:
    """Write the files (to a fresh staging folder unless ``path`` is given) and read them back.

    Where executors share no folder, each keeps the files that it packed as rows in Spark's block store, and they are read from there.
    """
    if not path and not has_folder(docs.sparkSession):
        return read_packed(stage(packed_files(docs, **options)))
    path = path or new_folder(docs.sparkSession)
    write_token_files(docs, path, **options)
    return read_token_files(docs.sparkSession, path)
