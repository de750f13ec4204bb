"""Language identification by cross-parsing with one suffix automaton per language."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from ..session import stage
from .bytesops import give_back, text_slices
from .naming import unused

UNDETERMINED = "und"
#: Bounds of the labelled sample that the automata are built from: bytes per language,
#: documents per language, and characters of one document. Every labelled language is learned.
SAMPLE_BYTES = 24_000
SAMPLE_DOCS = 128
SAMPLE_MARGIN = 4
SAMPLE_CHARS = 1_000
#: Texts are parsed in blocks of this many bytes; a phrase ends with its block.
BLOCK_BYTES = 1024
#: A text in which no language's phrases reach this mean length, in bytes, is not taken for any.
LEAST_PHRASE = 1.6
#: A script is known when it has this share of the letters of a language's sample; a stray letter is not enough.
SCRIPT_SHARE = 0.1

_BREAK, _OTHER = 0, 1  # byte classes: anything ASCII but letters, and letters that no sample has


def _byte_classes(samples: list[bytes]) -> tuple[np.ndarray, int]:
    """The class of each byte: one for each letter or higher byte of the samples, A-Z as a-z."""
    table = np.full(256, _OTHER, np.uint8)
    table[:128] = _BREAK
    table[0x61:0x7B] = _OTHER
    used = sorted({b for s in samples for b in s.lower() if b >= 0x80 or 0x61 <= b < 0x7B})
    for i, b in enumerate(used):
        table[b] = _OTHER + 1 + i
    table[0x41:0x5B] = table[0x61:0x7B]
    return table, _OTHER + 1 + len(used)


def _letters_only(classes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs of breaks as a single one, since only letters tell of a language."""
    kept = classes != _BREAK
    kept[1:] |= classes[:-1] != _BREAK
    before = np.concatenate([[0], np.cumsum(kept)])
    return classes[kept], before[offsets]


def suffix_automaton(classes: bytes) -> list[dict[int, int]]:
    """Transitions of the automaton that accepts exactly the substrings of the sequence; state 0 is the start."""
    following: list[dict[int, int]] = [{}]
    link, length = [-1], [0]
    last = 0
    for c in classes:
        state = len(following)
        following.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in following[p]:
            following[p][c] = state
            p = link[p]
        if p >= 0:
            q = following[p][c]
            if length[q] == length[p] + 1:
                link[state] = q
            else:
                clone = len(following)
                following.append(dict(following[q]))
                link.append(link[q])
                length.append(length[p] + 1)
                while p >= 0 and following[p].get(c) == q:
                    following[p][c] = clone
                    p = link[p]
                link[q] = link[state] = clone
        last = state
    return following


def _table(following: list[dict[int, int]], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Transitions in few slots, and the state that each class leads to from the start.

    A state is the number of a slot, its base; base plus class is where the state that follows stands, beside the
    base it belongs to (the higher 32 bits). No two states share a base, so a slot that belongs to another state
    means that the text cannot go on: its class begins the next phrase. The last ``width`` slots belong to none;
    their first is the state before any phrase, that of the sample's end, and that behind a class that the
    sample lacks. Bases are drawn until all slots of a state are free, states with many transitions first.
    """
    sizes = np.array([len(steps) for steps in following])
    state = np.repeat(np.arange(len(following)), sizes)
    classes = np.array([c for steps in following for c in steps], np.int64)
    targets = np.array([to for steps in following for to in steps.values()], np.int64)
    draw, slots = np.random.default_rng(0), 2 * len(targets) + width
    base = np.full(len(following), -1)
    taken, is_base = np.zeros(slots + width, bool), np.zeros(slots + width, bool)
    rank = np.minimum(sizes, 16)
    for size in range(16, 0, -1):
        waiting, entries = np.flatnonzero(rank == size), np.flatnonzero(rank[state] == size)
        while len(waiting):
            drawn = np.full(len(following), -1)
            drawn[waiting] = draw.integers(0, slots, len(waiting))
            places = drawn[state[entries]] + classes[entries]
            lost = np.zeros(len(following), bool)
            lost[state[entries[taken[places] | ~_first_of_each(places)]]] = True
            lost[waiting[is_base[drawn[waiting]] | ~_first_of_each(drawn[waiting])]] = True
            won = waiting[~lost[waiting]]
            base[won] = drawn[won]
            is_base[drawn[won]] = True
            taken[places[~lost[state[entries]]]] = True
            waiting, entries = waiting[lost[waiting]], entries[lost[state[entries]]]
    outside = len(taken)
    base[base < 0] = outside
    table = np.full(outside + width, -1, "<i8")
    table[base[state] + classes] = (base[state] << 32) | base[targets]
    first = np.full(width, outside, np.int32)
    for c, to in following[0].items():
        first[c] = base[to]
    return table, first


def _first_of_each(values: np.ndarray) -> np.ndarray:
    """Whether each value is the first one of its kind."""
    result = np.zeros(len(values), bool)
    result[np.unique(values, return_index=True)[1]] = True
    return result


@dataclass
class LanguageModel:
    """Byte classes and transition tables, one per language in alphabetical order."""

    languages: list[str]
    classes: np.ndarray
    width: int
    tables: list[tuple[np.ndarray, np.ndarray]]
    letters: tuple[Counter, ...] = ()  # of each sample, with their numbers

    def phrases(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of phrases that each text takes in each language, and its length in letters and breaks.

        From left to right, a phrase is the longest match that the sample of the language
        has. All blocks of all texts are parsed side by side, one byte at a time.
        """
        classes, offsets = _letters_only(self.classes[data], offsets)
        lengths = np.diff(offsets)
        blocks = -(-lengths // BLOCK_BYTES)
        owner = np.repeat(np.arange(len(lengths)), blocks)
        number = np.arange(len(owner)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        begin = offsets[owner] + number * BLOCK_BYTES
        size = np.minimum(offsets[owner + 1] - begin, BLOCK_BYTES)
        order = np.argsort(-size, kind="stable")
        begin, size, owner = begin[order], size[order], owner[order]
        result = np.zeros((len(lengths), len(self.languages)), np.int64)
        if not len(owner):
            return result, lengths
        longest = int(size[0])
        active = np.searchsorted(-size, -np.arange(longest), "left")  # blocks longer than each place
        columns = np.zeros((longest, len(owner)), np.uint8)
        for k in range(longest):
            columns[k, : active[k]] = classes[begin[: active[k]] + k]
        for j, (table, first) in enumerate(self.tables):
            state = np.full(len(owner), len(table) - self.width, np.int32)
            breaks = np.zeros(len(owner), np.int32)
            for k in range(longest):
                n = active[k]
                found = table[state[:n] + columns[k, :n]].view("<i4")
                broken = found[1::2] != state[:n]
                breaks[:n] += broken
                state[:n] = np.where(broken, first[columns[k, :n]], found[::2])
            result[:, j] = np.bincount(owner, breaks, minlength=len(lengths))
        return result, lengths


def _has_letter(text: Column | str) -> Column:
    return F.coalesce(F.col(text).rlike(r"\p{L}") if isinstance(text, str) else text.rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Labelled rows that may be learned from: crc32 of the id (as text) modulo 4 is not 2."""
    return docs.where(F.col(lang_col).isNotNull() & (F.crc32(F.col(id_col).cast("string")) % 4 != 2) & _has_letter(text_col))


def learn(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Automata from a bounded sample of the labelled rows of ``docs``.

    The sample takes different texts by their hash, up to ``SAMPLE_DOCS`` texts of
    ``SAMPLE_CHARS`` characters and ``SAMPLE_BYTES`` bytes for each language.
    """
    rows = training_rows(docs, id_col, text_col, lang_col)
    pick = F.xxhash64(text_col)
    rows = rows.select(F.col(lang_col).alias("lang"), pick.alias("pick"), F.substring(text_col, 1, SAMPLE_CHARS).alias("text"))
    # Copies are one entry, so that a text in many copies does not fill the sample.
    texts = stage(rows.select("lang", "pick").distinct())
    # Of a language about SAMPLE_MARGIN times the texts wanted pass, whatever their number; the first of them are taken.
    share = texts.groupBy(F.col("lang").alias("of")).agg((SAMPLE_MARGIN * SAMPLE_DOCS / F.count(F.lit(1))).alias("share"))
    low = F.shiftrightunsigned("pick", 11) / F.lit(float(1 << 53)) < F.col("share")
    # One row per language, of which the model holds far more.
    few = texts.join(F.broadcast(share), (F.col("lang") == F.col("of")) & low)
    place = F.row_number().over(W.partitionBy("lang").orderBy(F.shiftrightunsigned("pick", 1), "pick"))
    picked = few.withColumn("place", place).where(F.col("place") <= SAMPLE_DOCS)
    picked = picked.select(F.col("lang").alias("l"), F.col("pick").alias("p"))
    # At most SAMPLE_DOCS rows per language.
    found = rows.join(F.broadcast(picked), (F.col("lang") == F.col("l")) & (F.col("pick") == F.col("p")), "left_semi")
    sample = found.groupBy("lang", "pick").agg(F.min("text").alias("text"))
    collected = [(r["lang"], re.split(r"[\n.!?]+\s*", r["text"])) for r in sample.orderBy("lang", "pick").collect()]
    # A sentence that comes up again is boilerplate or a loop, whatever the language of the text around it.
    seen = Counter(line for _, lines in collected for line in lines)
    parts: dict[str, list[bytes]] = {}
    for lang, lines in collected:
        parts.setdefault(lang, []).extend(line.encode() for line in lines if seen[line] == 1)
    return model_of({lang: b"\n".join(lines)[:SAMPLE_BYTES] for lang, lines in _pure(parts).items()})


def _pure(lines: dict[str, list[bytes]]) -> dict[str, list[bytes]]:
    """The lines of each language that the other half of the lines gives to this language.

    Labelled texts may quote other languages. A language without such a line keeps all.
    """
    halves = [{lang: part[i::2] for lang, part in lines.items()} for i in (0, 1)]
    pure: dict[str, list[bytes]] = {}
    for known, tested in (halves, halves[::-1]):
        model = model_of({lang: b"\n".join(part)[:SAMPLE_BYTES] for lang, part in known.items()})
        for lang, part in tested.items():
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in part], dtype=np.int64)])
            counts, _ = model.phrases(np.frombuffer(b"".join(part), np.uint8), offsets)
            own = model.languages.index(lang)
            pure.setdefault(lang, []).extend(x for x, c in zip(part, counts) if c[own] == c.min())
    return {lang: pure.get(lang) or part for lang, part in lines.items()}


def model_of(samples: dict[str, bytes]) -> LanguageModel:
    languages = sorted(samples)
    classes, width = _byte_classes(list(samples.values()))
    tables = []
    for x in languages:
        sample = classes[np.frombuffer(samples[x], np.uint8)]
        sample, _ = _letters_only(sample, np.array([0, len(sample)]))
        tables.append(_table(suffix_automaton(sample.tobytes()), width))
    letters = tuple(Counter(c for c in samples[x].decode(errors="ignore") if c.isalpha()) for x in languages)
    return LanguageModel(languages, classes, width, tables, letters)


def kept_names(docs: DataFrame) -> list[str]:
    """Names for ``identify``'s result beside all columns of ``docs``."""
    return unused(docs, "_lang_pred", "_score", "_phrase_bytes")


def identify(
    docs: DataFrame, model: LanguageModel, id_col: str = "doc_id", text_col: str = "text", keep: bool = False
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``lang_pred``, ``score`` and ``phrase_bytes``.

    The language whose sample parses the whole text into the fewest phrases per byte wins,
    the first in the alphabet among equals. ``score`` is the runner-up's number of phrases
    over that of both (0.5: undecided, towards 1: certain; 1 if only one language is known).
    ``phrase_bytes`` is the mean length of the winner's phrases. Null texts and texts without
    a letter are ``und`` with score 0, and so is every text when nothing was learned.
    Only id and text are read. With ``keep`` all columns of ``docs`` stay, and these three are named by ``kept_names``.
    """
    # As plain values: executors need not have this package installed.
    shared = docs.sparkSession.sparkContext.broadcast((model.languages, model.classes, model.width, model.tables))
    names = kept_names(docs) if keep else ["lang_pred", "score", "phrase_bytes"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fitted = LanguageModel(*shared.value)
        for batch in batches:
            texts, letters = batch.column(text_at).cast(pa.binary()), batch.column(batch.num_columns - 1)
            found = []
            for _, data, offsets in text_slices(texts, 4_000_000):
                found.append(fitted.phrases(data, offsets))
            counts = np.concatenate([f[0] for f in found]) if found else np.zeros((0, 0))
            sizes = np.concatenate([f[1] for f in found]) if found else np.zeros(0)
            langs, scores, means = _decide(fitted.languages, counts, sizes, letters.to_numpy(zero_copy_only=False))
            columns = [batch.column(i) for i in range(n_kept)]
            columns += [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(means, pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [f"c{i}" for i in range(len(columns))])
            del columns, found, texts
            give_back()

    kept = [F.col(f"`{c}`") for c in docs.columns] if keep else [F.col(id_col).cast("long").alias("doc_id")]
    inner = unused(docs, "_text_bytes", "_letters")
    # A text that is kept is not sent a second time: whole texts are most of a batch.
    sent = keep and docs.columns.count(text_col) == 1 and docs.schema[text_col].dataType in (StringType(), BinaryType())
    own = [] if sent else [F.col(text_col).cast("binary").alias(inner[0])]
    rows = docs.select(*kept, *own, _has_letter(text_col).alias(inner[1]))
    n_kept = len(kept)
    text_at = docs.columns.index(text_col) if sent else n_kept
    fields = rows.schema.fields[:n_kept]
    schema = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(fields))
    schema += f", c{len(fields)} string, c{len(fields) + 1} double, c{len(fields) + 2} double"
    return rows.mapInArrow(task, schema).toDF(*[f.name for f in fields], *names)


def _decide(
    languages: list[str], counts: np.ndarray, sizes: np.ndarray, letters: np.ndarray
) -> tuple[list[str], np.ndarray, np.ndarray]:
    n = len(sizes)
    if not languages or not n:
        return [UNDETERMINED] * n, np.zeros(n), np.zeros(n)
    best = counts.argmin(1)
    ordered = np.sort(counts, 1).astype(float)
    least = ordered[:, 0]
    second = ordered[:, 1] if len(languages) > 1 else np.full(n, np.inf)
    with np.errstate(invalid="ignore", divide="ignore"):
        scores = np.where(np.isinf(second), 1.0, second / (least + second))
        means = np.where(least > 0, sizes / least, 0.0)
    known = letters.astype(bool)
    langs = [languages[b] if k else UNDETERMINED for b, k in zip(best, known)]
    return langs, np.where(known, scores, 0.0), np.where(known, means, 0.0)


def _unseen_script(spark: SparkSession, model: LanguageModel, text_col: str) -> Column:
    """Whether most letters of a text are of scripts that no language's sample is written in, so that parsing tells nothing of it."""
    script = spark._jvm.java.lang.Character.UnicodeScript
    names = {c: script.of(ord(c)).name() for c in set().union(*model.letters)}
    seen = {"COMMON", "INHERITED"}
    for letters in model.letters:
        counts: Counter = Counter()
        for c, n in letters.items():
            counts[names[c]] += n
        seen |= {name for name, n in counts.items() if n >= SCRIPT_SHARE * counts.total()}
    known = "".join(rf"\p{{script={name}}}" for name in sorted(seen))
    letters = F.length(F.regexp_replace(text_col, r"\P{L}", ""))
    unseen = F.length(F.regexp_replace(text_col, rf"[\P{{L}}{known}]", ""))
    return 2 * unseen > letters


def drop_unidentified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``docs`` without texts that have no letter, or that no language's sample can parse into phrases of ``LEAST_PHRASE`` bytes.

    A text mostly in scripts that no sample has stays: its short phrases say nothing about it.
    Without any labelled row nothing was learned; then only texts without a letter go.
    """
    model = learn(docs, id_col, text_col, lang_col)
    if not model.languages:
        return docs.where(_has_letter(text_col))
    found = identify(docs, model, id_col, text_col, keep=True)
    pred, _, phrase = kept_names(docs)
    parsed = (F.col(phrase) >= LEAST_PHRASE) | _unseen_script(docs.sparkSession, model, text_col)
    sure = (F.col(pred) != UNDETERMINED) & parsed
    return found.where(sure).select(*[F.col(f"`{c}`") for c in docs.columns])
