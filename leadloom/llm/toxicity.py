"""Toxicity scores from a learned lexicon, matched with misspellings and weighed by context."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage
from . import simhash
from .bytesops import ALNUM_LOWER, text_slices, word_spans
from .lexicon_automaton import Automaton, build, code_points, run_all
from .license_scan import words_of

#: Scores from here on are predicted toxic.
THRESHOLD = 0.7
#: Terms in one automaton; a larger lexicon goes into several.
AUTOMATON_TERMS = 1_000
#: A word is a term when its share of toxic documents is above this for certain (99.9 % Wilson bound).
LEAST_SHARE = 0.4
_Z2 = 3.29**2
#: A quotation is at most so many bytes long, so that a stray mark reaches no further.
QUOTE_BYTES = 240
#: Opening and closing quotation marks.
QUOTES = [('"', '"'), ("\u201c", "\u201d"), ("\u201d", "\u201d"), ("\u201e", "\u201c\u201d"), ("\u00ab", "\u00bb"), ("\u00bb", "\u00ab"), ("\u2018", "\u2019")]
#: A word one edit away from a term is an ordinary word, and no misspelling, when so many documents hold it, most of them clean.
ORDINARY_DOCS = 5
#: What a quoted match counts against an open one before any was seen, and how many documents that belief is worth.
QUOTED_PRIOR, PRIOR_DOCS = 0.4, 10

_LETTER = rb"[0-9A-Za-z\x80-\xff]"
_QUOTED = re.compile(
    b"|".join(
        [rb"%s(?:(?!%s)[^\n]){1,%d}?(?:%s)" % (a, b, QUOTE_BYTES, b) for a, b in ((o.encode(), b"|".join(x.encode() for x in c)) for o, c in QUOTES)]
        # The apostrophe quotes only where it stands outside a word on one side and at one on the other.
        + [rb"(?<!%s)'(?=%s)[^\n]{1,%d}?'(?!%s)" % (_LETTER, _LETTER, QUOTE_BYTES, _LETTER)]
    )
)


@dataclass
class Lexicon:
    """Terms, and the chance that a document is toxic that holds a term exactly, or with one edit."""

    base: float = 0.0
    terms: list[str] = field(default_factory=list)
    exact: list[float] = field(default_factory=list)
    edited: list[float] = field(default_factory=list)


def is_held_out(id_col: str = "doc_id") -> Column:
    """Labels of these documents are never learned from: crc32 of the id (as text) modulo 3 is 1."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_labels(labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> DataFrame:
    """``id`` and ``toxic`` (0 or 1) of documents that may be learned from, one row each."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & ~is_held_out(id_col))
    return rows.groupBy(F.col(id_col).cast("long").alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("toxic"))


def learn_lexicon(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> Lexicon:
    """The lexicon of all labelled documents that are not held out.

    Near copies count as one document together, else any word of a toxic text with many copies
    would pass for a term. They are told by SimHash; each document of a family has an equal share in it,
    so a word counts by the share of the family that holds it. All words
    of all documents are counted; those that are terms for certain come to the driver. The words one
    edit away from a term give the chance of its misspellings, but ordinary ones stand for themselves and
    are listed behind the terms, with a chance of 0. No labels, or no toxic one, give no terms.
    """
    known = training_labels(labels, id_col, label_col)
    share = known.agg(F.avg("toxic")).first()[0]
    if not share:
        return Lexicon()
    rows = docs.where(F.col(id_col).isNotNull() & ~is_held_out(id_col)).select(
        F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text")
    )
    weights = _family_weights(rows, known)
    # One row per labelled document, so it grows with the corpus: the same join at all sizes.
    held = rows.join(weights.hint("merge"), F.col("doc") == F.col("id"))
    texts = held.select("toxic", "weight", F.array_distinct(words_of("text")).alias("words"))
    words = texts.select("toxic", "weight", F.explode("words").alias("word"))
    # Rounded, so that the order of addition decides nothing.
    n, toxic = F.sum("weight"), F.sum(F.col("weight") * F.col("toxic"))
    vocabulary = stage(words.groupBy("word").agg(F.round(n, 6).alias("n"), F.round(toxic, 6).alias("toxic")).where("n > 0"))
    p = F.col("toxic") / F.col("n")
    spread = F.sqrt(_Z2 * (p * (1 - p) / F.col("n") + _Z2 / (4 * F.col("n") * F.col("n"))))
    certain = (p + _Z2 / (2 * F.col("n")) - spread) / (1 + _Z2 / F.col("n"))
    top = vocabulary.where(certain > LEAST_SHARE).orderBy(F.col("toxic").desc(), "word").collect()
    if not top:
        return Lexicon(share)
    smooth = [(r["toxic"] + 2 * share) / (r["n"] + 2) for r in top]
    terms = [r["word"] for r in top]
    near = stage(_near_words(vocabulary, terms))
    ordinary = (F.col("n") >= ORDINARY_DOCS) & (2 * F.col("toxic") < F.col("n"))
    summed = near.where(~ordinary).groupBy("term").agg(F.round(F.sum("n"), 6).alias("n"), F.round(F.sum("toxic"), 6).alias("toxic"))
    seen = {r["term"]: r for r in summed.collect()}
    edited = [
        (seen[i]["toxic"] + 2 * share) / (seen[i]["n"] + 2) if i in seen else max(share, p - 0.2)
        for i, p in enumerate(smooth)
    ]
    plain = sorted(r["word"] for r in near.where(ordinary).select("word").distinct().collect())
    return Lexicon(share, terms + plain, smooth + [0.0] * len(plain), edited + [0.0] * len(plain))


def _automata(terms: list[str]) -> tuple[list[tuple], list[int]]:
    """The terms in automata of bounded size, as plain tuples, and the number of the first term of each."""
    first = list(range(0, len(terms), AUTOMATON_TERMS)) or [0]
    return [tuple(build(terms[i : i + AUTOMATON_TERMS])) for i in first], first


def _family_weights(rows: DataFrame, known: DataFrame) -> DataFrame:
    """``id``, ``toxic`` and ``weight`` of the labelled documents: those of one label that SimHash links add up to 1.

    Of rows that repeat an id, each has an equal share in its document.
    """
    prints = simhash.fingerprints(rows, "doc", "text")
    prints = stage(prints.join(known, F.col("doc_id") == F.col("id")).select("doc_id", "toxic", "fingerprint"))
    components = simhash.fingerprint_components(prints)
    found = prints.join(components, F.col("fingerprint") == F.col("known"))
    family = F.min("component_id").alias("family")
    documents = stage(found.groupBy("doc_id", "toxic").agg(family, F.count(F.lit(1)).alias("copies")))
    # The hash gives both sides a shuffle that adaptive execution can split.
    key = F.xxhash64("family", "toxic")
    sizes = documents.groupBy("family", "toxic").agg(F.count(F.lit(1)).alias("size")).select(
        F.col("family").alias("f"), F.col("toxic").alias("t"), key.alias("kh"), "size"
    )
    same = (F.col("family") == F.col("f")) & (F.col("toxic") == F.col("t")) & (F.col("h") == F.col("kh"))
    return documents.withColumn("h", key).join(sizes, same).select(
        F.col("doc_id").alias("id"), "toxic", (1 / (F.col("size") * F.col("copies"))).alias("weight")
    )


def _near_words(vocabulary: DataFrame, terms: list[str]) -> DataFrame:
    """``word``, ``term``, ``n`` and ``toxic`` of the words of the vocabulary that are one edit away from a term."""
    shared = vocabulary.sparkSession.sparkContext.broadcast(_automata(terms))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, first = shared.value
        parts = [Automaton(*p) for p in plain]
        for batch in batches:
            for row, data, offsets in text_slices(batch.column(0)):
                word, term, edits = run_all(parts, first, *code_points(data, offsets[:-1], offsets[1:]))
                rows = pa.array(word[edits > 0] + row)
                columns = [batch.column(0).take(rows), pa.array(term[edits > 0].astype(np.int32))]
                columns += [batch.column(i).take(rows) for i in (1, 2)]
                yield pa.RecordBatch.from_arrays(columns, ["word", "term", "n", "toxic"])

    rows = vocabulary.select(F.col("word").cast("binary"), "n", "toxic").mapInArrow(task, "word binary, term int, n double, toxic double")
    return rows.withColumn("word", F.col("word").cast("string"))


def quotations(text: bytes) -> np.ndarray:
    """Begins and ends of what stands between paired quotation marks on one line, from left to right."""
    return np.array([m.span() for m in _QUOTED.finditer(text)], np.int64).reshape(-1, 2)


def find_terms(
    docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per row of ``docs``: its matches and what they weigh, apart for open and quoted ones.

    ``doc_id``, ``n_open``, ``n_quoted``, ``n_edited`` and ``open_weight``, ``quoted_weight``: the sums of
    -log(1 - chance) over the matches. Matches that do not make a document toxic rather than
    clean weigh nothing. A match is quoted where it stands between paired quotation marks of one line.
    ``terms`` lists the matched terms. Null and empty texts have none; very long texts are searched whole; every
    row is answered, repeated ones too; an empty table gives no rows.
    """
    chance = np.array([lexicon.exact, lexicon.edited]).reshape(2, -1)
    weight = np.where(chance >= 0.5, -np.log(1 - np.clip(chance, 0, 0.999)), 0.0)
    shared = docs.sparkSession.sparkContext.broadcast((*_automata(lexicon.terms), weight, lexicon.terms))
    fields = ["doc_id", "n_open", "n_quoted", "n_edited", "open_weight", "quoted_weight", "terms"]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plain, first_terms, weights, names = shared.value
        parts = [Automaton(*p) for p in plain]
        for batch in batches:
            n = batch.num_rows
            counts, sums = np.zeros((3, n), np.int64), np.zeros((2, n))
            found: list[set[str]] = [set() for _ in range(n)]
            for row, data, offsets in text_slices(batch.column(1)):
                mapped = ALNUM_LOWER[data]
                starts, ends, first = word_spans(mapped, offsets)
                word, term, edits = run_all(parts, first_terms, *code_points(mapped, starts, ends))
                some = weights[edits, term] > 0
                word, term, edits = word[some], term[some], edits[some]
                text = np.searchsorted(first, word, "right") - 1
                for i in np.unique(text).tolist():
                    at = np.flatnonzero(text == i)
                    begin, end = int(offsets[i]), int(offsets[i + 1])
                    spans = quotations(data[begin:end].tobytes()) + begin
                    place = np.searchsorted(spans[:, 0], starts[word[at]], "right") - 1
                    quoted = (place >= 0) & (ends[word[at]] <= spans[place, 1]) if len(spans) else np.zeros(len(at), bool)
                    value = weights[edits[at], term[at]]
                    counts[:, row + i] = (~quoted).sum(), quoted.sum(), edits[at].sum()
                    sums[:, row + i] = value[~quoted].sum(), value[quoted].sum()
                    found[row + i] = {names[t] for t in term[at].tolist()}
            columns = [batch.column(0), *(pa.array(c) for c in counts), *(pa.array(s) for s in sums)]
            columns.append(pa.array([sorted(f) for f in found], pa.list_(pa.string())))
            yield pa.RecordBatch.from_arrays(columns, fields)

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("binary").alias("text"))
    return rows.mapInArrow(
        task,
        "doc_id long, n_open long, n_quoted long, n_edited long, open_weight double, quoted_weight double, terms array<string>",
    )


def quoted_share(found: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "toxic") -> float:
    """What a quoted match counts against an open one: the toxic share of labelled documents with quoted matches only."""
    known = training_labels(labels, id_col, label_col)
    only = found.where("n_open = 0 AND n_quoted > 0").join(known, F.col("doc_id") == F.col("id"))
    row = only.agg(F.count(F.lit(1)).alias("n"), F.sum("toxic").alias("toxic")).first()
    return ((row["toxic"] or 0) + QUOTED_PRIOR * PRIOR_DOCS) / (row["n"] + PRIOR_DOCS)


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic"
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id``, ``held_out``, ``score``, ``predicted``, and what was found.

    The lexicon is learned from the labels that are not held out. Each match adds its weight,
    a quoted one only the share that quotations have; the score is 1 - exp(-sum). Null and
    empty texts and texts without a match score 0; without any toxic label all do. Rows
    without an id are scored but not learned from; a repeated label counts once, as toxic
    if any of its rows is; very long texts are read whole; other columns are not read; an empty
    table gives no rows.
    """
    lexicon = learn_lexicon(docs, labels, id_col, text_col, label_col)
    found = stage(find_terms(docs, lexicon, id_col, text_col))
    share = quoted_share(found, labels, id_col, label_col)
    score = 1 - F.exp(-(F.col("open_weight") + F.lit(share) * F.col("quoted_weight")))
    return found.withColumn("score", score).select(
        "doc_id",
        is_held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "n_open",
        "n_quoted",
        "n_edited",
        F.array_join("terms", ",").alias("terms"),
    )
