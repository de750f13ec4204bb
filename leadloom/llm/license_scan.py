"""License scans: phrases, and an exact set-similarity join against license templates. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import stage

#: The base phrases and their labels.
BASE_PHRASES = {
    "cc by": "cc-by",
    "general public license": "gpl",
    "all rights reserved": "reserved",
}

#: Label and wording of the templates. Words are compared as sets.
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "apache-2.0-grant": "you may not use this file except in compliance with the License. You may obtain a copy of the License",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "bsd-disclaimer": "This software is provided by the copyright holders and contributors as is and any express or implied warranties are disclaimed",
    "cc-by-text": "This work is licensed under a Creative Commons Attribution 4.0 International License",
    "cc-by-nc": "Licensed under CC BY-NC 4.0",
    "cc-by-sa": "Licensed under CC BY-SA 4.0",
    "cc0": "To the extent possible under law the author has waived all copyright and related or neighboring rights to this work",
    "gpl-grant": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License",
    "gpl-notice": "This work is licensed under the GNU General Public License, version 3",
    "lgpl": "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
    "mit": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mit-notice": "Released under the MIT License",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}

#: Words that must stand one after another in a block besides, which tell a template from its neighbours.
TELLING = {
    "apache-2.0": "apache license",
    "apache-2.0-grant": "in compliance with the license",
    "bsd": "redistribution and use in source and binary forms",
    "bsd-disclaimer": "provided by the copyright holders and contributors",
    "cc-by-text": "creative commons attribution 4",
    "cc-by-nc": "by nc 4",
    "cc-by-sa": "by sa 4",
    "cc0": "waived all copyright",
    "gpl-grant": "gnu general public license",
    "gpl-notice": "gnu general public license",
    "lgpl": "gnu lesser general public license",
    "mit": "hereby granted free of charge",
    "mit-notice": "mit license",
    "mpl-2.0": "mozilla public license",
    "unlicense": "unencumbered software",
}

#: Share of a template's different words that a block must hold, as tenths.
CONTAINMENT_TENTHS = 8
#: Blocks are this many words long and begin every half block. No template may be longer than half a block.
BLOCK_WORDS = 48

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_BETWEEN_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def words_of(text: Column | str) -> Column:
    """The words of a text (null: none): runs of digits, letters and characters beyond ASCII, A-Z in lower case."""
    lowered = F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER)
    return F.filter(F.split(lowered, _BETWEEN), lambda w: w != "")


def template_words(text: str) -> list[str]:
    """Different words of a template, in their order. Templates are ASCII."""
    cleaned = "".join(c if c.isalnum() else " " for c in text.lower())
    return list(dict.fromkeys(cleaned.split()))


def _needed(n: int) -> int:
    """How many of ``n`` words a block must hold."""
    return -(-n * CONTAINMENT_TENTHS // 10)


def _phrase_starts(hits: str, phrase: str) -> Column:
    """Places where the words of the phrase stand one after another, from the sorted ``hits`` of words and their places."""

    def place(hit: Column, i: Column) -> Column:
        first, *others = phrase.split(" ")
        found = hit["word"] == first
        for k, other in enumerate(others, 1):
            following = F.get(F.col(hits), i + k)  # past the end: null, so no match
            found = found & (following["word"] == other) & (following["at"] == hit["at"] + k)
        return F.when(found, hit["at"])

    return F.filter(F.transform(hits, place), lambda i: i.isNotNull())


def word_hits(docs: DataFrame, words: list[str], id_col: str, text_col: str) -> DataFrame:
    """Per row: ``doc_id``, ``key`` (of id and text), ``n_words`` and ``hits``: where the given words stand.

    Words are runs of digits, letters and characters beyond ASCII, A-Z in lower case. Every text is split once.
    """
    id = F.col(id_col)
    key = F.struct(id.alias("id"), F.xxhash64(text_col).alias("hash"))
    # Of all words few are wanted, so only those that may be are brought to lower case exactly.
    split = docs.select(id.alias("doc_id"), key.alias("key"), F.split(F.coalesce(text_col, F.lit("")), _BETWEEN_ANY_CASE).alias("words"))
    # A separator at either end leaves an empty word there.
    lead = (F.get("words", F.lit(0)) == "").cast("int")
    last = F.when((F.size("words") > 1) & (F.element_at("words", -1) == ""), 1).otherwise(0)

    def hit(word: Column, i: Column) -> Column:
        return F.when(F.lower(word).isin(words), F.struct((i - lead).alias("at"), F.translate(word, _UPPER, _LOWER).alias("word")))

    hits = F.filter(F.transform("words", hit), lambda h: h["word"].isin(words))
    return split.select("doc_id", "key", (F.size("words") - lead - last).cast("long").alias("n_words"), hits.alias("hits"))


def word_ranks(texts: DataFrame, words: list[str]) -> dict[str, int]:
    """Order of the template words: 0 for the rarest in the corpus, ties by the word.

    ``texts`` has the ``hits`` of each text; all of them are counted. The result has
    one entry per template word, whatever the size of the corpus.
    """
    hits = F.filter(F.transform("hits", lambda h: h["word"]), lambda w: w.isin(words))
    counted = texts.select(F.explode(hits).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    counts = {r["word"]: r["n"] for r in counted.collect()}
    return {w: i for i, w in enumerate(sorted(words, key=lambda w: (counts.get(w, 0), w)))}


def template_matches(texts: DataFrame, templates: dict[str, str] | None = None) -> DataFrame:
    """Exact join of text blocks with templates: ``key``, ``block``, ``label``, ``size``, ``shared``.

    ``texts`` has ``key`` and ``hits`` of ``word_hits``. A block matches a template when it holds at
    least ``CONTAINMENT_TENTHS`` tenths of the template's different words, and its ``TELLING`` words one after
    another. All tokens are put
    in one order, rarest in the corpus first; words of no template cannot be shared and
    are left out. A template must share one of its first n - needed + 1 tokens (its prefix),
    so only blocks around a prefix token are formed. Both sides then join on these
    tokens. Blocks with fewer template words than needed drop out by length, and pairs whose
    first shared token leaves too few tokens behind it on either side drop out by position.
    What is left is counted exactly.
    """
    sets = {label: template_words(t) for label, t in (templates or TEMPLATES).items()}
    half = BLOCK_WORDS // 2
    longest = max(len(t.split()) for t in (templates or TEMPLATES).values())
    if longest > half:
        raise ValueError(f"a template has {longest} words; blocks of {BLOCK_WORDS} words allow {half}")
    ranks = word_ranks(texts, sorted({w for words in sets.values() for w in words}))
    by_rank = {label: sorted(words, key=ranks.get) for label, words in sets.items()}
    prefixes = {label: words[: len(words) - _needed(len(words)) + 1] for label, words in by_rank.items()}
    rare = sorted({w for words in prefixes.values() for w in words})

    around = F.transform(F.filter("hits", lambda h: h["word"].isin(rare)), lambda h: F.floor(h["at"] / half).cast("int"))
    # A word stands in the block that begins in its own half block and in the one before.
    starts = F.array_distinct(F.flatten(F.transform(F.array_distinct(around), lambda b: F.array(b, F.greatest(b - 1, F.lit(0))))))
    blocks = texts.where(F.size("hits") > 0).select("key", "hits", F.explode(starts).alias("block"))
    begin = F.col("block") * half
    blocks = blocks.select("key", "block", F.filter("hits", lambda h: (h["at"] >= begin) & (h["at"] < begin + BLOCK_WORDS)).alias("inside"))
    # As many entries as template words.
    rank = F.create_map(*[F.lit(x) for w, i in ranks.items() for x in (w, i)])
    known = F.transform(F.filter("inside", lambda h: h["word"].isin(list(ranks))), lambda h: h["word"])
    tokens = F.array_sort(F.transform(F.array_distinct(known), lambda w: rank[w]))
    least = min(_needed(len(words)) for words in sets.values())
    blocks = blocks.select("key", "block", "inside", tokens.alias("tokens")).where(F.size("tokens") >= least)

    # One row per prefix token of a template: fixed in size, so safe to broadcast.
    rows = [
        (label, [ranks[w] for w in by_rank[label]], _needed(len(by_rank[label])), place, ranks[w])
        for label, words in prefixes.items()
        for place, w in enumerate(words)
    ]
    schema = "label string, template array<int>, needed int, place int, prefix_token int"
    sides = texts.sparkSession.createDataFrame(rows, schema)
    probes = blocks.select("*", F.posexplode("tokens").alias("token_place", "token"))
    pairs = probes.join(F.broadcast(sides), F.col("token") == F.col("prefix_token"))
    behind = F.least(F.size("template") - F.col("place"), F.size("tokens") - F.col("token_place"))
    possible = pairs.where((F.size("tokens") >= F.col("needed")) & (behind >= F.col("needed")))
    shared = F.array_intersect("template", "tokens")
    # A pair comes up once, at the first of its shared tokens.
    first = possible.where(F.get(shared, F.lit(0)) == F.col("token"))
    enough = first.where(F.size(shared) >= F.col("needed"))
    told = F.lit(True)
    for label in sets:
        if label in TELLING:
            told = F.when(F.col("label") == label, F.size(_phrase_starts("inside", TELLING[label])) > 0).otherwise(told)
    return enough.where(told).select(
        "key", "block", "label", F.size("template").alias("size"), F.size(shared).alias("shared")
    )


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs`` with the licenses that its whole text names.

    ``n_words``; ``n_base``, ``first_word`` and ``last_word`` of all places of ``BASE_PHRASES``;
    ``base_labels``, and ``labels`` with those of matched templates, both sorted and joined by
    commas; ``score``: 1 with a base phrase, else the best containment of a matched template,
    else 0. Null and empty texts have no words and no labels; very long texts are read whole, block by
    block; repeated rows, and those with the same id and text, share their labels; rows without an id are
    scanned like any other. Other columns are not read. An empty table gives no rows.
    """
    phrases = " ".join([*BASE_PHRASES, *TELLING.values()]).split(" ")
    wanted = sorted({*phrases, *(w for t in TEMPLATES.values() for w in template_words(t))})
    texts = stage(word_hits(docs, wanted, id_col, text_col))
    matches = template_matches(texts.select("key", "hits"))
    labels = matches.groupBy("key").agg(
        F.collect_set("label").alias("method_labels"), F.max(F.col("shared") / F.col("size")).alias("best")
    )
    found = [f"_{label}" for label in BASE_PHRASES.values()]
    starts = [_phrase_starts("hits", phrase).alias(f) for phrase, f in zip(BASE_PHRASES, found)]
    everywhere = F.concat(*found)
    base_labels = F.concat(
        *[F.when(F.size(f) > 0, F.array(F.lit(f[1:]))).otherwise(F.array().cast("array<string>")) for f in found]
    )
    base = texts.select("doc_id", "key", "n_words", *starts).select(
        "doc_id",
        "key",
        "n_words",
        F.size(everywhere).cast("long").alias("n_base"),
        F.array_min(everywhere).cast("long").alias("first_word"),
        F.array_max(everywhere).cast("long").alias("last_word"),
        base_labels.alias("base"),
    )
    same = base["key"].eqNullSafe(labels["key"])
    joined = base.join(labels, same, "left")
    both = F.array_union("base", F.coalesce("method_labels", F.array().cast("array<string>")))
    return joined.select(
        "doc_id",
        "n_words",
        "n_base",
        "first_word",
        "last_word",
        F.array_join(F.array_sort("base"), ",").alias("base_labels"),
        F.array_join(F.array_sort(both), ",").alias("labels"),
        F.when(F.col("n_base") > 0, 1.0).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
