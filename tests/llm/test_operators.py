"""Each operator against plain Python, and its rules for odd rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from leadloom.llm import (
    chat_format,
    decontaminate,
    elias_fano,
    exact_dedup,
    language_id,
    lexicon_automaton,
    license_scan,
    mixing,
    simhash,
    substring_dedup,
    token_shards,
    toxicity,
)
from leadloom.llm.components import connected_components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


LONG = prose(99, 30_000, 5_000)
ODD = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \t\n", "en", "a", 3),
    (4, "!!! 123", "en", "b", 7),
    (5, prose(1, 60), "en", "a", 1),
    (5, prose(1, 60), "en", "a", 1),
    (6, prose(1, 60), "fr", None, 1),
    (7, LONG, "en", "b", 1),
    (None, prose(2, 40), "en", "b", 1),
    (None, prose(2, 40), "en", "b", 1),
    (8, "Ünïcödé \U0001f600 wörds " + prose(3, 30), "de", "c", 1),
]


@pytest.fixture(scope="module")
def odd(spark):
    """Odd rows, with columns named as the operators name their own."""
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in ("key", "words", "digest", "row", "hash", "fingerprint", "n", "part", "offset", "phase", "id", "toxic", "node"):
        df = df.selectExpr("*", f"'x' AS {name}")
    return df


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark, medium):
    return spark.read.parquet(f"{medium}/documents.parquet")


def lowered(text: str | None) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def words(text: str | None) -> list[str]:
    return WORD.findall(lowered(text))


# 1


def shingles(text: str | None, n: int = 5) -> set[tuple[str, ...]]:
    w = words(text)
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)}


def contained(docs, items) -> set:
    pairs = set()
    for d, text in docs:
        for i, item in items:
            n = min(5, len(words(item)))
            need = shingles(item, n) if n else set()
            if need and 10 * len(need & shingles(text, n)) >= 8 * len(need):
                pairs.add((d, i))
    return pairs


def test_contamination_of_odd_rows(spark, odd, empty):
    w = prose(1, 60).split()
    items = [(1, " ".join(w[5:40])), (2, " ".join(w[:12] + ["y"] * 20)), (3, None), (4, "..."), (5, "123"), (7, " ".join(w[7:10])), (8, "W\u00f6rds, " + prose(3, 30).split()[0]), (6, prose(99, 30_000, 5_000)[200:900].upper())]
    benchmark = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 AS size")
    found = decontaminate.contaminated(odd, benchmark)
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == contained([r[:2] for r in ODD], items)
    clean = decontaminate.drop_contaminated(odd, benchmark)
    assert clean.columns == odd.columns
    gone = {d for d, _ in contained([r[:2] for r in ODD], items)}
    assert clean.count() == sum(r[0] not in gone for r in ODD)
    assert decontaminate.contaminated(empty, benchmark).isEmpty()
    assert decontaminate.drop_contaminated(odd, benchmark.where("false")).count() == len(ODD)


# 2


def distance_at_most_one(a: str, b: str) -> bool:
    if a == b:
        return True
    if len(a) > len(b):
        a, b = b, a
    i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return len(b) - len(a) <= 1 and (a[i:] == b[i + 1 :] or (len(a) == len(b) and a[i + 1 :] == b[i + 1 :]))


def test_the_automaton_accepts_what_one_edit_can_make():
    rng = random.Random(4)
    terms = ["".join(rng.choices("abö", k=rng.randrange(3, 9))) for _ in range(40)]
    probes = list({"".join(rng.choices("abö\u0434", k=rng.randrange(1, 10))) for _ in range(4_000)} | set(terms))
    data = np.frombuffer("".join(probes).encode(), np.uint8)
    ends = np.cumsum([len(p.encode()) for p in probes])
    codes = lexicon_automaton.code_points(data, np.concatenate([[0], ends[:-1]]), ends)
    for size in (40, 9):  # one automaton, or several
        parts = [lexicon_automaton.build(terms[i : i + size]) for i in range(0, 40, size)]
        word, term, edits = lexicon_automaton.run_all(parts, list(range(0, 40, size)), *codes)
        found = {probes[w]: (terms[t], e) for w, t, e in zip(word, term, edits)}
        assert len(found) == len(word)
        for p in probes:
            near = [t for t in terms if len(t) >= 4 and distance_at_most_one(p, t)]
            assert (p in found) == (p in terms or bool(near))
            if p in found:
                assert (found[p][1] == 0) == (p in terms) and distance_at_most_one(p, found[p][0])


SAID = {
    'He read "A" and you idiot then read "B"': False,
    'They wrote "you idiot" to me': True,
    "They wrote 'you idiot' to me": True,
    "don't be such an idiot, it's bad": False,
    "\u201eyou idiot\u201c, sagte er": True,
    "\u00abyou idiot\u00bb": True,
    'a stray " mark ' + "x " * 200 + 'idiot " end': False,
    'an "open\nidiot" line': False,
}


def test_what_is_quoted(spark):
    docs = spark.createDataFrame(list(enumerate(SAID)), "doc_id long, text string")
    found = toxicity.find_terms(docs, toxicity.Lexicon(0.2, ["idiot"], [0.9], [0.8])).collect()
    assert {r["doc_id"]: (r["n_open"], r["n_quoted"]) for r in found} == {i: (int(not q), int(q)) for i, q in enumerate(SAID.values())}


def test_misspellings_beyond_ascii_and_of_short_terms(spark):
    texts = ["scumm", "scu", "idi\u00f6t", "tr\u00e1sh", "\u0434\u0443\u0440\u0430\u043a\u0438", "\u0434\u0443\u0440\u043a", "scalar", "ass"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    lexicon = toxicity.Lexicon(0.2, ["scum", "idiot", "trash", "\u0434\u0443\u0440\u0430\u043a", "as"], [0.9] * 5, [0.8] * 5)
    found = {r["doc_id"]: r["n_edited"] for r in toxicity.find_terms(docs, lexicon).collect()}
    assert [found[i] for i in range(len(texts))] == [1, 1, 1, 1, 1, 1, 0, 0]


def test_scores_follow_from_the_labels_by_plain_counting(spark):
    """Terms, their chances and all scores, counted in plain Python; every text is a family of its own."""
    rng = random.Random(8)
    rows = []
    for i in range(900):
        toxic = i % 5 == 0
        text = prose(i, 60).split() + (["wr\u00e4tch", "viler"][: 1 + i % 2] if toxic else ["vilar"] if i % 3 == 0 else [])
        rng.shuffle(text)
        rows.append((i, " ".join(text), int(toxic)))
    rows += [(2000, "a wr\u00e4tchh", 0), (2001, "viles here", 0), (2002, "vilar there", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, mark int")
    labels = docs.where("doc_id < 1000").selectExpr("doc_id", "mark AS toxic")
    learned = [(t.split(), m) for i, t, m in rows if i < 1000 and zlib.crc32(str(i).encode()) % 3 != 1]
    share = sum(m for _, m in learned) / len(learned)
    n, bad = defaultdict(int), defaultdict(int)
    for text, m in learned:
        for w in set(text):
            n[w] += 1
            bad[w] += m

    def bound(w, z2=3.29**2):
        p = bad[w] / n[w]
        return (p + z2 / (2 * n[w]) - (z2 * (p * (1 - p) / n[w] + z2 / (4 * n[w] ** 2))) ** 0.5) / (1 + z2 / n[w])

    terms = sorted((w for w in n if bound(w) > 0.4), key=lambda w: (-bad[w], w))
    assert terms == ["wr\u00e4tch", "viler"]
    exact = [(bad[t] + 2 * share) / (n[t] + 2) for t in terms]
    edited = [max(share, p - 0.2) for p in exact]  # no misspelling was seen: "vilar" is an ordinary word
    lexicon = toxicity.learn_lexicon(docs, labels)
    assert lexicon.terms == [*terms, "vilar"]
    assert lexicon.exact == pytest.approx([*exact, 0]) and lexicon.edited == pytest.approx([*edited, 0])
    found = {r["doc_id"]: r["score"] for r in toxicity.score_toxicity(docs, labels).collect()}
    for i, text, _ in rows:
        clean = 1.0
        for w in text.split():
            near = [k for k, t in enumerate(terms) if distance_at_most_one(w, t)]
            if w in terms:
                clean *= 1 - exact[terms.index(w)]
            elif near and w != "vilar" and edited[near[0]] >= 0.5:
                clean *= 1 - edited[near[0]]
        assert found[i] == pytest.approx(1 - clean), text


def test_toxicity_with_misspellings_and_quotations(spark):
    rng = random.Random(5)
    rows, labels = [], []
    for i in range(900):
        toxic, quoted = i % 6 == 0, i % 6 == 1
        bad = rng.choice(["wretchedness", "scoundrels"])
        text = prose(i, 40).split()
        text[20:20] = [bad] if toxic else ['he said "some', bad, 'thing" then'] if quoted else []
        rows.append((i, " ".join(text)))
        labels.append((i, int(toxic)))
    rows += [(1001, "you wretchednes all"), (1002, "you wretchedness all"), (1003, None), (None, "scoundrels"), (1004, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "0 AS n_open", "1 AS toxic")
    marks = spark.createDataFrame(labels + labels[:50] + [(None, 1), (3, None)], "doc_id long, toxic int")
    lexicon = toxicity.Lexicon(0.2, ["wretchedness", "scoundrels"], [0.9, 0.9], [0.8, 0.8])
    got = {r["doc_id"]: r for r in toxicity.find_terms(docs, lexicon).collect()}
    assert (got[1001]["n_open"], got[1001]["n_edited"], got[1002]["n_edited"]) == (1, 1, 0)
    assert got[1]["n_quoted"] == 1 and got[1]["n_open"] == 0 and got[0]["n_open"] == 1
    found = toxicity.find_terms(docs, lexicon)
    assert toxicity.quoted_share(found, marks) < 0.1
    result = toxicity.score_toxicity(docs, marks).collect()
    assert len(result) == len(rows) and all(0 <= r["score"] <= 1 for r in result)
    for r in result:
        if r["doc_id"] is not None:
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7)
    none = toxicity.score_toxicity(docs, marks.where("toxic = 0"))
    assert {r["score"] for r in none.collect()} == {0.0}
    assert toxicity.score_toxicity(docs.where("false"), marks).isEmpty()


def test_toxicity_of_held_out_documents(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    scored = toxicity.score_toxicity(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    held = scored.where("held_out").join(labels, "doc_id").collect()
    hits = sum(r["predicted"] == r["toxic"] == 1 for r in held)
    assert hits / sum(r["toxic"] for r in held) > 0.75 and hits / sum(r["predicted"] for r in held) > 0.85


# 3


@pytest.mark.parametrize("values", [[0], [0, 0, 0], [0, 5, 5, 1_000_000], list(range(0, 100_000, 7)), []])
def test_elias_fano_returns_each_value(values):
    data = elias_fano.encode(np.array(values, np.int64))
    coded = elias_fano.EliasFano(memoryview(data), len(values), values[-1] if values else 0)
    assert coded.size == len(data) and coded.all().tolist() == values
    assert [coded[i] for i in range(len(values))] == values


def test_elias_fano_of_random_steps_is_small():
    values = np.cumsum(np.random.default_rng(0).integers(0, 4_000, 50_000))
    data = elias_fano.encode(values)
    coded = elias_fano.EliasFano(memoryview(data), len(values), int(values[-1]))
    assert all(coded[i] == values[i] for i in range(0, 50_000, 97))
    assert 8 * len(data) / len(values) < 2 + np.log2(values[-1] / len(values)) + 1


def token_rows(docs: list[tuple]) -> list[tuple]:
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    start, rows = 0, []
    for i, text in docs:
        ids = np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        rows.append((i, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


STRANGE = [
    (11, "Don't STOP, we'RE x.,y ... '' a1,b2; É, É́ H̱ İstanbul ſ ß ŉ ª"),
    (12, "<|endoftext|> <|ENDOFTEXT|>x<|startoftext|> \x01 a\x01b  nbsp em ​"),
    (13, "日本語, текст. العربية ΣΑΣ ς 12,000.5 e.g. U.S.A. www.x.com!?"),
]


def test_token_files_hold_what_the_tokenizer_gives(odd, empty, spark):
    docs = [(r[0], r[1]) for r in ODD] + STRANGE
    df = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS part", "2 AS file")
    expected = token_rows(sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")))
    got = token_shards.token_table(df).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, expected))
    assert token_shards.token_table(empty).isEmpty()
    assert token_shards.token_table(odd).count() == len(ODD)


def test_token_files_in_another_order(spark):
    docs = [(5, "e five"), (1, "a one"), (None, "none"), (3, "three c")]
    df = spark.createDataFrame([(*d, k) for k, d in enumerate(docs)], "doc_id long, text string, place int")
    got = sorted(map(tuple, token_shards.token_table(df, order=["place"]).collect()), key=lambda r: r[1])
    assert got == token_rows(docs)


def test_token_file_gives_one_document():
    ids = np.arange(1, 11, dtype=np.uint16)
    file = token_shards.TokenFile(token_shards.pack([None, 4, 4, 9], np.array([3, 0, 5, 2]), ids))
    assert file.doc_ids() == [None, 4, 4, 9] and file.n_docs == 4
    assert [file.ids(i).tolist() for i in range(4)] == [[1, 2, 3], [], [4, 5, 6, 7, 8], [9, 10]]


# 4


def fingerprint(text: str | None) -> int:
    w = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    runs = [b" ".join(w[k : k + 3]) for k in range(max(1, len(w) - 2))] if w else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, links) -> dict:
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close_pairs(prints: list[int]) -> list[tuple[int, int]]:
    return [(a, b) for i, a in enumerate(prints) for b in prints[i + 1 :] if (a ^ b).bit_count() <= 2]


def test_simhash_of_odd_rows(odd, empty):
    got = simhash.simhash_components(odd).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"] & (2**64 - 1)) for r in got) == sorted(
        (str(r[0]), fingerprint(r[1])) for r in ODD
    )
    root = roots(*(lambda p: (p, close_pairs(p)))(sorted({fingerprint(r[1]) for r in ODD})))
    lowest = defaultdict(list)
    for r in ODD:
        lowest[root[fingerprint(r[1])]].append(r[0])
    for r in got:
        ids = [i for i in lowest[root[r["fingerprint"] & (2**64 - 1)]] if i is not None]
        assert r["component_id"] == (min(ids) if ids else None)
    kept = simhash.drop_near_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 1, 4, 5, 7, 8]
    assert simhash.simhash_components(empty).isEmpty() and simhash.drop_near_copies(empty).isEmpty()


def test_rows_that_share_an_id_are_kept_by_their_texts(spark):
    """Ids 5, 5, 6 with three unrelated texts all stay; of near copies and repeated rows one stays."""
    long = prose(31, 300)
    rows = [(5, prose(32, 200)), (5, prose(33, 200)), (6, prose(34, 200)), (7, long), (7, long), (8, long + " more"), (None, prose(35, 90)), (None, prose(35, 90)), (None, prose(36, 90))]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS _id", "2 AS _kept_id", "3 AS _TEXT", "4 AS first")
    kept = simhash.drop_near_copies(df)
    assert kept.columns == df.columns
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept.collect()) == sorted({(i or 0, t) for i, t in rows if i != 8})


@pytest.mark.parametrize("paired", [2, 16])
def test_links_of_crowded_fingerprints(spark, paired):
    """A cluster where most pairs are close, whether its keys are paired or go through midpoints."""
    rng = random.Random(3)
    prints = set()
    for centre in (rng.getrandbits(64) for _ in range(3)):
        prints |= {centre ^ sum(1 << b for b in rng.sample(range(64), rng.randrange(5))) for _ in range(150)}
    prints |= {rng.getrandbits(64) for _ in range(100)}
    signed = {p - (p >> 63 << 64): p for p in prints}
    df = spark.createDataFrame([(s,) for s in signed], "fingerprint long")
    links = [(r["u"], r["v"]) for r in simhash.fingerprint_links(df, 2, paired).collect()]
    expected = roots(signed, [(a - (a >> 63 << 64), b - (b >> 63 << 64)) for a, b in close_pairs(sorted(prints))])
    assert roots(signed, links) == expected


def test_components_of_long_chains(spark):
    links = [(i, i + 1) for i in range(200)] + [(1_000, k) for k in range(1_001, 1_300)] + [(7, 7), (2_000, 2_001)]
    df = spark.createDataFrame(links, "u long, v long")
    got = {r["node"]: r["root"] for r in connected_components(df).collect()}
    assert got == roots({n for x in links for n in x}, links)
    assert connected_components(df.where("false")).isEmpty()


# 5


def test_exact_dedup_of_odd_rows(odd, empty, conf):
    for share in (0.001, 0.3):
        rows = exact_dedup.exact_duplicates(odd, share=share).collect()
        assert len(rows) == len(ODD)
        groups = defaultdict(list)
        for r in ODD:
            normal = re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "")
            groups[hashlib.sha256(normal.encode()).hexdigest()].append(r[0])
        seen = defaultdict(list)
        for r in rows:
            ids = [i for i in groups[r["text_sha256"]] if i is not None]
            assert r["group_size"] == len(groups[r["text_sha256"]])
            assert r["keep_id"] == (min(ids) if ids else None)
            seen[r["text_sha256"]].append(r)
        for same in seen.values():
            assert sum(r["kept"] for r in same) == 1
            assert all(r["doc_id"] == r["keep_id"] for r in same if r["kept"])
    assert exact_dedup.exact_duplicates(empty).isEmpty()


def test_frequent_digests_are_found_whatever_their_number(spark):
    many = spark.range(3_000).selectExpr("id AS doc_id", "CASE WHEN id % 3 = 0 THEN 'hot' ELSE concat('t', id % 700) END AS text")
    digests = many.selectExpr("doc_id", "unhex(sha2(text, 256)) AS digest", "doc_id AS row")
    found = exact_dedup.frequent_digests(digests, 0.05).collect()
    assert max(r["group_size"] for r in found) == 1_000 and len(found) <= 20


# 6


def repeated(texts: dict[int, str], n: int, across: bool = False) -> set[int]:
    """Documents with a run of n words that stands elsewhere too; with ``across``, in another document."""
    places = defaultdict(set)
    for i, t in texts.items():
        w = words(t)
        for k in range(len(w) - n + 1):
            places[tuple(w[k : k + n])].add((i, 0 if across else k))
    return {i for p in places.values() if len(p) > 1 for i, _ in p}


def test_passages_that_repeat_are_caught_and_no_others(documents):
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    numbered = substring_dedup.numbered_rows(documents)
    rows = substring_dedup.repeated_passages(numbered).collect()
    flagged = {r["doc_id"] for r in rows}
    assert repeated(texts, 51, across=True) <= flagged <= repeated(texts, substring_dedup.MIN_WORDS)
    for r in rows:
        assert len(words(texts[r["doc_id"]][r["begin"] : r["stop"]])) == r["n_words"]
    # Nothing is lost: what was cut still stands elsewhere, though not always all of it in one place.
    cut = {r["doc_id"]: r for r in substring_dedup.cut_repeats(numbered).collect()}
    left = {i: cut[i]["kept"] if i in cut else t for i, t in texts.items()}
    stands = {tuple(w[k : k + 4]) for w in map(words, left.values()) for k in range(len(w) - 3)}
    for i, r in cut.items():
        spans = [(p["begin"], p["stop"]) for p in r["passages"] if p["cut"]]
        assert left[i] == "".join(texts[i][a:b] for a, b in zip([0, *(s[1] for s in spans)], [*(s[0] for s in spans), len(texts[i])]))
        for a, b in spans:
            w = words(texts[i][a:b])
            runs = [tuple(w[k : k + 4]) for k in range(len(w) - 3)]
            assert sum(x in stands for x in runs) >= 0.9 * len(runs) - 1


def test_insertions_move_no_other_cut():
    text = prose(8, 400).encode()
    moved = b"some more words in front " + text

    def keys(data: bytes) -> set:
        return set(substring_dedup._links(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[1].tolist())

    assert len(keys(text) & keys(moved)) >= 0.9 * len(keys(text))
    table = substring_dedup._GEAR
    rolled, h = [], 0
    for b in text:
        h = (2 * h + int(table[b])) % 65536
        rolled.append(h)
    assert substring_dedup.gear_hashes(np.frombuffer(text, np.uint8)).tolist() == rolled


def test_repeats_of_odd_rows(spark, odd, empty):
    passage = prose(20, 80)
    rows = [(1, f"first {passage} end"), (2, f"Other text, then {passage.upper()}! and more."), (3, prose(21, 100)), (4, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 AS first", "2 AS begin", "3 AS row", "4 AS _spans", "5 AS KEPT")
    found = {r["doc_id"]: r for r in substring_dedup.repeated_passages(substring_dedup.numbered_rows(df)).collect()}
    assert set(found) == {1, 2} and found[1]["first"] and not found[2]["first"] and found[2]["first_doc_id"] == 1
    assert found[2]["cut"] and not found[1]["cut"]
    kept = substring_dedup.drop_repeats(df)
    assert kept.columns == df.columns
    cut = {r["doc_id"]: r["text"] for r in kept.collect()}
    assert cut[1] == rows[0][1] and cut[3] == rows[2][1] and cut[4] is None
    assert len(words(cut[2])) == len(words(rows[1][1])) - found[2]["n_words"]
    passages = substring_dedup.repeated_passages(substring_dedup.numbered_rows(odd))
    assert {r["doc_id"] for r in passages.collect()} == {5, 6, None}
    assert substring_dedup.repeated_passages(substring_dedup.numbered_rows(empty)).isEmpty()
    assert substring_dedup.drop_repeats(odd).columns == odd.columns and substring_dedup.drop_repeats(empty).isEmpty()


def test_one_of_repeated_rows_keeps_its_text(spark):
    text = prose(40, 120)
    rows = [(5, text), (5, text), (None, prose(41, 120)), (None, prose(41, 120)), (6, prose(42, 120))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    kept = defaultdict(list)
    for r in substring_dedup.drop_repeats(df).collect():
        kept[r["doc_id"]].append(len(words(r["text"])))
    assert {i: sorted(n) for i, n in kept.items()} == {5: [0, 120], None: [0, 120], 6: [120]}


def test_a_passage_with_a_frequent_line_in_it_is_listed_whole(spark):
    """The line stands first elsewhere; the rest of the passage is first here, and together they are long."""
    line, a, b = prose(50, 16), prose(51, 18), prose(52, 18)
    passage = f"{a} {line} {b}"
    rows = [(1, f"{prose(53, 40)} {line} {prose(54, 40)}"), (2, f"{prose(55, 40)} {passage} {prose(56, 40)}"), (3, f"{prose(57, 40)} {passage} {prose(58, 40)}")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring_dedup.cut_repeats(substring_dedup.numbered_rows(df)).collect()
    sizes = {r["doc_id"]: sum(p["n_words"] for p in r["passages"]) for r in found}
    assert sizes[2] >= 30 and sizes[3] >= 30
    assert {r["doc_id"]: r["kept"] for r in found}[2] == rows[1][1]


# 7


def phrases(sample: bytes, text: bytes) -> int:
    count, at = 0, 0
    while at < len(text):
        n = 1
        while at + n < len(text) and text[at : at + n + 1] in sample:
            n += 1
        count, at = count + 1, at + n
    return count


def test_cross_parsing_counts_longest_matches():
    rng = random.Random(1)
    samples = {x: bytes(rng.choices(letters, k=600)) for x, letters in (("a", b"abcde"), ("b", b"cdefg"))}
    model = language_id.model_of(samples)
    texts = [bytes(rng.choices(b"abcdefgz", k=rng.randrange(0, 500))) for _ in range(60)] + [b"z" * 9]
    offsets = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    counts, sizes = model.phrases(np.frombuffer(b"".join(texts), np.uint8), offsets)
    assert counts.tolist() == [[phrases(samples[x], t) for x in ("a", "b")] for t in texts]
    assert sizes.tolist() == [len(t) for t in texts]


def test_languages_of_held_out_documents(documents):
    found = language_id.identify(documents, language_id.learn(documents))
    rows = found.join(documents.select("doc_id", "lang"), "doc_id").where("crc32(cast(doc_id AS string)) % 4 = 2").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) / len(rows) > 0.97


def test_language_of_odd_rows(spark, odd, empty, documents):
    model = language_id.learn(documents)
    rows = language_id.identify(odd, model).collect()
    assert len(rows) == len(ODD)
    for r in rows:
        none = r["doc_id"] in (1, 2, 3, 4)
        assert (r["lang_pred"] == "und") == none and 0 <= r["score"] <= 1
    # Of texts with a letter only those go that no language's sample can parse.
    kept = language_id.drop_unidentified(odd)
    assert kept.columns == odd.columns and {1, 2, 3, 4}.isdisjoint({r["doc_id"] for r in kept.collect()})
    assert language_id.learn(empty).languages == []
    unlearned = language_id.identify(odd, language_id.learn(empty)).collect()
    assert {r["lang_pred"] for r in unlearned} == {"und"}
    assert language_id.drop_unidentified(documents).count() == documents.where(r"text rlike '\\p{L}'").count()


# 8


def test_each_period_is_less_than_a_block_from_its_shares():
    for weights in ({"a": 1}, {"a": 3, "b": 2, "c": 1}, {f"s{i}": 1 + i % 5 for i in range(23)}):
        total, done = sum(weights.values()), defaultdict(int)
        for t, source in enumerate(mixing.one_period(weights), 1):
            done[source] += 1
            assert all(abs(done[s] - t * w / total) < 1 for s, w in weights.items())
        assert done == weights


def test_the_mix_is_the_schedule_of_all_rows(odd, empty, documents):
    weights = {"src0": 3, "src1": 2}
    for docs, wanted in ((documents, weights), (odd, {None: 2, "a": 1})):
        rows = mixing.mix_sources(docs, wanted, block_docs=4).collect()
        assert len(rows) == docs.count() == len({r["_position"] for r in rows})
        per_source = defaultdict(list)
        for r in rows:
            per_source[r["source"]].append(r)
        for same in per_source.values():
            same.sort(key=lambda r: r["_position"])
            assert [r["_block"] for r in same] == [k // 4 for k in range(len(same))]
            ids = [(r["doc_id"] is not None, r["doc_id"] or 0) for r in same]
            assert ids == sorted(ids)
        # Block by block: within a phase each source is less than one block from its share.
        slots = sorted({(r["_slot"], r["_phase"], str(r["source"])) for r in rows})
        assert [s for s, _, _ in slots] == list(range(len(slots)))
        given = {str(k): v for k, v in wanted.items()}
        for phase in {p for _, p, _ in slots}:
            run = [s for _, p, s in slots if p == phase]
            active = {s for _, p, s in slots if p >= phase}
            total, done = sum(given.get(s, 1) for s in active), defaultdict(int)
            for t, s in enumerate(run, 1):
                done[s] += 1
                assert all(abs(done[a] - t * given.get(a, 1) / total) < 1 for a in active)
    assert mixing.mix_sources(empty).isEmpty()
    named = documents.selectExpr("*", *[f"{i} AS {c}" for i, c in enumerate(["_position", "_row", "_block", "doc", "tie", "in", "place"])])
    mixed = mixing.mix_sources(named, weights)
    assert mixed.columns == [*named.columns, "_block_", "_slot", "_phase", "_position_"]
    assert mixed.select(*named.columns).exceptAll(named).isEmpty() and mixed.count() == named.count()
    assert mixing.in_mixed_order(named, weights).exceptAll(named).isEmpty()
    ordered = mixing.in_mixed_order(documents, weights).select("doc_id").collect()
    wanted = mixing.mix_sources(documents, weights).orderBy("_position").select("doc_id").collect()
    assert ordered == wanted
    with pytest.raises(ValueError, match="weights"):
        mixing.mix_sources(documents, {"src0": 0})


# 9


def test_license_scan_of_odd_rows(spark, odd, empty):
    texts = [
        (20, "All rights reserved. CC-BY 4.0 and cc by; under the GNU General\nPublic License!"),
        (21, prose(1, 100) + " Permission is hereby granted, free of charge, to any person obtaining copy of software and documentation files " + prose(2, 50)),
        (22, "permission charge person obtaining"),
        (23, "all rights  reserved all rights reserved"),
    ]
    df = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 AS key", "2 AS words", "'x' AS label")
    got = {r["doc_id"]: r for r in license_scan.license_scan(df).collect()}
    assert (got[20]["n_base"], got[20]["first_word"], got[20]["last_word"]) == (4, 0, 13)
    assert got[20]["base_labels"] == "cc-by,gpl,reserved" and got[20]["score"] == 1.0
    assert got[21]["labels"] == "mit" and got[21]["n_base"] == 0 and got[21]["first_word"] is None
    assert 0.8 <= got[21]["score"] < 1
    assert got[22]["labels"] == "" and got[22]["score"] == 0.0
    assert (got[23]["n_base"], got[23]["last_word"], got[23]["n_words"]) == (2, 3, 6)
    rows = license_scan.license_scan(odd).collect()
    assert sorted((str(r["doc_id"]), r["n_words"]) for r in rows) == sorted((str(r[0]), len(words(r[1]))) for r in ODD)
    assert license_scan.license_scan(empty).isEmpty()


NEIGHBOURS = {
    "licensed under CC BY 4.0": "cc-by",
    "Licensed under CC BY-ND 4.0": "cc-by",
    "Licensed under CC BY-SA 4.0.": "cc-by,cc-by-sa",
    "(Licensed under CC BY-NC 4.0)": "cc-by,cc-by-nc",
    "released under the BSD license": "",
    "Released under the MIT License": "mit-notice",
    "Licensed under the Apache License, Version 2.0": "apache-2.0",
    "Licensed under the Mozilla License, Version 2.0": "",
    "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License": "",
    "This work is licensed under a Creative Commons Attribution 4.0 International License": "cc-by-text",
    "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License": "gpl,gpl-grant",
    "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation": "gpl,lgpl",
}


def test_licenses_are_told_from_their_neighbours(spark):
    texts = list(NEIGHBOURS) + [f"{prose(7, 70)}. {t} {prose(8, 70)}" for t in NEIGHBOURS] + [f"\u212a {t} wor\u212a" for t in NEIGHBOURS]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {r["doc_id"]: r["labels"] for r in license_scan.license_scan(df).collect()}
    assert [found[i] for i in range(len(texts))] == 3 * list(NEIGHBOURS.values())


# 10


def test_every_text_comes_back_from_its_turn():
    rng = random.Random(2)
    pieces = [*chat_format.CONTROL_STRINGS, "<", "[", "\\", "\n", "|", ">", "s>", "a", "<\\s>", "é"]
    for _ in range(3_000):
        role, text = ("".join(rng.choices(pieces, k=rng.randrange(6))) for _ in range(2))
        piece, turn = chat_format.render(role, text)
        assert (turn.role, turn.text) == (role, text)
        assert chat_format.unescape(piece[turn.begin : turn.end]) == text
        both = piece + chat_format.render("user", "x")[0]
        assert [(t.role, t.text) for t in chat_format.parse(both)] == [(role, text), ("user", "x")]
    assert chat_format.render("user", "plain [x] <b>")[0] == "<|im_start|>user\nplain [x] <b><|im_end|>\n"
    for broken in ("x", "<|im_start|>user", "<|im_start|>user\nx</s><|im_end|>\n", "<|im_start|>user\nx<|im_end|>"):
        with pytest.raises(ValueError):
            chat_format.parse(broken)


def test_conversations_of_odd_rows(spark):
    rows = [(1, 1, "assistant", None), (1, 0, None, "</s>"), (1, 1, "assistant", None), (None, None, "user", "x"), (2, 3, "assistant", "é</s>")]
    rows += [(3, k, "assistant" if k % 2 else "user", prose(k, 20)) for k in range(3_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS formatted")
    got = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_turns(df)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 3, None: 1, 2: 1, 3: 3_000}
    assert got[2]["loss_chars"] == 5 and got[2]["loss_sha256"] == hashlib.sha256("é</s>".encode()).hexdigest()
    assert got[1]["loss_chars"] == 0 and got[1]["loss_sha256"] == hashlib.sha256(b"").hexdigest()
    long = "".join(f"{r}\n{t}\n" for c, _, r, t in rows if c == 3)
    assert got[3]["turns_sha256"] == hashlib.sha256(long.encode()).hexdigest()
    assert chat_format.read_back(chat_format.format_turns(df.where("false"))).isEmpty()


def test_empty_word_encoder_input():
    import public_tokenizers

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        encoder = token_shards.WordEncoder(file.read())
    ids, lengths = encoder(pa.array(["", None, "a"], pa.string()))
    assert lengths.tolist()[:2] == [0, 0] and len(ids) == lengths[2]
    with open(public_tokenizers.path("byte_bpe_50k.json")) as file, pytest.raises(ValueError, match="white space"):
        token_shards.WordEncoder.check(file.read())


@pytest.mark.parametrize("change", ["none", "no lower case", "no word ends"])
def test_word_encoder_follows_the_tokenizer(change):
    import json

    import public_tokenizers
    from tokenizers import Tokenizer

    with open(public_tokenizers.path("word_bpe_49k.json")) as file:
        description = json.load(file)
    if change == "no lower case":
        description["normalizer"]["normalizers"].pop()
    if change == "no word ends":
        description["pre_tokenizer"]["pretokenizers"].pop()
    text = json.dumps(description)
    encoder, tokenizer = token_shards.WordEncoder(text), Tokenizer.from_str(text)
    texts = ["Hello World", "Hello, world! It's Élan's. ÀB naïve", "a.b c.. d; É é İi ǅ ﬁ 12x", "Hello Hello, hello"]
    for _ in range(2):
        ids, lengths = encoder(pa.array(texts))
        want = [e.ids for e in tokenizer.encode_batch(texts, add_special_tokens=False)]
        assert lengths.tolist() == [len(w) for w in want] and ids.tolist() == sum(want, [])


def test_word_store_tells_words_of_one_hash_apart(monkeypatch):
    from leadloom.llm import word_store

    monkeypatch.setattr(word_store, "flat_hashes", lambda data, bounds: np.diff(bounds).astype(np.uint64) % np.uint64(2))
    store = word_store.WordStore(np.uint16)
    words = [b"ab", b"", b"abc"]
    data, bounds = np.frombuffer(b"".join(words), np.uint8), np.array([0, 2, 2, 5])
    store.add(data, bounds, np.array([2, 0, 1]), np.array([7, 8, 9]))
    other = np.frombuffer(b"xbabc", np.uint8)
    found = store.find(other, np.array([0, 2, 5])).tolist()
    assert found[0] == -1 and found[1] in (-1, 2) and len(store) == 3


def test_files_close_and_kept_words_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(token_shards, "FILE_IDS", 300)
    monkeypatch.setattr(token_shards, "KEPT_BYTES", 2_000)
    monkeypatch.setattr(token_shards, "SLICE_BYTES", 2_000)
    docs = [(i, prose(i, 90)) for i in range(40)]
    got = sorted(map(tuple, token_shards.token_table(spark.createDataFrame(docs, "doc_id long, text string")).collect()))
    assert got == sorted(token_rows(docs))
