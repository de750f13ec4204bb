"""Whitening, ranked search and the language model against plain Python and numpy."""

from __future__ import annotations

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from leadloom.llm import kneser_ney, ranked_search, whitening

SCHEMA = "doc_id long, text string, lang string"


def prose(seed: int, n: int, words: int = 60) -> str:
    rng = random.Random(seed)
    return " ".join(f"W{min(rng.randrange(words), rng.randrange(words))}é" for _ in range(n))


ODD = [
    (1, None, None),
    (2, "", "en"),
    (3, " \t\n", "en"),
    (4, "!!! 123", "en"),
    (5, prose(1, 60), "en"),
    (5, prose(1, 60), "en"),
    (6, prose(1, 60), "fr"),
    (7, prose(9, 20_000, 3_000), "en"),
    (None, prose(2, 40), "en"),
    (None, prose(2, 40), "en"),
    (8, "Ünïcödé \U0001f600 wörds \x00 nul\x00x " + prose(3, 30) + " a-b_c", "de"),
    *[(20 + i, prose(50 + i, 15 + i), "en") for i in range(40)],
]
#: Names that the operators use themselves.
CLASHING = ["term", "tf", "n", "score", "rank", "block", "item", "word", "shard", "data", "x", "part", "spread", "terms", "_score"]


@pytest.fixture(scope="module")
def odd(spark):
    df = spark.createDataFrame(ODD, SCHEMA)
    for name in CLASHING:
        df = df.selectExpr("*", f"CAST(7 AS long) AS `{name}`")
    return df


# Whitening


def expected_whitening(rows, k=16):
    """Of plain lists; the commonest length is that of the first row."""
    dim = len(rows[0][1])
    kept = [(i, v) for i, v in rows if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in kept])
    fit = np.unique(x, axis=0)
    n, sums = len(fit), fit.sum(0)
    a = (fit * n - sums) / n
    values, axes = np.linalg.eigh(a.T @ a / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    deviation = [sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for row in x]
    return [i for i, _ in kept], n, deviation, ((x * n - sums) / n) @ axes, values, np.trace(a.T @ a / n)


def check_whitening(spark, rows, width):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x int, n int, component int")
    rows = [r[:2] for r in rows]
    found = whitening.whiten(df).toPandas()
    ids, n, deviation, projected, values, trace = expected_whitening(rows)
    assert len(found) == len(ids) * width
    assert set(found["n"]) == {n} and found["identity_error"].max() < 1e-9
    assert Counter(found[found.component == 1][["vec_id", "deviation"]].itertuples(index=False, name=None)) == Counter(zip(ids, deviation))
    for c in range(1, width + 1):
        part = found[found.component == c].sort_values(["vec_id", "whitened"])
        assert part["explained"].iloc[0] == pytest.approx(values[c - 1] / trace, rel=1e-9)
        for sign in (1, -1):
            want = sorted(zip(ids, sign * projected[:, c - 1] / math.sqrt(values[c - 1])))
            if np.allclose(part["whitened"], [w for _, w in want], atol=1e-8):
                break
        else:
            raise AssertionError(f"component {c}")


def vectors(n, dim, seed=1):
    rng = np.random.default_rng(seed)
    scale = np.linspace(4, 0.5, dim)
    return [(i, (rng.normal(size=dim) * scale).astype(np.float32).tolist(), 0, 1, 2, 3) for i in range(n)]


def test_whitening_agrees_with_an_eigendecomposition(spark):
    check_whitening(spark, vectors(400, 24), 16)


def test_whitening_of_odd_rows(spark):
    rows = vectors(60, 5)
    hot = rows[0][1]
    odd = [None, [], [1.0, 2.0, None, 3.0, 4.0], [1.0, 2.0, float("nan"), 3.0, 4.0], [float("inf")] * 5, [1.0, 2.0]]
    rows += [(100 + i, v, 0, 1, 2, 3) for i, v in enumerate(odd)]
    rows += [(200, hot, 0, 1, 2, 3)] * 300 + [(None, hot, 0, 1, 2, 3)] * 2
    check_whitening_with_null_ids(spark, rows)


def check_whitening_with_null_ids(spark, rows):
    """Ids that sort: -1 for those that are null."""
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, x int, n int, component int")
    assert whitening.whiten(df).where("vec_id IS NULL").count() == 2 * 5
    check_whitening(spark, [(-1 if r[0] is None else r[0], *r[1:]) for r in rows], 5)


def test_directions_without_spread_have_no_component(spark):
    """The third entry repeats the first, the fourth never changes."""
    rng = np.random.default_rng(3)
    rows = [(i, [a, b, a, 1.5], 0, 1, 2, 3) for i, (a, b) in enumerate(rng.normal(size=(80, 2)).astype(np.float32).tolist())]
    check_whitening(spark, rows, 2)


def test_whitening_of_equal_vectors_and_none(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<float>")
    assert whitening.whiten(df).count() == 0
    assert whitening.whiten(df.limit(0)).count() == 0
    assert whitening.whiten(df.limit(0)).columns[:4] == ["vec_id", "component", "n", "deviation"]
    assert whitening.whiten(spark.createDataFrame([(1, None)], "vec_id long, embedding array<float>")).count() == 0


def test_triangular_solve_and_shifted_factor():
    rng = np.random.default_rng(0)
    r = np.triu(rng.normal(size=(6, 6))) + 4 * np.eye(6)
    rows = rng.normal(size=(9, 6))
    assert np.allclose(whitening.triangular_solve(rows, r) @ r, rows)
    singular = np.ones((6, 6))
    factor = whitening._factor(singular, 100, shifted=False)
    assert np.isfinite(factor).all() and np.allclose(factor.T @ factor, singular, atol=1e-6)


# Ranked search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms_of(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def expected_search(docs, items, top=50):
    words = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, length = len(words), sum(w.total() for _, w in words)
    df = Counter(t for _, w in words for t in w)
    rows = []
    for item, text in items:
        scores = []
        for doc, w in words:
            m = 100 - 50 + (50 * w.total() * n_docs) // length
            s = 0
            for t in set(terms_of(text)):
                if w[t]:
                    weight = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    s += weight * ((1_000_000_000 * w[t]) // (1000 * w[t] + 20 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        rows += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scores, key=lambda x: x[:3])[:top], 1)]
    return Counter(rows)


ITEMS = [
    (1, "w1é w2é, W3É w3é w1é"),
    (1, "w1é w2é, W3É w3é w1é"),
    (2, "w1é w2é w40é unknown"),
    (3, None),
    (4, "... "),
    (5, "nothing known"),
    (None, "nul 123 a b c wörds"),
    (6, prose(9, 20_000, 3_000)),
]


@pytest.mark.parametrize("block_bytes", [1 << 20, 40])
def test_search_agrees_with_plain_python(spark, odd, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string").selectExpr("*", "1 AS terms", "2 AS bytes", "3 AS spread")
    found = ranked_search.search(odd, items, top=7, block_bytes=block_bytes).collect()
    assert Counter(map(tuple, found)) == expected_search([r[:2] for r in ODD], ITEMS, 7)


def test_search_of_empty_tables(spark, odd):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert ranked_search.search(odd.limit(0), items).count() == 0
    assert ranked_search.search(odd, items.limit(0)).count() == 0
    assert ranked_search.search(odd, items.where("item_id IN (3, 4)")).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plans_form_each_shared_sum_once(seed):
    rng = random.Random(seed)
    core = rng.sample(range(40), 8)
    items = [sorted({*rng.sample(range(40), rng.randrange(1, 9)), *(core[: rng.randrange(9)])}) for _ in range(30)] + [[], [3]]
    plan = ranked_search.sharing_plan(items, 40)
    assert len(set(plan.sums)) == len(plan.sums)
    assert all(a < 40 + k and b < 40 + k for k, (a, b) in enumerate(plan.sums))
    rows = {t: np.array([1 << t, t], np.int64) for t in range(40) if t != 5}
    found = ranked_search.accumulate(plan, dict(rows))
    for item, values in zip(items, found):
        want = sum((rows[t] for t in item if t in rows), np.zeros(2, np.int64))
        assert (np.zeros(2) if values is None else values).tolist() == want.tolist()
    assert len(plan.sums) < sum(max(0, len(i) - 1) for i in items)


def test_equal_items_share_their_whole_sum():
    plan = ranked_search.sharing_plan([[1, 2, 3], [3, 2, 1], [1, 2]], 4)
    assert plan.items[0] == plan.items[1] and len(plan.sums) == 2


# Language model


def held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def tokens_of(text):
    return [*re.sub("[A-Z]", lambda m: m[0].lower(), text or "").encode().split(), "end"]


def tokens(text):
    """ASCII white space only: bytes split at exactly these six characters."""
    return tokens_of(text)


class PlainModel:
    def __init__(self, texts):
        self.words, self.pairs = Counter(), Counter()
        for text in texts:
            row = tokens(text)
            self.words.update(row)
            self.pairs.update(zip(["begin", *row], row))
        self.n, self.v = self.words.total(), len(self.words)
        self.follows, self.total, self.by = Counter(), Counter(), defaultdict(Counter)
        for (h, w), c in self.pairs.items():
            self.follows[w] += 1
            self.total[h] += c
            self.by[h][min(c, 3)] += 1
        self.d = self.estimate(self.pairs)
        self.low = self.estimate(self.follows)

    @staticmethod
    def estimate(counts):
        t = Counter(counts.values())
        y = t[1] / (t[1] + 2 * t[2]) if t[1] else 0
        result = {0: 0.0}
        for k in (1, 2, 3):
            d = k - (k + 1) * y * t[k + 1] / t[k] if t[k] else 0
            result[k] = d if 0 < d <= k else k / 2
        return result

    def word(self, w):
        if not self.pairs:
            return 1.0
        a, all_ = self.follows[w], len(self.pairs)
        left = sum(self.low[min(c, 3)] for c in self.follows.values()) / all_
        return (a - self.low[min(a, 3)]) / all_ + left / (self.v + 1)

    def probability(self, h, w):
        if not self.total[h]:
            return self.word(w)
        c = self.pairs[h, w]
        left = sum(self.d[k] * n for k, n in self.by[h].items()) / self.total[h]
        return (c - self.d[min(c, 3)]) / self.total[h] + left * self.word(w)


@pytest.fixture(scope="module")
def small_files():
    """Files of few words and tokens, so that there are several of each kind."""
    old = kneser_ney.FILE_WORDS, kneser_ney.SHARD_TOKENS
    kneser_ney.FILE_WORDS, kneser_ney.SHARD_TOKENS = 700, 4_000
    yield
    kneser_ney.FILE_WORDS, kneser_ney.SHARD_TOKENS = old


def test_scores_agree_with_plain_python(spark, odd, small_files):
    files = kneser_ney.train(odd)
    assert files.n_shards > 2 and len(files.vocabulary) > 3 and len(files.statistics) > 2
    plain = PlainModel([t for i, t, _ in ODD if i is not None and not held_out(i)])
    assert files.tokens == plain.n and files.words == plain.v and files.bigrams == len(plain.pairs)
    want = []
    for i, text, _ in ODD:
        row = tokens(text)
        base = sum(math.log10((plain.words[w] + 1) / (plain.n + plain.v + 1)) for w in row)
        score = sum(math.log10(plain.probability(h, w)) for h, w in zip(["begin", *row], row))
        known = sum(plain.words[w] > 0 for w in row)
        want.append((i, held_out(i), len(row), known, plain.n, round(base, 5), round(score, 5)))
    found = [(*r[:5], round(r.base_score, 5), round(r.score, 5)) for r in kneser_ney.score(odd, files).collect()]
    assert Counter(found) == Counter(want)


def test_probabilities_add_up_to_one():
    texts = [prose(i, 80) for i in range(30)]
    plain = PlainModel(texts)
    for h in ["begin", b"w1\xc3\xa9", b"w50\xc3\xa9", "never seen"]:
        total = sum(plain.probability(h, w) for w in plain.words) + plain.probability(h, "unknown")
        assert total == pytest.approx(1)


def test_nothing_to_learn_and_nothing_to_score(spark, odd):
    rows = odd.where("doc_id IS NULL")
    found = kneser_ney.score(rows, kneser_ney.train(rows)).collect()
    assert len(found) == 2 and {(r.score, r.base_score, r.n_known, r.train_tokens) for r in found} == {(0.0, 0.0, 0, 0)}
    assert kneser_ney.score(odd.limit(0), kneser_ney.train(odd.limit(0))).count() == 0


def test_held_out_texts_are_less_perplexing_than_to_unigrams(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    scored = kneser_ney.score(docs, kneser_ney.train(docs)).where("held_out").cache()
    base = scored.selectExpr("base_score AS score", "n_tokens")
    assert kneser_ney.perplexity(scored) < 0.5 * kneser_ney.perplexity(base)


def test_large_counts_have_a_place_of_their_own():
    pairs = np.arange(10, dtype=np.uint64) * np.uint64(1 << 33)
    counts = np.array([1, 254, 255, 256, 3, 10**9, 1, 1, 1, 255])
    known, lookup = kneser_ney._bigram_file(np.frombuffer(kneser_ney._bigram_bytes(pairs, counts) + b"\n", np.uint8))
    assert known.tolist() == pairs.tolist() and lookup(np.arange(10)).tolist() == counts.tolist()
    back = kneser_ney._unpacked(kneser_ney._packed(pairs, counts), 1)
    assert back[0].tolist() == pairs.tolist() and back[1].tolist() == counts.tolist()
