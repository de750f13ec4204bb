"""Cases that the operators once settled only in part."""

from __future__ import annotations

import hashlib
import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

import __spark_entry__
from leadloom import session
from leadloom.llm import exact_dedup, kneser_ney, language_id, mixing, simhash, token_shards, toxicity, word_store


def prose(seed: int, n: int, words: int = 400) -> str:
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(words)}x" for _ in range(n))


def test_a_frequent_digest_in_one_block_is_found(spark):
    """The hot rows come first and fill whole partitions; all later rows differ."""
    digests = spark.range(0, 30_000, 1, 6).selectExpr(
        "id AS doc_id",
        "unhex(sha2(CASE WHEN id < 10000 THEN 'hot' ELSE CAST(id AS string) END, 256)) AS digest",
        "id AS row",
    )
    (found,) = exact_dedup.frequent_digests(digests, 0.001).collect()
    assert bytes(found["digest"]) == hashlib.sha256(b"hot").digest()
    assert found["group_size"] == 10_000 and found["keeper"]["id"] == 0


def test_no_task_collects_a_group_of_equal_texts(spark):
    """Groups below the share of frequent texts are counted and joined, without a window over them."""
    rows = [(None if i % 50 == 0 else 999 - i, f"text {i % 7 if i < 300 else i}") for i in range(1_000)]
    found = exact_dedup.exact_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), share=0.5)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "partial_min" in plan
    groups: dict[str, list] = {}
    for id, text in rows:
        groups.setdefault(hashlib.sha256(text.encode()).hexdigest(), []).append(id)
    got: dict[str, list] = {}
    for r in found.collect():
        got.setdefault(r["text_sha256"], []).append(r)
    assert got.keys() == groups.keys()
    for digest, ids in groups.items():
        least = min((x for x in ids if x is not None), default=None)
        assert sorted(str(r["doc_id"]) for r in got[digest]) == sorted(map(str, ids))
        assert {(r["keep_id"], r["group_size"]) for r in got[digest]} == {(least, len(ids))}
        assert [r["doc_id"] for r in got[digest] if r["kept"]] == [least]


def test_documents_with_a_common_passage_all_teach(spark):
    """One shared passage makes no family; near copies weigh as one document together."""
    passage = " ".join(f"shared{i}" for i in range(12))
    rows = [(i, f"{passage} {prose(i, 60)} {'wretchedness' if i % 3 == 0 else ''}") for i in range(600)]
    copies = [(1_000 + i, f"{prose(5_000, 300)} rareword copy{i}") for i in range(300)]
    docs = spark.createDataFrame(rows + copies, "doc_id long, text string")
    labels = [(i, int(i % 3 == 0)) for i, _ in rows] + [(i, 1) for i, _ in copies]
    marks = spark.createDataFrame(labels, "doc_id long, toxic int")
    lexicon = toxicity.learn_lexicon(docs, marks)
    assert lexicon.terms == ["wretchedness"], lexicon.terms
    known = toxicity.training_labels(marks)
    weights = toxicity._family_weights(docs.selectExpr("doc_id AS doc", "text"), known).collect()
    of = {r["id"]: r["weight"] for r in weights}
    assert len(of) == known.count() and all(of[i] == 1 for i, _ in rows if i in of)
    assert sum(of[i] for i, _ in copies if i in of) < 30


def test_all_labelled_languages_are_learned(spark):
    rows = [(100 * j + i, prose(j, 30).replace("w", f"l{j}q"), f"x{j:02}") for j in range(70) for i in range(4)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert model.languages == [f"x{j:02}" for j in range(70)]


def test_tables_grow_with_the_sample_and_not_with_its_letters():
    """Samples in many scripts have many byte classes; a language takes two slots of 8 bytes for each of its transitions."""
    rng = random.Random(3)
    samples = {}
    for j, first in enumerate((0x61, 0x3B1, 0x430, 0x5D0, 0x627, 0x905, 0xE01, 0x10D0, 0x3041, 0xAC00)):
        words = ["".join(chr(first + rng.randrange(24)) for _ in range(rng.randrange(2, 9))) for _ in range(300)]
        samples[f"x{j}"] = " ".join(rng.choices(words, k=6_000)).encode()[: language_id.SAMPLE_BYTES]
    model = language_id.model_of(samples)
    for language, (table, first) in zip(model.languages, model.tables):
        sample = model.classes[list(samples[language])].tobytes()
        transitions = sum(map(len, language_id.suffix_automaton(sample)))
        assert table.nbytes <= 16 * transitions + 64 * model.width and transitions <= 3 * len(sample)
        assert len(first) == model.width


def test_texts_in_a_script_without_sample_stay(spark):
    latin = [(i, prose(i, 60) + " Эт", "en") for i in range(40)]
    other = [(100, "Это чистый текст на другом языке", None), (101, "これは別の言語の文章です", None), (102, "123 !!!", None)]
    docs = spark.createDataFrame([*latin, *other], "doc_id long, text string, lang string")
    kept = {r["doc_id"] for r in language_id.drop_unidentified(docs).collect()}
    assert kept == {i for i, _, _ in latin} | {100, 101}


def test_the_mix_starts_no_python_workers(spark):
    """The table of phases is a local relation; rows of Python objects would pass through workers beside those of the operators."""
    docs = spark.range(90).selectExpr("id AS doc_id", "substr('abc', 1 + id % 3, 1) AS source")
    mixed = mixing.mix_sources(docs, {"a": 2}, block_docs=4)
    plan = mixed._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation" in plan and "RDD" not in plan
    assert mixed.count() == 90 and mixing.mix_sources(docs.limit(0)).isEmpty()


def test_kept_texts_go_to_the_language_task_once(spark):
    rows = [(1, prose(1, 40), "en"), (2, None, None), (3, "", "en"), (4, "\u00e9t\u00e9 \u042d\u0442", None), (5, "12", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.model_of({"en": prose(2, 400).encode(), "xx": prose(3, 400).replace("w", "q").encode()})
    kept = language_id.identify(docs, model, keep=True)
    assert "as binary" not in kept._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(tuple(r)[:3] for r in kept.collect()) == rows
    plain = {r["doc_id"]: tuple(r)[1:] for r in language_id.identify(docs, model).collect()}
    assert {r["doc_id"]: tuple(r)[3:] for r in kept.collect()} == plain
    letters = docs.selectExpr("doc_id", "lang", "text AS body")
    again = language_id.identify(letters, model, text_col="BODY", keep=True)
    assert {r["doc_id"]: tuple(r)[3:] for r in again.collect()} == plain


def test_encoding_takes_memory_by_the_slice():
    """Many different words, three times a slice and more, encoded as a task does it."""
    texts = [" ".join(f"{k:x}" + "abcdefgh"[i % 8] * 3 for k in range(i * 4_000, (i + 1) * 4_000)) for i in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(120), pa.int64()), pa.array(texts)], ["id", "text"])
    with open(token_shards._default_tokenizer(), encoding="utf-8") as file:
        encoder = token_shards.WordEncoder(file.read())
    tracemalloc.start()
    most, rows = 0, 0
    for piece in token_shards._slices(batch):
        tracemalloc.reset_peak()
        before = tracemalloc.get_traced_memory()[0]
        rows += len(encoder(piece.column(1))[1])
        most = max(most, tracemalloc.get_traced_memory()[1] - before)
    tracemalloc.stop()
    assert rows == 120
    assert most < 100 << 20


def test_words_are_hashed_in_blocks():
    data = np.frombuffer(bytes(random.Random(4).randbytes(6 << 20)), np.uint8)
    bounds = np.unique(np.array([0, *random.Random(5).sample(range(len(data)), 300_000), len(data)]))
    bounds = np.sort(np.concatenate([bounds, bounds[::1000]]))  # some words are empty
    tracemalloc.start()
    hashes = word_store.flat_hashes(data, bounds)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 4 * len(data) and np.array_equal(hashes, word_store._hashes_of(data, bounds))
    assert len(word_store.flat_hashes(data[:0], np.zeros(1, np.int64))) == 0


def test_ranges_follow_the_texts_and_not_their_compressed_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_shards, "RANGE_BYTES", 20_000)
    spark.range(60).selectExpr("id AS doc_id", "repeat('la ', 2000) AS text").coalesce(1).write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    got = token_shards.token_table(docs, f"{tmp_path}/tokens").collect()
    assert len({r["doc_id"] for r in got}) == len(got) == 60
    assert len(list((tmp_path / "tokens").glob("part=*"))) >= 12


WITHOUT_FOLDER = ["op2_toxicity", "op3_token_files", "op6_substring_dedup", "op8_source_mixing", "op12_ranked_search", "pipeline"]


@pytest.mark.parametrize("name", WITHOUT_FOLDER)
def test_the_same_rows_without_a_shared_folder(spark, small, monkeypatch, name):
    """Where executors share no folder, they keep what else is in files."""
    query = __spark_entry__.queries()[name]
    with session.staging(spark):
        expected = sorted(map(repr, query(spark, small).collect()))
    monkeypatch.setattr(session, "on_one_machine", lambda master: False)
    with pytest.warns(UserWarning, match="stay with the executors"), session.staging(spark):
        assert sorted(map(repr, query(spark, small).collect())) == expected and expected


def test_no_table_of_a_row_per_document_is_broadcast(spark, small):
    """Such tables grow with the corpus, and stored they look many times smaller than they are in a broadcast."""
    docs = spark.read.parquet(f"{small}/documents.parquet")
    with session.staging(spark):
        for found in (simhash.drop_near_copies(docs), simhash.simhash_components(docs)):
            plan = found._jdf.queryExecution().executedPlan().toString()
            assert "SortMergeJoin" in plan and "Broadcast" not in plan


def test_a_refused_folder_is_taken_for_a_model_if_all_share_it(spark, small, monkeypatch, tmp_path):
    """The model's files are mapped by the workers, which takes a folder that all executors see."""
    query = __spark_entry__.queries()["op13_language_model"]
    with session.staging(spark):
        expected = sorted(map(repr, query(spark, small).collect()))
    monkeypatch.setattr(session, "on_one_machine", lambda master: False)
    monkeypatch.setattr(session, "_named_folder", lambda _: f"file://{tmp_path}/named")
    with pytest.warns(UserWarning, match="all executors share it"), session.staging(spark):
        assert sorted(map(repr, query(spark, small).collect())) == expected and expected
    assert list((tmp_path / "named").iterdir()) == []
    (tmp_path / "file").touch()
    monkeypatch.setattr(session, "_named_folder", lambda _: f"file://{tmp_path}/file/below")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        query(spark, small)


def test_files_of_a_model_that_are_not_there_are_missed(spark, monkeypatch, tmp_path):
    """An executor that has written to a disk of its own must not make the model smaller."""
    listed = kneser_ney._listed
    monkeypatch.setattr(kneser_ney, "_listed", lambda spark, path: listed(spark, path)[1:])
    rows = spark.createDataFrame([(1, bytearray(b"a")), (2, bytearray(b"b"))], "part long, data binary")
    with pytest.raises(OSError, match="2 files were written"):
        kneser_ney._write(rows, f"file://{tmp_path}/out", ["part"])
