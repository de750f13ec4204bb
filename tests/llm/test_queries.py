"""The registered queries against DuckDB, and the pipeline against its parts."""

from __future__ import annotations

import corpus_pipeline
import pytest
from compare import connect, duck_rows, spark_rows
from leadloom import llm

NAMES = sorted(llm.queries())


@pytest.mark.parametrize("name", sorted(llm.oracle_sql()))
def test_query_agrees_with_sql(spark, medium, name):
    assert spark_rows(llm.queries()[name](spark, medium)) == duck_rows(connect(medium), llm.oracle_sql()[name])


@pytest.mark.parametrize("name", sorted(set(NAMES) - set(llm.oracle_sql())))
def test_query_reads_all_documents(spark, small, name):
    rows = llm.queries()[name](spark, small)
    if name not in ("op6_substring_dedup", "op11_embedding_whitening"):
        assert rows.count() == spark.read.parquet(f"{small}/documents.parquet").count()


def test_there_is_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in NAMES) == list(range(1, 14))


@pytest.mark.parametrize("name", ["op5_exact_dedup", "op9_license_scan"])
def test_native_queries_run_no_python(spark, small, name):
    plan = llm.queries()[name](spark, small)._jdf.queryExecution().toString()
    assert not any(word in plan for word in ("Python", "Arrow", "Pandas"))


def test_the_pipeline_keeps_what_each_stage_keeps(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    kept = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = corpus_pipeline.new_folder(spark)
        stage(spark, docs, medium).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.exceptAll(docs).isEmpty(), name
        kept.append(after.count())
        docs = after
    assert kept[0] >= kept[1] > kept[2] > kept[3] == kept[4]
    tokens = corpus_pipeline.run(spark, medium)
    assert tokens.count() == kept[4]
    # The token files follow the order of the mix.
    path = corpus_pipeline.new_folder(spark)
    corpus_pipeline.mix_sources(spark, docs, medium).write.parquet(path)
    mixed = [r["doc_id"] for r in corpus_pipeline.mixing.mix_sources(docs, corpus_pipeline.mixing.TARGET_WEIGHTS).orderBy("_position").collect()]
    assert [r["doc_id"] for r in tokens.orderBy("start").collect()] == mixed


def test_the_pipeline_takes_odd_rows(spark, small, tmp_path):
    """Nulls in any column, repeated rows and ids, empty and long texts, and the operators' own names as columns."""
    prose = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").orderBy("doc_id").limit(40).collect()]
    rows = [(i, t, "en" if i % 2 else None, "s" if i % 3 else None, 1) for i, t in enumerate(prose)]
    rows += [(0, prose[0], "en", "s", 1), (1, " ".join(prose[2:20]) * 3, "en", None, None), (None, prose[3] + " x", None, "s", 1)]
    rows += [(90, None, "en", "s", 0), (91, "", None, None, None), (92, "!!", "en", "s", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    clashing = ["_position", "_row", "_block", "_score", "_lang_pred", "_kept_id", "_id", "_found_id", "_spans", "_text_bytes", "term", "key", "part", "file", "place", "doc", "in"]
    docs = docs.selectExpr("*", *[f"'{i}' AS {c}" for i, c in enumerate(clashing)])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        path = str(tmp_path / name)
        stage(spark, docs, small).write.parquet(path)
        after = spark.read.parquet(path)
        assert after.columns == docs.columns and after.exceptAll(docs).isEmpty(), name
        assert after.select(*clashing).distinct().count() == 1
        docs = after
    kept = {(r["doc_id"], r["text"]) for r in docs.collect()}
    assert docs.count() == len(kept) and not {90, 91, 92} & {i for i, _ in kept}
    tokens = corpus_pipeline.write_tokens(spark, docs, small).collect()
    assert sorted(str(r["doc_id"]) for r in tokens) == sorted(str(i) for i, _ in kept)
