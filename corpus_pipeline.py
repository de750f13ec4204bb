"""From raw documents to token files: five stages, each written as Parquet (or kept by the executors) and read again by the next."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leadloom.llm import decontaminate, language_id, mixing, simhash, token_shards
from leadloom.session import stage


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which a language can be told.

    Null and empty texts and texts without a letter go. Long texts are parsed whole; repeated rows and rows without an
    id are judged like any other; all columns stay; an empty table gives no rows.
    """
    return language_id.drop_unidentified(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links: the lowest id, nulls last, ties by a hash of the text.

    Rows that share an id are told apart by their texts; of repeated rows one stays; all columns stay; an empty
    table gives no rows.
    """
    return simhash.drop_near_copies(docs, shingle_words=3, max_bits=2)


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item.

    Items without a word are in no document; rows that share an id are told apart by their texts; all columns stay;
    where either table is empty everything stays.
    """
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, written in the order in which the target weights interleave their sources.

    A null source is one like any other; repeated rows have places of their own; all columns stay; an empty table
    gives no rows.
    """
    return mixing.in_mixed_order(docs, mixing.TARGET_WEIGHTS)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the files before: part by part, row by row.

    Rows that are in no files, as executors share no folder, are in the order of their partitions. Null texts are empty and have their end only; every row is encoded, repeated ones and those without an id too;
    columns but id and text are not read; an empty table writes no file and gives no rows.
    """
    try:
        placed = docs.select(
            "doc_id",
            "text",
            F.regexp_extract("_metadata.file_name", r"^part-(\d+)", 1).cast("long").alias("part"),
            F.col("_metadata.file_name").alias("file"),
            F.col("_metadata.row_index").alias("place"),
        )
    except AnalysisException:
        placed = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("place"))
    return token_shards.token_table(placed, order=[c for c in placed.columns if c not in ("doc_id", "text")])


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", decontaminate_benchmark),
    ("source_mixing", mix_sources),
    ("token_files", write_tokens),
]

#: A fitted classifier, SimHash and tokens are beyond SQL; tests hold the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``: one row per kept document, read from its token file.

    An empty table of documents gives no rows.
    """
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, step in STAGES:
        docs = stage(step(spark, docs, sf_dir))
    return docs
