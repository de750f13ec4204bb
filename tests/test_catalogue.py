"""Every registered query gives the same columns and rows as its SQL form on DuckDB."""

from __future__ import annotations

import pytest
from compare import connect, duck_rows, spark_rows
from pyspark.sql import functions as F

from leadloom import catalogue
from leadloom.sources import (
    ENTITIES,
    SCHEMAS,
    Entities,
    conform,
    read_entity,
    view_sql,
    reader,
    write_entity,
    write_report,
)


@pytest.fixture(scope="module")
def duck(small):
    return connect(small)


def test_each_query_has_an_oracle():
    assert set(catalogue.queries()) == set(catalogue.oracle_sql())


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_matches_sql(spark, duck, small, name):
    columns, rows = spark_rows(catalogue.queries()[name](spark, small))
    expected_columns, expected_rows = duck_rows(duck, catalogue.oracle_sql()[name])
    assert columns == expected_columns
    assert rows == expected_rows
    assert [type(v) for v in rows[0]] == [type(v) for v in expected_rows[0]]


@pytest.mark.parametrize("name", sorted(ENTITIES))
def test_entity_has_the_declared_types_and_equal_content(spark, duck, small, name):
    df = getattr(Entities(spark, small), name)
    assert dict(df.dtypes) == SCHEMAS[name]
    assert spark_rows(df) == duck_rows(duck, view_sql(name))


def test_stored_entity_round_trip(spark, small, tmp_path):
    path = str(tmp_path / "agent")
    agents = Entities(spark, small).agent
    write_report(agents, path)
    write_report(agents, path)
    stored = read_entity(spark, "agent", path)
    assert spark_rows(stored) == spark_rows(agents)
    write_entity(agents, "agent", path, id_type="string")
    assert read_entity(spark, "agent", path, id_type="string").schema["id"].dataType.simpleString() == "string"


def test_conform_selects_and_casts(spark):
    raw = spark.createDataFrame([("7", "x", 1)], "ID string, Name string, extra int")
    assert conform(raw, "agent").dtypes == [("id", "bigint"), ("name", "string")]
    assert conform(raw, "agent").collect() == [(7, "x")]
    renamed = raw.withColumnRenamed("Name", "Full_Name__c")
    assert conform(renamed, "agent", {"name": "Full_Name__c"}).collect() == [(7, "x")]
    assert conform(raw, "agent", id_type="string").dtypes == [("id", "string"), ("name", "string")]
    with pytest.raises(ValueError):
        conform(raw, "agent", {"nickname": "Name"})


def test_stored_entity_is_sorted_by_date(spark, medium, tmp_path, conf):
    conf({"spark.sql.adaptive.coalescePartitions.enabled": "false"})
    path = str(tmp_path / "mkt_lead")
    leads = Entities(spark, medium).mkt_lead
    write_entity(leads, "mkt_lead", path)
    stored = read_entity(spark, "mkt_lead", path)
    assert spark_rows(stored) == spark_rows(leads)
    files = stored.groupBy(F.input_file_name()).agg(F.min("lead_date").alias("low"), F.max("lead_date").alias("high"))
    spans = sorted((r["low"], r["high"]) for r in files.collect())
    assert len(spans) > 1
    assert all(before[1] <= after[0] for before, after in zip(spans, spans[1:]))


def test_a_report_that_fails_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "report")
    write_report(spark.range(3), path)
    failing = spark.range(0, 100, 1, 4).selectExpr("CASE WHEN id = 77 THEN raise_error('midway') ELSE id END AS id")
    with pytest.raises(Exception, match="midway"):
        write_report(failing, path)
    assert spark.read.parquet(path).count() == 3
    assert [p.name for p in tmp_path.iterdir()] == ["report"]
    # A report may be built on its own last result.
    write_report(spark.read.parquet(path).selectExpr("id + 1 AS id"), path)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == [1, 2, 3]
    assert [p.name for p in tmp_path.iterdir()] == ["report"]


def test_a_move_that_fails_puts_the_old_report_back(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "report")
    write_report(spark.range(3), path)
    move = reader._move

    def once(system, source, target):
        if ".new-" in source.toString():
            raise OSError("no space")
        move(system, source, target)

    monkeypatch.setattr(reader, "_move", once)
    with pytest.raises(OSError, match="no space"):
        write_report(spark.range(5), path)
    assert spark.read.parquet(path).count() == 3 and [p.name for p in tmp_path.iterdir()] == ["report"]
