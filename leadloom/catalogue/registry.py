"""The list of queries."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.provided import ENTITIES, Entities, view_sql

Build = Callable[[Entities], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str


QUERIES: dict[str, Query] = {}


def query(name: str, sql: str) -> Callable[[Build], Build]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def register(build: Build) -> Build:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = Query(build, sql)
        return build

    return register


def double(value: Column | str) -> Column:
    """Exact decimals leave a query as double, the type that both engines share."""
    return (F.col(value) if isinstance(value, str) else value).cast("double")


def as_doubles(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.withColumns({c: double(c) for c in cols})


def quoted(values: list[str]) -> str:
    """A list of SQL text literals."""
    return ", ".join(f"'{v}'" for v in values)


def with_entities(sql: str) -> str:
    """Put the entities that the text reads in front of it."""
    used = [n for n in ENTITIES if re.search(rf"\b(?:from|join)\s+{n}\b", sql, re.IGNORECASE)]
    views = ", ".join(f"{n} AS ({view_sql(n)})" for n in used)
    body = re.sub(r"^with\b", ",", sql.strip(), flags=re.IGNORECASE) if _starts_with_cte(sql) else sql.strip()
    return f"WITH {views} {body}"


def _starts_with_cte(sql: str) -> bool:
    return sql.strip().lower().startswith("with ")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(build: Build) -> Callable[[SparkSession, str], DataFrame]:
        return lambda spark, folder: build(Entities(spark, folder))

    return {name: bind(q.build) for name, q in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return {name: with_entities(q.sql) for name, q in QUERIES.items()}
