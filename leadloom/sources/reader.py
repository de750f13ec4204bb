"""Reading and storing entities in their declared shape, and writing results."""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import DATE_COLUMNS, ID_TYPE, SCHEMAS


def _types(entity: str, id_type: str) -> dict[str, str]:
    return {c: id_type if t == ID_TYPE else t for c, t in SCHEMAS[entity].items()}


def read_entity(spark: SparkSession, entity: str, path: str, id_type: str = ID_TYPE) -> DataFrame:
    """Parquet files of one entity, with its declared schema."""
    types = _types(entity, id_type)
    return spark.read.schema(", ".join(f"{c} {t}" for c, t in types.items())).parquet(path)


def conform(
    df: DataFrame, entity: str, columns: Mapping[str, str] | None = None, id_type: str = ID_TYPE
) -> DataFrame:
    """Select and cast the declared columns of an entity from any DataFrame that has them.

    ``columns`` names the source column of a declared one where the two differ. Ids may be
    of any one type, say ``string``, in all entities alike.
    """
    source = columns or {}
    unknown = set(source) - set(SCHEMAS[entity])
    if unknown:
        raise ValueError(f"{entity} has no columns {sorted(unknown)}")
    return df.select(*[F.col(source.get(c, c)).cast(t).alias(c) for c, t in _types(entity, id_type).items()])


def write_entity(df: DataFrame, entity: str, path: str, id_type: str = ID_TYPE) -> None:
    """Store an entity in its declared shape, sorted by its date.

    The date filters of the reports then skip whole files and row groups. The id is part
    of the sort, so a date with very many rows still goes to several files.
    """
    rows = conform(df, entity, id_type=id_type)
    if entity in DATE_COLUMNS:
        order = [DATE_COLUMNS[entity], "id"]
        rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """Replace the stored result of a report, once the new one is complete.

    The rows are written to a folder beside ``path`` first. Only then the old result is moved aside, the new one
    takes its place, and the old one is removed; should the move fail, the old one is put back. A
    job that fails midway leaves the old result as it was and removes what it has written. ``report`` may
    read the old result. Between the two moves, for a moment, there is no folder at ``path``.
    """
    spark = report.sparkSession
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    system = target.getFileSystem(spark._jsc.hadoopConfiguration())
    mark = uuid.uuid4().hex
    fresh, old = (spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}{end}-{mark}") for end in (".new", ".old"))
    try:
        report.write.parquet(fresh.toString())
        replaced = system.exists(target)
        if replaced:
            _move(system, target, old)
        try:
            _move(system, fresh, target)
        except Exception:
            if replaced:
                _move(system, old, target)
            raise
    except Exception:
        system.delete(fresh, True)
        raise
    if replaced:
        system.delete(old, True)


def _move(system, source, target) -> None:
    if not system.rename(source, target):
        raise OSError(f"{source.toString()} cannot be moved to {target.toString()}")
