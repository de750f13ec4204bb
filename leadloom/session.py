"""Session settings and the staging of intermediate results."""

from __future__ import annotations

import math
import os
import socket
import time
import uuid
import warnings
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession


def local_session(cpus: int | str = "*", app_name: str = "leadloom") -> SparkSession:
    """A session for tests and the bench. A cluster job brings its own session."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", "8" if cpus == "*" else str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        # Split a skewed join even where that costs one more exchange above it.
        .config("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
        .getOrCreate()
    )


def scale_settings(shuffle_bytes: int, cores: int) -> dict[str, str]:
    """Session options for a large run, from the size of its largest shuffle.

    About 256 MB per shuffle partition and at least two partitions per core. Adaptive
    execution joins small partitions again and splits those of a frequent join key, but it
    never makes more partitions than this, so the number must fit the data.
    """
    partitions = max(2 * cores, math.ceil(shuffle_bytes / (256 * 1024 * 1024)))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128MB",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    }


_staged: dict[str, list[str | DataFrame]] = {}  # application id -> what stage() has written or kept


def staging_folder(spark: SparkSession) -> str:
    """The folder for intermediate files: ``spark.checkpoint.dir``, else one in the warehouse.

    Both are shared by all executors of a cluster. A folder without a scheme belongs to the
    default file system, as for any path in Spark. Unless all executors run on the driver's machine by
    the way the application is deployed, a folder on a local disk is refused, as they could not read each
    other's files; ``leadloom.staging.sharedMount`` says that it is a mount they share.
    """
    folder = _named_folder(spark)
    shared = spark.conf.get("leadloom.staging.sharedMount", "false") == "true"
    if not shared and _scheme(spark, folder) == "file" and not on_one_machine(spark.conf.get("spark.master")):
        raise ValueError(f"{folder} is on a local disk: set spark.checkpoint.dir to a folder that all executors share")
    return folder.rstrip("/")


def _named_folder(spark: SparkSession) -> str:
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or f"{spark.conf.get('spark.sql.warehouse.dir')}/leadloom-staging"


def on_one_machine(master: str) -> bool:
    """Whether this master runs all executors beside the driver: ``local`` and ``local-cluster`` do."""
    return master == "local" or master.startswith(("local[", "local-cluster["))


def _scheme(spark: SparkSession, folder: str) -> str:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).getUri().getScheme()


def stage(df: DataFrame, **options: str) -> DataFrame:
    """Run ``df`` once and return its stored rows, for a result that is read several times.

    The rows go to Parquet files in ``staging_folder``, written with ``options``. So they outlive lost executors, each
    later read takes only its columns, and the planner knows their size. Where there is no folder that all
    executors share, or it cannot be made, each executor keeps its rows on its own disk, in Spark's block store; those
    of a lost executor are computed again. This is an action; ``clear_staged``, or the end of a ``staging`` block,
    removes the rows once the results built on them have been written.
    """
    spark = df.sparkSession
    if not has_folder(spark):
        return _kept(df)
    path = new_folder(spark)
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _kept(df: DataFrame) -> DataFrame:
    """The rows of ``df`` on the disks of the executors, as a table of its own.

    Its plan begins with the rows, as that of files does. The plan of a cached table holds the one it was made
    by, and so on: results staged one upon the other, each read a few times, would make plans that fill the driver.
    """
    spark = df.sparkSession
    rows = spark._jsparkSession.internalCreateDataFrame(df._jdf.queryExecution().toRdd(), df._jdf.schema(), False)
    kept = DataFrame(rows, spark).persist(StorageLevel.DISK_ONLY)
    kept.count()
    _staged.setdefault(spark.sparkContext.applicationId, []).append(kept)
    return kept


def has_folder(spark: SparkSession) -> bool:
    """Whether ``staging_folder`` names a folder, and it is there or can be made."""
    try:
        path = spark._jvm.org.apache.hadoop.fs.Path(staging_folder(spark))
        made = path.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(path)
    except (ValueError, Py4JJavaError) as error:
        warnings.warn(f"staged rows stay with the executors: {str(error).strip().splitlines()[0]}", stacklevel=3)
        return False
    if not made:
        warnings.warn(f"staged rows stay with the executors: {path.toString()} cannot be made", stacklevel=3)
    return made


def new_folder(spark: SparkSession, proven: bool = False) -> str:
    """A fresh path in ``staging_folder`` that ``clear_staged`` will remove.

    With ``proven``, a folder that is refused is taken all the same if the executors that are up prove to share it. That
    says nothing about later ones, so it is for files that must be files, by callers that check that all they wrote is there.
    """
    try:
        folder = staging_folder(spark)
    except ValueError:
        folder = _named_folder(spark).rstrip("/")
        if not (proven and _all_share(spark, folder)):
            raise
        warnings.warn(f"{folder} is on a local disk, but all executors share it", stacklevel=2)
    path = f"{folder}/leadloom-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def _all_share(spark: SparkSession, folder: str) -> bool:
    """Whether each executor that is up sees a mark of the driver's in this folder of a local disk, and the driver one of each executor's."""
    Path = spark._jvm.org.apache.hadoop.fs.Path
    mark = Path(f"{folder}/leadloom-seen-{uuid.uuid4().hex}")
    system = mark.getFileSystem(spark._jsc.hadoopConfiguration())
    seen_at = mark.toUri().getPath()

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _ in batches:
            time.sleep(0.2)  # so that the tasks spread over all executors
            name = f"{socket.gethostname()}-{os.getcwd().replace('/', '_')}"  # executors have folders of their own
            there = os.path.isdir(seen_at)
            if there:
                open(f"{seen_at}/{name}", "w").close()
            yield pa.RecordBatch.from_pydict({"name": [name], "there": [there]})

    try:
        if not system.mkdirs(mark):
            return False
        executors = max(1, len(spark.sparkContext._jsc.sc().statusTracker().getExecutorInfos()) - 1)
        tasks, names = 4 * max(executors, spark.sparkContext.defaultParallelism), set()
        for _ in range(5):
            found = spark.range(0, tasks, 1, tasks).mapInArrow(look, "name string, there boolean").collect()
            if not all(r["there"] and system.exists(Path(mark, r["name"])) for r in found):
                return False
            names |= {r["name"] for r in found}
            if len(names) >= executors:
                return True
        return False
    except Py4JJavaError:
        return False
    finally:
        system.delete(mark, True)


@contextmanager
def staging(spark: SparkSession) -> Iterator[None]:
    """Owns what is staged inside the block: its files are removed at the end, also after an error.

    Write the results that are built on staged rows within the block. What was staged before it stays.
    """
    folders = _staged.setdefault(spark.sparkContext.applicationId, [])
    before = len(folders)
    try:
        yield
    finally:
        own = folders[before:]
        del folders[before:]
        _remove(spark, own)


def clear_staged(spark: SparkSession) -> int:
    """Remove all rows that ``stage`` has stored in this application; returns the number of results.

    DataFrames built on staged rows can no longer be read then.
    """
    folders = _staged.pop(spark.sparkContext.applicationId, [])
    _remove(spark, folders)
    return len(folders)


def _remove(spark: SparkSession, staged: list[str | DataFrame]) -> None:
    for folder in staged:
        if isinstance(folder, DataFrame):
            folder.unpersist()
            continue
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
