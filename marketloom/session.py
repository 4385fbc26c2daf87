"""Session settings the operators rely on."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Runtime settings, safe to put on a session somebody else made.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot join key is worth splitting even if the output has to be shuffled once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
}

# Settings a context only takes at its start: checkpoints go when nothing refers to them any more.
START_CONF = {"spark.cleaner.referenceTracking.cleanCheckpoints": "true"}


def build_session(app: str = "marketloom", master: str | None = None, **conf: str) -> SparkSession:
    """A session with the runtime settings; cluster sizes stay with spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **START_CONF, **conf}.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())


def prepare(spark: SparkSession) -> SparkSession:
    """Put the runtime settings on an existing session."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The cluster's checkpoint folder; where none is named, a folder in the warehouse, which is shared too."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    return folder or spark.conf.get("spark.sql.warehouse.dir") + "/_stored"


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The folder for checkpoints that model fits write."""
    context = spark.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(spark))
    return context.getCheckpointDir()


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def brief_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of queries built and run in here go when they end, not when the driver happens to collect garbage."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


@contextmanager
def single_rows(spark: SparkSession) -> Iterator[None]:
    """Rows of queries run in here reach Python one at a time, for rows that are large."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "1")
    try:
        yield
    finally:
        spark.conf.set(name, before)


_STORED: list[str] = []


def new_folder(spark: SparkSession) -> str:
    """A path in the shared folder that nothing uses yet; ``drop_stored`` deletes what lies there."""
    path = f"{shared_folder(spark)}/stored/{uuid.uuid4().hex}"
    _STORED.append(path)
    return path


def stored(df: DataFrame, folder: str | None = None) -> DataFrame:
    """The rows, written once as Parquet to the shared folder and read from there.

    For intermediate results that several branches of a plan read: a branch then scans the small stored
    rows, and of those the columns and rows it needs, instead of recomputing them from the sales, also after
    an executor is lost. ``drop_stored`` removes the files. ``folder`` is one from ``new_folder``, for rows that go earlier
    (``drop_folders``).
    """
    spark = df.sparkSession
    path = folder or new_folder(spark)
    with brief_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def for_iterations(df: DataFrame, rows_per_task: int = 50_000) -> DataFrame:
    """Stored rows in tasks of at least about that many, for fits that run hundreds of short jobs over them.

    Such a job takes as long as starting its tasks where rows are few; where there are many, the tasks stay as they are.
    """
    return df.coalesce(max(1, -(-df.count() // rows_per_task)))


def drop_folders(spark: SparkSession, folders: list[str]) -> None:
    """Delete folders from ``new_folder`` whose rows are no longer read."""
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(hadoop).delete(path, True)
        if folder in _STORED:
            _STORED.remove(folder)


@contextmanager
def passing(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes in here goes at the end, for steps whose result is stored in a folder named before."""
    before = set(_STORED)
    yield
    drop_folders(spark, [folder for folder in _STORED if folder not in before])


def drop_stored(spark: SparkSession) -> None:
    """Delete what ``stored`` wrote; call it when the results built on it have been read."""
    drop_folders(spark, list(_STORED))
