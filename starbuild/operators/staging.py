"""Intermediate tables in the folder all executors share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

_FOLDER_SETTING = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """Folder for this application's intermediate tables.

    Taken from ``spark.checkpoint.dir`` (or the context's checkpoint folder).  Only a
    local session may fall back to a temporary folder of its own machine.
    """
    base = spark.conf.get(_FOLDER_SETTING, None)
    if not base:
        base = spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {_FOLDER_SETTING} to a folder that every executor can reach")
        spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="starbuild-"))
        base = spark.sparkContext.getCheckpointDir()
    return f"{base.rstrip('/')}/starbuild/{spark.conf.get('spark.app.id')}"


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


# of the present thread: warehouses built side by side do not see each other's tables
_scopes: ContextVar[tuple[list[str], ...]] = ContextVar("staged_tables", default=())


def stage(df: DataFrame, label: str, codec: str | None = None) -> DataFrame:
    """Write ``df`` once and continue from the files; ``codec`` overrides the session's compression.

    Later steps see one fixed result, whatever is recomputed after a lost executor.
    """
    spark = df.sparkSession
    path = new_path(spark, label)
    for paths in _scopes.get():
        paths.append(path)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def _delete(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def staged_tables(spark: SparkSession) -> Iterator[None]:
    """Delete, on leaving, the tables staged inside; what was computed from them must be written by then."""
    paths: list[str] = []
    token = _scopes.set((*_scopes.get(), paths))
    try:
        yield
    finally:
        _scopes.reset(token)
        for path in paths:
            _delete(spark, path)


def discard_staged(spark: SparkSession) -> None:
    """Delete everything this application staged."""
    _delete(spark, shared_folder(spark))
