"""Source files with a declared schema, and the lineage columns of a batch."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions.dates import as_timestamp

LINEAGE = ("_source_file", "_ingested_at", "_batch_id")
_FILE = "__file"


def batch_id_of(moment: dt.datetime) -> str:
    return moment.strftime("%Y%m%d_%H%M%S")


def require_columns(present: list[str], schema: T.StructType, path: str) -> None:
    missing = [f.name for f in schema if f.name not in present]
    if missing:
        raise ValueError(f"{path}: columns missing from source: {missing}")


def _typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Bind by name; text that does not parse as the declared type becomes NULL."""
    return df.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], _FILE)


def _file_path() -> Column:
    return F.col("_metadata.file_path").alias(_FILE)


def read_untyped_csv(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.option("header", True).option("inferSchema", False).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """CSV bound to the declared schema by header name.

    Spark binds a CSV schema by position, so the header is read first and the files are
    then read with exactly its columns; a file whose header differs fails the query
    instead of shifting values into the wrong column.
    """
    header = read_untyped_csv(spark, path).columns
    require_columns(header, schema, path)
    strings = T.StructType([T.StructField(name, T.StringType()) for name in header])
    raw = spark.read.option("header", True).option("enforceSchema", False).schema(strings).csv(path)
    return _typed(raw.select("*", _file_path()), schema)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """JSON lines with the declared schema."""
    return spark.read.schema(schema).json(path).select("*", _file_path())


def read_parquet(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Parquet projected and cast to the declared schema."""
    raw = spark.read.parquet(path)
    require_columns(raw.columns, schema, path)
    return _typed(raw.select("*", _file_path()), schema)


_READERS = {"csv": read_csv, "json": read_json, "parquet": read_parquet}


def read_source(
    spark: SparkSession, path: str, schema: T.StructType, file_format: str = "csv", keep_file: bool = False
) -> DataFrame:
    """Read one feed; an unknown format is an error at once."""
    if file_format not in _READERS:
        raise ValueError(f"unsupported file format: {file_format}")
    df = _READERS[file_format](spark, path, schema)
    return df if keep_file else df.drop(_FILE)


def with_lineage(df: DataFrame, batch_id: str, ingested_at, source: str | None = None) -> DataFrame:
    """Add source file, ingest time and batch id; one time for the whole batch."""
    origin = F.lit(source) if source is not None else F.col(_FILE)
    return df.withColumns(
        {"_source_file": origin, "_ingested_at": as_timestamp(ingested_at), "_batch_id": F.lit(batch_id)}
    ).drop(_FILE)


def ingest(
    spark: SparkSession, path: str, schema: T.StructType, batch_id: str, ingested_at, file_format: str = "csv"
) -> DataFrame:
    """Source rows in the declared types plus lineage columns."""
    return with_lineage(read_source(spark, path, schema, file_format, keep_file=True), batch_id, ingested_at)
