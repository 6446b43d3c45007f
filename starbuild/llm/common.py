"""Small helpers that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.operators.staging import stage

__all__ = ["stage", "ascii_lower", "packed", "text_or_empty", "null_safe_key", "shuffle_partitions"]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(c: Column) -> Column:
    """Lower-case A to Z and nothing else; all-ASCII text takes the faster built-in."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(F.translate(c, _UPPER, _LOWER))


def text_or_empty(name: str) -> Column:
    return F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))


def packed(df: DataFrame, *more: Column) -> DataFrame:
    """All columns of ``df`` in one struct ``row``, so that no working column can clash with them."""
    return df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row"), *more)


def null_safe_key(*columns: Column) -> Column:
    """One text key for several columns; NULL is a value of its own, different from the empty text."""
    return F.to_json(F.struct(*[c.cast("string").alias(f"k{i}") for i, c in enumerate(columns)]))


def shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
