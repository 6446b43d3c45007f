"""Surrogate integer keys, numbered in parallel."""

from __future__ import annotations

from collections.abc import Sequence
from typing import Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.operators.staging import stage

# monotonically_increasing_id puts the partition in the bits above the row position
_POSITION_BITS = 33


class Numbering(Protocol):
    """Something that remembers which natural key has which integer key."""

    def fill(self, df: DataFrame, natural_key: Sequence[str]) -> DataFrame: ...


def number_rows(df: DataFrame, key: str, order_by: Sequence[str], first: int = 1) -> DataFrame:
    """Number all rows in ``order_by`` order, from ``first`` on, in the column ``key`` (replaced).

    ``order_by`` must be unique.  Rows are range-partitioned and sorted, and each takes its
    position inside its partition.  The driver reads one row count per partition, as
    ``zipWithIndex`` does, and turns them into offsets.  The sorted rows are written before
    they are counted: counting and numbering then look at the same partitions, also when a
    lost executor forces a recomputation.
    """
    placed = stage(
        df.drop(key)
        .repartitionByRange(*order_by)
        .sortWithinPartitions(*order_by)
        .withColumn("__pos", F.monotonically_increasing_id()),
        f"keys-{key}",
    )
    chunk = F.shiftright("__pos", _POSITION_BITS)
    per_partition = placed.groupBy(chunk.alias("chunk")).agg(F.count("*").alias("n")).orderBy("chunk").collect()
    first_keys = [0] * (per_partition[-1].chunk + 1 if per_partition else 1)
    for p in per_partition:
        first_keys[p.chunk] = first
        first += p.n
    # a constant rather than a join: the planner then knows the size of the numbered table
    firsts = F.split(F.lit(",".join(map(str, first_keys))), ",").cast("array<bigint>")
    position = F.col("__pos") - F.shiftleft(chunk, _POSITION_BITS)
    numbered = placed.withColumn(key, F.get(firsts, chunk.cast("int")) + position)
    return numbered.select(*df.columns if key in df.columns else [key, *df.columns])


def fill_keys(df: DataFrame, key: str, order_by: Sequence[str], highest: int | None = None) -> DataFrame:
    """Number the rows whose ``key`` is NULL, in ``order_by`` order, after the highest key in use.

    ``order_by`` must be unique among those rows; ``highest`` is the highest key in use, by
    default that of ``df``.  Only the rows to number are sorted and staged.
    """
    typed = df.withColumn(key, F.col(key).cast("bigint"))
    if highest is None:
        highest = typed.agg(F.max(key)).first()[0] or 0
    fresh = stage(typed.where(F.col(key).isNull()), f"new-{key}")
    return typed.where(F.col(key).isNotNull()).unionByName(number_rows(fresh, key, order_by, highest + 1))


def assign_keys(
    df: DataFrame, natural_key: Sequence[str], key: str, existing: DataFrame | Numbering | None = None
) -> DataFrame:
    """Give every row an integer key; natural keys already in ``existing`` keep theirs.

    New natural keys are numbered in natural-key order after the highest existing key.
    The key becomes the first column.
    """
    columns = [c for c in df.columns if c != key]
    if existing is None:
        return number_rows(df.select(F.lit(None).cast("bigint").alias(key), *columns), key, natural_key)
    if not isinstance(existing, DataFrame):
        return existing.fill(df.select(F.lit(None).cast("bigint").alias(key), *columns), natural_key)
    known = existing.select(*natural_key, F.col(key).cast("bigint").alias(key))
    keyed = df.select(*columns).join(known, list(natural_key), "left").select(key, *columns)
    highest = existing.agg(F.max(key).cast("bigint").alias("top")).first().top
    return fill_keys(keyed, key, natural_key, highest or 0)
