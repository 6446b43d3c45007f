"""Incremental loads: high-water mark, recent window, upsert."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions.dates import as_date
from starbuild.operators.dedup import assert_unique

_BEGINNING = "0001-01-01 00:00:00"


def recent_rows(df: DataFrame, column: str, as_of, days: int = 1) -> DataFrame:
    """Rows whose timestamp lies on or after ``as_of`` minus ``days`` days."""
    return df.where(is_recent(column, as_of, days))


def is_recent(column: str, as_of, days: int = 1) -> Column:
    return F.col(column) >= F.date_sub(as_date(as_of), days)


def newer_rows(source: DataFrame, updated: str, target: DataFrame, loaded: str) -> DataFrame:
    """Source rows updated after the newest load of the target; all rows if it is empty.

    The mark is a scalar subquery, so the comparison reaches the source scan.
    """
    return source.where(F.col(updated) > high_water_mark(target, loaded, source.schema[updated].dataType))


def high_water_mark(target: DataFrame, loaded: str, kind: T.DataType) -> Column:
    """The newest load of ``target`` as a scalar subquery; the beginning of time if it is empty."""
    return target.agg(F.coalesce(F.max(loaded).cast(kind), F.lit(_BEGINNING).cast(kind)).alias("m")).scalar()


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str], check_unique: bool = True) -> DataFrame:
    """``target`` with rows of equal key replaced by ``updates`` and new keys added.

    Fails when the updates hold a key twice.  Columns only one side has are NULL-filled.
    """
    kept = target.join(updates.select(*keys), list(keys), "left_anti")
    if check_unique:
        updates = assert_unique(updates, keys, "updates")
    return kept.select(*target.columns).unionByName(updates, allowMissingColumns=True)


def upsert_partitions(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], partition: Sequence[str]
) -> DataFrame:
    """New content of only those partitions that the updates touch.

    For keys that never move between partitions.  Written with dynamic partition
    overwrite, the untouched part of the table is neither read nor rewritten: the
    distinct partition values of the updates prune the target scan.
    """
    touched = updates.select(*partition).distinct()
    affected = target.join(touched, list(partition), "left_semi")
    return upsert(affected, updates, [*keys, *partition])
