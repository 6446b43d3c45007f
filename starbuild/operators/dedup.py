"""One row per key."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def any_null(keys: Sequence[str]) -> Column:
    """Whether a row lacks one of the key columns."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


#: What tells rows that lack a key apart in :func:`keep_latest`: empty for rows with all keys.
APART = "__apart"


def _ordering(order_by: Sequence[str | Column]) -> list[Column]:
    return [F.col(o).desc_nulls_last() if isinstance(o, str) else o for o in order_by]


def _split_null_keys(df: DataFrame, keys: Sequence[str], null_keys: str) -> tuple[DataFrame, DataFrame | None]:
    if null_keys not in ("keep", "drop", "group"):
        raise ValueError(f"unknown null_keys mode: {null_keys}")
    if null_keys == "group":
        return df, None
    missing = any_null(keys)
    return df.where(~missing), df.where(missing) if null_keys == "keep" else None


def keep_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str | Column],
    tie_breakers: Sequence[str | Column] | None = None,
    null_keys: str = "keep",
    row_id: Sequence[str] | None = None,
    with_apart: bool = False,
) -> DataFrame:
    """The row ranked first per key (names sort descending, NULLs last).

    Without explicit ``tie_breakers`` a hash of the whole row decides, so the choice
    among rows with equal order values is the same on every run.  Rows with a NULL key
    are not duplicates of each other: they all pass (``"keep"``), all go (``"drop"``)
    or count as one key (``"group"``).

    ``row_id`` names columns that tell any two rows apart and stay the same when a task is
    repeated, such as a row's file and place in it (``Lake.read_bronze(row_ids=True)``).  With
    it, rows with a NULL key go through the window too, each by itself, and the input is read
    once; without it they are read apart.  A row's place does not decide ties.  ``with_apart``
    leaves the column that does this (``APART``) in the result: a join on the keys and it finds
    the rows where the window put them, without another shuffle.

    The filter on the row number sits directly on the window, which lets Spark cut each
    map partition to one row per key before the shuffle; a key holding a third of the
    table sends one row per task.
    """
    if tie_breakers is None:
        tie_breakers = [F.xxhash64(*[F.col(c) for c in df.columns if c not in (row_id or ())])]
    groups: list[Column] = [F.col(k) for k in keys]
    if null_keys == "keep" and row_id:
        place = F.to_json(F.struct(*[F.col(c) for c in row_id]))
        keyed, loose = df.withColumn(APART, F.when(any_null(keys), place).otherwise("")), None
        groups.append(F.col(APART))
    else:
        keyed, loose = _split_null_keys(df, keys, null_keys)
    window = Window.partitionBy(*groups).orderBy(*_ordering(order_by), *_ordering(tie_breakers))
    latest = keyed.withColumn("__rank", F.row_number().over(window)).where(F.col("__rank") == 1).drop("__rank")
    if not with_apart:
        latest = latest.drop(APART)
    return latest if loose is None else latest.unionByName(loose)


def keep_latest_by_aggregate(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    tie_breakers: Sequence[str] | None = None,
    null_keys: str = "keep",
) -> DataFrame:
    """:func:`keep_latest` as a ``max_by`` aggregate (descending order columns only)."""
    keyed, loose = _split_null_keys(df, keys, null_keys)
    if tie_breakers is None:
        ties = [F.xxhash64(*[F.col(c) for c in df.columns])]
    else:
        ties = [F.col(t) for t in tie_breakers]
    rank = F.struct(*[F.col(o) for o in order_by], *[t.alias(f"__tie{i}") for i, t in enumerate(ties)])
    payload = F.struct(*[F.col(c) for c in df.columns])
    latest = keyed.groupBy(*keys).agg(F.max_by(payload, rank).alias("__row")).select("__row.*")
    return latest if loose is None else latest.unionByName(loose)


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "input") -> DataFrame:
    """Pass ``df`` through; the query fails when two rows share a (non-NULL) key.

    Shares the key partitioning with a following join on the same keys, and keeps at
    most two rows per key and task in the shuffle.
    """
    window = Window.partitionBy(*keys).orderBy(*keys)
    missing = any_null(keys)
    message = f"{what}: more than one row for a value of {', '.join(keys)}"
    repeated = F.col("__copy") > 1
    checked = (
        df.where(~missing)
        .withColumn("__copy", F.row_number().over(window))
        .where(F.col("__copy") <= 2)
        .where(F.when(repeated, F.raise_error(F.lit(message)).cast("boolean")).otherwise(F.lit(True)))
        .drop("__copy")
    )
    return checked.unionByName(df.where(missing))
