"""Natural key to surrogate key, point-in-time lookups, unresolved keys."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from starbuild.functions.dates import as_date, date_key


def _pairs(on: str | Mapping[str, str]) -> dict[str, str]:
    return {on: on} if isinstance(on, str) else dict(on)


def _and(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def lookup_key(
    df: DataFrame,
    dim: DataFrame | None,
    on: str | Mapping[str, str],
    key: str,
    as_name: str | None = None,
    key_type: str = "bigint",
) -> DataFrame:
    """Left-join one dimension column on its natural key (``on``: row column -> dim column).

    Only the key columns of the dimension take part, so Spark broadcasts it when their
    size is under its threshold and otherwise shuffles, splitting hot partitions of
    ``df`` at run time.  Without a dimension the key is NULL.
    """
    as_name = as_name or key
    if dim is None:
        return df.withColumn(as_name, F.lit(None).cast(key_type))
    pairs = _pairs(on)
    natural = [f"__nk{i}" for i in range(len(pairs))]
    side = dim.select(
        *[F.col(d).alias(n) for d, n in zip(pairs.values(), natural)], F.col(key).alias("__key")
    )
    same = _and([F.col(f) == F.col(n) for f, n in zip(pairs, natural)])
    joined = df.drop(as_name).join(side, same, "left")
    return joined.drop(*natural).withColumnRenamed("__key", as_name)


def heavy_values(df: DataFrame, column: str, share: float) -> DataFrame:
    """Values of ``column`` held by more than ``share`` of the rows: at most 1/share of them."""
    if not 0 < share < 1:
        raise ValueError("share must lie between 0 and 1")
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))
    total = df.agg(F.count(F.lit(1)).alias("n")).scalar()
    return counts.where(F.col(column).isNotNull() & (F.col("rows") > total * F.lit(share)))


def lookup_key_skewed(
    df: DataFrame,
    dim: DataFrame,
    on: str | Mapping[str, str],
    key: str,
    as_name: str | None = None,
    share: float = 0.01,
    spread: int | None = None,
) -> DataFrame:
    """:func:`lookup_key` against a large dimension when a few values fill ``df``.

    Values above ``share`` of the rows number at most 1/share; their dimension rows are
    broadcast.  Their rows, whether the dimension knows the value or not, and rows without
    a key then spread over all partitions of the shuffled join instead of meeting in one.
    """
    spread = spread or max(1024, 4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ((column, natural),) = _pairs(on).items()
    as_name = as_name or key
    side = dim.select(F.col(natural).alias("__nk"), F.col(key).alias("__key"))
    heavy = heavy_values(df, column, share).select(F.col(column).alias("__nk"))
    matched = side.join(F.broadcast(heavy), "__nk")
    heavy_side = heavy.join(F.broadcast(matched), "__nk", "left").select(
        F.col("__nk").alias("__hot"), F.col("__key").alias("__hot_key")
    )
    others = [F.col(c) for c in df.columns if c != column] or [F.col(column)]
    settled = F.col("__hot").isNotNull() | F.col(column).isNull()
    slot = F.when(settled, F.pmod(F.xxhash64(*others), F.lit(spread))).otherwise(F.lit(0).cast("bigint"))
    marked = df.drop(as_name).join(F.broadcast(heavy_side), F.col(column) == F.col("__hot"), "left").withColumn(
        "__slot", slot
    )
    # always 0, but not as a literal: Spark would fold that and partition the join by the key alone
    cold = side.withColumn("__zero", F.pmod(F.xxhash64("__nk"), F.lit(1)))
    joined = marked.join(cold, (F.col(column) == F.col("__nk")) & (F.col("__slot") == F.col("__zero")), "left")
    return joined.withColumn(as_name, F.coalesce("__hot_key", "__key")).drop(
        "__hot", "__hot_key", "__slot", "__nk", "__key", "__zero"
    )


def lookup_date_key(
    df: DataFrame, column: str, as_name: str, calendar: DataFrame | None = None, first=None, last=None
) -> DataFrame:
    """Date key of a date column in one of its roles.

    With a ``calendar`` table this is a join on full_date.  With the calendar's ``first``
    and ``last`` day the key is computed in place, without a join; dates outside are NULL.
    """
    if calendar is not None:
        return lookup_key(df, calendar, {column: "full_date"}, "date_key", as_name, "int")
    if first is None or last is None:
        raise ValueError("give either a calendar or its first and last day")
    inside = F.col(column).between(as_date(first), as_date(last))
    return df.withColumn(as_name, F.when(inside, date_key(F.col(column))))


def lookup_as_of(
    df: DataFrame,
    dim: DataFrame,
    on: str | Mapping[str, str],
    date: str,
    key: str,
    as_name: str | None = None,
    start: str = "effective_start_date",
    end: str = "effective_end_date",
) -> DataFrame:
    """Key of the version that was in force on each row's own date (start <= date < end).

    Versions of a key do not overlap, so every row finds at most one.
    """
    as_name = as_name or key
    pairs = _pairs(on)
    natural = [f"__nk{i}" for i in range(len(pairs))]
    side = dim.select(
        *[F.col(d).alias(n) for d, n in zip(pairs.values(), natural)],
        F.col(key).alias("__key"),
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
    )
    in_force = (F.col("__from") <= F.col(date)) & (F.col("__to").isNull() | (F.col(date) < F.col("__to")))
    same = _and([F.col(f) == F.col(n) for f, n in zip(pairs, natural)])
    joined = df.drop(as_name).join(side, same & in_force, "left")
    return joined.drop(*natural, "__from", "__to").withColumnRenamed("__key", as_name)


def resolved(df: DataFrame, keys: Sequence[str], seen: Observation | None = None) -> DataFrame:
    """Rows whose required keys were all found; ``seen`` takes the counts of :func:`unresolved_metrics` on the way."""
    if seen is not None:
        df = df.observe(seen, *unresolved_metrics(keys))
    return df.where(_and([F.col(k).isNotNull() for k in keys]))


def unresolved_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row: how many rows lack each key, and how many lack any; a single pass."""
    return df.agg(*unresolved_metrics(keys))


def unresolved_metrics(keys: Sequence[str]) -> list[Column]:
    """The same counts as expressions for ``DataFrame.observe`` while the table is written."""
    any_missing = ~_and([F.col(k).isNotNull() for k in keys])
    return [
        F.count(F.lit(1)).alias("total_rows"),
        *[F.count_if(F.col(k).isNull()).alias(f"missing_{k}") for k in keys],
        F.count_if(any_missing).alias("dropped_rows"),
    ]


def orphans(df: DataFrame, column: str, dim: DataFrame, key: str) -> DataFrame:
    """Rows whose non-NULL key has no match in the dimension."""
    side = dim.select(F.col(key).alias("__key"))
    return df.where(F.col(column).isNotNull()).join(side, F.col(column) == F.col("__key"), "left_anti")
