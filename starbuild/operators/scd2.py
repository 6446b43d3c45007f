"""Type-2 slowly changing dimensions as set operations.

A version carries ``effective_start_date``, ``effective_end_date`` (exclusive, NULL
while open) and ``is_current``.  Nothing is updated in place: a merge returns the whole
next state of the dimension from one join of its current versions with the snapshot.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions.dates import as_date, as_timestamp
from starbuild.operators.dedup import any_null, assert_unique
from starbuild.operators.keys import fill_keys

START, END, CURRENT = "effective_start_date", "effective_end_date", "is_current"


def first_versions(df: DataFrame, as_of, stamp=None) -> DataFrame:
    """Every row becomes an open version starting on ``as_of``."""
    versions = {START: as_date(as_of), END: F.lit(None).cast("date"), CURRENT: F.lit(True)}
    if stamp is not None:
        versions |= {"created_at": as_timestamp(stamp), "updated_at": as_timestamp(stamp)}
    return df.withColumns(versions)


def _differs(left: str, right: str, tracked: Sequence[str]) -> Column:
    """NULL-safe: NULL against a value is a change, NULL against NULL is not."""
    return reduce(
        lambda a, b: a | b,
        [~F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in tracked],
    )


def _keyed(df: DataFrame, natural_key: Sequence[str], name: str) -> DataFrame:
    return df.select(*natural_key, F.struct(*df.columns).alias(name))


def changed_rows(dim: DataFrame, snapshot: DataFrame, natural_key: Sequence[str], tracked: Sequence[str]) -> DataFrame:
    """Snapshot rows whose tracked columns differ from their current version."""
    current = _keyed(dim.where(F.col(CURRENT)).select(*natural_key, *tracked), natural_key, "__old")
    pairs = _keyed(snapshot, natural_key, "__new").join(current, list(natural_key), "inner")
    return pairs.where(_differs("__old", "__new", tracked)).select("__new.*")


def new_rows(dim: DataFrame, snapshot: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Snapshot rows whose natural key has no current version."""
    return snapshot.join(dim.where(F.col(CURRENT)).select(*natural_key), list(natural_key), "left_anti")


def new_and_changed(
    dim: DataFrame, snapshot: DataFrame, natural_key: Sequence[str], tracked: Sequence[str]
) -> DataFrame:
    """:func:`new_rows` and :func:`changed_rows` together, from one join, with a ``change`` column."""
    current = _keyed(dim.where(F.col(CURRENT)).select(*natural_key, *tracked), natural_key, "__old")
    pairs = _keyed(snapshot, natural_key, "__new").join(current, list(natural_key), "left")
    change = F.when(F.col("__old").isNull(), "new").when(_differs("__old", "__new", tracked), "changed")
    return pairs.withColumn("__change", change).where(F.col("__change").isNotNull()).select(
        "__new.*", F.col("__change").alias("change")
    )


def merge_versions(
    dim: DataFrame,
    snapshot: DataFrame,
    natural_key: Sequence[str],
    tracked: Sequence[str],
    as_of,
    stamp=None,
    check_unique: bool = True,
) -> DataFrame:
    """Next state of ``dim`` after taking in ``snapshot`` (one row per natural key) on ``as_of``.

    Closed versions stay as they are.  A current version stays when its key is absent
    from the snapshot or its tracked columns are equal.  A changed one is closed on
    ``as_of`` and followed by a new open version; if it began on ``as_of`` itself it is
    rewritten instead, so a second run on the same day leaves no empty interval.  New
    keys get an open version.  Columns of ``dim`` missing from the snapshot (such as a
    surrogate key) are NULL in new versions.  Snapshot rows without a natural key cannot be
    versioned and are left out.  A snapshot older than a version it would close is an error.
    """
    at = as_date(as_of)
    types = {f.name: f.dataType for f in dim.schema}
    stamps = [c for c in ("created_at", "updated_at") if c in types]
    now = F.current_timestamp() if stamp is None else as_timestamp(stamp)

    def version(values: dict[str, Column]) -> Column:
        return F.struct(*[values[c].cast(types[c]).alias(c) for c in dim.columns])

    kept = {c: F.col(f"__old.{c}") for c in dim.columns}
    fresh = {
        c: F.col(f"__new.{c}") if c in snapshot.columns else F.lit(None) for c in dim.columns
    } | {START: at, END: F.lit(None), CURRENT: F.lit(True)} | {c: now for c in stamps}
    closed = kept | {END: at, CURRENT: F.lit(False)}
    rewritten = kept | {c: fresh[c] for c in snapshot.columns if c in types and c not in stamps}
    if "updated_at" in types:
        closed["updated_at"] = rewritten["updated_at"] = now

    snapshot = snapshot.where(~any_null(natural_key))
    if check_unique:
        snapshot = assert_unique(snapshot, natural_key, "snapshot")
    pairs = _keyed(dim.where(F.col(CURRENT)), natural_key, "__old").join(
        _keyed(snapshot, natural_key, "__new"), list(natural_key), "full"
    )
    began = F.col(f"__old.{START}")
    too_old = F.raise_error(F.lit(f"snapshot of {as_of} is older than a version it would close"))
    versions = (
        F.when(F.col("__new").isNull(), F.array(version(kept)))
        .when(F.col("__old").isNull(), F.array(version(fresh)))
        .when(~_differs("__old", "__new", tracked), F.array(version(kept)))
        .when(began == at, F.array(version(rewritten)))
        .when(began > at, too_old.cast(T.ArrayType(dim.schema)))
        .otherwise(F.array(version(closed), version(fresh)))
    )
    merged = pairs.select(F.inline(versions))
    # a row without the flag is no current version; it stays untouched like a closed one
    return dim.where(~F.coalesce(F.col(CURRENT), F.lit(False))).unionByName(merged)


def merge_versions_with_keys(
    dim: DataFrame,
    snapshot: DataFrame,
    natural_key: Sequence[str],
    tracked: Sequence[str],
    as_of,
    key: str,
    stamp=None,
) -> DataFrame:
    """:func:`merge_versions`, then an integer key for each new version in natural-key order."""
    merged = merge_versions(dim, snapshot, natural_key, tracked, as_of, stamp)
    highest = dim.agg(F.max(key).cast("bigint")).first()[0]  # of one column, not of the merge
    return fill_keys(merged, key, [*natural_key, START], highest or 0)


def timelines(states: DataFrame, natural_key: Sequence[str], tracked: Sequence[str], day: str) -> DataFrame:
    """Versions from dated states: at most one row per natural key and ``day``, in any order.

    A state whose tracked columns equal those of the state before opens no version; a version
    ends where the next one begins.  States without a key or a day are left out.
    """
    dated = states.where(~any_null([*natural_key, day])).withColumn(day, F.col(day).cast("date"))
    over_time = Window.partitionBy(*natural_key).orderBy(day)
    same = [F.col(c).eqNullSafe(F.lag(c).over(over_time)) for c in tracked]
    opens = (F.row_number().over(over_time) == 1) | ~reduce(lambda a, b: a & b, same)
    opened = dated.withColumn("__opens", opens).where(F.col("__opens")).drop("__opens")
    ended = opened.withColumn(END, F.lead(day).over(over_time))
    return ended.withColumnRenamed(day, START).withColumn(CURRENT, F.col(END).isNull())


def merge_states(
    dim: DataFrame,
    states: DataFrame,
    late: DataFrame,
    natural_key: Sequence[str],
    tracked: Sequence[str],
    day: str,
    key: str | None = None,
) -> DataFrame:
    """``dim`` after taking in dated states that may be older than its versions.

    ``states`` are all dated states that ``dim`` was made from, also those that opened no version
    (a late state between two equal ones splits their version); ``late`` the new ones, which win on
    a day that both have.  Only the timelines of the natural keys in ``late`` are rebuilt, so states
    give the same history in whatever order they arrive.  A version that begins on the day on which one
    of its key began before keeps that one's integer ``key``; the others are numbered after the highest.
    """
    touched = late.where(~any_null(natural_key)).select(*natural_key).distinct()
    earlier = states.join(touched, list(natural_key), "left_semi")
    earlier = earlier.join(late.select(*natural_key, day), [*natural_key, day], "left_anti")
    rebuilt = timelines(earlier.unionByName(late.select(*states.columns)), natural_key, tracked, day)
    untouched = dim.join(touched, list(natural_key), "left_anti")
    if key is None:
        return untouched.unionByName(rebuilt.select(*untouched.columns))
    known = dim.select(*natural_key, START, F.col(key).cast("bigint").alias(key))
    keyed = rebuilt.join(known, [*natural_key, START], "left")
    merged = untouched.unionByName(keyed.select(*untouched.columns))
    return fill_keys(merged, key, [*natural_key, START], dim.agg(F.max(key).cast("bigint")).first()[0] or 0)


def as_of_rows(dim: DataFrame, date) -> DataFrame:
    """The versions in force on one date."""
    day = as_date(date)
    return dim.where((F.col(START) <= day) & (F.col(END).isNull() | (day < F.col(END))))


def history(dim: DataFrame, natural_key: str, value=None) -> DataFrame:
    """All versions (of one key, or of all) from oldest to newest."""
    rows = dim if value is None else dim.where(F.col(natural_key) == F.lit(value))
    return rows.orderBy(natural_key, START)


def version_faults(dim: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Keys breaking the invariants: several current versions, or an interval without length."""
    return (
        dim.groupBy(*natural_key)
        .agg(
            F.count_if(F.col(CURRENT)).alias("current_versions"),
            F.count_if(F.col(END) <= F.col(START)).alias("empty_intervals"),
        )
        .where((F.col("current_versions") > 1) | (F.col("empty_intervals") > 0))
    )
