"""Grouped sums that are kept up to date from the rows that left and came, instead of being added up again.

Counts and sums take the rows that left off and the rows that came on.  A smallest or largest
value cannot be taken back: only groups that lost a row at such an edge are looked up again.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.operators.staging import stage

#: Column of changed rows: 1 for a row that came, -1 for one that left.
SIGN = "_sign"
#: Rows of a group; one without rows is none.
ROWS = "rows"


@dataclass(frozen=True)
class Sums:
    """What is added up per group of ``keys``.

    ``added`` names SQL expressions that are whole or decimal numbers and never NULL.  Of each of the
    ``edges``, too, the smallest and largest value are held as ``<name>_min`` and ``<name>_max``.  ``reads``
    are the columns of a row that all of this takes.
    """

    keys: tuple[str, ...]
    reads: tuple[str, ...]
    added: Mapping[str, str]
    edges: Mapping[str, str] = field(default_factory=dict)

    def _edges(self) -> list[Column]:
        low = [F.min(F.expr(e)).alias(f"{name}_min") for name, e in self.edges.items()]
        return [*low, *[F.max(F.expr(e)).alias(f"{name}_max") for name, e in self.edges.items()]]

    def of(self, rows: DataFrame) -> DataFrame:
        """The sums of all ``rows``."""
        added = [F.sum(F.expr(e)).alias(name) for name, e in self.added.items()]
        return rows.groupBy(*self.keys).agg(F.count(F.lit(1)).alias(ROWS), *added, *self._edges())

    def combined(self, sums: DataFrame) -> DataFrame:
        """Sums whose keys were replaced, with equal keys put together again."""
        kinds = {f.name: f.dataType for f in sums.schema}
        added = [F.sum(c).cast(kinds[c]).alias(c) for c in (ROWS, *self.added)]
        low = [F.min(f"{c}_min").alias(f"{c}_min") for c in self.edges]
        return sums.groupBy(*self.keys).agg(*added, *low, *[F.max(f"{c}_max").alias(f"{c}_max") for c in self.edges])

    def kept_up(self, stored: DataFrame, changes: DataFrame, rows: DataFrame) -> DataFrame:
        """``stored`` after ``changes`` (rows with a ``_sign``); ``rows`` are those that the groups have now.

        ``stored`` and ``rows`` may be limited to partitions that hold all groups of the changes.
        Rows are read only if a group lost its smallest or largest value, and then of such groups.
        """
        came = F.col(SIGN) > 0

        def moved(c: Column) -> Column:
            return F.sum(F.when(came, c).otherwise(-c))

        moves = [moved(F.lit(1).cast("long")).alias(ROWS), *[moved(F.expr(e)).alias(name) for name, e in self.added.items()]]
        for name, e in self.edges.items():
            for side, at in (("came", came), ("left", ~came)):
                value = F.when(at, F.expr(e))
                moves += [F.min(value).alias(f"__{name}_{side}_min"), F.max(value).alias(f"__{name}_{side}_max")]
        delta = changes.groupBy(*self.keys).agg(*moves)
        same = [F.col(f"s.{k}").eqNullSafe(F.col(f"d.{k}")) for k in self.keys]
        joined = stored.alias("s").join(delta.alias("d"), same, "full")
        kinds = {f.name: f.dataType for f in stored.schema}
        keys = [F.coalesce(f"s.{k}", f"d.{k}").alias(k) for k in self.keys]
        added = [
            (F.coalesce(f"s.{c}", F.lit(0)) + F.coalesce(f"d.{c}", F.lit(0))).cast(kinds[c]).alias(c)
            for c in (ROWS, *self.added)
        ]
        if not self.edges:
            return joined.select(*keys, *added).where(F.col(ROWS) > 0)
        at_edge = F.lit(False)
        for c in self.edges:
            for reached in (F.col(f"__{c}_left_min") <= F.col(f"s.{c}_min"), F.col(f"__{c}_left_max") >= F.col(f"s.{c}_max")):
                at_edge = at_edge | F.coalesce(reached, F.lit(False))
        least = [F.least(f"s.{c}_min", f"__{c}_came_min").alias(f"{c}_min") for c in self.edges]
        most = [F.greatest(f"s.{c}_max", f"__{c}_came_max").alias(f"{c}_max") for c in self.edges]
        updated = stage(joined.select(*keys, *added, *least, *most, at_edge.alias("__again")).where(F.col(ROWS) > 0), "kept-up")
        settled, lost = updated.where("NOT __again").drop("__again"), updated.where("__again").drop("__again")
        if lost.isEmpty():
            return settled
        groups = lost.select(*[F.col(k).alias(f"__{k}") for k in self.keys])
        theirs = rows.select(*self.reads).join(groups, [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in self.keys], "left_semi")
        edges = theirs.groupBy(*self.keys).agg(*self._edges())
        names = [f"{c}_{side}" for side in ("min", "max") for c in self.edges]
        known = lost.drop(*names).alias("l").join(edges.alias("e"), [F.col(f"l.{k}").eqNullSafe(F.col(f"e.{k}")) for k in self.keys], "left")
        again = known.select("l.*", *[F.col(f"e.{n}") for n in names])
        return settled.unionByName(again.select(*settled.columns))
