"""Which natural key has which integer key, once and for ever."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from starbuild.operators.keys import number_rows
from starbuild.operators.staging import stage
from starbuild.sources.lake import Lake

_LAYER = "keys"


class KeyRegistry:
    """An append-only table of natural keys and the integer key of each.

    Every run that meets new members adds one segment, and does so before anything with their
    keys is written.  A run may stop at any point after: the members keep their keys, and
    nobody else gets them, whether or not they ever appear in the dimension, leave it or come
    back.  A segment counts once it is complete.  Only members without a key are sorted and
    numbered; keys rise from segment to segment, so the highest is read from the last one.
    """

    def __init__(self, lake: Lake, table: str, key: str):
        self.lake, self.table, self.key = lake, table, key

    def known(self) -> DataFrame | None:
        """All natural keys with their integer key."""
        return self.lake.read_all(_LAYER, self.table) if self.lake.exists(_LAYER, self.table) else None

    def seed(self, members: DataFrame, natural_key: Sequence[str]) -> None:
        """Start with the members of a table that was numbered without a registry."""
        if not self.lake.exists(_LAYER, self.table):
            self.lake.overwrite(members.select(F.col(self.key).cast("bigint"), *natural_key).distinct(), _LAYER, self.table)

    def _highest(self) -> int:
        if not self.lake.exists(_LAYER, self.table):
            return 0
        return self.lake.read(_LAYER, self.table, columns=[self.key]).agg(F.max(self.key)).first()[0] or 0

    def fill(self, df: DataFrame, natural_key: Sequence[str]) -> DataFrame:
        """``df`` in which rows without an integer key have that of their natural key (NULL is a value like others)."""
        lacking = F.col(self.key).isNull()
        known = self.known()
        named = df.where(lacking).select(*natural_key).distinct()
        if known is not None:
            named = named.join(self._as(known), self._same(natural_key), "left_anti")
        fresh = stage(named, f"new-{self.key}")
        if known is None or not fresh.isEmpty():
            self.lake.overwrite(number_rows(fresh, self.key, natural_key, self._highest() + 1), _LAYER, self.table)
        joined = df.where(lacking).join(self._as(self.known()), self._same(natural_key), "left")
        filled = joined.select(*[F.col(f"__known.{self.key}").alias(c) if c == self.key else F.col(c) for c in df.columns])
        return df.where(~lacking).unionByName(filled)

    @staticmethod
    def _as(known: DataFrame) -> DataFrame:
        return known.select(F.struct(*known.columns).alias("__known"))

    @staticmethod
    def _same(natural_key: Sequence[str]):
        return reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__known.{c}")) for c in natural_key])
