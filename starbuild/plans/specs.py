"""What a layer runner has to know about one entity."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from starbuild.operators.validate import Rule


@dataclass(frozen=True)
class EntitySpec:
    """Tables, keys, layouts and silver rules of one source entity.

    ``cleanse`` derives columns, ``rules`` are built when a session exists.
    """

    name: str
    keys: tuple[str, ...]
    source: T.StructType
    silver: T.StructType
    cleanse: Callable[[DataFrame], DataFrame]
    rules: Callable[[], Sequence[Rule]]
    gold_table: str
    #: Column whose values part the stored silver table; none: it is one partition.
    partition: tuple[str, ...] = ()

    @property
    def bronze_table(self) -> str:
        return f"raw_{self.name}"

    @property
    def silver_table(self) -> str:
        return f"stg_{self.name}"


TEXT, INT, FLAG, DAY = T.StringType(), T.IntegerType(), T.BooleanType(), T.DateType()
SCORE, POINTS, MONEY, RATIO = T.DecimalType(5, 2), T.DecimalType(3, 2), T.DecimalType(15, 2), T.DecimalType(9, 2)
VALIDITY = (("is_valid", FLAG), ("validation_errors", T.ArrayType(TEXT)))


def fields(*groups: tuple[str, T.DataType]) -> T.StructType:
    """Schema from groups of equally typed columns: ``("first_name last_name", TEXT)``."""
    return T.StructType([T.StructField(name, kind) for names, kind in groups for name in names.split()])
