"""Registration of queries, access to the tables, and small helpers shared by the query modules."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
OPERATORS: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder as DataFrames: ``tables.orders``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self._built: dict[str, DataFrame] = {}

    def once(self, name: str, build: Callable[["Tables"], DataFrame]) -> DataFrame:
        """A derived table, planned once per query however often it is used."""
        if name not in self._built:
            self._built[name] = build(self)
        return self._built[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.once(name, lambda t: t.spark.read.parquet(f"{t.folder}/{name}.parquet"))


def query(name: str, operators: str, sql: str | None = None):
    """Register ``function(tables) -> DataFrame``; ``operators`` lists the inventory rows it covers."""

    def register(function: Callable[[Tables], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query registered twice: {name}")
        QUERIES[name] = lambda spark, folder: plain(function(Tables(spark, folder)))
        OPERATORS[name] = operators
        if sql is not None:
            ORACLE[name] = sql
        return function

    return register


def plain(df: DataFrame) -> DataFrame:
    """Result columns in types every SQL client reads alike.

    Decimals become doubles, dates and times text, arrays joined text, small integers bigint.
    """

    def simple(f: T.StructField):
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            c = c.cast("string")
        elif isinstance(f.dataType, T.ArrayType):
            c = F.array_join(c, "; ")
        elif isinstance(f.dataType, (T.ByteType, T.ShortType, T.IntegerType)):
            c = c.cast("bigint")
        return c.alias(f.name)

    return df.select(*[simple(f) for f in df.schema])


# -- common table expressions for the SQL side -------------------------------

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def cte(name: str, body: str, *needs: str) -> None:
    """Name a piece of SQL; ``needs`` are the pieces it refers to."""
    _CTES[name] = (needs, body)


def with_ctes(body: str, *needs: str) -> str:
    """``body`` preceded by the pieces it needs, each once and in order."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for inner in _CTES[name][0]:
            visit(inner)
        ordered.append(name)

    for name in needs:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS (\n{_CTES[n][1]}\n)" for n in ordered) + "\n" + body
