"""Target layouts, audit columns, renames and validity gates."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions.dates import as_timestamp

ERRORS_TYPE = "array<string>"


def to_layout(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Select and cast to ``schema`` by name; a column the input lacks is an error.

    A number that does not fit its decimal is NULL, so one odd row does not stop the table.
    """
    missing = [f.name for f in schema if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns missing from input: {missing}")

    def fitted(f: T.StructField):
        c = F.col(f.name)
        return (c.try_cast(f.dataType) if isinstance(f.dataType, T.DecimalType) else c.cast(f.dataType)).alias(f.name)

    return df.select(*[fitted(f) for f in schema])


def with_audit(df: DataFrame, at, updated: bool = True, created: bool = True) -> DataFrame:
    """Add created_at / updated_at holding the one run time ``at``."""
    stamp = F.current_timestamp() if at is None else as_timestamp(at)
    names = [n for n, wanted in (("created_at", created), ("updated_at", updated)) if wanted]
    return df.withColumns({n: stamp for n in names})


def copy_columns(df: DataFrame, copies: Mapping[str, str]) -> DataFrame:
    """Add ``new: old`` copies of existing columns."""
    return df.withColumns({new: F.col(old) for new, old in copies.items()})


def assume_valid(df: DataFrame) -> DataFrame:
    """Mark every row valid without rules."""
    return df.withColumns({"is_valid": F.lit(True), "validation_errors": F.array().cast(ERRORS_TYPE)})


def valid_rows(df: DataFrame, columns: Sequence[str | Column] = ()) -> DataFrame:
    """Rows flagged valid (NULL is not valid), optionally projected: a staging view."""
    kept = df.where(F.col("is_valid"))
    return kept.select(*columns) if columns else kept


def current_rows(df: DataFrame, columns: Sequence[str | Column] = ()) -> DataFrame:
    """Current versions of a versioned dimension."""
    kept = df.where(F.col("is_current"))
    return kept.select(*columns) if columns else kept
