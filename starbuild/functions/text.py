"""String cleaning and code standardisation."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def blank_to_null(c: Column) -> Column:
    """Strip surrounding spaces; a value with nothing left becomes NULL."""
    return F.nullif(F.trim(c), F.lit(""))


def clean_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Apply :func:`blank_to_null` to each named column in one projection."""
    return df.withColumns({name: blank_to_null(F.col(name)) for name in columns})


def trim_strings(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Strip surrounding spaces only; empty strings stay empty strings."""
    return df.withColumns({name: F.trim(F.col(name)) for name in columns})


def email_form(c: Column) -> Column:
    return F.lower(F.trim(c))


def phone_form(c: Column) -> Column:
    """Keep digits and plus signs (the pattern is a fixed value)."""
    return F.regexp_replace(c, "[^0-9+]", "")


def normalize_email(df: DataFrame, column: str = "email") -> DataFrame:
    return df.withColumn(column, email_form(F.col(column)))


def clean_phone(df: DataFrame, column: str = "phone") -> DataFrame:
    return df.withColumn(column, phone_form(F.col(column)))


def joined_name(*parts: Column, separator: str = " ") -> Column:
    """Parts with a separator between them; NULL as soon as one part is NULL."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [F.lit(separator), part] if pieces else [part]
    return F.concat(*pieces)


def _accent_table() -> tuple[str, str]:
    """(accented, plain) letters of the Latin blocks, from their Unicode decomposition."""
    accented, plain = ["Đ", "đ"], ["D", "d"]
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        base = unicodedata.normalize("NFD", chr(code))[0]
        if base != chr(code) and base.isascii():
            accented.append(chr(code))
            plain.append(base)
    return "".join(accented), "".join(plain)


def without_accents(c: Column) -> Column:
    """Replace accented Latin letters by their base letter (``Hà Nội`` -> ``Ha Noi``)."""
    return F.translate(c, *_accent_table())


def _folded(c: Column, ignore_case: bool, ignore_accents: bool) -> Column:
    if ignore_accents:
        c = without_accents(c)
    return F.upper(c) if ignore_case else c


def _fold_literal(text: str, ignore_case: bool, ignore_accents: bool) -> str:
    if ignore_accents:
        text = text.translate(str.maketrans(*_accent_table()))
    return text.upper() if ignore_case else text


def standardize(
    c: Column,
    aliases: Mapping[str, Sequence[str]],
    default: str | None = None,
    ignore_case: bool = True,
    ignore_accents: bool = False,
) -> Column:
    """Map each alias to its standard value; anything else, NULL included, to ``default``."""
    probe = _folded(c, ignore_case, ignore_accents)
    result = None
    for standard, names in aliases.items():
        listed = sorted({_fold_literal(n, ignore_case, ignore_accents) for n in names})
        hit = probe.isin(listed)
        result = F.when(hit, standard) if result is None else result.when(hit, standard)
    return F.lit(default) if result is None else result.otherwise(F.lit(default))


def standardize_from_table(
    df: DataFrame,
    column: str,
    alias_table: DataFrame,
    alias: str = "alias",
    standard: str = "standard",
    default: str | None = None,
    ignore_case: bool = True,
) -> DataFrame:
    """:func:`standardize` for alias lists too long to write as literals.

    ``alias_table`` holds one row per alias.  It is deduplicated on the folded
    alias (smallest standard value wins), so the join never multiplies rows;
    Spark picks the join strategy from the table's size.
    """
    folded = "__alias"
    table = (
        alias_table.select(
            _folded(F.col(alias), ignore_case, False).alias(folded), F.col(standard).alias("__standard")
        )
        .where(F.col(folded).isNotNull())
        .groupBy(folded)
        .agg(F.min("__standard").alias("__standard"))
    )
    probe = _folded(F.col(column), ignore_case, False)
    return (
        df.withColumn("__probe", probe)
        .join(table, F.col("__probe") == F.col(folded), "left")
        .withColumn(column, F.coalesce("__standard", F.lit(default)))
        .drop("__probe", folded, "__standard")
    )
