"""Numeric derivations: code-to-value maps, steps, buckets, rates, money, flags, hashes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def value_map(c: Column, mapping: Mapping[Any, Any], default: Any = None, null_as: Any = None) -> Column:
    """Exact lookup of ``c``; unlisted values give ``default``, NULL gives ``null_as``."""
    result = F.when(c.isNull(), F.lit(null_as))
    for code, value in mapping.items():
        result = result.when(c == F.lit(code), F.lit(value))
    return result.otherwise(F.lit(default))


def step(c: Column, levels: Sequence[tuple[Any, Any]], below: Any = None) -> Column:
    """Value of the highest ``(minimum, value)`` level that ``c`` reaches, else ``below``."""
    ordered = sorted(levels, key=lambda level: level[0], reverse=True)
    result = F.when(c.isNull(), F.lit(below))
    for minimum, value in ordered:
        result = result.when(c >= F.lit(minimum), F.lit(value))
    return result.otherwise(F.lit(below))


def bucketize(c: Column, uppers: Sequence[Any], labels: Sequence[str], null_label: str | None = None) -> Column:
    """Label of the first bucket whose exclusive upper bound exceeds ``c``.

    ``labels`` has one entry more than ``uppers``; the last one is open-ended.
    """
    if len(labels) != len(uppers) + 1:
        raise ValueError("bucketize needs exactly one label more than bounds")
    if list(uppers) != sorted(uppers):
        raise ValueError("bucketize bounds must ascend")
    result = F.when(c.isNull(), F.lit(null_label))
    for upper, label in zip(uppers, labels):
        result = result.when(c < F.lit(upper), label)
    return result.otherwise(labels[-1])


def percentage(part: Column, whole: Column, digits: int = 2) -> Column:
    """``100 * part / whole`` rounded; NULL when the whole is zero or anything is NULL."""
    return F.round(F.try_divide(part * F.lit(100), whole), digits)


def reaches(c: Column, minimum: Any, null_as: bool | None = False) -> Column:
    """``c >= minimum``; a NULL gives ``null_as`` (pass None to keep it NULL)."""
    flag = c >= F.lit(minimum)
    return flag if null_as is None else F.coalesce(flag, F.lit(null_as))


def stays_within(c: Column, maximum: Any, null_as: bool | None = False) -> Column:
    """``c <= maximum``; a NULL gives ``null_as`` (pass None to keep it NULL)."""
    flag = c <= F.lit(maximum)
    return flag if null_as is None else F.coalesce(flag, F.lit(null_as))


def with_money_columns(
    df: DataFrame,
    gross: str = "tuition_amount",
    deductions: Sequence[str] = ("scholarship_amount", "discount_amount"),
    paid: str = "paid_amount",
    money: str = "decimal(15,2)",
    ratio: str = "decimal(9,2)",
) -> DataFrame:
    """Add total_discount, net_amount, balance_amount and payment_ratio (percent paid).

    A NULL deduction counts as zero.  Sums widen inside Spark, so results are cast
    back to the declared money type; the ratio is NULL where the net amount is zero.  What
    does not fit its type is NULL, so one odd row does not stop the table.
    """
    total = sum((F.coalesce(F.col(d).cast(money), F.lit(0).cast(money)) for d in deductions), F.lit(0).cast(money))
    net = F.col(gross).cast(money) - total
    paid_amount = F.col(paid).cast(money)
    return df.withColumns(
        {
            "total_discount": total.try_cast(money),
            "net_amount": net.try_cast(money),
            "balance_amount": (net - paid_amount).try_cast(money),
            "payment_ratio": percentage(paid_amount, net).try_cast(ratio),
        }
    )


def row_hash(*columns: Column) -> Column:
    """SHA-256 over the columns, each written as ``length:text`` and NULL as ``-``.

    The length prefix keeps ("ab", "c") and ("a", "bc") apart, the marker keeps NULL
    apart from an empty string.
    """
    pieces = []
    for c in columns:
        text = c.cast("string")
        pieces.append(F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*pieces), 256)


def rate(condition: Column, digits: int = 2) -> Column:
    """Aggregate: percentage of all rows of the group for which the condition holds."""
    return percentage(F.count_if(condition), F.count(F.lit(1)), digits)


def exact_avg(c: Column, digits: int = 2, exact_type: str = "decimal(18,4)") -> Column:
    """Aggregate: rounded mean that does not depend on the order of summation.

    Sum and quotient are decimal, so partial sums arriving in any order (or re-run after
    a lost executor) give the same last digit, and a tie rounds up.
    """
    exact = c.cast(exact_type)
    return F.round(F.try_divide(F.sum(exact), F.count(exact).cast("decimal(20,0)")), digits)
