"""Row-level rules: ``is_valid`` and ``validation_errors``."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.operators.layout import ERRORS_TYPE

# fixed value: the e-mail form that counts as valid
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"


@dataclass(frozen=True)
class Rule:
    """A condition rows must meet; unknown (NULL) counts as not met."""

    condition: Column
    message: str

    def fails(self) -> Column:
        return ~F.coalesce(self.condition, F.lit(False))


def required(column: str) -> Rule:
    return Rule(F.col(column).isNotNull(), f"Missing {column}")


def matches(column: str, pattern: str, message: str) -> Rule:
    return Rule(F.col(column).rlike(pattern), message)


def validate(df: DataFrame, rules: Sequence[Rule], report: str = "first") -> DataFrame:
    """Flag rows.  ``report`` lists the first broken rule per row, or ``"all"`` of them."""
    if report not in ("first", "all"):
        raise ValueError(f"unknown report mode: {report}")
    messages = [F.when(rule.fails(), F.lit(rule.message)) for rule in rules]
    none = F.array().cast(ERRORS_TYPE)
    if not rules:
        errors = none
    elif report == "all":
        errors = F.array_compact(F.array(*messages))
    else:
        first = F.coalesce(*messages) if len(messages) > 1 else messages[0]
        errors = F.when(first.isNotNull(), F.array(first)).otherwise(none)
    ok = F.lit(True)
    for rule in rules:
        ok = ok & ~rule.fails()
    return df.withColumns({"is_valid": ok, "validation_errors": errors})
