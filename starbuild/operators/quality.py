"""Data-quality checks: declared per table, compiled into one aggregation, answered as rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace
from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starbuild.functions.dates import as_timestamp

RESULT_COLUMNS = (
    "check_name", "table_name", "column_name", "check_type", "expected_value", "actual_value",
    "is_passed", "severity", "check_time", "batch_id",
)
_SHARE = "decimal(18,6)"


class QualityGateError(RuntimeError):
    """A table failed a check of severity ``error``."""


@dataclass(frozen=True)
class Check:
    """One declared check; build it with the functions below.

    ``metric`` is an aggregate over the table and ``passes`` turns its value into the
    verdict.  ``columns`` must exist for the check to run; otherwise it fails.
    """

    kind: str
    column: str | None
    expected: str
    metric: Column | None
    passes: Any
    columns: tuple[str, ...] = ()
    severity: str = "error"
    name: str | None = None
    unique: tuple[str, ...] = field(default=())
    parent: tuple[DataFrame, str] | None = None

    @property
    def label(self) -> str:
        return self.name or "_".join([self.kind, *([self.column] if self.column else [])])

    def warn(self) -> "Check":
        return replace(self, severity="warn")


def _ratio(part: Column, whole: Column) -> Column:
    return F.try_divide(F.count_if(part).cast("double"), F.count_if(whole).cast("double")).cast(_SHARE)


def _text(value: Any) -> str:
    return "" if value is None else str(value)


def row_count(at_least: int | None = None, at_most: int | None = None) -> Check:
    def passes(n: Column) -> Column:
        return n.between(at_least if at_least is not None else 0, at_most if at_most is not None else 2**63 - 1)

    return Check("row_count", None, f"{_text(at_least)}..{_text(at_most)}", F.count(F.lit(1)), passes)


def column_exists(column: str) -> Check:
    return Check("column_exists", column, "present", F.lit("present"), lambda v: F.lit(True), (column,))


def not_null(column: str, below_share: float | None = None) -> Check:
    """No NULLs, or a share of NULLs under ``below_share``."""
    missing = F.col(column).isNull()
    if below_share is None:
        return Check("missing_count", column, "0", F.count_if(missing), lambda n: n == 0, (column,))
    return Check(
        "missing_share", column, f"< {below_share}", _ratio(missing, F.lit(True)),
        lambda v: F.coalesce(v < F.lit(below_share), F.lit(True)), (column,),
    )


def unique(*columns: str) -> Check:
    """No two rows share a value; rows with a NULL in the columns do not count."""
    return Check(
        "duplicate_count", ",".join(columns), "0", None, lambda n: n == 0, tuple(columns), unique=columns
    )


def _tolerant(kind: str, column: str, expected: str, good: Column, mostly: float) -> Check:
    """Share of non-NULL values meeting ``good`` must reach ``mostly``."""
    present = F.col(column).isNotNull()
    return Check(
        kind, column, f"{expected} >= {mostly}", _ratio(present & good, present),
        lambda v: F.coalesce(v >= F.lit(mostly), F.lit(True)), (column,),
    )


def matches_pattern(column: str, pattern: str, mostly: float = 1.0) -> Check:
    return _tolerant("regex", column, pattern, F.col(column).rlike(pattern), mostly)


def in_set(column: str, values: Sequence[Any], mostly: float = 1.0) -> Check:
    listed = [v for v in values if v is not None]
    return _tolerant("value_set", column, "|".join(map(str, listed)), F.col(column).isin(listed), mostly)


def in_range(column: str, low: Any, high: Any, mostly: float = 1.0) -> Check:
    return _tolerant("range", column, f"{low}..{high}", F.col(column).between(low, high), mostly)


def _bound(kind: str, column: str, metric: Column, low: Any, high: Any) -> Check:
    def passes(v: Column) -> Column:
        inside = F.lit(True)
        if low is not None:
            inside = inside & (v >= F.lit(low))
        if high is not None:
            inside = inside & (v <= F.lit(high))
        return F.coalesce(inside, F.lit(True))

    return Check(kind, column, f"{_text(low)}..{_text(high)}", metric, passes, (column,))


def min_between(column: str, low: Any = None, high: Any = None) -> Check:
    return _bound("min", column, F.min(column), low, high)


def max_between(column: str, low: Any = None, high: Any = None) -> Check:
    return _bound("max", column, F.max(column), low, high)


def avg_between(column: str, low: Any = None, high: Any = None) -> Check:
    exact = F.col(column).cast("decimal(18,4)")
    mean = F.try_divide(F.sum(exact).cast("double"), F.count(exact)).cast(_SHARE)
    return _bound("avg", column, mean, low, high)


def fresh(column: str, as_of, max_hours: float) -> Check:
    """The newest timestamp is younger than ``max_hours`` at ``as_of``; an empty table is stale."""
    newest = F.max(F.col(column).cast("timestamp"))
    age = F.unix_micros(as_timestamp(as_of)) - F.unix_micros(newest)
    hours = (age.cast("double") / F.lit(3_600_000_000)).cast(_SHARE)
    return Check(
        "freshness", column, f"< {max_hours}h", hours,
        lambda v: F.coalesce(v < F.lit(max_hours), F.lit(False)), (column,),
    )


def failed_rows(condition: Column, below_percent: float, name: str, columns: Sequence[str] = ()) -> Check:
    """Percentage of rows meeting the failure condition stays under a limit."""
    share = (F.try_divide(F.count_if(condition).cast("double"), F.count(F.lit(1))) * 100).cast(_SHARE)
    return Check(
        "failed_rows_percent", None, f"< {below_percent}", share,
        lambda v: F.coalesce(v < F.lit(below_percent), F.lit(True)), tuple(columns), name=name,
    )


def references(column: str, parent: DataFrame, key: str) -> Check:
    """Every non-NULL value exists in the parent table."""
    return Check(
        "referential", column, "0 orphans", None, lambda n: n == 0, (column,),
        parent=(parent, key),
    )


def _row(check: Check, value: Column, passed: Column, table: str, at: Column, batch: str | None) -> Column:
    values = (
        F.lit(check.label), F.lit(table), F.lit(check.column), F.lit(check.kind), F.lit(check.expected),
        value.cast("string"), F.coalesce(passed, F.lit(False)), F.lit(check.severity), at, F.lit(batch),
    )
    types = ("string",) * 6 + ("boolean", "string", "timestamp", "string")
    return F.struct(*[v.cast(t).alias(n) for v, t, n in zip(values, types, RESULT_COLUMNS)])


def _by_value(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with a column ``m<i>`` for each uniqueness or reference check, from one pass over ``df``.

    Every row gives its value for each check; values are counted per check (before the shuffle, so
    a hot value leaves each task once) and meet the values of all parents in one join.
    """

    def value(columns: Sequence[str], text: Sequence[Column]) -> Column:
        return text[0] if len(columns) == 1 else F.to_json(F.struct(*[t.alias(f"c{i}") for i, t in enumerate(text)]))

    values, parents, metrics = [], [], []
    for i, check in enumerate(checks):
        columns = check.unique or check.columns
        present = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
        values.append(F.struct(F.lit(i).alias("check"), F.when(present, value(columns, [F.col(c).cast("string") for c in columns])).alias("value")))
        mine = F.col("check") == i
        if check.unique:
            metrics.append(F.count_if(mine & (F.col("n") > 1)))
            continue
        parent, key = check.parent
        same_type = F.col(key).try_cast(df.schema[check.column].dataType)
        parents.append(parent.select(F.lit(i).alias("check"), same_type.cast("string").alias("value")))
        metrics.append(F.coalesce(F.sum(F.when(mine & F.col("known").isNull(), F.col("n"))), F.lit(0)))
    exploded = df.select(F.inline(F.array(*values))).where(F.col("value").isNotNull())
    counted = exploded.groupBy("check", "value").agg(F.count(F.lit(1)).alias("n"))
    if parents:
        known = reduce(DataFrame.union, parents).distinct().withColumn("known", F.lit(True))
        counted = counted.join(known, ["check", "value"], "left")
    return counted.agg(*[m.alias(f"m{i}") for i, m in enumerate(metrics)])


def run_checks(
    df: DataFrame, checks: Sequence[Check], table: str, as_of=None, batch_id: str | None = None
) -> DataFrame:
    """One result row per check.

    All plain checks share a single aggregation over ``df``, all uniqueness and reference
    checks a second one per value, so the table is read twice at most.
    """
    at = F.current_timestamp() if as_of is None else as_timestamp(as_of)
    simple, special, absent = [], [], []
    for check in checks:
        if any(c not in df.columns for c in check.columns):
            absent.append(check)
        elif check.unique or check.parent:
            special.append(check)
        else:
            simple.append(check)

    parts = []
    if simple:
        metrics = df.agg(*[c.metric.alias(f"m{i}") for i, c in enumerate(simple)])
        parts.append((metrics, [(c, F.col(f"m{i}")) for i, c in enumerate(simple)]))
    if special:
        parts.append((_by_value(df, special), [(c, F.col(f"m{i}")) for i, c in enumerate(special)]))
    if absent:
        nothing = df.sparkSession.range(1).select(F.lit("column missing").alias("m0"))
        parts.append((nothing, [(c, F.col("m0")) for c in absent]))

    results = []
    for metrics, members in parts:
        rows = [
            _row(c, v, F.lit(False) if c in absent else c.passes(v), table, at, batch_id) for c, v in members
        ]
        results.append(metrics.select(F.inline(F.array(*rows))))
    if not results:
        raise ValueError("no checks given")
    return reduce(DataFrame.unionByName, results)


def enforce(results: DataFrame) -> DataFrame:
    """Raise when a check of severity ``error`` failed (at most one row per declared check is read)."""
    failed = results.where(~F.col("is_passed") & (F.col("severity") == "error")).collect()
    if failed:
        lines = [f"{r.table_name}.{r.check_name}: expected {r.expected_value}, got {r.actual_value}" for r in failed]
        raise QualityGateError("; ".join(lines))
    return results


JOB_COLUMNS = (
    "job_name string, run_id string, start_time timestamp, end_time timestamp, status string, "
    "records_processed bigint, records_inserted bigint, records_updated bigint, records_failed bigint, "
    "error_message string"
)
LINEAGE_COLUMNS = "source_table string, target_table string, transformation_type string, batch_id string"


def job_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Job-history rows from the driver's own run records."""
    return spark.createDataFrame(list(rows), JOB_COLUMNS)


def lineage_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """Which table was built from which."""
    return spark.createDataFrame(list(rows), LINEAGE_COLUMNS)


def unresolved_rows(spark: SparkSession, rows: Sequence[tuple]) -> DataFrame:
    """How many rows of a table's build lacked which key."""
    return spark.createDataFrame(list(rows), "job_name string, run_id string, key_name string, missing_rows bigint")


def row_flow(kept: Column, updated: Column | None = None) -> list[Column]:
    """processed / inserted / updated / failed counts as expressions for ``observe`` or ``agg``."""
    changed = F.lit(False) if updated is None else updated
    return [
        F.count(F.lit(1)).alias("records_processed"),
        F.count_if(kept & ~changed).alias("records_inserted"),
        F.count_if(kept & changed).alias("records_updated"),
        F.count_if(~kept).alias("records_failed"),
    ]


#: Steps after which a chain of sources is taken for a circle.
LONGEST_CHAIN = 50


def lineage_closure(lineage: DataFrame) -> DataFrame:
    """Every table with all tables it comes from, directly or not, and the fewest ``steps`` between them.

    ``lineage`` has rows of ``source_table`` and ``target_table``, as many a pair as there were runs.
    """
    edges = lineage.select("source_table", "target_table").distinct()
    return lineage.sparkSession.sql(
        """
WITH RECURSIVE found (target_table, source_table, steps) AS (
  SELECT target_table, source_table, 1 FROM {edges}
  UNION ALL
  SELECT f.target_table, e.source_table, f.steps + 1
  FROM found f JOIN {edges} e ON f.source_table = e.target_table WHERE f.steps < {longest}
)
SELECT target_table, source_table, min(steps) AS steps FROM found GROUP BY target_table, source_table""",
        edges=edges,
        longest=LONGEST_CHAIN,
    )
