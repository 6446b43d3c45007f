"""Data-quality suites over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue import standins
from catalogue.registry import Tables, query, with_ctes
from catalogue.standins import STAMP
from catalogue.warehouse import enrollment_facts, courses, semesters, silver, students
from starbuild.operators import quality
from starbuild.operators.staging import stage
from starbuild.operators.validate import EMAIL_PATTERN
from starbuild.plans import university as uni


def _ratio(part: str, whole: str) -> str:
    return f"cast(count(*) FILTER (WHERE {part}) / cast(nullif(count(*) FILTER (WHERE {whole}), 0) AS double) AS decimal(18,6))"


def _row(kind, column, expected, actual, passed, severity="error", name=None, table="", source="", batch="b1"):
    label = name or "_".join([kind, *([column] if column else [])])
    shown = f"'{column}'" if column else "cast(NULL AS varchar)"
    text = expected.replace("'", "''")
    return f"""
SELECT '{label}' AS check_name, '{table}' AS table_name, {shown} AS column_name, '{kind}' AS check_type,
  '{text}' AS expected_value, cast(v AS varchar) AS actual_value, coalesce({passed}, false) AS is_passed,
  '{severity}' AS severity, '{STAMP}' AS check_time, '{batch}' AS batch_id FROM (SELECT {actual} AS v FROM {source}) q"""


def _suite(table: str, source: str, rows: list[tuple], *needs: str) -> str:
    body = "\nUNION ALL".join(_row(*row, table=table, source=source) for row in rows)
    return with_ctes(body, *needs) if needs else body


def _missing(column: str) -> tuple:
    return "missing_count", column, "0", f"count(*) - count({column})", "v = 0"


def _missing_share(column: str, below: float) -> tuple:
    return "missing_share", column, f"< {below}", _ratio(f"{column} IS NULL", "true"), f"v < {below}"


def _duplicates(column: str, source: str) -> tuple:
    inner = f"(SELECT count(*) FROM (SELECT {column} FROM {source} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1) d)"
    return "duplicate_count", column, "0", f"max({inner})", "v = 0"


def _orphans(source: str, column: str, dim: str) -> tuple:
    inner = f"(SELECT count(*) FROM {source} o LEFT JOIN {dim} d ON o.{column} = d.{column} WHERE o.{column} IS NOT NULL AND d.{column} IS NULL)"
    return "referential", column, "0 orphans", f"max({inner})", "v = 0"


def _present(column: str) -> tuple:
    return "column_exists", column, "present", "max('present')", "true"


def _mostly(kind: str, column: str, expected: str, good: str, mostly: float) -> tuple:
    return kind, column, f"{expected} >= {mostly}", _ratio(f"{column} IS NOT NULL AND {good}", f"{column} IS NOT NULL"), (
        f"coalesce(v >= {mostly}, true)"
    )


def _least(column: str, low) -> tuple:
    return "min", column, f"{low}..", f"min({column})", f"v >= {low}"


def _most(column: str, high) -> tuple:
    return "max", column, f"..{high}", f"max({column})", f"v <= {high}"


_MAIL = f"regexp_matches(email, '{EMAIL_PATTERN}')"
_BRONZE_GENDERS = ["M", "F", "Male", "Female", "NAM", "NỮ", "NU", "Other"]


def _in(column: str, listed: list[str]) -> str:
    return f"{column} IN ({', '.join(repr(v) for v in listed)})"


@query(
    "dq_bronze_students",
    "Q1 Q2 Q3 Q4 Q5 Q6 Q7 Q8",
    _suite(
        "bronze.raw_students",
        "b_students",
        [
            ("row_count", None, "1..1000000", "count(*)", "v BETWEEN 1 AND 1000000"),
            *[_present(c) for c in ("student_id", "first_name", "last_name", "email")],
            _missing("student_id"),
            _duplicates("student_id", "b_students"),
            _mostly("regex", "email", EMAIL_PATTERN, _MAIL, 0.95),
            _mostly("value_set", "gender", "|".join(_BRONZE_GENDERS), _in("gender", _BRONZE_GENDERS), 0.99),
            _mostly("range", "cohort_year", "2000..2030", "cohort_year BETWEEN 2000 AND 2030", 0.99),
        ],
        "b_students",
    ),
)
def dq_bronze_students(t: Tables):
    return quality.run_checks(standins.students(t), uni.bronze_student_checks(), "bronze.raw_students", STAMP, "b1")


_STATUSES = ["Active", "Graduated", "Dropped", "Suspended", "Unknown"]
_GENDERS = ["Male", "Female", "Other"]
_AGE = "cast(date_diff('microsecond', max(updated_at), TIMESTAMP '{0}') / cast(3600000000 AS double) AS decimal(18,6))".format(STAMP)


@query(
    "dq_silver_students",
    "Q4 Q5 Q6 Q7 Q8 Q10 Q11",
    _suite(
        "silver.stg_students",
        f"(SELECT *, TIMESTAMP '{STAMP}' AS updated_at FROM s_students) s",
        [
            ("row_count", None, "100..1000000", "count(*)", "v BETWEEN 100 AND 1000000"),
            ("freshness", "updated_at", "< 48h", _AGE, "v < 48"),
            _duplicates("student_id", "s_students"),
            *[_missing(c) for c in ("student_id", "full_name", "email")],
            _missing_share("date_of_birth", 0.05),
            _missing_share("phone", 0.2),
            _mostly("regex", "email", EMAIL_PATTERN, _MAIL, 1.0),
            _mostly("value_set", "status", "|".join(_STATUSES), _in("status", _STATUSES), 0.99),
            _mostly("value_set", "gender", "|".join(_GENDERS), _in("gender", _GENDERS), 0.99),
            _least("cohort_year", 2000),
            _most("cohort_year", 2030),
            (
                "failed_rows_percent", None, "< 5",
                "cast(100.0 * (count(*) FILTER (WHERE NOT is_valid) / cast(count(*) AS double)) AS decimal(18,6))",
                "v < 5", "error", "invalid_rows",
            ),
        ],
        "s_students",
    ),
)
def dq_silver_students(t: Tables):
    return quality.run_checks(silver(t, "students"), uni.silver_checks("students", STAMP), "silver.stg_students", STAMP, "b1")


_LETTERS = ["A", "B+", "B", "C+", "C", "D+", "D", "F"]
_SCORES = ("midterm_score", "final_score", "total_score")


@query(
    "dq_silver_enrollments",
    "Q2 Q4 Q5 Q7 Q8 Q10",
    _suite(
        "silver.stg_enrollments",
        f"(SELECT * REPLACE (cast(gpa_points AS decimal(3,2)) AS gpa_points, cast(attendance_rate AS decimal(5,2)) AS attendance_rate), TIMESTAMP '{STAMP}' AS updated_at FROM s_enrollments) s",
        [
            ("row_count", None, "1..", "count(*)", "v >= 1"),
            ("freshness", "updated_at", "< 48h", _AGE, "v < 48"),
            _duplicates("enrollment_id", "s_enrollments"),
            *[_missing(c) for c in ("enrollment_id", "student_id", "course_id", "semester_id")],
            *[_least(c, 0) for c in _SCORES],
            *[_most(c, 10) for c in _SCORES],
            _mostly("value_set", "grade_letter", "|".join(_LETTERS), _in("grade_letter", _LETTERS), 0.99),
            _least("gpa_points", 0),
            _most("gpa_points", 4.0),
            _least("attendance_count", 0),
            _least("absence_count", 0),
            (
                "avg", "attendance_rate", "0..100",
                "cast(cast(sum(attendance_rate) AS double) / count(attendance_rate) AS decimal(18,6))",
                "v BETWEEN 0 AND 100",
            ),
        ],
        "s_enrollments",
    ),
)
def dq_silver_enrollments(t: Tables):
    checks = uni.silver_checks("enrollments", STAMP)
    return quality.run_checks(silver(t, "enrollments"), checks, "silver.stg_enrollments", STAMP, "b1")


@query(
    "dq_silver_courses",
    "Q4 Q5 Q8 Q12",
    _suite(
        "silver.stg_courses",
        "s_courses",
        [
            _duplicates("course_id", "s_courses"),
            _missing("course_id"),
            _missing("course_name"),
            _least("credits", 1),
            _most("credits", 10),
        ],
        "s_courses",
    ),
)
def dq_silver_courses(t: Tables):
    return quality.run_checks(silver(t, "courses"), uni.silver_checks("courses", STAMP), "silver.stg_courses", STAMP, "b1")


@query(
    "dq_references",
    "Q13 Q5",
    _suite(
        "lineitem",
        "lineitem",
        [
            (
                "referential", "l_orderkey", "0 orphans",
                "max((SELECT count(*) FROM lineitem WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')))",
                "v = 0", "warn",
            ),
            (
                "referential", "l_partkey", "0 orphans",
                "max((SELECT count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)))", "v = 0",
            ),
            (
                "duplicate_count", "l_orderkey,l_linenumber", "0",
                "max((SELECT count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1) d))",
                "v = 0",
            ),
            ("missing_count", "no_such_column", "0", "max('column missing')", "false"),
        ],
    ),
)
def dq_references(t: Tables):
    settled = t.orders.where(F.col("o_orderstatus") != "P")
    checks = [
        quality.references("l_orderkey", settled, "o_orderkey").warn(),
        quality.references("l_partkey", t.part, "p_partkey"),
        quality.unique("l_orderkey", "l_linenumber"),
        quality.not_null("no_such_column"),
    ]
    return quality.run_checks(t.lineitem, checks, "lineitem", STAMP, "b1")


@query(
    "dq_fact_enrollment",
    "Q13 Q12",
    _suite(
        "gold.fact_enrollment",
        "f_enrollment",
        [
            _missing("enrollment_id"),
            _duplicates("enrollment_id", "f_enrollment"),
            *[_orphans("f_enrollment", f"{d}_key", f"g_{d}") for d in ("student", "semester", "course")],
        ],
        "f_enrollment", "g_student", "g_semester", "g_course",
    ),
)
def dq_fact_enrollment(t: Tables):
    dims = students(t), semesters(t), courses(t)
    # one stored table for all checks, as the runner has it: each uniqueness and reference check reads it again
    facts = stage(enrollment_facts(t, dims[0]), "checked-facts")
    return quality.run_checks(facts, uni.fact_checks("fact_enrollment", *dims), "gold.fact_enrollment", STAMP, "b1")


@query(
    "dq_events",
    "Q2 Q6 Q7 Q8 Q10 Q11",
    """
SELECT * REPLACE ('2024-01-31 00:00:00' AS check_time) FROM ("""
    + _suite(
        "events",
        "events",
        [
            ("row_count", None, "1..", "count(*)", "v >= 1"),
            _mostly("regex", "props", r'^\{"k": [0-9]+\}$', r"""regexp_matches(props, '^\{"k": [0-9]+\}$')""", 0.9),
            _mostly("value_set", "event_type", "click|view|purchase", _in("event_type", ["click", "view", "purchase"]), 0.5),
            _mostly("range", "value", "0..100", "value BETWEEN 0 AND 100", 0.9),
            (
                "freshness", "ts", "< 24h",
                "cast(date_diff('microsecond', max(ts), TIMESTAMP '2024-01-31 00:00:00') / cast(3600000000 AS double) AS decimal(18,6))",
                "v < 24",
            ),
            (
                "failed_rows_percent", None, "< 25",
                "cast(100.0 * (count(*) FILTER (WHERE event_type = 'error') / cast(count(*) AS double)) AS decimal(18,6))",
                "v < 25", "error", "error_events",
            ),
        ],
    )
    + ") r",
)
def dq_events(t: Tables):
    checks = [
        quality.row_count(1),
        quality.matches_pattern("props", r'^\{"k": [0-9]+\}$', 0.9),
        quality.in_set("event_type", ["click", "view", "purchase"], 0.5),
        quality.in_range("value", 0, 100, 0.9),
        quality.fresh("ts", "2024-01-31 00:00:00", 24),
        quality.failed_rows(F.col("event_type") == "error", 25, "error_events", ["event_type"]),
    ]
    return quality.run_checks(t.events, checks, "events", "2024-01-31 00:00:00", "b1")


@query(
    "job_metrics",
    "Q9 A7",
    """
SELECT o_orderpriority, count(*) AS records_processed,
  count(*) FILTER (WHERE o_totalprice > 1000 AND o_orderstatus <> 'F') AS records_inserted,
  count(*) FILTER (WHERE o_totalprice > 1000 AND o_orderstatus = 'F') AS records_updated,
  count(*) FILTER (WHERE NOT o_totalprice > 1000) AS records_failed FROM orders GROUP BY o_orderpriority""",
)
def job_metrics(t: Tables):
    flow = quality.row_flow(F.col("o_totalprice") > 1000, F.col("o_orderstatus") == "F")
    return t.orders.groupBy("o_orderpriority").agg(*flow)


