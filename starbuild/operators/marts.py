"""Summary marts over star-schema facts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.functions.values import exact_avg, percentage, rate
from starbuild.operators.upkeep import Sums

# fixed values: letters counted by the grade distribution, and the stand-in graduate GPA
GRADE_LETTERS = ("A", "B", "C", "D", "F")
PLACEHOLDER_GPA = 3.5


_EXACT = "decimal(18,4)"
_EXACT_SUM = "decimal(28,4)"


_GPA, _ATTENDANCE = f"cast(gpa_points AS {_EXACT})", f"cast(attendance_rate AS {_EXACT})"
_AMOUNTS = ("tuition_amount", "scholarship_amount", "discount_amount", "paid_amount", "remaining_amount", "net_amount")
_MONEY = "decimal(15,2)"


def _flag(condition: str) -> str:
    return f"if({condition}, 1L, 0L)"


def _known(amount: str, kind: str = _EXACT) -> str:
    return f"coalesce(cast({amount} AS {kind}), cast(0 AS {kind}))"


#: Enrolments added up per semester and student, before they meet the student dimension: the join
#: carries one row per student and semester, and the rows of a group are its distinct students.
ENROLLMENT_SUMS = Sums(
    ("semester_key", "student_key"),
    ("semester_key", "student_key", "enrollment_id", "gpa_points", "attendance_rate", "is_passed", "grade_letter"),
    {
        "ids": _flag("enrollment_id IS NOT NULL"),
        "gpa_sum": _known(_GPA),
        "gpa_count": _flag(f"{_GPA} IS NOT NULL"),
        "gpa_squares": _known(f"{_GPA} * {_GPA}", "decimal(28,8)"),
        "passed": _flag("is_passed"),
        "failed": _flag("NOT is_passed"),
        "attendance_sum": _known(_ATTENDANCE),
        "attendance_count": _flag(f"{_ATTENDANCE} IS NOT NULL"),
        **{f"grade_{letter.lower()}": _flag(f"grade_letter = '{letter}'") for letter in GRADE_LETTERS},
    },
    {"gpa": _GPA},
)

#: Payments added up per semester and student; an amount's count tells no amount from nothing.
PAYMENT_SUMS = Sums(
    ("semester_key", "student_key"),
    ("semester_key", "student_key", *_AMOUNTS),
    {a: _known(a, _MONEY) for a in _AMOUNTS} | {f"{a}_count": _flag(f"{a} IS NOT NULL") for a in _AMOUNTS},
)


def with_current_key(facts: DataFrame, versions: DataFrame, natural_key: str, key: str) -> DataFrame:
    """``facts`` with the key of a closed dimension version replaced by that of the current one.

    Keys of members without a current version stay.
    """
    current = versions.where("is_current").select(natural_key, F.col(key).alias("__now"))
    closed = versions.where("NOT is_current").select(natural_key, F.col(key).alias("__then"))
    moved = closed.join(current, natural_key).select("__then", "__now")
    joined = facts.join(moved, F.col(key) == F.col("__then"), "left")
    return joined.withColumn(key, F.coalesce("__now", key)).select(*facts.columns)


def _by_department(sums: DataFrame, students: DataFrame, how: str):
    """Per-student sums grouped by semester and department of the current student version."""
    side = students.where(F.col("is_current")).select(F.col("student_key").alias("__sk"), "department_key")
    joined = sums.join(side, F.col("student_key") == F.col("__sk"), how)
    return joined.groupBy("semester_key", "department_key")


def _mean(total: str, count: str, digits: int = 2) -> Column:
    """Mean from partial sums, exact like :func:`exact_avg`."""
    whole = F.sum(count).cast("decimal(20,0)")
    return F.round(F.try_divide(F.sum(total).cast(_EXACT_SUM), whole), digits)


def _deviation(total: str, squares: str, count: str) -> Column:
    """Sample standard deviation from exact partial sums; NULL for a single value."""
    n, s, q = (F.sum(c).cast("double") for c in (count, total, squares))
    return F.sqrt(F.greatest(F.try_divide(n * q - s * s, n * (n - 1)), F.lit(0.0)))


def _core() -> list[Column]:
    return [
        F.count("student_key").alias("total_students"),
        _mean("gpa_sum", "gpa_count").alias("avg_gpa"),
        percentage(F.sum("passed"), F.sum("rows")).alias("pass_rate"),
        percentage(F.sum("failed"), F.sum("rows")).alias("fail_rate"),
        _mean("attendance_sum", "attendance_count").alias("avg_attendance_rate"),
    ]


def academic_performance(facts: DataFrame, students: DataFrame) -> DataFrame:
    """Per semester and department: heads, enrolments, mean GPA, pass/fail and attendance rates.

    Facts without a current student are left out.
    """
    return academic_from_sums(ENROLLMENT_SUMS.of(facts), students)


def academic_from_sums(sums: DataFrame, students: DataFrame) -> DataFrame:
    """:func:`academic_performance` from ``ENROLLMENT_SUMS``."""
    return _by_department(sums, students, "inner").agg(F.sum("ids").alias("total_enrollments"), *_core())


def academic_performance_extended(facts: DataFrame, students: DataFrame) -> DataFrame:
    """:func:`academic_performance` plus GPA spread and grade counts, keeping facts without a student."""
    return academic_extended_from_sums(ENROLLMENT_SUMS.of(facts), students)


def academic_extended_from_sums(sums: DataFrame, students: DataFrame) -> DataFrame:
    """:func:`academic_performance_extended` from ``ENROLLMENT_SUMS``."""
    deviation = _deviation("gpa_sum", "gpa_squares", "gpa_count")
    return _by_department(sums, students, "left").agg(
        F.sum("rows").alias("total_enrollments"),
        *_core(),
        F.round(F.min("gpa_min").cast("double"), 2).alias("min_gpa"),
        F.round(F.max("gpa_max").cast("double"), 2).alias("max_gpa"),
        F.round(F.when(F.sum("gpa_count") > 1, deviation), 2).alias("stddev_gpa"),
        *[F.sum(f"grade_{letter.lower()}").alias(f"grade_{letter.lower()}_count") for letter in GRADE_LETTERS],
    )


def financial_summary(facts: DataFrame) -> DataFrame:
    """Per semester: money expected, granted, collected, outstanding, and the collection rate.

    ``avg_tuition_per_student`` is the mean over transactions.
    """
    return financial_from_sums(PAYMENT_SUMS.of(facts))


def financial_from_sums(sums: DataFrame) -> DataFrame:
    """:func:`financial_summary` from ``PAYMENT_SUMS``."""

    def total(amount: str) -> Column:
        return F.when(F.sum(f"{amount}_count") > 0, F.sum(amount).cast("decimal(25,2)"))

    return sums.groupBy("semester_key").agg(
        total("tuition_amount").alias("total_tuition_expected"),
        total("scholarship_amount").alias("total_scholarships"),
        total("discount_amount").alias("total_discounts"),
        total("paid_amount").alias("total_collected"),
        total("remaining_amount").alias("total_outstanding"),
        percentage(total("paid_amount"), total("net_amount")).alias("collection_rate"),
        F.count("student_key").alias("student_count"),
        _mean("tuition_amount", "tuition_amount_count").alias("avg_tuition_per_student"),
    )


def student_gpa(sums: DataFrame) -> DataFrame:
    """Mean points of each student over all enrolments, from ``ENROLLMENT_SUMS``."""
    return sums.groupBy("student_key").agg(_mean("gpa_sum", "gpa_count", 4).alias("student_gpa"))


def cohort_analysis(students: DataFrame, facts: DataFrame | None = None, sums: DataFrame | None = None) -> DataFrame:
    """Per cohort year and department: sizes by status, retention, graduation, time to graduate.

    The graduate GPA is a constant where a group has graduates; with ``facts``, or their ``ENROLLMENT_SUMS``,
    the column ``avg_cumulative_gpa`` holds the mean of the graduates' own averages instead.
    """
    members = students.where(F.col("is_current") & F.col("cohort_year").isNotNull())
    graduated = F.col("status") == "Graduated"
    if facts is not None:
        sums = ENROLLMENT_SUMS.of(facts)
    if sums is None:
        gpa_name, gpa = "avg_graduate_gpa", F.lit(PLACEHOLDER_GPA)
    else:
        own = student_gpa(sums).withColumnRenamed("student_key", "__sk")
        members = members.join(own, F.col("student_key") == F.col("__sk"), "left")
        gpa_name, gpa = "avg_cumulative_gpa", F.col("student_gpa")
    return members.groupBy("cohort_year", "department_key").agg(
        F.count(F.lit(1)).alias("initial_students"),
        F.count_if(F.col("status") == "Active").alias("current_students"),
        F.count_if(graduated).alias("graduated_students"),
        F.count_if(F.col("status").isin("Dropped", "Suspended")).alias("dropped_students"),
        rate(F.col("status") == "Active").alias("retention_rate"),
        rate(graduated).alias("graduation_rate"),
        exact_avg(F.when(graduated & F.col("graduation_date").isNotNull(), F.col("years_enrolled")), 1).alias(
            "avg_years_to_graduate"
        ),
        exact_avg(F.when(graduated, gpa)).alias(gpa_name),
    )


def cohort_order(mart: DataFrame) -> DataFrame:
    """Report order: newest cohort first, then department."""
    return mart.orderBy(F.col("cohort_year").desc(), F.col("department_key"))
