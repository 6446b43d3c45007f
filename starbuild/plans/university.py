"""University star schema: entity layouts, code lists, rules, dimensions, facts, checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions import dates, text, values
from starbuild.operators import dedup, keys, layout, lookup, merge, quality, scd2
from starbuild.operators.staging import stage
from starbuild.operators.validate import EMAIL_PATTERN, Rule, matches, required, validate
from starbuild.plans.specs import DAY, FLAG, INT, MONEY, POINTS, RATIO, SCORE, TEXT, VALIDITY, EntitySpec, fields

# --- fixed values ------------------------------------------------------------
# Code lists, thresholds and labels that decide results.

GENDERS = {"Male": ["M", "MALE", "NAM"], "Female": ["F", "FEMALE", "NỮ", "NU"]}
GENDER_DEFAULT = "Other"

STATUSES = {
    "Active": ["ACTIVE", "ENROLLED", "ĐANG HỌC"],
    "Graduated": ["GRADUATED", "TỐT NGHIỆP"],
    "Dropped": ["DROPPED", "BỎ HỌC", "THÔI HỌC"],
    "Suspended": ["SUSPENDED", "TẠM NGHỈ"],
}
STATUS_DEFAULT = "Unknown"

REGIONS = {
    "Miền Bắc": [
        "Hà Nội", "Hải Phòng", "Quảng Ninh", "Hải Dương", "Bắc Ninh",
        "Vĩnh Phúc", "Phú Thọ", "Thái Nguyên", "Lạng Sơn", "Cao Bằng",
    ],
    "Miền Trung": [
        "Đà Nẵng", "Huế", "Quảng Nam", "Quảng Ngãi", "Bình Định",
        "Phú Yên", "Khánh Hòa", "Nghệ An", "Hà Tĩnh", "Quảng Bình",
    ],
    "Miền Nam": [
        "TP HCM", "Hồ Chí Minh", "Bình Dương", "Đồng Nai", "Long An",
        "Cần Thơ", "An Giang", "Kiên Giang", "Vũng Tàu", "Bà Rịa",
    ],
}
REGIONS_SHORT = {
    "Miền Bắc": ["Hà Nội", "Hải Phòng", "Quảng Ninh", "Hải Dương", "Bắc Ninh"],
    "Miền Trung": ["Đà Nẵng", "Huế", "Quảng Nam", "Nghệ An"],
    "Miền Nam": ["TP HCM", "Hồ Chí Minh", "Bình Dương", "Đồng Nai", "Long An"],
}
REGION_DEFAULT = "Khác"

LETTER_POINTS = {"A": 4.0, "A-": 3.7, "B+": 3.3, "B": 3.0, "B-": 2.7, "C+": 2.3, "C": 2.0, "D": 1.0}
SCORE_POINTS = [(8.5, 4.0), (7.0, 3.0), (5.5, 2.0), (4.0, 1.0)]
NO_POINTS = 0.0
PASSING_SCORE = 5.0
HIGH_GPA = 3.5
AT_RISK_ATTENDANCE = 0.7  # a fraction; attendance rates are percentages

AGE_BOUNDS = [20, 25, 30, 35]
AGE_LABELS = ["Under 20", "20-24", "25-29", "30-34", "35+"]
CREDIT_BOUNDS = [3, 4]
CREDIT_LABELS = ["Light", "Standard", "Heavy"]

TRACKED = ["full_name", "email", "phone", "address", "city", "province", "status", "graduation_date"]
CALENDAR = ("2020-01-01", "2030-12-31")

# --- scalar rules ------------------------------------------------------------


def gender(c: Column) -> Column:
    return text.standardize(c, GENDERS, GENDER_DEFAULT)


def status(c: Column) -> Column:
    return text.standardize(c, STATUSES, STATUS_DEFAULT)


def region(c: Column, short: bool = False, ignore_accents: bool = False) -> Column:
    lists = REGIONS_SHORT if short else REGIONS
    return text.standardize(c, lists, REGION_DEFAULT, ignore_case=False, ignore_accents=ignore_accents)


def letter_points(c: Column) -> Column:
    """Points of a letter grade; an unlisted letter earns none, a missing letter is unknown."""
    return values.value_map(c, LETTER_POINTS, NO_POINTS).cast("decimal(3,2)")


def score_points(c: Column) -> Column:
    return values.step(c, SCORE_POINTS, NO_POINTS).cast("decimal(3,2)")


def age_group(birth: Column, as_of, calendar_years: bool = False) -> Column:
    """Bucketed age; the default counts 365-day years, fractions included."""
    today = dates.as_date(as_of)
    age = dates.years_by_calendar(birth, today) if calendar_years else F.datediff(today, birth) / F.lit(365)
    return values.bucketize(age, AGE_BOUNDS, AGE_LABELS, null_label=AGE_LABELS[-1])


def years_enrolled(enrolled: Column, graduated: Column, as_of, calendar_years: bool = False) -> Column:
    count = dates.years_by_calendar if calendar_years else dates.years_by_days
    return count(enrolled, F.coalesce(graduated, dates.as_date(as_of)))


def credit_category(credits: Column) -> Column:
    return values.bucketize(credits, CREDIT_BOUNDS, CREDIT_LABELS)


def is_high_gpa(points: Column, threshold: float = HIGH_GPA) -> Column:
    return values.reaches(points, threshold)


def is_at_risk(attendance_rate: Column, fraction: float = AT_RISK_ATTENDANCE) -> Column:
    return F.coalesce(attendance_rate < F.lit(fraction * 100), F.lit(False))


# --- silver ------------------------------------------------------------------


def _clean_students(df: DataFrame) -> DataFrame:
    if "graduation_date" not in df.columns:
        df = df.withColumn("graduation_date", F.lit(None).cast("string"))
    df = text.clean_strings(df, ["first_name", "last_name", "city", "province"])
    return df.withColumns(
        {
            "full_name": text.joined_name(F.col("first_name"), F.col("last_name")),
            "email": text.email_form(F.col("email")),
            "phone": text.phone_form(F.col("phone")),
            "gender": gender(F.col("gender")),
            "status": status(F.col("status")),
            **{c: dates.parse_date(F.col(c)) for c in ("date_of_birth", "enrollment_date", "graduation_date")},
        }
    )


def _clean_courses(df: DataFrame) -> DataFrame:
    return text.trim_strings(df, ["course_name", "course_description", "course_level", "course_type"])


def _clean_enrollments(df: DataFrame) -> DataFrame:
    sessions = F.col("attendance_count") + F.col("absence_count")
    return df.withColumns(
        {
            "enrollment_date": dates.parse_date(F.col("enrollment_date")),
            "attendance_rate": values.percentage(F.col("attendance_count"), sessions),
            "gpa_points": letter_points(F.col("grade_letter")),
        }
    )


def _clean_tuition(df: DataFrame) -> DataFrame:
    return values.with_money_columns(df).withColumn("payment_date", dates.parse_date(F.col("payment_date")))


def _clean_semesters(df: DataFrame) -> DataFrame:
    return df.withColumns({c: dates.parse_date(F.col(c)) for c in ("start_date", "end_date")})


def _clean_departments(df: DataFrame) -> DataFrame:
    return text.trim_strings(df, ["department_name", "faculty", "dean_name"])


def _all_required(*columns: str):
    return lambda: [required(c) for c in columns]


# Column names, types and rule messages of the entities are fixed values.

STUDENTS = EntitySpec(
    "students",
    ("student_id",),
    fields(
        ("student_id first_name last_name date_of_birth gender email phone address city province", TEXT),
        ("cohort_year", INT),
        ("department_id enrollment_date status", TEXT),
    ),
    fields(
        ("student_id full_name", TEXT),
        ("date_of_birth", DAY),
        ("gender email phone address city province", TEXT),
        ("cohort_year", INT),
        ("department_id", TEXT),
        ("enrollment_date graduation_date", DAY),
        ("status", TEXT),
        *VALIDITY,
    ),
    _clean_students,
    lambda: [required("student_id"), matches("email", EMAIL_PATTERN, "Invalid email format")],
    "dim_student",
    ("cohort_year",),
)
COURSES = EntitySpec(
    "courses",
    ("course_id",),
    fields(
        ("course_id course_name course_description", TEXT),
        ("credits", INT),
        ("department_id course_level course_type", TEXT),
        ("is_active", FLAG),
    ),
    fields(
        ("course_id course_name course_description", TEXT),
        ("credits", INT),
        ("department_id course_level course_type", TEXT),
        ("is_active", FLAG),
        *VALIDITY,
    ),
    _clean_courses,
    _all_required("course_id", "course_name", "credits"),
    "dim_course",
)
ENROLLMENTS = EntitySpec(
    "enrollments",
    ("enrollment_id",),
    fields(
        ("enrollment_id student_id course_id semester_id enrollment_date", TEXT),
        ("midterm_score final_score total_score", SCORE),
        ("grade_letter status", TEXT),
        ("attendance_count absence_count", INT),
    ),
    fields(
        ("enrollment_id student_id course_id semester_id", TEXT),
        ("enrollment_date", DAY),
        ("midterm_score final_score total_score", SCORE),
        ("grade_letter", TEXT),
        ("gpa_points", POINTS),
        ("status", TEXT),
        ("attendance_count absence_count", INT),
        ("attendance_rate", SCORE),
        *VALIDITY,
    ),
    _clean_enrollments,
    _all_required("enrollment_id", "student_id", "course_id"),
    "fact_enrollment",
    ("semester_id",),
)
TUITION = EntitySpec(
    "tuition",
    ("transaction_id",),
    fields(
        ("transaction_id student_id semester_id", TEXT),
        ("tuition_amount scholarship_amount discount_amount paid_amount", MONEY),
        ("payment_date payment_method status", TEXT),
    ),
    fields(
        ("transaction_id student_id semester_id", TEXT),
        (
            "tuition_amount scholarship_amount discount_amount total_discount net_amount paid_amount "
            "balance_amount",
            MONEY,
        ),
        ("payment_date", DAY),
        ("payment_method", TEXT),
        ("payment_ratio", RATIO),
        ("status", TEXT),
        *VALIDITY,
    ),
    _clean_tuition,
    lambda: [
        required("transaction_id"),
        required("student_id"),
        Rule(F.col("net_amount") >= 0, "Negative net amount"),
    ],
    "fact_tuition",
    ("semester_id",),
)
SEMESTERS = EntitySpec(
    "semesters",
    ("semester_id",),
    fields(
        ("semester_id semester_name", TEXT),
        ("academic_year semester_number", INT),
        ("start_date end_date", TEXT),
        ("is_current", FLAG),
    ),
    fields(
        ("semester_id semester_name", TEXT),
        ("academic_year semester_number", INT),
        ("start_date end_date", DAY),
        ("is_current", FLAG),
        *VALIDITY,
    ),
    _clean_semesters,
    _all_required("semester_id", "start_date", "end_date"),
    "dim_semester",
)
DEPARTMENTS = EntitySpec(
    "departments",
    ("department_id",),
    fields(
        ("department_id department_name faculty dean_name", TEXT),
        ("established_year", INT),
    ),
    fields(
        ("department_id department_name faculty dean_name", TEXT),
        ("established_year", INT),
        *VALIDITY,
    ),
    _clean_departments,
    _all_required("department_id", "department_name"),
    "dim_department",
)
ENTITIES = {e.name: e for e in (STUDENTS, COURSES, ENROLLMENTS, TUITION, SEMESTERS, DEPARTMENTS)}


def silver(
    df: DataFrame,
    entity: EntitySpec,
    stamp=None,
    tie_breakers: Sequence | None = None,
    origin: T.StructType = T.StructType(),
    only: DataFrame | None = None,
    with_apart: bool = False,
) -> DataFrame:
    """Bronze rows to the entity's silver table: cleanse, validate, latest per key, layout, audit.

    ``origin`` names further columns to carry along behind the layout; ``only`` limits the keys.  A column
    ``_row`` of ``df`` tells its rows apart, so that rows without a key need no second pass; then
    ``with_apart`` keeps the column ``dedup.APART``.
    """
    checked = validate(entity.cleanse(df), entity.rules())
    if only is not None:
        checked = checked.join(only.select(*entity.keys), list(entity.keys), "left_semi")
    row_id = ["_row"] if "_row" in df.columns else None
    latest = dedup.keep_latest(checked, entity.keys, ["_ingested_at"], tie_breakers, row_id=row_id, with_apart=with_apart)
    apart = fields((dedup.APART, TEXT)) if with_apart else T.StructType()
    layout_and_origin = T.StructType([*entity.silver.fields, *origin.fields, *apart.fields])
    return layout.with_audit(layout.to_layout(latest, layout_and_origin), stamp)


def unchecked_silver(df: DataFrame, entity: EntitySpec, stamp=None) -> DataFrame:
    """Bronze rows to the silver layout with every row taken as valid."""
    return layout.with_audit(layout.to_layout(layout.assume_valid(entity.cleanse(df)), entity.silver), stamp)


def staging_view(df: DataFrame, entity: EntitySpec) -> DataFrame:
    """Valid silver rows without the validity columns."""
    names = [f.name for f in entity.silver if f.name not in ("is_valid", "validation_errors")]
    return layout.valid_rows(df, [*names, "created_at", "updated_at"])


# --- gold: dimensions --------------------------------------------------------


def department_rows(departments: DataFrame, as_of) -> DataFrame:
    rows = layout.valid_rows(
        departments, ["department_id", "department_name", "faculty", "dean_name", "established_year"]
    )
    return rows.withColumn("department_age", F.year(dates.as_date(as_of)) - F.col("established_year"))


def dim_department(departments: DataFrame, as_of, existing: DataFrame | keys.Numbering | None = None, stamp=None) -> DataFrame:
    rows = department_rows(departments, as_of)
    return layout.with_audit(keys.assign_keys(rows, ["department_id"], "department_key", existing), stamp)


def dim_semester(semesters: DataFrame, existing: DataFrame | keys.Numbering | None = None, stamp=None) -> DataFrame:
    rows = layout.valid_rows(
        semesters,
        [
            "semester_id", "semester_name", "academic_year", "semester_number", "start_date", "end_date",
            dates.weeks_between(F.col("start_date"), F.col("end_date")).alias("duration_weeks"), "is_current",
        ],
    )
    return layout.with_audit(keys.assign_keys(rows, ["semester_id"], "semester_key", existing), stamp)


def dim_course(
    courses: DataFrame, departments: DataFrame | None, existing: DataFrame | keys.Numbering | None = None, stamp=None
) -> DataFrame:
    rows = lookup.lookup_key(layout.valid_rows(courses), departments, "department_id", "department_key").select(
        "course_id", "course_name", "course_description", "credits",
        credit_category(F.col("credits")).alias("credit_category"), "department_key", "course_level",
        "course_type", "is_active",
    )
    return layout.with_audit(keys.assign_keys(rows, ["course_id"], "course_key", existing), stamp)


#: What tells the versions of students apart.
VERSION_KEYS = ["student_id", scd2.START]


def student_snapshot(
    students: DataFrame,
    departments: DataFrame | None,
    as_of,
    calendar_years: bool = False,
    short_regions: bool = False,
    ignore_accents: bool = False,
) -> DataFrame:
    """Enriched student rows of one day: age group, region, years enrolled, department key."""
    rows = layout.valid_rows(students).withColumns(
        {
            "age_group": age_group(F.col("date_of_birth"), as_of, calendar_years),
            "region": region(F.col("province"), short_regions, ignore_accents),
            "years_enrolled": years_enrolled(
                F.col("enrollment_date"), F.col("graduation_date"), as_of, calendar_years
            ),
        }
    )
    return lookup.lookup_key(rows, departments, "department_id", "department_key").select(
        "student_id", "full_name", "date_of_birth", "age_group", "gender", "email", "phone", "address", "city",
        "province", "region", "cohort_year", "department_key", "enrollment_date", "graduation_date",
        "years_enrolled", "status",
    )


def dim_student(
    students: DataFrame,
    departments: DataFrame | None,
    as_of,
    existing: DataFrame | None = None,
    stamp=None,
    numbering: keys.Numbering | None = None,
) -> DataFrame:
    """Next state of the versioned student dimension (``existing`` may be its current rows alone).

    ``numbering`` remembers the key of each version, by student and first day.
    """
    snapshot = student_snapshot(students, departments, as_of)
    stamp = stamp or f"{as_of} 00:00:00"
    if existing is None:
        first = scd2.first_versions(snapshot, as_of, stamp)
        return keys.assign_keys(first, ["student_id"] if numbering is None else VERSION_KEYS, "student_key", numbering)
    if numbering is None:
        return scd2.merge_versions_with_keys(existing, snapshot, ["student_id"], TRACKED, as_of, "student_key", stamp)
    return numbering.fill(scd2.merge_versions(existing, snapshot, ["student_id"], TRACKED, as_of, stamp), VERSION_KEYS)


def dim_student_rebuilt(
    students: DataFrame, departments: DataFrame | None, as_of, stamp=None
) -> DataFrame:
    """Type-1 rebuild: one version per student, calendar ages, the shorter region lists."""
    snapshot = student_snapshot(students, departments, as_of, calendar_years=True, short_regions=True)
    stamp = stamp or f"{as_of} 00:00:00"
    return keys.assign_keys(scd2.first_versions(snapshot, as_of, stamp), ["student_id"], "student_key")


# --- gold: facts -------------------------------------------------------------

ENROLLMENT_KEYS = ["student_key", "course_key", "semester_key"]
TUITION_KEYS = ["student_key", "semester_key"]


def enrollment_lookups(
    enrollments: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    semesters: DataFrame,
    calendar: DataFrame | None = None,
    days: tuple[str, str] = CALENDAR,
) -> DataFrame:
    """Valid enrolments with their dimension keys; keys that were not found are NULL."""
    rows = lookup.lookup_key(layout.valid_rows(enrollments), layout.current_rows(students), "student_id", "student_key")
    rows = lookup.lookup_key(rows, courses, "course_id", "course_key")
    rows = lookup.lookup_key(rows, semesters, "semester_id", "semester_key")
    return lookup.lookup_date_key(rows, "enrollment_date", "enrollment_date_key", calendar, *days)


def fact_enrollment(
    enrollments: DataFrame,
    students: DataFrame,
    courses: DataFrame,
    semesters: DataFrame,
    calendar: DataFrame | None = None,
    days: tuple[str, str] = CALENDAR,
    passing_score: float = PASSING_SCORE,
    unknown_score_passes: bool | None = False,
    stamp=None,
    seen: Observation | None = None,
) -> DataFrame:
    """Enrolments with dimension keys; rows lacking a student, course or semester are dropped.

    ``unknown_score_passes=None`` keeps is_passed NULL for a missing score; ``seen`` counts the
    dropped rows per missing key while the facts are written.
    """
    rows = lookup.resolved(
        enrollment_lookups(enrollments, students, courses, semesters, calendar, days), ENROLLMENT_KEYS, seen
    )
    sessions = F.col("attendance_count") + F.col("absence_count")
    rows = rows.select(
        "enrollment_id", *ENROLLMENT_KEYS, "enrollment_date_key", "midterm_score", "final_score", "total_score",
        "grade_letter",
        F.coalesce(F.col("gpa_points"), score_points(F.col("total_score"))).cast("decimal(3,2)").alias("gpa_points"),
        values.reaches(F.col("total_score"), passing_score, unknown_score_passes).alias("is_passed"),
        "status", "attendance_count", "absence_count",
        F.coalesce(
            F.col("attendance_rate"), values.percentage(F.col("attendance_count"), sessions).cast("decimal(5,2)")
        ).alias("attendance_rate"),
    )
    return layout.with_audit(rows, stamp, updated=False)


def fact_enrollment_merged(
    existing: DataFrame, enrollments: DataFrame, students: DataFrame, courses: DataFrame, semesters: DataFrame, **options
) -> DataFrame:
    """``existing`` facts brought up to date with ``enrollments``.

    Enrolments updated since the newest load are put in or replaced, and leave the facts if
    they no longer count.  Enrolments without a fact are tried again on every run, so one
    whose student, course or semester arrives late is taken in then.
    """
    mark = merge.high_water_mark(existing, "created_at", enrollments.schema["updated_at"].dataType)
    known = existing.select(F.col("enrollment_id").alias("__known")).distinct()
    # one pass over the enrolments: those without a fact, and those updated since
    paired = enrollments.join(known, F.col("enrollment_id") == F.col("__known"), "left").withColumn("__loaded", mark)
    open_rows = paired.where(F.col("__known").isNull() | (F.col("updated_at") > F.col("__loaded"))).drop("__loaded")
    open_rows = stage(open_rows, "open-enrollments")
    # staged by itself: few ids mean that the facts stay where they are
    replaced = stage(open_rows.where("__known IS NOT NULL").select("enrollment_id"), "replaced-facts")
    facts = fact_enrollment(open_rows.drop("__known"), students, courses, semesters, **options)
    kept = existing.join(replaced, "enrollment_id", "left_anti").select(*existing.columns)
    # used by the check and by the union, so computed once
    facts = dedup.assert_unique(stage(facts, "fresh-facts"), ["enrollment_id"], "updates")
    return kept.unionByName(facts, allowMissingColumns=True)


def fact_tuition(
    tuition: DataFrame,
    students: DataFrame,
    semesters: DataFrame,
    calendar: DataFrame | None = None,
    days: tuple[str, str] = CALENDAR,
    stamp=None,
    seen: Observation | None = None,
) -> DataFrame:
    """Payments with dimension keys; rows lacking a student or semester are dropped, and counted by ``seen``."""
    rows = lookup.lookup_key(layout.valid_rows(tuition), layout.current_rows(students), "student_id", "student_key")
    rows = lookup.lookup_key(rows, semesters, "semester_id", "semester_key")
    rows = lookup.lookup_date_key(rows, "payment_date", "payment_date_key", calendar, *days)
    rows = layout.copy_columns(
        lookup.resolved(rows, TUITION_KEYS, seen), {"remaining_amount": "balance_amount", "payment_status": "status"}
    ).withColumn("is_fully_paid", values.stays_within(F.col("balance_amount"), 0))
    rows = rows.select(
        "transaction_id", *TUITION_KEYS, "payment_date_key", "tuition_amount", "scholarship_amount",
        "discount_amount", "net_amount", "paid_amount", "remaining_amount", "payment_method", "payment_status",
        "is_fully_paid",
    )
    return layout.with_audit(rows, stamp, updated=False)


# --- quality suites ----------------------------------------------------------
# The limits, value lists and tolerances are fixed values of the declared checks.


def bronze_student_checks(rows: tuple[int | None, int | None] = (1, 1_000_000)) -> list[quality.Check]:
    return [
        quality.row_count(*rows),
        *[quality.column_exists(c) for c in ("student_id", "first_name", "last_name", "email")],
        quality.not_null("student_id"),
        quality.unique("student_id"),
        quality.matches_pattern("email", EMAIL_PATTERN, 0.95),
        quality.in_set("gender", ["M", "F", "Male", "Female", "NAM", "NỮ", "NU", "Other", None], 0.99),
        quality.in_range("cohort_year", 2000, 2030, 0.99),
    ]


def silver_checks(
    entity: str, as_of, student_rows: tuple[int | None, int | None] = (100, 1_000_000)
) -> list[quality.Check]:
    """Checks of one silver table; entities without declared checks have none."""
    if entity == "students":
        return [
            quality.row_count(*student_rows),
            quality.fresh("updated_at", as_of, 48),
            quality.unique("student_id"),
            *[quality.not_null(c) for c in ("student_id", "full_name", "email")],
            quality.not_null("date_of_birth", 0.05),
            quality.not_null("phone", 0.20),
            quality.matches_pattern("email", EMAIL_PATTERN),
            quality.in_set("status", [*STATUSES, STATUS_DEFAULT], 0.99),
            quality.in_set("gender", [*GENDERS, GENDER_DEFAULT], 0.99),
            quality.min_between("cohort_year", 2000),
            quality.max_between("cohort_year", high=2030),
            quality.failed_rows(~F.col("is_valid"), 5, "invalid_rows", ["is_valid"]),
        ]
    if entity == "enrollments":
        scores = ("midterm_score", "final_score", "total_score")
        return [
            quality.row_count(1),
            quality.fresh("updated_at", as_of, 48),
            quality.unique("enrollment_id"),
            *[quality.not_null(c) for c in ("enrollment_id", "student_id", "course_id", "semester_id")],
            *[quality.min_between(c, 0) for c in scores],
            *[quality.max_between(c, high=10) for c in scores],
            quality.in_set("grade_letter", ["A", "B+", "B", "C+", "C", "D+", "D", "F", None], 0.99),
            quality.min_between("gpa_points", 0),
            quality.max_between("gpa_points", high=4.0),
            quality.min_between("attendance_count", 0),
            quality.min_between("absence_count", 0),
            quality.avg_between("attendance_rate", 0, 100),
        ]
    if entity == "courses":
        return [
            quality.unique("course_id"),
            quality.not_null("course_id"),
            quality.not_null("course_name"),
            quality.min_between("credits", 1),
            quality.max_between("credits", high=10),
        ]
    return []


def dimension_checks(key: str, natural_key: str) -> list[quality.Check]:
    """Keys present and unique; a natural key held twice would multiply facts."""
    return [quality.not_null(key), quality.unique(key), quality.unique(natural_key)]


def fact_checks(
    fact: str, students: DataFrame, semesters: DataFrame, courses: DataFrame | None = None
) -> list[quality.Check]:
    """Foreign keys and row identity of a fact table."""
    identity = "enrollment_id" if fact == "fact_enrollment" else "transaction_id"
    checks = [
        quality.not_null(identity),
        quality.unique(identity),
        quality.references("student_key", students, "student_key"),
        quality.references("semester_key", semesters, "semester_key"),
    ]
    if courses is not None:
        checks.append(quality.references("course_key", courses, "course_key"))
    return checks
