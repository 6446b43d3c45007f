"""Silver tables, dimensions, facts and marts of the domain pack over the stand-in feeds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue import standins
from catalogue.registry import Tables, cte, query, with_ctes
from catalogue.scalars import mean, pct
from catalogue.standins import AS_OF, DAYS, STAMP
from starbuild.operators import calendar, dedup, keys, lookup, marts
from starbuild.plans import university as uni
from starbuild.sources.lake import row_id

_EMAIL_OK = f"coalesce(regexp_matches(lower(trim(email)), '{uni.EMAIL_PATTERN}'), false)"

cte(
    "s_students",
    f"""
SELECT student_id, nullif(trim(first_name), '') || ' ' || nullif(trim(last_name), '') AS full_name,
  try_cast(date_of_birth AS date) AS date_of_birth,
  CASE WHEN upper(gender) IN ('M', 'MALE', 'NAM') THEN 'Male' WHEN upper(gender) IN ('F', 'FEMALE', 'NỮ', 'NU')
    THEN 'Female' ELSE 'Other' END AS gender,
  lower(trim(email)) AS email, regexp_replace(phone, '[^0-9+]', '', 'g') AS phone, address,
  nullif(trim(city), '') AS city, nullif(trim(province), '') AS province, cohort_year, department_id,
  try_cast(enrollment_date AS date) AS enrollment_date, try_cast(graduation_date AS date) AS graduation_date,
  CASE upper(status) WHEN 'ENROLLED' THEN 'Active' WHEN 'TỐT NGHIỆP' THEN 'Graduated' WHEN 'BỎ HỌC' THEN 'Dropped'
    WHEN 'SUSPENDED' THEN 'Suspended' ELSE 'Unknown' END AS status,
  student_id IS NOT NULL AND {_EMAIL_OK} AS is_valid,
  CASE WHEN student_id IS NULL THEN 'Missing student_id' WHEN NOT {_EMAIL_OK} THEN 'Invalid email format'
    ELSE '' END AS validation_errors
FROM b_students""",
    "b_students",
)
cte(
    "s_departments",
    """
SELECT department_id, trim(department_name) AS department_name, trim(faculty) AS faculty, trim(dean_name) AS dean_name,
  established_year, department_id IS NOT NULL AND department_name IS NOT NULL AS is_valid,
  CASE WHEN department_id IS NULL THEN 'Missing department_id' WHEN department_name IS NULL
    THEN 'Missing department_name' ELSE '' END AS validation_errors
FROM b_departments""",
    "b_departments",
)
cte(
    "s_courses",
    """
SELECT course_id, trim(course_name) AS course_name, trim(course_description) AS course_description, credits,
  department_id, trim(course_level) AS course_level, trim(course_type) AS course_type, is_active,
  course_id IS NOT NULL AND course_name IS NOT NULL AND credits IS NOT NULL AS is_valid,
  CASE WHEN course_id IS NULL THEN 'Missing course_id' WHEN course_name IS NULL THEN 'Missing course_name'
    WHEN credits IS NULL THEN 'Missing credits' ELSE '' END AS validation_errors
FROM b_courses""",
    "b_courses",
)
cte(
    "s_semesters",
    """
SELECT semester_id, semester_name, academic_year, semester_number, try_cast(start_date AS date) AS start_date,
  try_cast(end_date AS date) AS end_date, is_current, try_cast(start_date AS date) IS NOT NULL AS is_valid,
  CASE WHEN try_cast(start_date AS date) IS NULL THEN 'Missing start_date' ELSE '' END AS validation_errors
FROM b_semesters""",
    "b_semesters",
)
cte(
    "s_enrollments",
    f"""
SELECT * EXCLUDE (rn, _ingested_at) FROM (
  SELECT enrollment_id, student_id, course_id, semester_id, try_cast(enrollment_date AS date) AS enrollment_date,
    midterm_score, final_score, total_score, grade_letter,
    CASE grade_letter WHEN 'A' THEN 4.0 WHEN 'B+' THEN 3.3 WHEN 'B' THEN 3.0 WHEN 'C' THEN 2.0 WHEN 'D' THEN 1.0
      WHEN 'D+' THEN 0.0 WHEN 'F' THEN 0.0 END AS gpa_points,
    status, attendance_count, absence_count, {pct("attendance_count", "attendance_count + absence_count")} AS attendance_rate,
    enrollment_id IS NOT NULL AND student_id IS NOT NULL AND course_id IS NOT NULL AS is_valid,
    CASE WHEN enrollment_id IS NULL THEN 'Missing enrollment_id' WHEN student_id IS NULL THEN 'Missing student_id'
      WHEN course_id IS NULL THEN 'Missing course_id' ELSE '' END AS validation_errors, _ingested_at,
    row_number() OVER (PARTITION BY enrollment_id ORDER BY _ingested_at DESC NULLS LAST,
      midterm_score DESC NULLS LAST, attendance_count DESC NULLS LAST, absence_count DESC NULLS LAST,
      course_id DESC NULLS LAST, student_id DESC NULLS LAST, status DESC NULLS LAST) AS rn
  FROM b_enrollments) x WHERE rn = 1 OR enrollment_id IS NULL""",
    "b_enrollments",
)
cte(
    "s_tuition",
    f"""
SELECT transaction_id, student_id, semester_id, tuition_amount, scholarship_amount, discount_amount, total_discount,
  net_amount, paid_amount, net_amount - paid_amount AS balance_amount, try_cast(payment_date AS date) AS payment_date,
  payment_method, {pct("paid_amount", "cast(net_amount AS double)")} AS payment_ratio, status,
  transaction_id IS NOT NULL AND student_id IS NOT NULL AND coalesce(net_amount >= 0, false) AS is_valid,
  CASE WHEN transaction_id IS NULL THEN 'Missing transaction_id' WHEN student_id IS NULL THEN 'Missing student_id' WHEN coalesce(net_amount >= 0, false) THEN ''
    ELSE 'Negative net amount' END AS validation_errors
FROM (SELECT *, tuition_amount - total_discount AS net_amount FROM (
  SELECT *, coalesce(scholarship_amount, 0) + coalesce(discount_amount, 0) AS total_discount FROM b_tuition) a) b""",
    "b_tuition",
)

_TIES = {"enrollments": standins.ENROLLMENT_TIES}


def silver(t: Tables, name: str) -> DataFrame:
    return uni.silver(getattr(standins, name)(t), uni.ENTITIES[name], STAMP, _TIES.get(name))


def _silver_sql(name: str) -> str:
    """Select list of a silver table in plain types."""
    out = []
    for f in uni.ENTITIES[name].silver:
        kind = f.dataType.typeName()
        cast = {"date": "varchar", "decimal": "double", "integer": "bigint"}.get(kind)
        out.append(f"cast({f.name} AS {cast}) AS {f.name}" if cast else f.name)
    stamps = [f"'{STAMP}' AS created_at", f"'{STAMP}' AS updated_at"]
    return with_ctes(f"SELECT {', '.join(out + stamps)} FROM s_{name}", f"s_{name}")


for _name, _ops in (
    ("students", "V1 W1 P2 P3 P5 I12"),
    ("courses", "V2"),
    ("enrollments", "V3 W1"),
    ("tuition", "V4"),
    ("semesters", "V5"),
    ("departments", "V6"),
):
    query(f"silver_{_name}", _ops, _silver_sql(_name))(lambda t, n=_name: silver(t, n))


@query(
    "silver_unchecked",
    "P6",
    with_ctes(
        """
SELECT course_id, course_name, course_description, cast(credits AS bigint) AS credits, department_id, course_level,
  course_type, is_active, true AS is_valid, '' AS validation_errors FROM s_courses""",
        "s_courses",
    ),
)
def silver_unchecked(t: Tables):
    return uni.unchecked_silver(standins.courses(t), uni.COURSES, STAMP).drop("created_at", "updated_at")


@query(
    "staging_students",
    "P7 F1",
    with_ctes(
        """
SELECT student_id, full_name, cast(date_of_birth AS varchar) AS date_of_birth, gender, email, phone, address, city,
  province, cast(cohort_year AS bigint) AS cohort_year, department_id, cast(enrollment_date AS varchar) AS enrollment_date,
  cast(graduation_date AS varchar) AS graduation_date, status FROM s_students WHERE is_valid""",
        "s_students",
    ),
)
def staging_students(t: Tables):
    return uni.staging_view(silver(t, "students"), uni.STUDENTS).drop("created_at", "updated_at")


@query(
    "staging_enrollments",
    "P7 F1",
    with_ctes(
        """
SELECT enrollment_id, student_id, course_id, semester_id, cast(enrollment_date AS varchar) AS enrollment_date,
  cast(midterm_score AS double) AS midterm_score, cast(final_score AS double) AS final_score,
  cast(total_score AS double) AS total_score, grade_letter, cast(gpa_points AS double) AS gpa_points, status,
  cast(attendance_count AS bigint) AS attendance_count, cast(absence_count AS bigint) AS absence_count,
  attendance_rate FROM s_enrollments WHERE is_valid""",
        "s_enrollments",
    ),
)
def staging_enrollments(t: Tables):
    return uni.staging_view(silver(t, "enrollments"), uni.ENROLLMENTS).drop("created_at", "updated_at")


# -- dimensions ---------------------------------------------------------------

cte(
    "g_department",
    """
SELECT row_number() OVER (ORDER BY department_id) AS department_key, department_id, department_name, faculty, dean_name,
  established_year, 2002 - established_year AS department_age FROM s_departments WHERE is_valid""",
    "s_departments",
)
cte(
    "g_semester",
    """
SELECT row_number() OVER (ORDER BY semester_id) AS semester_key, semester_id, semester_name, academic_year,
  semester_number, start_date, end_date, floor(date_diff('day', start_date, end_date) / 7.0) AS duration_weeks, is_current
FROM s_semesters WHERE is_valid""",
    "s_semesters",
)
cte(
    "g_course",
    """
SELECT row_number() OVER (ORDER BY course_id) AS course_key, course_id, course_name, course_description, credits,
  CASE WHEN credits < 3 THEN 'Light' WHEN credits = 3 THEN 'Standard' ELSE 'Heavy' END AS credit_category,
  department_key, course_level, course_type, is_active
FROM s_courses c LEFT JOIN g_department d ON c.department_id = d.department_id WHERE c.is_valid""",
    "s_courses",
    "g_department",
)


def _student_cte(name: str, age: str, years: str, regions: str) -> None:
    cte(
        name,
        f"""
SELECT row_number() OVER (ORDER BY student_id) AS student_key, student_id, full_name, date_of_birth,
  CASE WHEN {age} < 20 THEN 'Under 20' WHEN {age} < 25 THEN '20-24' WHEN {age} < 30 THEN '25-29'
    WHEN {age} < 35 THEN '30-34' ELSE '35+' END AS age_group,
  gender, email, phone, address, city, province, CASE {regions} ELSE 'Khác' END AS region, cohort_year, department_key,
  enrollment_date, graduation_date, {years} AS years_enrolled, status
FROM s_students s LEFT JOIN g_department d ON s.department_id = d.department_id WHERE s.is_valid""",
        "s_students",
        "g_department",
    )


_ENDED = f"coalesce(graduation_date, DATE '{AS_OF}')"
_student_cte(
    "g_student",
    f"date_diff('day', date_of_birth, DATE '{AS_OF}') / 365.0",
    f"floor(date_diff('day', enrollment_date, {_ENDED}) / 365.0)",
    "WHEN province IN ('Hà Nội') THEN 'Miền Bắc' WHEN province IN ('Huế', 'Nghệ An', 'Quảng Bình') THEN 'Miền Trung' "
    "WHEN province = 'TP HCM' THEN 'Miền Nam'",
)
_student_cte(
    "g_student_rebuilt",
    f"extract(year FROM age(DATE '{AS_OF}', date_of_birth))",
    f"extract(year FROM age({_ENDED}, enrollment_date))",
    "WHEN province IN ('Hà Nội') THEN 'Miền Bắc' WHEN province IN ('Huế', 'Nghệ An') THEN 'Miền Trung' "
    "WHEN province = 'TP HCM' THEN 'Miền Nam'",
)

_STUDENT_OUT = """student_key, student_id, full_name, cast(date_of_birth AS varchar) AS date_of_birth, age_group, gender,
  email, phone, address, city, province, region, cast(cohort_year AS bigint) AS cohort_year, department_key,
  cast(enrollment_date AS varchar) AS enrollment_date, cast(graduation_date AS varchar) AS graduation_date,
  cast(years_enrolled AS bigint) AS years_enrolled, status"""


def departments(t: Tables) -> DataFrame:
    return t.once(
        "dim_department", lambda t: uni.dim_department(silver(t, "departments"), AS_OF, stamp=STAMP)
    )


def semesters(t: Tables) -> DataFrame:
    return uni.dim_semester(silver(t, "semesters"), stamp=STAMP)


def courses(t: Tables) -> DataFrame:
    return uni.dim_course(silver(t, "courses"), departments(t), stamp=STAMP)


def students(t: Tables) -> DataFrame:
    return t.once("dim_student", lambda t: uni.dim_student(silver(t, "students"), departments(t), AS_OF))


@query(
    "dim_department",
    "D3 D10 D2",
    with_ctes(
        """
SELECT department_key, department_id, department_name, faculty, dean_name, cast(established_year AS bigint) AS established_year,
  cast(department_age AS bigint) AS department_age FROM g_department""",
        "g_department",
    ),
)
def dim_department(t: Tables):
    return departments(t).drop("created_at", "updated_at")


@query(
    "dim_semester",
    "D4 C15",
    with_ctes(
        """
SELECT semester_key, semester_id, semester_name, cast(academic_year AS bigint) AS academic_year,
  cast(semester_number AS bigint) AS semester_number, cast(start_date AS varchar) AS start_date,
  cast(end_date AS varchar) AS end_date, cast(duration_weeks AS bigint) AS duration_weeks, is_current FROM g_semester""",
        "g_semester",
    ),
)
def dim_semester(t: Tables):
    return semesters(t).drop("created_at", "updated_at")


@query(
    "dim_course",
    "D5 D9 C22 J1",
    with_ctes(
        """
SELECT course_key, course_id, course_name, course_description, cast(credits AS bigint) AS credits, credit_category,
  department_key, course_level, course_type, is_active FROM g_course""",
        "g_course",
    ),
)
def dim_course(t: Tables):
    return courses(t).drop("created_at", "updated_at")


@query(
    "dim_student",
    "D6 D7 C8 C11 C13",
    with_ctes(
        f"SELECT {_STUDENT_OUT}, '{AS_OF}' AS effective_start_date, cast(NULL AS varchar) AS effective_end_date, "
        "true AS is_current FROM g_student",
        "g_student",
    ),
)
def dim_student(t: Tables):
    return students(t).drop("created_at", "updated_at")


@query(
    "dim_student_rebuilt",
    "D15 C14 C8",
    with_ctes(
        f"SELECT {_STUDENT_OUT}, '{AS_OF}' AS effective_start_date, cast(NULL AS varchar) AS effective_end_date, "
        "true AS is_current FROM g_student_rebuilt",
        "g_student_rebuilt",
    ),
)
def dim_student_rebuilt(t: Tables):
    rebuilt = uni.dim_student_rebuilt(silver(t, "students"), departments(t), AS_OF)
    return rebuilt.drop("created_at", "updated_at")


# -- keys and lookups ---------------------------------------------------------


@query(
    "surrogate_keys",
    "D2",
    "SELECT row_number() OVER (ORDER BY c_name) AS customer_key, c_name, c_custkey FROM customer",
)
def surrogate_keys(t: Tables):
    return keys.assign_keys(t.customer.select("c_name", "c_custkey"), ["c_name"], "customer_key")


@query(
    "surrogate_keys_incremental",
    "D2",
    """
WITH old AS (SELECT o_custkey, row_number() OVER (ORDER BY o_custkey) AS customer_key FROM (
    SELECT DISTINCT o_custkey FROM orders WHERE o_orderdate < DATE '1995-07-01' AND o_custkey IS NOT NULL) a),
now AS (SELECT o_custkey, count(*) AS order_count FROM orders WHERE o_custkey IS NOT NULL GROUP BY o_custkey)
SELECT coalesce(customer_key, (SELECT max(customer_key) FROM old) +
    row_number() OVER (PARTITION BY customer_key IS NULL ORDER BY now.o_custkey)) AS customer_key,
  now.o_custkey, order_count FROM now LEFT JOIN old ON now.o_custkey = old.o_custkey""",
)
def surrogate_keys_incremental(t: Tables):
    known = t.orders.where(F.col("o_custkey").isNotNull())
    early = known.where(F.col("o_orderdate") < F.lit("1995-07-01").cast("date")).select("o_custkey").distinct()
    existing = keys.assign_keys(early, ["o_custkey"], "customer_key")
    now = known.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("order_count"))
    return keys.assign_keys(now, ["o_custkey"], "customer_key", existing)


_LOOKUP_SQL = """
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_partkey, l_suppkey, l_quantity, p_partkey * 10 AS part_key,
  s_suppkey + 1000 AS supplier_key
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN NULL WHEN l_linenumber = 1 THEN -1 ELSE l_partkey END AS pk FROM lineitem) l
LEFT JOIN part ON pk = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0"""


def _lines(t: Tables) -> DataFrame:
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
        F.expr("case when l_returnflag = 'R' then null when l_linenumber = 1 then -1 else l_partkey end").alias("pk"),
    )


def _part_dim(t: Tables) -> DataFrame:
    return t.part.select("p_partkey", (F.col("p_partkey") * 10).alias("part_key"))


def _supplier_dim(t: Tables) -> DataFrame:
    return t.supplier.where(F.col("s_acctbal") > 0).select(
        "s_suppkey", (F.col("s_suppkey") + 1000).alias("supplier_key")
    )


def _keyed_lines(t: Tables) -> DataFrame:
    lines = lookup.lookup_key(_lines(t), _part_dim(t), {"pk": "p_partkey"}, "part_key")
    return lookup.lookup_key(lines, _supplier_dim(t), {"l_suppkey": "s_suppkey"}, "supplier_key")


@query("lookup_keys", "J1 J8 F2", _LOOKUP_SQL)
def lookup_keys(t: Tables):
    return _keyed_lines(t).drop("pk")


@query("lookup_keys_hot_values", "J1", _LOOKUP_SQL)
def lookup_keys_hot_values(t: Tables):
    lines = lookup.lookup_key_skewed(_lines(t), _part_dim(t), {"pk": "p_partkey"}, "part_key", share=0.01)
    return lookup.lookup_key(lines, _supplier_dim(t), {"l_suppkey": "s_suppkey"}, "supplier_key").drop("pk")


@query(
    "lookup_without_dimension",
    "J3",
    "SELECT cast(n_nationkey AS bigint) AS n_nationkey, n_name, cast(NULL AS bigint) AS department_key FROM nation",
)
def lookup_without_dimension(t: Tables):
    return lookup.lookup_key(t.nation, None, "n_nationkey", "department_key").drop("n_regionkey")


@query("resolved_rows", "F3 F6", f"SELECT * FROM ({_LOOKUP_SQL}) x WHERE part_key IS NOT NULL AND supplier_key IS NOT NULL")
def resolved_rows(t: Tables):
    return lookup.resolved(_keyed_lines(t), ["part_key", "supplier_key"]).drop("pk")


@query(
    "missing_key_counts",
    "F4 A7",
    f"""
SELECT count(*) AS total_rows, count(*) - count(part_key) AS missing_part_key,
  count(*) - count(supplier_key) AS missing_supplier_key,
  count(*) FILTER (WHERE part_key IS NULL OR supplier_key IS NULL) AS dropped_rows FROM ({_LOOKUP_SQL}) x""",
)
def missing_key_counts(t: Tables):
    return lookup.unresolved_counts(_keyed_lines(t), ["part_key", "supplier_key"])


_DATE_KEY_SQL = """
SELECT o_orderkey, cast(CASE WHEN o_orderdate >= DATE '1996-01-01' AND o_orderdate < DATE '2001-01-01'
  THEN strftime(o_orderdate, '%Y%m%d') END AS bigint) AS order_date_key FROM orders"""


@query("date_key_computed", "J2 C24 P4", _DATE_KEY_SQL)
def date_key_computed(t: Tables):
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
    keyed = lookup.lookup_date_key(days, "order_day", "order_date_key", first="1996-01-01", last="2000-12-31")
    return keyed.drop("order_day")


@query("date_key_lookup", "J2 D1", _DATE_KEY_SQL)
def date_key_lookup(t: Tables):
    days = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("order_day"))
    dim = calendar.date_dimension(t.spark, "1996-01-01", "2000-12-31")
    return lookup.lookup_date_key(days, "order_day", "order_date_key", dim).drop("order_day")


_DAY_COLUMNS = """
  year(d) * 10000 + month(d) * 100 + day(d) AS date_key, cast(d AS varchar) AS full_date, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name, week(d) AS week, day(d) AS day,
  strftime(d, '%A') AS day_name, dayofweek(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
  cast(CASE WHEN month(d) >= 10 THEN 2 WHEN month(d) >= 7 THEN 1 WHEN month(d) >= 4 THEN 4 ELSE 3 END AS bigint) AS fiscal_quarter"""


@query(
    "date_dimension",
    "D1 C23 C24",
    f"""
SELECT {_DAY_COLUMNS}, h.d2 IS NOT NULL AS is_holiday
FROM (SELECT cast(unnest(generate_series((SELECT min(o_orderdate) FROM orders)::timestamp,
    (SELECT max(o_orderdate) FROM orders)::timestamp, INTERVAL 1 DAY)) AS date) AS d) x
LEFT JOIN (SELECT DISTINCT cast(o_orderdate AS date) AS d2 FROM orders WHERE o_totalprice > 400000) h ON d = d2""",
)
def date_dimension(t: Tables):
    busy = t.orders.where(F.col("o_totalprice") > 400000).select(F.col("o_orderdate").cast("date").alias("full_date"))
    return calendar.date_dimension_of(t.orders, "o_orderdate", busy)


@query(
    "date_dimension_extended",
    "D1",
    f"""
SELECT {_DAY_COLUMNS}, false AS is_holiday
FROM (SELECT cast(o_orderdate AS date) AS d FROM orders UNION SELECT cast(l_shipdate AS date) FROM lineitem) x""",
)
def date_dimension_extended(t: Tables):
    ordered = t.orders.select(F.col("o_orderdate").cast("date").alias("full_date")).distinct()
    shipped = t.lineitem.select(F.col("l_shipdate").cast("date").alias("full_date")).distinct()
    return calendar.add_dates(shipped, existing=calendar.describe_dates(ordered))


# -- duplicates ---------------------------------------------------------------

_LINE_COLUMNS = "l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice"


@query(
    "dedup_latest",
    "W1",
    f"""
SELECT * REPLACE (cast(l_linenumber AS bigint) AS l_linenumber) FROM (SELECT {_LINE_COLUMNS}, cast(l_shipdate AS varchar) AS l_shipdate FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_extendedprice DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC) AS rn FROM lineitem) x WHERE rn = 1) y""",
)
def dedup_latest(t: Tables):
    latest = dedup.keep_latest(
        t.lineitem.select("*", row_id()), ["l_orderkey", "l_linenumber"], ["l_shipdate"],
        ["l_extendedprice", "l_partkey", "l_suppkey", "l_quantity"], row_id=["_row"],
    )
    return latest.select(*_LINE_COLUMNS.split(", "), "l_shipdate")


@query(
    "dedup_latest_aggregate",
    "W2",
    """
SELECT event_id, user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) x
WHERE rn = 1""",
)
def dedup_latest_aggregate(t: Tables):
    latest = dedup.keep_latest_by_aggregate(t.events, ["user_id", "event_type"], ["ts"], ["event_id"])
    return latest.select("event_id", "user_id", "event_type", "value")


@query(
    "dedup_null_keys",
    "W1",
    """
SELECT event_id, who, event_type FROM (
  SELECT *, row_number() OVER (PARTITION BY who ORDER BY ts DESC, event_id DESC) AS rn FROM (
    SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE user_id END AS who FROM events) y) x
WHERE rn = 1 OR who IS NULL""",
)
def dedup_null_keys(t: Tables):
    events = t.events.select("*", row_id()).withColumn("who", F.when(F.col("event_type") != "error", F.col("user_id")))
    return dedup.keep_latest(events, ["who"], ["ts"], ["event_id"], row_id=["_row"]).select("event_id", "who", "event_type")


# -- facts --------------------------------------------------------------------

_DAY_KEY = "cast(CASE WHEN {0} BETWEEN DATE '%s' AND DATE '%s' THEN strftime({0}, '%%Y%%m%%d') END AS bigint)" % DAYS
_SCORE_POINTS = (
    "CASE WHEN total_score >= 8.5 THEN 4.0 WHEN total_score >= 7 THEN 3.0 WHEN total_score >= 5.5 THEN 2.0 "
    "WHEN total_score >= 4 THEN 1.0 ELSE 0.0 END"
)
cte(
    "f_enrollment",
    f"""
SELECT enrollment_id, student_key, course_key, semester_key, {_DAY_KEY.format("e.enrollment_date")} AS enrollment_date_key,
  cast(midterm_score AS double) AS midterm_score, cast(final_score AS double) AS final_score,
  cast(total_score AS double) AS total_score, grade_letter,
  cast(coalesce(gpa_points, {_SCORE_POINTS}) AS double) AS gpa_points, coalesce(total_score >= 5, false) AS is_passed,
  total_score >= 5 AS is_passed_or_unknown, e.status, cast(attendance_count AS bigint) AS attendance_count,
  cast(absence_count AS bigint) AS absence_count, attendance_rate
FROM s_enrollments e JOIN g_student s ON e.student_id = s.student_id JOIN g_course c ON e.course_id = c.course_id
JOIN g_semester m ON e.semester_id = m.semester_id WHERE e.is_valid""",
    "s_enrollments",
    "g_student",
    "g_course",
    "g_semester",
)
cte(
    "f_tuition",
    f"""
SELECT transaction_id, student_key, semester_key, {_DAY_KEY.format("payment_date")} AS payment_date_key,
  cast(tuition_amount AS double) AS tuition_amount, cast(scholarship_amount AS double) AS scholarship_amount,
  cast(discount_amount AS double) AS discount_amount, cast(net_amount AS double) AS net_amount,
  cast(paid_amount AS double) AS paid_amount, cast(balance_amount AS double) AS remaining_amount, payment_method,
  t.status AS payment_status, balance_amount <= 0 AS is_fully_paid
FROM s_tuition t JOIN g_student s ON t.student_id = s.student_id JOIN g_semester m ON t.semester_id = m.semester_id
WHERE t.is_valid""",
    "s_tuition",
    "g_student",
    "g_semester",
)


def enrollment_facts(t: Tables, student_dim: DataFrame | None = None, **options) -> DataFrame:
    return uni.fact_enrollment(
        silver(t, "enrollments"), student_dim or students(t), courses(t), semesters(t), days=DAYS, stamp=STAMP, **options
    )


def tuition_facts(t: Tables) -> DataFrame:
    return uni.fact_tuition(silver(t, "tuition"), students(t), semesters(t), days=DAYS, stamp=STAMP)


@query(
    "fact_enrollment",
    "D12 J1 J2 J8 C10 C16 C18 F3",
    with_ctes("SELECT * EXCLUDE (is_passed_or_unknown) FROM f_enrollment", "f_enrollment"),
)
def fact_enrollment(t: Tables):
    return enrollment_facts(t).drop("created_at")


@query(
    "fact_enrollment_unknown_kept",
    "D12 C18",
    with_ctes(
        "SELECT enrollment_id, student_key, gpa_points, is_passed_or_unknown AS is_passed FROM f_enrollment",
        "f_enrollment",
    ),
)
def fact_enrollment_unknown_kept(t: Tables):
    facts = enrollment_facts(t, unknown_score_passes=None)
    return facts.select("enrollment_id", "student_key", "gpa_points", "is_passed")


@query("fact_tuition", "D13 P4 C18", with_ctes("SELECT * FROM f_tuition", "f_tuition"))
def fact_tuition(t: Tables):
    return tuition_facts(t).drop("created_at")


# -- marts --------------------------------------------------------------------

_FLAG = "sum(CASE WHEN {} THEN 1 ELSE 0 END)"
_CORE = f"""semester_key, department_key, count(DISTINCT f.student_key) AS total_students, count(*) AS total_enrollments,
  {mean("gpa_points")} AS avg_gpa, {pct(_FLAG.format("is_passed"), "count(*)")} AS pass_rate,
  {pct(_FLAG.format("NOT is_passed"), "count(*)")} AS fail_rate, {mean("attendance_rate")} AS avg_attendance_rate"""


@query(
    "academic_mart",
    "A1 A6 J4",
    with_ctes(
        f"SELECT {_CORE} FROM f_enrollment f JOIN g_student s ON f.student_key = s.student_key "
        "GROUP BY semester_key, department_key",
        "f_enrollment",
    ),
)
def academic_mart(t: Tables):
    dim = students(t)
    return marts.academic_performance(enrollment_facts(t, dim), dim)


def extended_mart_sql(students: str) -> str:
    return with_ctes(
        f"""
SELECT {_CORE}, min(gpa_points) AS min_gpa, max(gpa_points) AS max_gpa,
  cast(round(cast(stddev_samp(gpa_points) AS decimal(20,10)), 2) AS double) AS stddev_gpa,
  count(*) FILTER (WHERE grade_letter = 'A') AS grade_a_count, count(*) FILTER (WHERE grade_letter = 'B') AS grade_b_count,
  count(*) FILTER (WHERE grade_letter = 'C') AS grade_c_count, count(*) FILTER (WHERE grade_letter = 'D') AS grade_d_count,
  count(*) FILTER (WHERE grade_letter = 'F') AS grade_f_count
FROM f_enrollment f LEFT JOIN {students} s ON f.student_key = s.student_key
GROUP BY semester_key, department_key""",
        "f_enrollment",
    )


@query("academic_mart_extended", "A2 J5", extended_mart_sql("(SELECT * FROM g_student WHERE status <> 'Dropped')"))
def academic_mart_extended(t: Tables):
    dim = students(t)
    known = dim.where(F.col("status") != "Dropped")
    return marts.academic_performance_extended(enrollment_facts(t, dim), known)


@query(
    "financial_mart",
    "A3",
    with_ctes(
        f"""
SELECT semester_key, cast(sum(cast(tuition_amount AS decimal(15,2))) AS double) AS total_tuition_expected,
  cast(sum(cast(scholarship_amount AS decimal(15,2))) AS double) AS total_scholarships,
  cast(sum(cast(discount_amount AS decimal(15,2))) AS double) AS total_discounts,
  cast(sum(cast(paid_amount AS decimal(15,2))) AS double) AS total_collected,
  cast(sum(cast(remaining_amount AS decimal(15,2))) AS double) AS total_outstanding,
  {pct("sum(cast(paid_amount AS decimal(15,2)))", "cast(sum(cast(net_amount AS decimal(15,2))) AS double)")} AS collection_rate,
  count(DISTINCT student_key) AS student_count, {mean("tuition_amount")} AS avg_tuition_per_student
FROM f_tuition GROUP BY semester_key""",
        "f_tuition",
    ),
)
def financial_mart(t: Tables):
    return marts.financial_summary(tuition_facts(t))


_COHORT = f"""cohort_year, department_key, count(*) AS initial_students,
  count(*) FILTER (WHERE status = 'Active') AS current_students, count(*) FILTER (WHERE status = 'Graduated') AS graduated_students,
  count(*) FILTER (WHERE status IN ('Dropped', 'Suspended')) AS dropped_students,
  {pct(_FLAG.format("status = 'Active'"), "count(*)")} AS retention_rate,
  {pct(_FLAG.format("status = 'Graduated'"), "count(*)")} AS graduation_rate,
  {mean("CASE WHEN status = 'Graduated' AND graduation_date IS NOT NULL THEN years_enrolled END", 1)} AS avg_years_to_graduate"""


@query(
    "cohort_mart",
    "A4 S1 F6",
    with_ctes(
        f"""
SELECT cast(c.cohort_year AS bigint) AS cohort_year, c.* EXCLUDE (cohort_year) FROM (
  SELECT {_COHORT}, CASE WHEN count(*) FILTER (WHERE status = 'Graduated') > 0 THEN 3.5::double END AS avg_graduate_gpa
  FROM g_student WHERE cohort_year IS NOT NULL GROUP BY cohort_year, department_key) c""",
        "g_student",
    ),
)
def cohort_mart(t: Tables):
    return marts.cohort_order(marts.cohort_analysis(students(t)))


@query(
    "cohort_mart_gpa",
    "A5",
    with_ctes(
        f"""
SELECT cast(c.cohort_year AS bigint) AS cohort_year, c.* EXCLUDE (cohort_year) FROM (
  SELECT {_COHORT}, {mean("CASE WHEN status = 'Graduated' THEN own END")} AS avg_cumulative_gpa
  FROM g_student s LEFT JOIN (SELECT student_key, {mean("gpa_points", 4)} AS own FROM f_enrollment GROUP BY student_key) g
    ON s.student_key = g.student_key
  WHERE cohort_year IS NOT NULL GROUP BY cohort_year, department_key) c""",
        "g_student",
        "f_enrollment",
    ),
)
def cohort_mart_gpa(t: Tables):
    dim = students(t)
    return marts.cohort_analysis(dim, enrollment_facts(t, dim))
