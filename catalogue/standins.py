"""University feeds made from the given tables, so that the domain pack runs on them whole.

students <- customer with its first and last order, departments <- nation and region,
courses <- part, semesters <- half-years of orders, enrollments <- lineitem and orders,
tuition <- orders.  The column expressions are plain SQL and serve both sides; they put
in the blanks, aliases, bad dates, bad addresses, zero denominators and missing keys that
the operators have to handle.  Some ids are missing, as are some references and dates, so the
rules on them fire.  ``_row`` tells rows apart by file and place, as in a bronze table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import Tables, cte
from starbuild.sources.lake import row_id

AS_OF = "2002-01-01"
STAMP = "2002-01-01 00:00:00"
INGESTED = "2001-12-31 00:00:00"
DAYS = ("1996-01-01", "2001-12-31")  # the calendar; orders before 1996 fall outside

_SEMESTER = "cast(year(o_orderdate) as string) || case when month(o_orderdate) <= 6 then 'S' else 'F' end"
_ORDER_DAY = "cast(cast(o_orderdate as date) as string)"

STUDENTS = {
    "student_id": "case when c_custkey % 211 <> 0 then 'SV' || cast(c_custkey as string) end",
    "first_name": "' ' || c_mktsegment || ' '",
    "last_name": "case when c_mktsegment = 'BUILDING' and c_acctbal < 1000 then '   ' else c_name end",
    "date_of_birth": "case when c_nationkey = 24 then '1980-13-01' else "
    "cast(cast(first_order as date) - (7000 + cast(floor(c_acctbal) as int) % 3000) as string) end",
    "gender": "case c_mktsegment when 'BUILDING' then 'm' when 'FURNITURE' then 'Nam' when 'MACHINERY' then 'nữ' "
    "when 'HOUSEHOLD' then 'FEMALE' else null end",
    "email": "case when c_acctbal < 0 then null when c_nationkey = 3 then 'not an address' "
    "else ' ' || replace(c_name, '#', '.') || '@Example.COM ' end",
    "phone": "'+84 (90) ' || cast(c_custkey as string) || '-' || cast(c_nationkey as string)",
    "address": "c_name",
    "city": "case when c_nationkey < 5 then ' city ' else '' end",
    "province": "case c_nationkey when 0 then 'Hà Nội' when 1 then 'Huế' when 2 then 'TP HCM' "
    "when 4 then ' Nghệ An ' when 5 then 'Quảng Bình' when 6 then 'Da Nang' when 7 then null else 'elsewhere' end",
    "cohort_year": "cast(year(first_order) as int)",
    "department_id": "'DEPT' || cast(c_nationkey as string)",
    "enrollment_date": "cast(cast(first_order as date) as string)",
    "status": "case c_mktsegment when 'BUILDING' then 'enrolled' when 'FURNITURE' then 'tốt nghiệp' "
    "when 'MACHINERY' then 'Bỏ học' when 'HOUSEHOLD' then 'Suspended' else '?' end",
    "graduation_date": "case when c_mktsegment = 'FURNITURE' and c_acctbal > 3000 "
    "then cast(cast(last_order as date) as string) end",
    "_ingested_at": f"timestamp '{INGESTED}'",
}
DEPARTMENTS = {
    "department_id": "'DEPT' || cast(n_nationkey as string)",
    "department_name": "case when n_nationkey = 20 then null else ' ' || n_name end",
    "faculty": "r_name || ' '",
    "dean_name": "cast(null as string)",
    "established_year": "1950 + n_nationkey",
    "_ingested_at": f"timestamp '{INGESTED}'",
}
COURSES = {
    "course_id": "'C' || cast(p_partkey as string)",
    "course_name": "' ' || p_name",
    "course_description": "p_type",
    "credits": "case when p_size = 50 then null else p_size % 6 end",
    "department_id": "'DEPT' || cast(p_partkey % 30 as string)",
    "course_level": "p_brand",
    "course_type": "p_type",
    "is_active": "p_retailprice < 1000",
    "_ingested_at": f"timestamp '{INGESTED}'",
}
SEMESTERS = {
    "semester_id": "sem",
    "semester_name": "'Term ' || sem",
    "academic_year": "cast(yr as int)",
    "semester_number": "half",
    "start_date": "case when yr = 1996 and half = 2 then 'unknown' "
    "else cast(yr as string) || case when half = 2 then '-02-01' else '-09-01' end end",
    "end_date": "case when half = 2 then cast(yr as string) || '-06-15' else cast(yr + 1 as string) || '-01-15' end",
    "is_current": "false",
    "_ingested_at": f"timestamp '{INGESTED}'",
}
ENROLLMENTS = {
    "enrollment_id": "case when l_linenumber <> 6 or l_quantity <> 7 "
    "then cast(l_orderkey as string) || '-' || cast(l_linenumber as string) end",
    "student_id": "case when l_linenumber <> 5 or l_quantity <> 8 then 'SV' || cast(o_custkey as string) end",
    "course_id": "case when l_linenumber <> 3 or l_quantity <> 9 then 'C' || cast(l_partkey as string) end",
    "semester_id": _SEMESTER,
    "enrollment_date": _ORDER_DAY,
    "midterm_score": "cast(l_quantity / 5 as decimal(5,2))",
    "final_score": "cast(l_quantity / 10 as decimal(5,2))",
    "total_score": "case when l_tax = 0 then null else cast(l_quantity / 5 as decimal(5,2)) end",
    "grade_letter": "case when l_discount = 0.05 then null when l_quantity >= 45 then 'A' when l_quantity >= 40 "
    "then 'B+' when l_quantity >= 30 then 'B' when l_quantity >= 25 then 'C' when l_quantity >= 20 then 'D+' "
    "when l_quantity >= 10 then 'D' else 'F' end",
    "status": "l_linestatus",
    "attendance_count": "cast(round(l_discount * 100) as int)",
    "absence_count": "cast(round(l_tax * 100) as int)",
    "_ingested_at": "cast(l_shipdate as timestamp)",
}
ENROLLMENT_TIES = ["midterm_score", "attendance_count", "absence_count", "course_id", "student_id", "status"]
TUITION = {
    "transaction_id": "case when o_orderkey % 97 <> 0 then cast(o_orderkey as string) end",
    "student_id": "'SV' || cast(o_custkey as string)",
    "semester_id": _SEMESTER,
    "tuition_amount": "cast(o_totalprice as decimal(15,2))",
    "scholarship_amount": "case o_orderpriority when '1-URGENT' then null when '2-HIGH' "
    "then cast(floor(o_totalprice / 10) as decimal(15,2)) else cast(0 as decimal(15,2)) end",
    "discount_amount": "case when o_orderpriority = '3-MEDIUM' then cast(floor(o_totalprice / 20) as decimal(15,2)) "
    "when o_orderpriority = '4-NOT SPECIFIED' and o_orderstatus = 'F' then cast(floor(o_totalprice) + 10 as decimal(15,2)) "
    "when o_orderpriority = '5-LOW' and o_orderstatus = 'P' then cast(o_totalprice as decimal(15,2)) "
    "else cast(0 as decimal(15,2)) end",
    "paid_amount": "case o_orderstatus when 'F' then cast(floor(o_totalprice) as decimal(15,2)) "
    "when 'P' then cast(floor(o_totalprice / 2) as decimal(15,2)) else cast(0 as decimal(15,2)) end",
    "payment_date": _ORDER_DAY,
    "payment_method": "o_orderpriority",
    "status": "o_orderstatus",
    "_ingested_at": "cast(o_orderdate as timestamp)",
}


def _columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.selectExpr(*[f"{e} AS {n}" for n, e in columns.items()], *["_row"] * ("_row" in df.columns))


def _with_row(df: DataFrame) -> DataFrame:
    return df.select("*", row_id())


def _select(columns: dict[str, str], source: str) -> str:
    return "SELECT " + ",\n  ".join(f"{e} AS {n}" for n, e in columns.items()) + f"\nFROM {source}"


def students(t: Tables) -> DataFrame:
    spans = t.orders.groupBy("o_custkey").agg(
        F.min("o_orderdate").alias("first_order"), F.max("o_orderdate").alias("last_order")
    )
    return _columns(_with_row(t.customer).join(spans, F.col("c_custkey") == F.col("o_custkey"), "left"), STUDENTS)


def departments(t: Tables) -> DataFrame:
    return _columns(t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")), DEPARTMENTS)


def courses(t: Tables) -> DataFrame:
    return _columns(t.part, COURSES)


def semesters(t: Tables) -> DataFrame:
    halves = t.orders.selectExpr(
        f"{_SEMESTER} AS sem", "year(o_orderdate) AS yr", "case when month(o_orderdate) <= 6 then 2 else 1 end AS half"
    ).distinct()
    return _columns(halves, SEMESTERS)


def enrollments(t: Tables) -> DataFrame:
    return _columns(_with_row(t.lineitem).join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")), ENROLLMENTS)


def tuition(t: Tables) -> DataFrame:
    return _columns(_with_row(t.orders), TUITION)


cte(
    "b_students",
    _select(
        STUDENTS,
        "customer LEFT JOIN (SELECT o_custkey, min(o_orderdate) AS first_order, max(o_orderdate) AS last_order "
        "FROM orders GROUP BY o_custkey) o ON c_custkey = o_custkey",
    ),
)
cte("b_departments", _select(DEPARTMENTS, "nation JOIN region ON n_regionkey = r_regionkey"))
cte("b_courses", _select(COURSES, "part"))
cte(
    "b_semesters",
    _select(
        SEMESTERS,
        f"(SELECT DISTINCT {_SEMESTER} AS sem, year(o_orderdate) AS yr, "
        "case when month(o_orderdate) <= 6 then 2 else 1 end AS half FROM orders) h",
    ),
)
cte("b_enrollments", _select(ENROLLMENTS, "lineitem JOIN orders ON l_orderkey = o_orderkey"))
cte("b_tuition", _select(TUITION, "orders"))
