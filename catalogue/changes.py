"""Versioned dimensions and incremental loads.

The versioned dimension follows customers through ``orders``: on any day a customer's
state is the priority and status of the latest order so far.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue.registry import Tables, cte, query, with_ctes
from catalogue.standins import DAYS, STAMP
from catalogue.warehouse import courses, semesters, silver, students
from starbuild.operators import dedup, keys, lookup, merge, scd2
from starbuild.operators.staging import new_path, stage
from starbuild.plans import university as uni
from starbuild.sources.lake import Lake

FIRST, SECOND, LATER = "1998-01-01", "2000-01-01", "2001-01-01"
NATURAL, TRACKED = ["customer_id"], ["last_priority", "last_status"]


def snapshot(t: Tables, day: str) -> DataFrame:
    """State of every customer that has ordered by ``day``."""
    so_far = t.orders.where(F.col("o_orderdate") <= F.lit(day).cast("date"))
    latest = dedup.keep_latest(so_far, ["o_custkey"], ["o_orderdate"], ["o_orderkey"], null_keys="drop")
    return latest.select(
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderpriority").alias("last_priority"),
        F.nullif("o_orderstatus", F.lit("P")).alias("last_status"),
        F.col("o_orderdate").cast("date").alias("last_order_day"),
    )


def first_dimension(t: Tables) -> DataFrame:
    versions = scd2.first_versions(snapshot(t, FIRST), FIRST, f"{FIRST} 00:00:00")
    return t.once("first_dimension", lambda t: keys.assign_keys(versions, NATURAL, "customer_key"))


def merged_dimension(t: Tables) -> DataFrame:
    return t.once(
        "merged_dimension",
        lambda t: scd2.merge_versions_with_keys(
            first_dimension(t), snapshot(t, SECOND), NATURAL, TRACKED, SECOND, "customer_key", f"{SECOND} 00:00:00"
        ),
    )


for _name, _day in (("snap1", FIRST), ("snap2", SECOND), ("snap3", LATER)):
    cte(
        _name,
        f"""
SELECT o_custkey AS customer_id, o_orderpriority AS last_priority, nullif(o_orderstatus, 'P') AS last_status,
  cast(o_orderdate AS date) AS last_order_day FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn
  FROM orders WHERE o_orderdate <= DATE '{_day}' AND o_custkey IS NOT NULL) x WHERE rn = 1""",
    )
cte(
    "dim1",
    f"""
SELECT row_number() OVER (ORDER BY customer_id) AS customer_key, *, DATE '{FIRST}' AS effective_start_date,
  cast(NULL AS date) AS effective_end_date, true AS is_current, '{FIRST} 00:00:00' AS created_at,
  '{FIRST} 00:00:00' AS updated_at FROM snap1""",
    "snap1",
)
_CHANGED = "(s.last_priority IS DISTINCT FROM d.last_priority OR s.last_status IS DISTINCT FROM d.last_status)"
cte(
    "pairs2",
    f"""
SELECT d.customer_key, s.*, d.customer_id IS NULL AS is_new, d.customer_id IS NOT NULL AND {_CHANGED} AS is_changed
FROM snap2 s LEFT JOIN dim1 d ON s.customer_id = d.customer_id""",
    "snap2",
    "dim1",
)
cte(
    "dim2",
    f"""
SELECT customer_key, customer_id, last_priority, last_status, last_order_day, effective_start_date,
  CASE WHEN changed THEN DATE '{SECOND}' END AS effective_end_date, NOT changed AS is_current, created_at,
  CASE WHEN changed THEN '{SECOND} 00:00:00' ELSE updated_at END AS updated_at
FROM (SELECT d.*, d.customer_id IN (SELECT customer_id FROM pairs2 WHERE is_changed) AS changed FROM dim1 d) x
UNION ALL
SELECT (SELECT max(customer_key) FROM dim1) + row_number() OVER (ORDER BY customer_id), customer_id, last_priority,
  last_status, last_order_day, DATE '{SECOND}', NULL, true, '{SECOND} 00:00:00', '{SECOND} 00:00:00'
FROM pairs2 WHERE is_new OR is_changed""",
    "dim1",
    "pairs2",
)

_OUT = """customer_key, customer_id, last_priority, last_status, cast(last_order_day AS varchar) AS last_order_day,
  cast(effective_start_date AS varchar) AS effective_start_date, cast(effective_end_date AS varchar) AS effective_end_date,
  is_current, created_at, updated_at"""
_SNAP = "s.customer_id, s.last_priority, s.last_status, cast(s.last_order_day AS varchar) AS last_order_day"


@query("scd2_initial", "D7", with_ctes(f"SELECT {_OUT} FROM dim1", "dim1"))
def scd2_initial(t: Tables):
    return first_dimension(t)


@query("scd2_merge", "D8 U1 J6 J7", with_ctes(f"SELECT {_OUT} FROM dim2", "dim2"))
def scd2_merge(t: Tables):
    return merged_dimension(t)


@query("scd2_merge_repeated", "D8", with_ctes(f"SELECT {_OUT} FROM dim2", "dim2"))
def scd2_merge_repeated(t: Tables):
    """The same snapshot on the same day again: nothing changes."""
    return scd2.merge_versions_with_keys(
        merged_dimension(t), snapshot(t, SECOND), NATURAL, TRACKED, SECOND, "customer_key", f"{LATER} 00:00:00"
    )


@query(
    "scd2_same_day_correction",
    "D8",
    with_ctes(
        f"""
, pairs3 AS (
  SELECT s.*, d.customer_id IS NULL AS is_new, d.effective_start_date AS began,
    d.customer_id IS NOT NULL AND {_CHANGED} AS is_changed
  FROM snap3 s LEFT JOIN (SELECT * FROM dim2 WHERE is_current) d ON s.customer_id = d.customer_id),
kept AS (
  SELECT d.customer_key, d.customer_id,
    CASE WHEN rewrite THEN p.last_priority ELSE d.last_priority END AS last_priority,
    CASE WHEN rewrite THEN p.last_status ELSE d.last_status END AS last_status,
    CASE WHEN rewrite THEN p.last_order_day ELSE d.last_order_day END AS last_order_day, d.effective_start_date,
    CASE WHEN changed AND NOT rewrite THEN DATE '{SECOND}' ELSE d.effective_end_date END AS effective_end_date,
    d.is_current AND NOT (changed AND NOT rewrite) AS is_current, d.created_at,
    CASE WHEN changed THEN '{LATER} 00:00:00' ELSE d.updated_at END AS updated_at
  FROM (SELECT dim2.*, coalesce(is_current AND q.is_changed, false) AS changed,
      coalesce(is_current AND q.is_changed AND effective_start_date = DATE '{SECOND}', false) AS rewrite
    FROM dim2 LEFT JOIN pairs3 q ON dim2.customer_id = q.customer_id) d
  LEFT JOIN pairs3 p ON d.customer_id = p.customer_id),
added AS (
  SELECT * FROM pairs3 WHERE is_new OR (is_changed AND began < DATE '{SECOND}'))
SELECT {_OUT} FROM kept
UNION ALL
SELECT (SELECT max(customer_key) FROM dim2) + row_number() OVER (ORDER BY customer_id), customer_id, last_priority,
  last_status, cast(last_order_day AS varchar), '{SECOND}', NULL, true, '{LATER} 00:00:00', '{LATER} 00:00:00'
FROM added""",
        "snap3",
        "dim2",
    ),
)
def scd2_same_day_correction(t: Tables):
    """A later state arriving for the day already merged: versions begun that day are rewritten."""
    return scd2.merge_versions_with_keys(
        merged_dimension(t), snapshot(t, LATER), NATURAL, TRACKED, SECOND, "customer_key", f"{LATER} 00:00:00"
    )


@query("scd2_changed_rows", "J6", with_ctes(f"SELECT {_SNAP} FROM pairs2 s WHERE is_changed", "pairs2"))
def scd2_changed_rows(t: Tables):
    return scd2.changed_rows(first_dimension(t), snapshot(t, SECOND), NATURAL, TRACKED)


@query("scd2_new_rows", "J7", with_ctes(f"SELECT {_SNAP} FROM pairs2 s WHERE is_new", "pairs2"))
def scd2_new_rows(t: Tables):
    return scd2.new_rows(first_dimension(t), snapshot(t, SECOND), NATURAL)


@query(
    "union_new_changed",
    "U1 J6 J7",
    with_ctes(
        f"SELECT {_SNAP}, CASE WHEN is_new THEN 'new' ELSE 'changed' END AS change FROM pairs2 s WHERE is_new OR is_changed",
        "pairs2",
    ),
)
def union_new_changed(t: Tables):
    return scd2.new_and_changed(first_dimension(t), snapshot(t, SECOND), NATURAL, TRACKED)


@query(
    "scd2_as_of",
    "D11",
    with_ctes(
        f"""
SELECT {_OUT} FROM dim2 WHERE effective_start_date <= DATE '1999-06-30'
  AND (effective_end_date IS NULL OR effective_end_date > DATE '1999-06-30')""",
        "dim2",
    ),
)
def scd2_as_of(t: Tables):
    return scd2.as_of_rows(merged_dimension(t), "1999-06-30")


@query("scd2_current", "D11 F2", with_ctes(f"SELECT {_OUT} FROM dim2 WHERE is_current", "dim2"))
def scd2_current(t: Tables):
    return merged_dimension(t).where(F.col("is_current"))


@query(
    "scd2_history",
    "D11",
    with_ctes(
        """
SELECT customer_id, cast(effective_start_date AS varchar) AS effective_start_date, last_priority, last_status
FROM dim2 ORDER BY customer_id, effective_start_date""",
        "dim2",
    ),
)
def scd2_history(t: Tables):
    versions = scd2.history(merged_dimension(t), "customer_id")
    return versions.select("customer_id", "effective_start_date", "last_priority", "last_status")


@query(
    "scd2_faults",
    "D8 Q5",
    with_ctes(
        """
SELECT customer_id, 2::bigint AS current_versions, 0::bigint AS empty_intervals FROM pairs2 WHERE is_changed""",
        "pairs2",
    ),
)
def scd2_faults(t: Tables):
    """What the invariants report when changed versions are added without closing the old ones."""
    added = scd2.new_and_changed(first_dimension(t), snapshot(t, SECOND), NATURAL, TRACKED).drop("change")
    careless = first_dimension(t).unionByName(scd2.first_versions(added, SECOND), allowMissingColumns=True)
    return scd2.version_faults(careless, NATURAL)


@query(
    "scd2_lookup",
    "J9",
    with_ctes(
        """
SELECT o_orderkey, o_custkey, customer_key FROM orders LEFT JOIN dim2 ON o_custkey = customer_id
  AND effective_start_date <= cast(o_orderdate AS date)
  AND (effective_end_date IS NULL OR cast(o_orderdate AS date) < effective_end_date)""",
        "dim2",
    ),
)
def scd2_lookup(t: Tables):
    facts = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("order_day"))
    found = lookup.lookup_as_of(facts, merged_dimension(t), {"o_custkey": "customer_id"}, "order_day", "customer_key")
    return found.drop("order_day")


# -- incremental loads --------------------------------------------------------


def _shipped(t: Tables, stamp: str, before: str | None = None) -> DataFrame:
    lines = t.lineitem if before is None else t.lineitem.where(F.col("l_shipdate") < F.lit(before).cast("date"))
    return lines.groupBy(F.col("l_orderkey").alias("order_id")).agg(
        F.sum("l_quantity").cast("bigint").alias("quantity"),
        F.count(F.lit(1)).alias("line_count"),
        F.max("l_shipdate").alias(stamp),
    )


_SHIPPED_SQL = """
WITH loaded AS (SELECT l_orderkey AS order_id, cast(sum(l_quantity) AS bigint) AS quantity, count(*) AS line_count,
    max(l_shipdate) AS stamp FROM lineitem WHERE l_shipdate < DATE '2000-01-01' GROUP BY l_orderkey),
source AS (SELECT l_orderkey AS order_id, cast(sum(l_quantity) AS bigint) AS quantity, count(*) AS line_count,
    max(l_shipdate) AS stamp FROM lineitem GROUP BY l_orderkey),
fresh AS (SELECT * FROM source WHERE stamp > (SELECT max(stamp) FROM loaded))
"""


@query("newer_rows", "A8 D14", _SHIPPED_SQL + "SELECT order_id, quantity, line_count FROM fresh")
def newer_rows(t: Tables):
    loaded = _shipped(t, "loaded_at", "2000-01-01")
    fresh = merge.newer_rows(_shipped(t, "updated_at"), "updated_at", loaded, "loaded_at")
    return fresh.select("order_id", "quantity", "line_count")


@query(
    "incremental_merge",
    "D14 A8",
    _SHIPPED_SQL
    + """
SELECT order_id, quantity, line_count FROM loaded WHERE order_id NOT IN (SELECT order_id FROM fresh)
UNION ALL SELECT order_id, quantity, line_count FROM fresh""",
)
def incremental_merge(t: Tables):
    loaded = _shipped(t, "loaded_at", "2000-01-01")
    fresh = merge.newer_rows(_shipped(t, "updated_at"), "updated_at", loaded, "loaded_at")
    merged = merge.upsert(loaded, fresh.withColumnRenamed("updated_at", "loaded_at"), ["order_id"])
    return merged.select("order_id", "quantity", "line_count")


@query(
    "incremental_merge_partitions",
    "D14 O2",
    """
WITH target AS (SELECT o_orderkey, year(o_orderdate) AS order_year, o_totalprice AS amount FROM orders
  WHERE o_orderdate < DATE '2001-03-01'),
updates AS (SELECT o_orderkey, year(o_orderdate) AS order_year, o_totalprice / 2 AS amount FROM orders
  WHERE o_orderdate >= DATE '2000-06-01' AND o_orderstatus = 'F')
SELECT * FROM target WHERE order_year IN (SELECT order_year FROM updates)
  AND (o_orderkey, order_year) NOT IN (SELECT (o_orderkey, order_year) FROM updates)
UNION ALL SELECT * FROM updates""",
)
def incremental_merge_partitions(t: Tables):
    orders = t.orders.withColumn("order_year", F.year("o_orderdate"))
    target = orders.where(F.col("o_orderdate") < F.lit("2001-03-01").cast("date")).select(
        "o_orderkey", "order_year", F.col("o_totalprice").alias("amount")
    )
    updates = orders.where(
        (F.col("o_orderdate") >= F.lit("2000-06-01").cast("date")) & (F.col("o_orderstatus") == "F")
    ).select("o_orderkey", "order_year", (F.col("o_totalprice") / 2).alias("amount"))
    return merge.upsert_partitions(target, updates, ["o_orderkey"], ["order_year"])


def _by_year(t: Tables, where, factor: float = 1.0) -> DataFrame:
    return t.orders.where(where).select(
        "o_orderkey", F.year("o_orderdate").alias("order_year"), (F.col("o_totalprice") * factor).alias("amount")
    )


@query(
    "incremental_merge_stored",
    "D14 O2",
    """
SELECT o_orderkey, year(o_orderdate) AS order_year,
  CASE WHEN o_orderdate >= DATE '2000-06-01' AND o_orderstatus = 'F' THEN o_totalprice / 2 ELSE o_totalprice END AS amount
FROM orders WHERE o_orderdate < DATE '2001-03-01' OR o_orderstatus = 'F'""",
)
def incremental_merge_stored(t: Tables):
    """The stored table after an update that rewrites only the years it touches."""
    store = Lake(t.spark, new_path(t.spark, "lake"))
    loaded = _by_year(t, F.col("o_orderdate") < F.lit("2001-03-01").cast("date"))
    store.overwrite(loaded, "gold", "orders_by_year", ["order_year"])
    late = (F.col("o_orderdate") >= F.lit("2000-06-01").cast("date")) & (F.col("o_orderstatus") == "F")
    changed = merge.upsert_partitions(
        store.read("gold", "orders_by_year"), _by_year(t, late, 0.5), ["o_orderkey"], ["order_year"]
    )
    store.replace_partitions(changed, "gold", "orders_by_year", ["order_year"])
    return store.read("gold", "orders_by_year")


cte(
    "facts_then",
    "SELECT f.* FROM f_enrollment f JOIN s_enrollments s ON f.enrollment_id = s.enrollment_id "
    "WHERE s.enrollment_date < DATE '2000-01-01'",
    "f_enrollment",
)


@query(
    "fact_enrollment_incremental",
    "D14 D12 A8",
    with_ctes(
        """
SELECT enrollment_id, student_key, course_key, semester_key,
  CASE WHEN enrollment_id IN (SELECT enrollment_id FROM facts_then) THEN total_score ELSE total_score / 2 END AS total_score,
  CASE WHEN enrollment_id IN (SELECT enrollment_id FROM facts_then) THEN '1999-12-31 00:00:00'
    ELSE '2002-01-01 00:00:00' END AS created_at
FROM f_enrollment""",
        "facts_then",
    ),
)
def fact_enrollment_incremental(t: Tables):
    """Facts loaded up to the end of 1999, then merged with the enrolments dated later."""
    # silver and the first load are tables, which the merge reads several times
    enrollments = silver(t, "enrollments").withColumn("updated_at", F.col("enrollment_date").cast("timestamp"))
    enrollments = stage(enrollments.drop("validation_errors", "created_at"), "silver-enrollments")
    dims = students(t), courses(t), semesters(t)
    early = enrollments.where(F.col("enrollment_date") < F.lit("2000-01-01").cast("date"))
    loaded = stage(uni.fact_enrollment(early, *dims, days=DAYS, stamp="1999-12-31 00:00:00"), "loaded-facts")
    corrected = enrollments.withColumn("total_score", F.col("total_score") / 2)
    merged = uni.fact_enrollment_merged(loaded, corrected, *dims, days=DAYS, stamp=STAMP)
    return merged.select("enrollment_id", "student_key", "course_key", "semester_key", "total_score", "created_at")
