"""Runs that stop, are repeated, and bring corrections: the state they leave equals that of one go."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue import standins
from catalogue.registry import Tables, query, with_ctes
from catalogue.warehouse import extended_mart_sql
from starbuild.operators import dedup, keys, ledger, marts, quality, scd2
from starbuild.operators.staging import new_path, stage
from starbuild.operators.upkeep import SIGN, Sums
from starbuild.plans.university import ENTITIES
from starbuild.plans.warehouse import Warehouse
from starbuild.sources.lake import Lake, partition_label
from starbuild.sources.registry import KeyRegistry

_BEGIN = dt.datetime.fromisoformat(standins.STAMP)


def _written(t: Tables, name: str, rows: DataFrame) -> tuple[str, str]:
    path = new_path(t.spark, f"feed-{name}")
    rows.select(*[F.col(f.name).cast(f.dataType) for f in ENTITIES[name].source]).write.parquet(path)
    return path, "parquet"


@query(
    "warehouse_stopped_run",
    "D14 D12 O2 W1 I7 I9",
    with_ctes("SELECT * EXCLUDE (is_passed_or_unknown) FROM f_enrollment", "f_enrollment"),
)
def warehouse_stopped_run(t: Tables):
    """The enrolment facts after a first run, a stopped one and its repetition at the same time.

    The first run takes the whole feed, duplicates included, with wrong scores.  The second brings the
    latest row of each enrolment, again with a wrong score, and stops after silver.  Its repetition brings
    the right rows.
    """
    rows = standins.enrollments(t)
    latest = dedup.keep_latest(rows, ["enrollment_id"], ["_ingested_at"], standins.ENROLLMENT_TIES, row_id=["_row"])
    latest = stage(latest.drop("_row", "_ingested_at"), "latest-enrollments")  # two feeds bring it
    root = new_path(t.spark, "lake")

    def run(at: dt.datetime) -> Warehouse:
        return Warehouse(t.spark, root, at, gate=False, calendar_days=standins.DAYS)

    first = run(_BEGIN)
    feeds = {n: _written(t, n, getattr(standins, n)(t)) for n in ("departments", "semesters", "courses", "students")}
    first.build_bronze(feeds | {"enrollments": _written(t, "enrollments", rows.withColumn("total_score", F.lit(None)))})
    first.build_silver([*feeds, "enrollments"])
    first.build_dimensions()
    first.build_fact("fact_enrollment")
    enrollments = _written(t, "enrollments", latest.withColumn("total_score", F.lit(1)))
    stopped = run(_BEGIN + dt.timedelta(hours=6))
    stopped.build_bronze({"enrollments": enrollments})
    stopped.build_silver(["enrollments"], recent_days=1)
    again = run(_BEGIN + dt.timedelta(hours=6))
    again.build_bronze({"enrollments": _written(t, "enrollments", latest)})
    again.build_silver(["enrollments"], recent_days=1)
    again.build_fact("fact_enrollment", incremental=True)
    return again.gold("fact_enrollment").drop("created_at")


@query(
    "keys_after_stopped_run",
    "D2",
    """
WITH seen AS (SELECT 'C' || p_partkey AS course_id, CASE WHEN p_size < 20 THEN 1 WHEN p_size < 30 THEN 2 ELSE 3 END AS run FROM part)
SELECT course_key, course_id FROM (SELECT *, row_number() OVER (ORDER BY run, course_id) AS course_key FROM seen) x WHERE run <> 2""",
)
def keys_after_stopped_run(t: Tables):
    """Courses of three runs; the second one stopped before its dimension, and its courses never came back."""
    lake = Lake(t.spark, new_path(t.spark, "lake"))
    rows = t.part.selectExpr("CAST(NULL AS bigint) AS course_key", "'C' || p_partkey AS course_id", "p_size")

    def run(where: str) -> DataFrame:
        return KeyRegistry(lake, "dim_course", "course_key").fill(rows.where(where), ["course_id"]).select("course_key", "course_id")

    run("p_size < 20")
    run("p_size BETWEEN 10 AND 29")  # some members left, others are new
    return run("p_size < 20 OR p_size >= 30")


@query(
    "lake_partition_versions",
    "O2 O3",
    """
SELECT 1::bigint AS version, year(o_orderdate) AS order_year, count(*) AS order_count, cast(sum(cast(o_totalprice AS decimal(18,2))) AS double) AS amount
FROM orders GROUP BY ALL
UNION ALL SELECT 2, year(o_orderdate), count(*),
  cast(sum(cast(o_totalprice AS decimal(18,2)) * CASE WHEN year(o_orderdate) = 1996 THEN 2 ELSE 1 END) AS double)
FROM orders WHERE year(o_orderdate) <> 1997 GROUP BY ALL""",
)
def lake_partition_versions(t: Tables):
    """Two versions of a table read after both were written: one year doubled, one emptied, the others shared."""
    lake = Lake(t.spark, new_path(t.spark, "lake"))
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"), F.col("o_totalprice").cast("decimal(18,2)").alias("amount"))
    lake.overwrite(orders, "gold", "orders", ["order_year"])
    before = lake.read("gold", "orders", partitions=["1996"])
    lake.replace_partitions(before.withColumn("amount", (F.col("amount") * 2).cast("decimal(18,2)")), "gold", "orders", ["order_year"], ["1996", "1997"])
    both = [lake.read("gold", "orders", version=v).withColumn("version", F.lit(v)) for v in (1, 2)]
    sums = F.count(F.lit(1)).alias("order_count"), F.sum("amount").alias("amount")
    return both[0].unionByName(both[1]).groupBy("version", "order_year").agg(*sums)


@query(
    "change_ledger",
    "D14 J6 J7",
    """
WITH old AS (SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 <> 0),
now AS (SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice
  FROM orders WHERE o_orderkey % 7 <> 0)
SELECT coalesce(o.o_orderkey, n.o_orderkey) AS o_orderkey,
  CASE WHEN o.o_orderkey IS NULL THEN 'new' WHEN n.o_orderkey IS NULL THEN 'removed' ELSE 'changed' END AS change,
  o.o_orderstatus AS part_before, n.o_orderstatus AS part_after
FROM old o FULL JOIN now n ON o.o_orderkey = n.o_orderkey
WHERE o.o_orderkey IS NULL OR n.o_orderkey IS NULL OR o.o_orderstatus <> n.o_orderstatus""",
)
def change_ledger(t: Tables):
    """What a later state of the orders changes, and in which partitions."""
    columns = ["o_orderkey", "o_orderstatus", "o_totalprice"]
    old = t.orders.where("o_orderkey % 5 <> 0").select(*columns)
    status = F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus"))
    now = t.orders.withColumn("o_orderstatus", status).where("o_orderkey % 7 <> 0").select(*columns)
    decided = old.select("o_orderkey").union(now.select("o_orderkey"))
    found = ledger.changes(old, now, ["o_orderkey"], columns[1:], partition_label(["o_orderstatus"]), decided=decided)
    return found.drop("after")


@query(
    "scd2_late_snapshots",
    "D8 D11",
    """
WITH states AS (SELECT o_custkey, cast(o_orderdate AS date) AS day, max(o_orderpriority) AS priority, max(o_orderstatus) AS status
  FROM orders GROUP BY ALL),
opened AS (SELECT *, row_number() OVER w = 1 OR priority IS DISTINCT FROM lag(priority) OVER w
    OR status IS DISTINCT FROM lag(status) OVER w AS opens FROM states WINDOW w AS (PARTITION BY o_custkey ORDER BY day))
SELECT o_custkey, priority, status, cast(day AS varchar) AS effective_start_date,
  cast(lead(day) OVER (PARTITION BY o_custkey ORDER BY day) AS varchar) AS effective_end_date,
  lead(day) OVER (PARTITION BY o_custkey ORDER BY day) IS NULL AS is_current
FROM opened WHERE opens""",
)
def scd2_late_snapshots(t: Tables):
    """The states of all customers by day, arriving in three lots of mixed days; the last lot is the oldest third."""
    order = F.max("o_orderpriority").alias("priority"), F.max("o_orderstatus").alias("status")
    states = t.orders.groupBy("o_custkey", F.col("o_orderdate").cast("date").alias("day")).agg(*order)
    lot = F.when(F.col("day") < F.lit("1997-07-01").cast("date"), 2).otherwise(F.pmod(F.dayofyear("day"), F.lit(2)))
    lots = [states.where(lot == n) for n in range(3)]
    natural, tracked = ["o_custkey"], ["priority", "status"]
    dim = keys.assign_keys(scd2.timelines(lots[0], natural, tracked, "day"), [*natural, scd2.START], "customer_key")
    dim = scd2.merge_states(dim, lots[0], lots[1], natural, tracked, "day", "customer_key")
    dim = scd2.merge_states(dim, lots[0].union(lots[1]), lots[2], natural, tracked, "day", "customer_key")
    return dim.drop("customer_key")


@query(
    "lineage_closure",
    "Q14",
    """
WITH n AS (SELECT * FROM (VALUES ('departments', (SELECT count(*) FROM nation)), ('courses', (SELECT count(*) FROM part))) v(e, n))
SELECT 'bronze.raw_' || e AS target_table, 'feed' AS source_table, 1::bigint AS steps, n AS row_count FROM n
UNION ALL SELECT 'silver.stg_' || e, 'bronze.raw_' || e, 1, n FROM n
UNION ALL SELECT 'silver.stg_' || e, 'feed', 2, n FROM n""",
)
def lineage_closure(t: Tables):
    """Two feeds taken up to silver: all sources of each table, with the table's rows."""
    names = ("departments", "courses")
    warehouse = Warehouse(t.spark, new_path(t.spark, "lake"), _BEGIN, gate=False)
    warehouse.build_bronze({n: _written(t, n, getattr(standins, n)(t)) for n in names})
    warehouse.build_silver(names)
    warehouse.write_audit()
    lineage = warehouse.lake.read("audit", "data_lineage")
    history = warehouse.lake.read("audit", "etl_job_history")
    counts = history.select(F.col("job_name").alias("target_table"), F.col("records_processed").alias("row_count"))
    source = F.when(F.col("source_table").startswith("bronze."), F.col("source_table")).otherwise("feed")
    return quality.lineage_closure(lineage).withColumn("source_table", source).join(counts, "target_table")


@query(
    "sums_kept_up",
    "A1 A3 D14",
    """
SELECT o_orderpriority, year(o_orderdate) AS order_year, count(*) AS order_count,
  cast(sum(cast(o_totalprice AS decimal(15,2))) AS double) AS amount,
  cast(min(cast(o_totalprice AS decimal(15,2))) AS double) AS price_min, cast(max(cast(o_totalprice AS decimal(15,2))) AS double) AS price_max
FROM orders WHERE o_orderkey % 7 <> 0 GROUP BY ALL""",
)
def sums_kept_up(t: Tables):
    """Sums of an earlier state of the orders, brought up to date: a third had other prices, some were not there, some leave."""
    price = "cast(o_totalprice AS decimal(15,2))"
    orders = t.orders.select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("order_year"), F.expr(price).alias("price"))
    then = orders.where("o_orderkey % 5 <> 0").withColumn("price", F.expr("if(o_orderkey % 3 = 0, cast(price * 2 AS decimal(15,2)), price)"))
    now = orders.where("o_orderkey % 7 <> 0")
    sums = Sums(("o_orderpriority", "order_year"), ("o_orderpriority", "order_year", "price"), {"amount": "price"}, {"price": "price"})
    touched = "o_orderkey % 5 = 0 OR o_orderkey % 3 = 0 OR o_orderkey % 7 = 0"
    left, came = [df.where(touched).withColumn(SIGN, F.lit(s)) for df, s in ((then, -1), (now, 1))]
    return sums.kept_up(sums.of(then), left.unionByName(came), now).withColumnRenamed("rows", "order_count")


@query("mart_kept_up", "A1 A2 D14 J5", extended_mart_sql("g_student"))
def mart_kept_up(t: Tables):
    """The extended mart from sums stored by a first run, after a second one brought what one year's enrolments lacked."""
    rows = standins.enrollments(t).where("enrollment_id IS NOT NULL")
    latest = dedup.keep_latest(rows, ["enrollment_id"], ["_ingested_at"], standins.ENROLLMENT_TIES, row_id=["_row"])
    latest = stage(latest.drop("_row", "_ingested_at"), "latest-enrollments")  # two feeds bring it
    of_year = F.coalesce(F.col("semester_id").startswith("1997"), F.lit(False))
    root = new_path(t.spark, "lake")

    def run(at: dt.datetime, enrollments: DataFrame, feeds: dict, recent_days: int | None = None) -> DataFrame:
        warehouse = Warehouse(t.spark, root, at, gate=False, calendar_days=standins.DAYS)
        warehouse.build_bronze(feeds | {"enrollments": _written(t, "enrollments", enrollments)})
        warehouse.build_silver([*feeds, "enrollments"], recent_days)
        if feeds:
            warehouse.build_dimensions()
        warehouse.build_fact("fact_enrollment", incremental=recent_days is not None)
        sums = warehouse.build_sums("fact_enrollment", incremental=recent_days is not None)
        return marts.academic_extended_from_sums(sums, warehouse.current_students())

    wrong = latest.withColumn("total_score", F.when(~of_year, F.col("total_score"))).where(~of_year | (F.crc32("enrollment_id") % 10 > 0))
    feeds = {n: _written(t, n, getattr(standins, n)(t)) for n in ("departments", "semesters", "courses", "students")}
    run(_BEGIN, wrong, feeds)
    return run(_BEGIN + dt.timedelta(hours=6), latest.where(of_year), {}, recent_days=0)


@query(
    "retention_by_use",
    "O3",
    """
SELECT version, year(o_orderdate) AS order_year, count(*) AS order_count FROM orders, (VALUES (2::bigint), (4)) v(version)
WHERE year(o_orderdate) <> 1995 + version GROUP BY ALL""",
)
def retention_by_use(t: Tables):
    """What a sweep leaves of four versions, each without another year: the newest one, and the second, which is pinned."""
    store = Lake(t.spark, new_path(t.spark, "lake"))
    orders = t.orders.select("o_orderkey", F.year("o_orderdate").alias("order_year"))
    store.overwrite(orders.where("order_year <> 1996"), "gold", "orders", ["order_year"])
    store.replace_partitions(
        orders.where("order_year = 1996"), "gold", "orders", ["order_year"], ["1996", "1997"]
    )
    with store.pin("gold", "orders") as held:
        for gone in (1998, 1999):
            back = orders.where(F.col("order_year") == gone - 1)
            store.replace_partitions(back, "gold", "orders", ["order_year"], [str(gone - 1), str(gone)])
        store.sweep("gold", "orders")
        left = [store.read("gold", "orders", version=v).withColumn("version", F.lit(v)) for v in (held, store.versions("gold", "orders")[-1])]
    return left[0].unionByName(left[1]).groupBy("version", "order_year").agg(F.count(F.lit(1)).alias("order_count"))
