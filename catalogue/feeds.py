"""Sources and sinks: the given tables written out as feeds and taken in again."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from catalogue import standins
from catalogue.registry import Tables, query, with_ctes
from starbuild.operators import dedup, layout
from starbuild.operators.staging import new_path
from starbuild.plans.specs import DAY, INT, MONEY, TEXT, fields
from starbuild.plans.university import ENTITIES
from starbuild.plans.warehouse import Warehouse
from starbuild.sources import files, lake
from starbuild.streaming.ingest import ingest_new_files

AT = "2024-03-01 00:00:00"
BATCH = files.batch_id_of(dt.datetime(2024, 3, 1))
LONG = T.LongType()
ORDERS = fields(
    ("o_orderkey", LONG), ("o_orderstatus o_orderpriority", TEXT), ("o_totalprice", MONEY), ("o_orderdate", DAY)
)

_BAD = "case when o_orderstatus = 'P' then 'n/a' else cast(cast(o_totalprice as decimal(15,2)) as string) end"
_TAKEN = f"""
SELECT o_orderkey, o_orderstatus, o_orderpriority,
  CASE WHEN o_orderstatus <> 'P' THEN cast(cast(o_totalprice AS decimal(15,2)) AS double) END AS o_totalprice,
  cast(cast(o_orderdate AS date) AS varchar) AS o_orderdate, '{BATCH}' AS _batch_id, '{AT}' AS _ingested_at,
  true AS has_source_file FROM orders"""


def _feed(t: Tables) -> DataFrame:
    """Orders as text, columns in another order than declared, one column too many, some unparsable prices."""
    return t.orders.selectExpr(
        "o_orderpriority", "cast(cast(o_orderdate as date) as string) AS o_orderdate", "o_custkey", "o_orderstatus",
        f"{_BAD} AS o_totalprice", "o_orderkey",
    )


def _shown(df: DataFrame) -> DataFrame:
    return df.withColumn("has_source_file", F.col("_source_file").contains("feed")).drop("_source_file")


@query("csv_ingest", "I1 I8 P1 C12", _TAKEN)
def csv_ingest(t: Tables):
    path = new_path(t.spark, "feed-csv")
    _feed(t).write.option("header", True).csv(path)
    return _shown(files.ingest(t.spark, path, ORDERS, BATCH, AT, "csv"))


@query("json_ingest", "I2 P1", _TAKEN.replace("CASE WHEN o_orderstatus <> 'P' THEN", "CASE WHEN true THEN"))
def json_ingest(t: Tables):
    path = new_path(t.spark, "feed-json")
    layout.to_layout(t.orders, ORDERS).write.json(path)
    return _shown(files.ingest(t.spark, path, ORDERS, BATCH, AT, "json"))


@query("parquet_ingest", "I3 P1 P2", _TAKEN)
def parquet_ingest(t: Tables):
    path = new_path(t.spark, "feed-parquet")
    _feed(t).write.parquet(path)
    return _shown(files.ingest(t.spark, path, ORDERS, BATCH, AT, "parquet"))


@query(
    "csv_untyped",
    "I8",
    "SELECT cast(p_partkey AS varchar) AS p_partkey, p_name, p_brand, cast(p_size AS varchar) AS p_size FROM part",
)
def csv_untyped(t: Tables):
    path = new_path(t.spark, "feed-untyped")
    t.part.select("p_partkey", "p_name", "p_brand", "p_size").write.option("header", True).csv(path)
    return files.read_untyped_csv(t.spark, path)


CUSTOMERS = fields(("c_custkey", LONG), ("c_name", TEXT), ("c_nationkey", INT), ("c_mktsegment", TEXT))


@query(
    "lake_batches",
    "O1 O2 I6",
    """
SELECT c_custkey, c_name, CASE WHEN b = 'first' THEN NULL ELSE c_mktsegment END AS c_mktsegment, b AS _batch_id
FROM customer, (VALUES ('first'), ('second'), ('second')) v(b) WHERE c_nationkey >= 3""",
)
def lake_batches(t: Tables):
    """Two batches, the first written twice as a retry, the second twice on purpose; an older layout is read as NULL."""
    store = lake.Lake(t.spark, new_path(t.spark, "lake"))
    rows = layout.to_layout(t.customer, CUSTOMERS)

    def batch(df: DataFrame, name: str) -> DataFrame:
        return files.with_lineage(df, name, AT, source="feed")

    for _ in range(2):
        store.replace_batch(batch(rows.drop("c_mktsegment"), "first"), "raw_customers")
    for _ in range(2):
        store.append_batch(batch(rows, "second"), "raw_customers")
    return store.read_bronze(
        "raw_customers", CUSTOMERS, where=F.col("c_nationkey") >= 3,
        columns=["c_custkey", "c_name", "c_mktsegment", "_batch_id"],
    )


@query(
    "lake_overwrite",
    "O3 I6",
    "SELECT s_suppkey, s_name, cast(s_acctbal * 4 AS double) AS s_acctbal FROM supplier WHERE s_nationkey >= 3",
)
def lake_overwrite(t: Tables):
    """A table rebuilt twice from its own previous version."""
    store = lake.Lake(t.spark, new_path(t.spark, "lake"))
    store.overwrite(t.supplier, "silver", "suppliers")
    for _ in range(2):
        before = store.read("silver", "suppliers")
        store.overwrite(before.withColumn("s_acctbal", F.col("s_acctbal") * 2), "silver", "suppliers")
    return store.read(
        "silver", "suppliers", where=F.col("s_nationkey") >= 3, columns=["s_suppkey", "s_name", "s_acctbal"]
    )


@query(
    "lake_two_sinks",
    "O5",
    """
SELECT o_orderpriority, count(*) AS row_count, true AS same_ingest_time FROM orders GROUP BY o_orderpriority""",
)
def lake_two_sinks(t: Tables):
    """The second sink is fed from the first one's files, so both hold the same ingest time."""
    store = lake.Lake(t.spark, new_path(t.spark, "lake"))
    first = files.with_lineage(layout.to_layout(t.orders, ORDERS), BATCH, AT, source="feed")
    store.append_batch(first, "raw_orders")
    store.overwrite(store.read_bronze("raw_orders", ORDERS, BATCH), "mirror", "raw_orders")
    a = store.read_bronze("raw_orders", ORDERS).select("o_orderkey", "o_orderpriority", "_ingested_at")
    b = store.read("mirror", "raw_orders", columns=["o_orderkey", F.col("_ingested_at").alias("__at")])
    both = a.join(b, "o_orderkey").withColumn("same", F.col("_ingested_at") == F.col("__at"))
    return both.groupBy("o_orderpriority").agg(
        F.count(F.lit(1)).alias("row_count"), F.bool_and("same").alias("same_ingest_time")
    )


@query(
    "ingest_new_files",
    "I1 O1 O2",
    """
SELECT o_orderkey, o_orderstatus, cast(cast(o_totalprice AS decimal(15,2)) AS double) AS o_totalprice,
  cast(cast(o_orderdate AS date) AS varchar) AS o_orderdate FROM orders""",
)
def new_files(t: Tables):
    """Files arriving in two goes; each run takes only what is new."""
    feed, progress = new_path(t.spark, "feed-stream"), new_path(t.spark, "progress")
    store = lake.Lake(t.spark, new_path(t.spark, "lake"))
    rows = layout.to_layout(t.orders, ORDERS)
    early = F.col("o_orderdate") < F.lit("1998-01-01").cast("date")
    for part in (early, ~early):
        rows.where(part).write.mode("append").option("header", True).csv(feed)
        ingest_new_files(t.spark, feed, ORDERS, store, "raw_orders", progress, AT)
    return store.read_bronze("raw_orders", ORDERS, columns=["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate"])


@query(
    "ingest_resent_files",
    "I1 O1",
    """
SELECT o_orderkey, o_orderstatus, cast(cast(o_totalprice AS decimal(15,2)) AS double) AS o_totalprice,
  cast(cast(o_orderdate AS date) AS varchar) AS o_orderdate, run AS _batch_id
FROM (SELECT *, CASE WHEN o_orderkey % 3 = 0 THEN 'first' ELSE 'later' END AS run FROM orders
  UNION ALL SELECT * REPLACE ('Z' AS o_orderstatus), 'later' FROM orders WHERE o_orderkey % 6 = 0) x""",
)
def resent_files(t: Tables):
    """Rows sent in a first run, sent again in the next ones along with others, some of them corrected."""
    feed, progress = new_path(t.spark, "feed-stream"), new_path(t.spark, "progress")
    store = lake.Lake(t.spark, new_path(t.spark, "lake"))
    rows = layout.to_layout(t.orders, ORDERS)
    corrected = rows.where("o_orderkey % 6 = 0").withColumn("o_orderstatus", F.lit("Z"))
    for sent in (rows.where("o_orderkey % 3 = 0"), rows, corrected.unionByName(rows.where("o_orderkey % 3 < 2"))):
        sent.write.mode("append").option("header", True).csv(feed)
        ingest_new_files(t.spark, feed, ORDERS, store, "raw_orders", progress, AT, resent_within="1 day")
    taken = store.read_bronze("raw_orders", ORDERS, columns=["o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "_batch_id"])
    return taken.withColumn("_batch_id", F.when(F.col("_batch_id") == "stream_00000000", "first").otherwise("later"))


_FORMATS = {"students": "parquet", "tuition": "json", "semesters": "json"}
_GROUPS = "(SELECT DISTINCT {} FROM {}) x"
_ACADEMIC = "f_enrollment f LEFT JOIN g_student s ON f.student_key = s.student_key"


def _written(rows: DataFrame, name: str) -> tuple[str, str]:
    """A feed's folder and format.  Text is compressed; such a file is read by one task, so its rows are bounded."""
    path, kind = new_path(rows.sparkSession, f"feed-{name}"), _FORMATS.get(name, "csv")
    writer = rows.write.format(kind).option("header", True).option("maxRecordsPerFile", 1_000_000)
    (writer if kind == "parquet" else writer.option("compression", "gzip")).save(path)
    return path, kind


def _job(name: str, source: str, failed: str = "false") -> str:
    return (
        f"SELECT '{name}' AS job_name, 'success' AS status, count(*) AS records_processed, "
        f"count(*) FILTER (WHERE NOT ({failed})) AS records_inserted, count(*) FILTER (WHERE {failed}) AS records_failed "
        f"FROM {source}"
    )


def _fact_job(name: str, silver: str, facts: str) -> str:
    """Valid rows taken in, those with all keys written, the others noted as failed."""
    valid, written = f"(SELECT count(*) FROM {silver} WHERE is_valid)", f"(SELECT count(*) FROM {facts})"
    return (
        f"SELECT '{name}' AS job_name, 'success' AS status, {valid} AS records_processed, {written} AS records_inserted, "
        f"{valid} - {written} AS records_failed"
    )


@query(
    "warehouse_run",
    "I9 I10 I12 P1 Q9 Q12 Q14",
    with_ctes(
        "\nUNION ALL ".join(
            [
                *[
                    _job(f"bronze.raw_{n}", "s_enrollments" if n == "enrollments" else f"b_{n}") for n in ENTITIES
                ],
                *[_job(f"silver.stg_{n}", f"s_{n}", "NOT is_valid") for n in ENTITIES],
                _job("gold.dim_date", "(SELECT unnest(generate_series(1, 4018))) d"),
                _job("gold.dim_department", "g_department"),
                _job("gold.dim_semester", "g_semester"),
                _job("gold.dim_course", "g_course"),
                _job("gold.dim_student", "g_student"),
                _fact_job("gold.fact_enrollment", "s_enrollments", "f_enrollment"),
                _fact_job("gold.fact_tuition", "s_tuition", "f_tuition"),
                _job("gold.sums_enrollment", _GROUPS.format("semester_key, student_key", "f_enrollment")),
                _job("gold.sums_tuition", _GROUPS.format("semester_key, student_key", "f_tuition")),
                _job(
                    "gold.agg_academic_performance_semester", _GROUPS.format("semester_key, department_key", _ACADEMIC)
                ),
                _job("gold.agg_academic_performance", _GROUPS.format("semester_key, department_key", _ACADEMIC)),
                _job("gold.agg_financial_summary", _GROUPS.format("semester_key", "f_tuition")),
                _job(
                    "gold.agg_cohort_analysis",
                    _GROUPS.format("cohort_year, department_key", "g_student WHERE cohort_year IS NOT NULL"),
                ),
            ]
        ),
        "f_enrollment",
        "f_tuition",
    ),
)
def warehouse_run(t: Tables):
    """All feeds written to files, then one whole run; the answer is the job history with its row counts."""
    feeds = {}
    for name in ENTITIES:
        rows = getattr(standins, name)(t)
        if name == "enrollments":
            rows = dedup.keep_latest(rows, ["enrollment_id"], ["_ingested_at"], standins.ENROLLMENT_TIES, row_id=["_row"])
        feeds[name] = _written(rows.drop("_ingested_at", "graduation_date", "_row"), name)
    warehouse = Warehouse(t.spark, new_path(t.spark, "lake"), dt.datetime.fromisoformat(standins.STAMP), gate=False)
    warehouse.run(feeds)
    history = warehouse.lake.read("audit", "etl_job_history")
    return history.select("job_name", "status", "records_processed", "records_inserted", "records_failed")


@query(
    "table_lineage",
    "Q14 I9",
    """
SELECT 'bronze.raw_' || e AS target_table, 'ingest' AS transformation_type, 1::bigint AS source_count,
  CASE e WHEN 'departments' THEN (SELECT count(*) FROM nation) ELSE (SELECT count(*) FROM part) END AS row_count
FROM (VALUES ('departments'), ('courses')) v(e)""",
)
def table_lineage(t: Tables):
    """Two feeds ingested; each table's recorded sources next to its row count."""
    feeds = {}
    for name in ("departments", "courses"):
        path = new_path(t.spark, f"feed-{name}")
        getattr(standins, name)(t).drop("_ingested_at", "_row").write.option("header", True).csv(path)
        feeds[name] = (path, "csv")
    warehouse = Warehouse(t.spark, new_path(t.spark, "lake"), dt.datetime.fromisoformat(standins.STAMP))
    warehouse.build_bronze(feeds)
    warehouse.write_audit()
    audit = warehouse.lake.read
    counts = audit("audit", "etl_job_history").select(
        F.col("job_name").alias("target_table"), F.col("records_processed").alias("row_count")
    )
    sources = (
        audit("audit", "data_lineage")
        .groupBy("target_table", "transformation_type")
        .agg(F.count(F.lit(1)).alias("source_count"))
    )
    return sources.join(counts, "target_table")
