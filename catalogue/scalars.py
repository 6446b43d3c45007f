"""Column functions on the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from catalogue.registry import Tables, query
from starbuild.functions import dates, text, values
from starbuild.operators import merge
from starbuild.operators.validate import EMAIL_PATTERN, Rule, matches, required, validate
from starbuild.plans import university as uni

_MESSY_SOURCE = "case when lang = 'fr' then '   ' when lang = 'de' then ' ' || source || ' ' else source end"


@query(
    "clean_strings",
    "C1 C2",
    f"""
SELECT doc_id, nullif(trim({_MESSY_SOURCE}), '') AS source, trim({_MESSY_SOURCE}) AS trimmed_source,
  nullif(trim(lang), '') AS lang, sha256(nullif(trim(text), '')) AS text_hash
FROM documents""",
)
def clean_strings(t: Tables):
    messy = t.documents.withColumn("source", F.expr(_MESSY_SOURCE)).withColumn("trimmed_source", F.col("source"))
    clean = text.trim_strings(text.clean_strings(messy, ["source", "lang", "text"]), ["trimmed_source"])
    return clean.select("doc_id", "source", "trimmed_source", "lang", F.sha2("text", 256).alias("text_hash"))


_EMAIL = "' ' || c_name || '@Example.COM '"
_PHONE = "'+84 (90) ' || cast(c_custkey as string) || '-' || cast(c_nationkey as string)"
_SEGMENT = "case when c_acctbal < 0 then null else c_mktsegment end"


@query(
    "normalize_contact",
    "C3 C4 C5",
    f"""
SELECT c_custkey, lower(trim({_EMAIL})) AS email, regexp_replace({_PHONE}, '[^0-9+]', '', 'g') AS phone,
  ({_SEGMENT}) || ' ' || c_name AS full_name
FROM customer""",
)
def normalize_contact(t: Tables):
    raw = t.customer.selectExpr("c_custkey", f"{_EMAIL} AS email", f"{_PHONE} AS phone", f"{_SEGMENT} AS seg", "c_name")
    df = text.clean_phone(text.normalize_email(raw))
    return df.select(
        "c_custkey", "email", "phone", text.joined_name(F.col("seg"), F.col("c_name")).alias("full_name")
    )


_GENDER = (
    "case c_mktsegment when 'BUILDING' then 'm' when 'FURNITURE' then 'nam' when 'MACHINERY' then 'nữ' "
    "when 'HOUSEHOLD' then 'NU' else null end"
)
_STATUS = (
    "case c_mktsegment when 'BUILDING' then 'đang học' when 'FURNITURE' then 'tốt nghiệp' "
    "when 'MACHINERY' then 'thôi học' when 'HOUSEHOLD' then 'tạm nghỉ' else '?' end"
)


@query(
    "standardize_alias",
    "C6 C7 F5",
    f"""
SELECT c_custkey,
  CASE WHEN upper({_GENDER}) IN ('M', 'MALE', 'NAM') THEN 'Male'
       WHEN upper({_GENDER}) IN ('F', 'FEMALE', 'NỮ', 'NU') THEN 'Female' ELSE 'Other' END AS gender,
  CASE upper({_STATUS}) WHEN 'ĐANG HỌC' THEN 'Active' WHEN 'TỐT NGHIỆP' THEN 'Graduated'
       WHEN 'THÔI HỌC' THEN 'Dropped' WHEN 'TẠM NGHỈ' THEN 'Suspended' ELSE 'Unknown' END AS status
FROM customer""",
)
def standardize_alias(t: Tables):
    return t.customer.select(
        "c_custkey", uni.gender(F.expr(_GENDER)).alias("gender"), uni.status(F.expr(_STATUS)).alias("status")
    )


_PROVINCE = (
    "case s_nationkey % 8 when 0 then 'Hà Nội' when 1 then 'Ha Noi' when 2 then 'Huế' when 3 then 'Quảng Bình' "
    "when 4 then 'TP HCM' when 5 then 'Da Nang' when 6 then null else 'Long An' end"
)


@query(
    "standardize_region",
    "C8",
    f"""
SELECT s_suppkey,
  CASE s_nationkey % 8 WHEN 0 THEN 'Miền Bắc' WHEN 2 THEN 'Miền Trung' WHEN 3 THEN 'Miền Trung'
    WHEN 4 THEN 'Miền Nam' WHEN 7 THEN 'Miền Nam' ELSE 'Khác' END AS region,
  CASE s_nationkey % 8 WHEN 0 THEN 'Miền Bắc' WHEN 2 THEN 'Miền Trung'
    WHEN 4 THEN 'Miền Nam' WHEN 7 THEN 'Miền Nam' ELSE 'Khác' END AS region_short,
  CASE s_nationkey % 8 WHEN 0 THEN 'Miền Bắc' WHEN 1 THEN 'Miền Bắc' WHEN 2 THEN 'Miền Trung'
    WHEN 3 THEN 'Miền Trung' WHEN 4 THEN 'Miền Nam' WHEN 5 THEN 'Miền Trung' WHEN 7 THEN 'Miền Nam'
    ELSE 'Khác' END AS region_folded
FROM supplier""",
)
def standardize_region(t: Tables):
    province = F.expr(_PROVINCE)
    return t.supplier.select(
        "s_suppkey",
        uni.region(province).alias("region"),
        uni.region(province, short=True).alias("region_short"),
        uni.region(province, ignore_accents=True).alias("region_folded"),
    )


@query(
    "standardize_from_table",
    "C6",
    """
SELECT p_partkey, coalesce(a.standard, 'Unlisted') AS p_brand
FROM part LEFT JOIN (
  SELECT upper(s_name) AS alias, min('Supplier nation ' || cast(s_nationkey AS varchar)) AS standard
  FROM supplier GROUP BY 1) a
ON upper('supplier#' || lpad(cast(p_partkey AS varchar), 9, '0')) = a.alias""",
)
def standardize_from_table(t: Tables):
    aliases = t.supplier.select(
        F.col("s_name").alias("alias"), F.expr("'Supplier nation ' || cast(s_nationkey as string)").alias("standard")
    )
    coded = t.part.select(
        "p_partkey", F.expr("'supplier#' || lpad(cast(p_partkey as string), 9, '0')").alias("p_brand")
    )
    return text.standardize_from_table(coded, "p_brand", aliases, default="Unlisted")


_LETTER = (
    "case when l_linestatus = 'O' and l_returnflag = 'N' then null when l_quantity >= 45 then 'A' "
    "when l_quantity >= 40 then 'A-' when l_quantity >= 35 then 'B+' when l_quantity >= 30 then 'B-' "
    "when l_quantity >= 20 then 'C+' when l_quantity >= 10 then 'D+' else 'D' end"
)


@query(
    "value_map_points",
    "C9",
    f"""
SELECT letter, cast(CASE letter WHEN 'A' THEN 4.0 WHEN 'A-' THEN 3.7 WHEN 'B+' THEN 3.3 WHEN 'B-' THEN 2.7
    WHEN 'C+' THEN 2.3 WHEN 'D' THEN 1.0 WHEN 'D+' THEN 0.0 END AS double) AS points, count(*) AS line_count
FROM (SELECT {_LETTER} AS letter FROM lineitem) x GROUP BY letter""",
)
def value_map_points(t: Tables):
    graded = t.lineitem.select(F.expr(_LETTER).alias("letter"))
    points = graded.withColumn("points", uni.letter_points(F.col("letter")))
    return points.groupBy("letter", "points").agg(F.count(F.lit(1)).alias("line_count"))


@query(
    "step_points",
    "C10",
    """
SELECT l_quantity, cast(CASE WHEN l_quantity / 5 >= 8.5 THEN 4 WHEN l_quantity / 5 >= 7 THEN 3
    WHEN l_quantity / 5 >= 5.5 THEN 2 WHEN l_quantity / 5 >= 4 THEN 1 ELSE 0 END AS double) AS points,
  count(*) AS line_count
FROM (SELECT nullif(l_quantity, 13) AS l_quantity FROM lineitem) x GROUP BY l_quantity""",
)
def step_points(t: Tables):
    scored = t.lineitem.select(F.nullif(F.col("l_quantity"), F.lit(13.0)).alias("l_quantity"))
    points = scored.withColumn("points", uni.score_points(F.col("l_quantity") / 5))
    return points.groupBy("l_quantity", "points").agg(F.count(F.lit(1)).alias("line_count"))


@query(
    "bucketize",
    "C11 C22",
    """
SELECT p_partkey, CASE WHEN p_size < 20 THEN 'Under 20' WHEN p_size < 25 THEN '20-24' WHEN p_size < 30 THEN '25-29'
    WHEN p_size < 35 THEN '30-34' ELSE '35+' END AS size_group,
  CASE WHEN p_size % 6 < 3 THEN 'Light' WHEN p_size % 6 = 3 THEN 'Standard' ELSE 'Heavy' END AS credit_category
FROM part""",
)
def bucketize(t: Tables):
    return t.part.select(
        "p_partkey",
        values.bucketize(F.col("p_size"), uni.AGE_BOUNDS, uni.AGE_LABELS, "35+").alias("size_group"),
        uni.credit_category(F.col("p_size") % 6).alias("credit_category"),
    )


@query(
    "date_diffs",
    "C13 C14 C15",
    """
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_partkey, l_suppkey,
  cast(floor(date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) / 365.0) AS bigint) AS years_by_days,
  cast(extract(year FROM age(cast(l_shipdate AS date), cast(o_orderdate AS date))) AS bigint) AS years_by_calendar,
  cast(floor(date_diff('day', cast(o_orderdate AS date), cast(l_shipdate AS date)) / 7.0) AS bigint) AS weeks
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def date_diffs(t: Tables):
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    start, end = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return lines.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        dates.years_by_days(start, end).alias("years_by_days"),
        dates.years_by_calendar(start, end).alias("years_by_calendar"),
        dates.weeks_between(start, end).alias("weeks"),
    )


_MESSY_DATE = (
    "case o_orderpriority when '1-URGENT' then '2020-13-01' when '2-HIGH' then '' when '3-MEDIUM' then 'soon' "
    "else cast(cast(o_orderdate as date) as string) end"
)


@query(
    "parse_dates",
    "C12",
    f"SELECT o_orderkey, cast(try_cast({_MESSY_DATE} AS date) AS varchar) AS order_day FROM orders",
)
def parse_dates(t: Tables):
    return t.orders.select("o_orderkey", dates.parse_date(F.expr(_MESSY_DATE)).alias("order_day"))


@query(
    "date_parts",
    "C23 C24",
    """
SELECT d AS order_day, count(*) AS order_count, year(d) * 10000 + month(d) * 100 + day(d) AS date_key, year(d) AS year,
  quarter(d) AS quarter, month(d) AS month, strftime(d, '%B') AS month_name, week(d) AS week, day(d) AS day,
  strftime(d, '%A') AS day_name, dayofweek(d) AS day_of_week, dayofweek(d) IN (0, 6) AS is_weekend,
  CASE WHEN month(d) >= 7 THEN year(d) ELSE year(d) - 1 END AS fiscal_year,
  cast(CASE WHEN month(d) >= 10 THEN 2 WHEN month(d) >= 7 THEN 1 WHEN month(d) >= 4 THEN 4 ELSE 3 END AS bigint) AS fiscal_quarter
FROM (SELECT cast(o_orderdate AS date) AS d FROM orders) x GROUP BY d""".replace("d AS order_day", "cast(d AS varchar) AS order_day"),
)
def date_parts(t: Tables):
    days = t.orders.groupBy(F.col("o_orderdate").cast("date").alias("order_day")).agg(
        F.count(F.lit(1)).alias("order_count")
    )
    day = F.col("order_day")
    return days.withColumn("date_key", dates.date_key(day)).withColumns(dates.calendar_parts(day))


def pct(part: str, whole: str) -> str:
    """SQL of a percentage rounded half up to two places, NULL over zero."""
    ratio = f"100 * cast({part} AS double) / nullif({whole}, 0)"
    return f"cast(round(cast({ratio} AS decimal(20,10)), 2) AS double)"


def mean(value: str, digits: int = 2) -> str:
    """SQL of a mean taken from a decimal sum, rounded half up."""
    ratio = f"cast(sum(cast({value} AS decimal(18,4))) AS double) / nullif(count({value}), 0)"
    return f"cast(round(cast({ratio} AS decimal(20,10)), {digits}) AS double)"


@query(
    "safe_rate",
    "C16 C25",
    f"""
SELECT l_orderkey, {pct("a", "a + b")} AS share
FROM (SELECT l_orderkey, sum(cast(round(l_discount * 100) AS int)) AS a, sum(cast(round(l_tax * 100) AS int)) AS b
      FROM lineitem GROUP BY l_orderkey) x""",
)
def safe_rate(t: Tables):
    sums = t.lineitem.groupBy("l_orderkey").agg(
        F.sum(F.round(F.col("l_discount") * 100).cast("int")).alias("a"),
        F.sum(F.round(F.col("l_tax") * 100).cast("int")).alias("b"),
    )
    return sums.select("l_orderkey", values.percentage(F.col("a"), F.col("a") + F.col("b")).alias("share"))


_GROSS = "cast(l_extendedprice as decimal(15,2))"
_GRANT = "case when l_returnflag = 'R' then null else cast(floor(l_extendedprice / 4) as decimal(15,2)) end"
_CUT = (
    "case when l_quantity = 7 then cast(l_extendedprice as decimal(15,2)) - coalesce("
    f"{_GRANT}, 0) else cast(floor(l_extendedprice * l_discount) as decimal(15,2)) end"
)
_PAID = "cast(floor(l_extendedprice * 0.75) as decimal(15,2))"


@query(
    "money_columns",
    "C17 C18",
    f"""
SELECT l_orderkey, cast(l_linenumber AS bigint) AS l_linenumber, l_partkey, l_suppkey, cast(total_discount AS double) AS total_discount,
  cast(gross - total_discount AS double) AS net_amount, cast(gross - total_discount - paid AS double) AS balance_amount,
  {pct("paid", "cast(gross - total_discount AS double)")} AS payment_ratio,
  gross - total_discount - paid <= 0 AS is_fully_paid
FROM (SELECT *, coalesce(scholarship, 0) + coalesce(cut, 0) AS total_discount FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_GROSS} AS gross, {_GRANT} AS scholarship, {_CUT} AS cut,
    {_PAID} AS paid FROM lineitem) y) x""",
)
def money_columns(t: Tables):
    raw = t.lineitem.selectExpr(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", f"{_GROSS} AS tuition_amount",
        f"{_GRANT} AS scholarship_amount", f"{_CUT} AS discount_amount", f"{_PAID} AS paid_amount",
    )
    return values.with_money_columns(raw).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "total_discount", "net_amount", "balance_amount",
        "payment_ratio", values.stays_within(F.col("balance_amount"), 0).alias("is_fully_paid"),
    )


@query(
    "threshold_flags",
    "C18 C26",
    """
SELECT o_orderkey, coalesce(points >= 3.5, false) AS high_gpa, coalesce(rate < 70, false) AS at_risk,
  coalesce(points >= 5.0, false) AS passed, points >= 5.0 AS passed_or_unknown
FROM (SELECT o_orderkey, o_totalprice / 50000 AS points,
        CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice / 5000 END AS rate FROM orders) x""",
)
def threshold_flags(t: Tables):
    points = F.col("o_totalprice") / 50000
    rate = F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") / 5000)
    return t.orders.select(
        "o_orderkey",
        uni.is_high_gpa(points).alias("high_gpa"),
        uni.is_at_risk(rate).alias("at_risk"),
        values.reaches(points, uni.PASSING_SCORE).alias("passed"),
        values.reaches(points, uni.PASSING_SCORE, null_as=None).alias("passed_or_unknown"),
    )


@query(
    "row_hash",
    "C19",
    f"""
SELECT c_custkey, sha256(
  coalesce(cast(length(c_name) AS varchar) || ':' || c_name, '-') ||
  coalesce(cast(length({_SEGMENT}) AS varchar) || ':' || {_SEGMENT}, '-') ||
  coalesce(cast(length(cast(c_nationkey AS varchar)) AS varchar) || ':' || cast(c_nationkey AS varchar), '-')
) AS row_hash FROM customer""",
)
def row_hash(t: Tables):
    hashed = values.row_hash(F.col("c_name"), F.expr(_SEGMENT), F.col("c_nationkey"))
    return t.customer.select("c_custkey", hashed.alias("row_hash"))


_MAIL = "case when c_acctbal < 0 then null when c_nationkey = 3 then 'bad' else lower(replace(c_name, '#', '.')) || '@example.com' end"
_KEY = "case when c_mktsegment = 'BUILDING' and c_nationkey < 4 then null else c_custkey end"
_MAIL_OK = f"coalesce(regexp_matches({_MAIL}, '{EMAIL_PATTERN}'), false)"
_KEY_OK = f"({_KEY}) IS NOT NULL"
_MONEY_OK = "coalesce(c_acctbal > -500, false)"


def _messy_customers(t: Tables):
    return t.customer.selectExpr("c_custkey", "c_acctbal", f"{_KEY} AS customer_key", f"{_MAIL} AS email")


def _customer_rules():
    return [
        required("customer_key"),
        matches("email", EMAIL_PATTERN, "Invalid email format"),
        Rule(F.col("c_acctbal") > -500, "Balance too low"),
    ]


@query(
    "validate_first_error",
    "C20 C21 V1",
    f"""
SELECT c_custkey, {_KEY_OK} AND {_MAIL_OK} AND {_MONEY_OK} AS is_valid,
  CASE WHEN NOT {_KEY_OK} THEN 'Missing customer_key' WHEN NOT {_MAIL_OK} THEN 'Invalid email format'
    WHEN NOT {_MONEY_OK} THEN 'Balance too low' ELSE '' END AS validation_errors
FROM customer""",
)
def validate_first_error(t: Tables):
    checked = validate(_messy_customers(t), _customer_rules())
    return checked.select("c_custkey", "is_valid", "validation_errors")


@query(
    "validate_all_errors",
    "C21",
    f"""
SELECT c_custkey, {_KEY_OK} AND {_MAIL_OK} AND {_MONEY_OK} AS is_valid,
  concat_ws('; ', CASE WHEN NOT {_KEY_OK} THEN 'Missing customer_key' END,
    CASE WHEN NOT {_MAIL_OK} THEN 'Invalid email format' END,
    CASE WHEN NOT {_MONEY_OK} THEN 'Balance too low' END) AS validation_errors
FROM customer""",
)
def validate_all_errors(t: Tables):
    checked = validate(_messy_customers(t), _customer_rules(), report="all")
    return checked.select("c_custkey", "is_valid", "validation_errors")


@query(
    "incremental_window",
    "I7 I6",
    "SELECT event_id, user_id, event_type, value FROM events WHERE ts >= DATE '2024-01-20' - 1",
)
def incremental_window(t: Tables):
    return merge.recent_rows(t.events, "ts", "2024-01-20", 1).select("event_id", "user_id", "event_type", "value")


@query(
    "conditional_rate",
    "A6",
    f"""
SELECT event_type, {pct("sum(CASE WHEN value > 50 THEN 1 ELSE 0 END)", "count(*)")} AS high_value_rate,
  {mean("value")} AS avg_value, count(*) AS event_count FROM events GROUP BY event_type""",
)
def conditional_rate(t: Tables):
    return t.events.groupBy("event_type").agg(
        values.rate(F.col("value") > 50).alias("high_value_rate"),
        values.exact_avg(F.col("value")).alias("avg_value"),
        F.count(F.lit(1)).alias("event_count"),
    )
