"""Column functions on hostile values."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from starbuild.functions import dates, text, values
from starbuild.plans import university as uni


def column(spark, data, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(data)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expression(F.col("v"))).collect()]


def test_blank_strings(spark):
    assert column(spark, ["  a ", "   ", "", None, "\t"], "string", text.blank_to_null) == ["a", None, None, None, "\t"]


def test_trim_only_keeps_empty(rows):
    out = text.trim_strings(rows([(" ", " x ")], "a string, b string"), ["a", "b"]).first()
    assert tuple(out) == ("", "x")


def test_contact_forms(rows):
    df = rows([("  A.B@Example.COM ", "+84 (90) 123-4567")], "email string, phone string")
    out = text.clean_phone(text.normalize_email(df)).first()
    assert tuple(out) == ("a.b@example.com", "+84901234567")


def test_name_is_null_with_a_missing_part(spark):
    def build(c):
        return text.joined_name(F.lit("Le"), c)

    assert column(spark, ["Van", None], "string", build) == ["Le Van", None]


def test_gender_aliases(spark):
    found = column(spark, ["nam", "Nữ", "NU", "m", "female", "x", None], "string", uni.gender)
    assert found == ["Male", "Female", "Female", "Male", "Female", "Other", "Other"]


def test_status_aliases(spark):
    given = ["đang học", "Enrolled", "tốt nghiệp", "bỏ học", "THÔI HỌC", "tạm nghỉ", "?", None]
    assert column(spark, given, "string", uni.status) == [
        "Active", "Active", "Graduated", "Dropped", "Dropped", "Suspended", "Unknown", "Unknown",
    ]


def test_region_is_exact_unless_folded(spark):
    given = ["Hà Nội", "Ha Noi", "TP HCM", "hà nội", None]
    assert column(spark, given, "string", uni.region) == ["Miền Bắc", "Khác", "Miền Nam", "Khác", "Khác"]
    folded = column(spark, given, "string", lambda c: uni.region(c, ignore_accents=True))
    assert folded == ["Miền Bắc", "Miền Bắc", "Miền Nam", "Khác", "Khác"]


def test_accents(spark):
    assert column(spark, ["Đà Nẵng, Quảng Ngãi"], "string", text.without_accents) == ["Da Nang, Quang Ngai"]


def test_alias_table_never_multiplies_rows(rows):
    codes = rows([(1, "a"), (2, "B"), (3, None), (4, "z")], "id int, code string")
    aliases = rows([("A", "first"), ("a", "alpha"), ("b", "beta"), (None, "none")], "alias string, standard string")
    out = text.standardize_from_table(codes, "code", aliases, default="?").orderBy("id").collect()
    assert [r.code for r in out] == ["alpha", "beta", "?", "?"]


def test_letter_points(spark):
    found = column(spark, ["A", "A-", "B+", "B", "B-", "C+", "C", "D", "D+", "F", None], "string", uni.letter_points)
    assert [None if v is None else float(v) for v in found] == [4, 3.7, 3.3, 3, 2.7, 2.3, 2, 1, 0, 0, None]


def test_score_points_and_passing(spark):
    scores = [Decimal(s) if s else None for s in ("8.5", "7.0", "5.5", "4.0", "3.99", "5.0", "4.99", None)]
    points = column(spark, scores, "decimal(5,2)", uni.score_points)
    assert [float(p) for p in points] == [4, 3, 2, 1, 0, 1, 1, 0]
    passed = column(spark, scores, "decimal(5,2)", lambda c: values.reaches(c, uni.PASSING_SCORE))
    assert passed == [True, True, True, False, False, True, False, False]
    unknown = column(spark, scores, "decimal(5,2)", lambda c: values.reaches(c, uni.PASSING_SCORE, None))
    assert unknown[-1] is None


def test_buckets(spark):
    born = [dt.date(1982, 1, 1), dt.date(1982, 1, 10), dt.date(1970, 1, 1), dt.date(1950, 1, 1), None]
    groups = column(spark, born, "date", lambda c: uni.age_group(c, "2002-01-01"))
    assert groups == ["20-24", "Under 20", "30-34", "35+", "35+"]
    by_calendar = column(spark, born, "date", lambda c: uni.age_group(c, "2002-01-01", calendar_years=True))
    assert by_calendar == ["20-24", "Under 20", "30-34", "35+", "35+"]
    assert column(spark, [0, 1, 2, 3, 4, 9, None], "int", uni.credit_category) == [
        "Light", "Light", "Light", "Standard", "Heavy", "Heavy", None,
    ]


def test_bucket_arguments():
    with pytest.raises(ValueError):
        values.bucketize(None, [1, 2], ["a", "b"])
    with pytest.raises(ValueError):
        values.bucketize(None, [2, 1], ["a", "b", "c"])


def test_year_counts_differ(rows):
    pairs = [
        ("2004-05-05", "2024-05-04", 20, 19),
        ("2004-05-05", "2024-05-05", 20, 20),
        ("2004-02-29", "2005-02-28", 1, 0),
        ("2020-06-01", "2019-06-02", -1, 0),
    ]
    df = rows([(a, b) for a, b, _, _ in pairs], "a string, b string")
    a, b = F.col("a").cast("date"), F.col("b").cast("date")
    out = df.select(dates.years_by_days(a, b).alias("d"), dates.years_by_calendar(a, b).alias("c")).collect()
    assert [r.c for r in out] == [c for _, _, _, c in pairs]
    assert [r.d for r in out] == [20, 20, 1, -1]


def test_bad_dates_become_null(spark):
    found = column(spark, ["2020-13-01", "2020-02-29", "", "x", None], "string", dates.parse_date)
    assert found == [None, dt.date(2020, 2, 29), None, None, None]


def test_percentage_guards(rows):
    df = rows([(28, 2), (0, 0), (0, 5), (None, 3)], "a int, b int")
    out = [r[0] for r in df.select(values.percentage(F.col("a"), F.col("a") + F.col("b"))).collect()]
    assert out == [93.33, None, 0.0, None]


def test_money(rows):
    d = Decimal
    df = rows(
        [(d("5000"), d("1000"), None, d("4000")), (d("100"), d("100"), d("0"), d("0")), (d("100"), None, d("150"), d("10"))],
        "tuition_amount decimal(15,2), scholarship_amount decimal(15,2), discount_amount decimal(15,2), paid_amount decimal(15,2)",
    )
    out = values.with_money_columns(df)
    assert dict(out.dtypes)["payment_ratio"] == "decimal(9,2)"
    got = [tuple(r)[4:] for r in out.collect()]
    assert got == [
        (d("1000"), d("4000"), d("0"), d("100")),
        (d("100"), d("0"), d("0"), None),
        (d("150"), d("-50"), d("-60"), d("-20")),
    ]


def test_row_hash_separates(rows):
    df = rows([("ab", "c"), ("a", "bc"), (None, "x"), ("", "x"), ("-", "x")], "a string, b string")
    hashes = [r[0] for r in df.select(values.row_hash(F.col("a"), F.col("b"))).collect()]
    assert len(set(hashes)) == 5


def test_mean_does_not_depend_on_order(spark):
    df = spark.range(0, 3000, numPartitions=7).selectExpr("cast(id % 7 as double) / 10 AS v")
    one = df.agg(values.exact_avg(F.col("v"), 4)).first()[0]
    two = df.orderBy(F.col("v").desc()).agg(values.exact_avg(F.col("v"), 4)).first()[0]
    assert one == two == Decimal("0.2998")


def test_calendar_parts(rows):
    df = rows([("2021-01-03",), ("2020-06-30",), ("2020-07-01",), ("2020-12-31",)], "d string").select(
        F.col("d").cast("date").alias("d")
    )
    out = df.withColumns({**dates.calendar_parts(F.col("d")), "key": dates.date_key(F.col("d"))}).collect()
    assert [r.key for r in out] == [20210103, 20200630, 20200701, 20201231]
    assert [(r.day_of_week, r.is_weekend, r.week) for r in out][:2] == [(0, True, 53), (2, False, 27)]
    assert [(r.fiscal_year, r.fiscal_quarter) for r in out] == [(2020, 3), (2019, 4), (2020, 1), (2020, 2)]
    assert out[0].month_name == "January" and out[0].day_name == "Sunday"
