"""Table operators: duplicates, lookups, keys, versions, merges, checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from starbuild.operators import dedup, keys, layout, ledger, lookup, merge, quality, scd2
from starbuild.operators.calendar import date_dimension
from starbuild.operators.validate import EMAIL_PATTERN, Rule, matches, required, validate
from starbuild.sources.lake import row_id


def table(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]


# -- rules and duplicates -----------------------------------------------------


def test_rules_treat_unknown_as_broken(rows):
    df = rows(
        [(1, "a@b.co"), (2, None), (3, ""), (4, "a@b"), (None, "bad")], "id int, email string"
    )
    rules = [required("id"), matches("email", EMAIL_PATTERN, "Invalid email format")]
    out = {r.email: (r.is_valid, r.validation_errors) for r in validate(df, rules).collect()}
    assert out["a@b.co"] == (True, [])
    assert out[None] == out[""] == out["a@b"] == (False, ["Invalid email format"])
    assert out["bad"] == (False, ["Missing id"])
    every = {r.email: r.validation_errors for r in validate(df, rules, "all").collect()}
    assert every["bad"] == ["Missing id", "Invalid email format"]
    assert dict(validate(df, []).dtypes)["validation_errors"] == "array<string>"
    with pytest.raises(ValueError):
        validate(df, rules, "some")


def test_range_rule(rows):
    df = validate(rows([(1,), (-1,), (None,)], "net int"), [Rule(F.col("net") >= 0, "Negative net amount")])
    assert [r.is_valid for r in df.collect()] == [True, False, False]


COPIES = [
    ("a", 1, "x"), ("a", 2, "p"), ("a", 2, "q"), ("b", None, "r"), ("b", 1, "s"),
    (None, 1, "t"), (None, 1, "t"), ("c", 3, "same"), ("c", 3, "same"),
]


@pytest.mark.parametrize("operator", [dedup.keep_latest, dedup.keep_latest_by_aggregate])
def test_latest_row(rows, operator):
    df = rows(COPIES, "k string, ts int, v string")
    out = table(operator(df, ["k"], ["ts"], ["v"]), "k", "v")
    assert out == [(None, 1, "t"), (None, 1, "t"), ("a", 2, "q"), ("b", 1, "s"), ("c", 3, "same")]
    assert len(table(operator(df, ["k"], ["ts"], ["v"], null_keys="drop"), "k")) == 3
    assert len(table(operator(df, ["k"], ["ts"], ["v"], null_keys="group"), "k")) == 4


def test_default_tie_break_is_stable(rows):
    df = rows(COPIES, "k string, ts int, v string")
    runs = {tuple(table(dedup.keep_latest(df.repartition(n), ["k"], ["ts"]), "k", "v")) for n in (1, 3, 7)}
    assert len(runs) == 1


def test_hot_key_is_cut_before_the_shuffle(spark):
    df = spark.range(1000).selectExpr("case when id % 3 = 0 then 0 else id end AS k", "id AS ts")
    latest = dedup.keep_latest(df, ["k"], ["ts"], ["ts"], null_keys="drop")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2
    assert latest.count() == df.select("k").distinct().count()


def test_assert_unique(rows):
    good = rows([("a", 1), ("b", 2), (None, 3), (None, 4)], "k string, v int")
    assert dedup.assert_unique(good, ["k"]).count() == 4
    with pytest.raises(Exception, match="more than one row"):
        dedup.assert_unique(rows([("a", 1), ("a", 2)], "k string, v int"), ["k"]).collect()
    with pytest.raises(Exception, match="more than one row"):
        dedup.assert_unique(rows([("a", 1), ("a", 1)], "k string, v int"), ["k"]).collect()


# -- lookups ------------------------------------------------------------------

FACTS = [(1, "x"), (2, "y"), (3, None), (4, "nowhere"), (5, "x")]


def test_lookup(rows):
    facts = rows(FACTS, "id int, code string")
    dim = rows([("x", 10), ("y", 20), (None, 30)], "code string, code_key int")
    found = lookup.lookup_key(facts, dim, "code", "code_key")
    assert table(found.select("id", "code_key"), "id") == [(1, 10), (2, 20), (3, None), (4, None), (5, 10)]
    assert found.columns == ["id", "code", "code_key"]
    none = lookup.lookup_key(facts, None, "code", "code_key")
    assert none.where(F.col("code_key").isNull()).count() == 5
    counts = lookup.unresolved_counts(found, ["code_key"]).first()
    assert tuple(counts) == (5, 2, 2)
    assert lookup.resolved(found, ["code_key"]).count() == 3
    assert lookup.orphans(facts, "code", dim, "code").first().id == 4


def test_lookup_with_hot_values_gives_the_same(spark):
    facts = spark.range(3000).selectExpr(
        "id", "case when id % 3 = 0 then 7 when id % 11 = 0 then null else id % 500 end AS code"
    )
    dim = spark.range(0, 400).selectExpr("id AS code", "id * 2 AS code_key")
    plain = lookup.lookup_key(facts, dim, "code", "code_key")
    skewed = lookup.lookup_key_skewed(facts, dim, "code", "code_key", share=0.05, spread=64)
    assert skewed.columns == plain.columns
    assert table(skewed, "id") == table(plain, "id")
    assert [r.code for r in lookup.heavy_values(facts, "code", 0.05).collect()] == [7]


def test_hot_rows_spread_over_the_join(spark):
    """The rows of a hot value do not meet in one partition of the shuffled join."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        facts = spark.range(4000).selectExpr("id", "case when id % 2 = 0 then 7 else id end AS code")
        dim = spark.range(0, 4000).selectExpr("id AS code", "id * 2 AS code_key")
        out = lookup.lookup_key_skewed(facts, dim, "code", "code_key", share=0.1)
        sizes = [r["count"] for r in out.groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 4000 and max(sizes) < 1500
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_date_keys(spark, rows):
    df = rows([("2019-12-31",), ("2020-01-01",), (None,)], "d string").select(F.col("d").cast("date").alias("d"))
    calendar = date_dimension(spark, "2020-01-01", "2020-12-31")
    joined = lookup.lookup_date_key(df, "d", "k", calendar)
    computed = lookup.lookup_date_key(df, "d", "k", first="2020-01-01", last="2020-12-31")
    assert sorted(r.k or 0 for r in joined.collect()) == sorted(r.k or 0 for r in computed.collect()) == [0, 0, 20200101]
    with pytest.raises(ValueError):
        lookup.lookup_date_key(df, "d", "k")


def test_calendar(spark, rows):
    whole = date_dimension(spark)
    assert whole.count() == 4018
    holiday = rows([(dt.date(2020, 1, 1),), (dt.date(2020, 1, 1),)], "full_date date")
    first = date_dimension(spark, "2020-01-01", "2020-01-02", holiday)
    assert table(first.select("date_key", "is_holiday"), "date_key") == [(20200101, True), (20200102, False)]
    kept = date_dimension(spark, "2020-01-01", "2020-01-03", existing=first)
    assert table(kept.select("date_key", "is_holiday"), "date_key") == [
        (20200101, True), (20200102, False), (20200103, False),
    ]


# -- keys ---------------------------------------------------------------------


def test_keys_are_dense_and_ordered(spark):
    df = spark.range(500).selectExpr("'n' || lpad(cast(id * 37 % 500 as string), 4, '0') AS nk", "id AS v").repartition(6)
    out = table(keys.assign_keys(df, ["nk"], "sk"), "nk")
    assert [r[0] for r in out] == list(range(1, 501))


def test_known_keys_stay(rows):
    existing = rows([("b", 7), ("gone", 9)], "nk string, sk bigint")
    out = keys.assign_keys(rows([("c",), ("b",), ("a",)], "nk string"), ["nk"], "sk", existing)
    assert table(out, "sk") == [(7, "b"), (10, "a"), (11, "c")]
    empty = keys.assign_keys(rows([("a",)], "nk string"), ["nk"], "sk", existing.limit(0))
    assert table(empty, "sk") == [(1, "a")]


def test_numbering_runs_in_parallel(spark):
    """Numbering a written, range-partitioned table needs no exchange of its rows at all."""
    numbered = keys.assign_keys(spark.range(100).selectExpr("id AS nk", "id AS v"), ["nk"], "sk")
    plan = numbered._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan and "Join" not in plan


def test_numbered_tables_have_a_known_size(spark):
    """A small keyed dimension is broadcast by the planner's own estimate, before anything has run."""
    numbered = keys.assign_keys(spark.range(100).selectExpr("id AS nk", "id AS v"), ["nk"], "sk")
    facts = lookup.lookup_key(spark.range(1000).withColumnRenamed("id", "nk"), numbered, "nk", "sk")
    assert "BroadcastHashJoin" in facts._jdf.queryExecution().sparkPlan().toString()


# -- versions -----------------------------------------------------------------

SNAP = "id string, name string, city string"


def first(rows):
    snapshot = rows([("1", "ab", "c"), ("2", "x", None), ("3", "y", "z"), ("4", "q", "")], SNAP)
    return keys.assign_keys(scd2.first_versions(snapshot, "2024-01-01", "2024-01-01 02:00:00"), ["id"], "sk")


def second_snapshot(rows):
    return rows([("1", "a", "bc"), ("2", "x", ""), ("3", "y", "z"), ("5", "new", "n")], SNAP)


def state(df):
    out = df.select("id", "name", "city", "effective_start_date", "effective_end_date", "is_current", "sk")
    return [(r[0], r[1], r[2], str(r[3]), r[4] and str(r[4]), r[5], r[6]) for r in out.orderBy("id", "effective_start_date").collect()]


def merge_day(dim, snapshot, day):
    return scd2.merge_versions_with_keys(dim, snapshot, ["id"], ["name", "city"], day, "sk")


def test_merge_closes_and_opens(rows):
    dim = merge_day(first(rows), second_snapshot(rows), "2024-02-01")
    assert state(dim) == [
        ("1", "ab", "c", "2024-01-01", "2024-02-01", False, 1),
        ("1", "a", "bc", "2024-02-01", None, True, 5),
        ("2", "x", None, "2024-01-01", "2024-02-01", False, 2),
        ("2", "x", "", "2024-02-01", None, True, 6),
        ("3", "y", "z", "2024-01-01", None, True, 3),
        ("4", "q", "", "2024-01-01", None, True, 4),
        ("5", "new", "n", "2024-02-01", None, True, 7),
    ]
    assert scd2.version_faults(dim, ["id"]).count() == 0
    again = merge_day(dim, second_snapshot(rows), "2024-02-01")
    assert state(again) == state(dim)


def test_second_change_of_a_day_rewrites(rows):
    dim = merge_day(first(rows), second_snapshot(rows), "2024-02-01")
    later = rows([("1", "third", "t"), ("3", "moved", "z")], SNAP)
    out = state(merge_day(dim, later, "2024-02-01"))
    assert [r for r in out if r[0] == "1"] == [
        ("1", "ab", "c", "2024-01-01", "2024-02-01", False, 1), ("1", "third", "t", "2024-02-01", None, True, 5),
    ]
    assert [r[4:] for r in out if r[0] == "3"] == [("2024-02-01", False, 3), (None, True, 8)]


def test_bad_snapshots_fail(rows):
    dim = merge_day(first(rows), second_snapshot(rows), "2024-02-01")
    with pytest.raises(Exception, match="older than a version"):
        scd2.merge_versions(dim, rows([("1", "z", "z")], SNAP), ["id"], ["name"], "2024-01-15").collect()
    with pytest.raises(Exception, match="more than one row"):
        twice = rows([("1", "z", "z"), ("1", "y", "y")], SNAP)
        scd2.merge_versions(dim, twice, ["id"], ["name"], "2024-03-01").collect()


def test_reading_versions(rows):
    dim = merge_day(first(rows), second_snapshot(rows), "2024-02-01")
    assert scd2.as_of_rows(dim, "2024-01-31").count() == 4
    assert scd2.as_of_rows(dim, "2024-02-01").count() == 5
    assert [r.name for r in scd2.history(dim, "id", "1").collect()] == ["ab", "a"]
    facts = rows([("1", "2024-01-31"), ("1", "2024-02-01"), ("5", "2024-01-15"), ("9", "2024-03-01")], "id string, d string")
    facts = facts.withColumn("d", F.col("d").cast("date"))
    found = lookup.lookup_as_of(facts, dim, "id", "d", "sk")
    assert [r.sk for r in found.orderBy("id", "d").collect()] == [1, 5, None, None]
    assert layout.current_rows(dim).count() == 5


def test_change_sets(rows):
    dim = first(rows)
    assert [r.id for r in scd2.changed_rows(dim, second_snapshot(rows), ["id"], ["name", "city"]).orderBy("id").collect()] == ["1", "2"]
    assert [r.id for r in scd2.new_rows(dim, second_snapshot(rows), ["id"]).collect()] == ["5"]
    both = scd2.new_and_changed(dim, second_snapshot(rows), ["id"], ["name", "city"])
    assert table(both.select("id", "change"), "id") == [("1", "changed"), ("2", "changed"), ("5", "new")]


# -- merges -------------------------------------------------------------------


def test_upsert(rows):
    target = rows([(1, "a"), (2, "b")], "k int, v string")
    updates = rows([(2, "B", 1.0), (3, "C", 2.0)], "k int, v string, extra double")
    merged = merge.upsert(target, updates, ["k"])
    assert table(merged, "k") == [(1, "a", None), (2, "B", 1.0), (3, "C", 2.0)]
    assert table(merge.upsert(merged, updates, ["k"]), "k") == table(merged, "k")
    with pytest.raises(Exception, match="more than one row"):
        merge.upsert(target, rows([(2, "x"), (2, "y")], "k int, v string"), ["k"]).collect()


def test_only_touched_partitions_are_read(spark, tmp_path):
    """With a partitioned target the partition values of the updates prune its scan at run time."""
    spark.range(100).selectExpr("id AS k", "id % 5 AS part", "'old' AS v").write.partitionBy("part").parquet(
        str(tmp_path / "t")
    )
    spark.range(0, 10).selectExpr("id AS k", "id % 5 AS part", "'new' AS v").write.parquet(str(tmp_path / "u"))
    target = spark.read.parquet(str(tmp_path / "t")).withColumn("part", F.col("part").cast("bigint"))
    updates = spark.read.parquet(str(tmp_path / "u")).where("part = 3 and k < 9")
    merged = merge.upsert_partitions(target.select("k", "v", "part"), updates.select("k", "v", "part"), ["k"], ["part"])
    assert "dynamicpruning" in merged._jdf.queryExecution().executedPlan().toString()
    got = {r.k: r.v for r in merged.collect()}
    assert len(got) == 20 and {k for k, v in got.items() if v == "new"} == {3, 8}


def test_snapshot_rows_without_a_key_are_left_out(rows):
    dim = scd2.merge_versions(first(rows), rows([(None, "n", "n"), (None, "m", "m")], SNAP), ["id"], ["name"], "2024-02-01")
    assert dim.count() == 4


def test_high_water_mark(rows):
    source = rows([(1, "2024-01-01 00:00:00"), (2, "2024-01-02 00:00:00")], "k int, t string").withColumn(
        "t", F.col("t").cast("timestamp")
    )
    loaded = source.where("k = 1").withColumnRenamed("t", "loaded")
    assert [r.k for r in merge.newer_rows(source, "t", loaded, "loaded").collect()] == [2]
    assert merge.newer_rows(source, "t", loaded.limit(0), "loaded").count() == 2


def test_recent_window(rows):
    df = rows([("2024-01-01 23:59:59",), ("2024-01-02 00:00:00",)], "t string").withColumn("t", F.col("t").cast("timestamp"))
    assert merge.recent_rows(df, "t", "2024-01-03").count() == 1


# -- quality ------------------------------------------------------------------


def test_checks_and_gate(rows, spark):
    df = rows(
        [(1, "a@b.co", 5, "x"), (2, None, 50, "y"), (2, "bad", None, None), (None, "c@d.ee", 7, "x")],
        "id int, email string, n int, tag string",
    ).withColumn("at", F.lit("2024-01-01 00:00:00").cast("timestamp"))
    checks = [
        quality.row_count(1, 3),
        quality.column_exists("id"),
        quality.column_exists("nope"),
        quality.not_null("id"),
        quality.not_null("email", 0.5),
        quality.unique("id"),
        quality.matches_pattern("email", EMAIL_PATTERN, 0.5),
        quality.in_set("tag", ["x", "y", None]),
        quality.in_range("n", 0, 10, 0.9),
        quality.min_between("n", 0),
        quality.max_between("n", high=10),
        quality.avg_between("n", 0, 100),
        quality.fresh("at", "2024-01-02 00:00:00", 24),
        quality.fresh("at", "2024-01-01 12:00:00", 24),
        quality.failed_rows(F.col("n") > 10, 50, "big"),
        quality.references("tag", rows([("x",)], "t string"), "t"),
    ]
    out = quality.run_checks(df, checks, "t", "2024-01-02 00:00:00", "b").collect()
    assert len(out) == len(checks) and tuple(out[0].asDict()) == quality.RESULT_COLUMNS
    failed = sorted((r.check_name, r.actual_value) for r in out if not r.is_passed)
    assert failed == sorted([
        ("row_count", "4"), ("column_exists_nope", "column missing"), ("missing_count_id", "1"),
        ("duplicate_count_id", "1"), ("range_n", "0.666667"), ("max_n", "50"), ("freshness_at", "24.000000"),
        ("referential_tag", "1"),
    ])
    with pytest.raises(quality.QualityGateError, match="missing_count_id"):
        quality.enforce(quality.run_checks(df, checks, "t"))
    lenient = [c.warn() for c in checks]
    quality.enforce(quality.run_checks(df, lenient, "t"))


def test_plain_checks_take_one_pass(spark, tmp_path):
    spark.range(10).selectExpr("id", "id AS n").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = quality.run_checks(df, [quality.not_null("id"), quality.in_range("n", 0, 5), quality.row_count(1)], "t")
    assert plan._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1


def test_empty_table(rows):
    df = rows([], "id int, at timestamp")
    checks = [quality.not_null("id"), quality.unique("id"), quality.fresh("at", "2024-01-01", 1), quality.row_count(1)]
    out = {r.check_type: r.is_passed for r in quality.run_checks(df, checks, "t").collect()}
    assert out == {"missing_count": True, "duplicate_count": True, "freshness": False, "row_count": False}


# -- late states, lineage, ledger ---------------------------------------------

STATES = "id string, city string, day string"


def versions(df):
    return sorted(((r.id, r.city, str(r.effective_start_date), r.effective_end_date and str(r.effective_end_date), r.is_current) for r in df.collect()), key=str)


def test_states_give_one_history_in_any_order(rows):
    lots = [
        [("1", "a", "2024-01-01"), ("2", "x", "2024-01-01"), ("1", "a", "2024-01-05"), ("3", None, "2024-01-02")],
        [("1", "b", "2024-01-03"), ("2", "x", "2024-01-09"), (None, "x", "2024-01-09"), ("4", "q", None)],
        [("1", "b", "2023-12-31"), ("3", "", "2024-01-01"), ("3", None, "2024-01-03")],
    ]
    whole = versions(scd2.timelines(rows(sum(lots, []), STATES), ["id"], ["city"], "day"))
    assert [v for v in whole if v[0] == "1"] == [
        ("1", "a", "2024-01-01", "2024-01-03", False), ("1", "a", "2024-01-05", None, True),
        ("1", "b", "2023-12-31", "2024-01-01", False), ("1", "b", "2024-01-03", "2024-01-05", False),
    ]
    for order in ([0, 1, 2], [2, 1, 0], [1, 2, 0]):
        first, taken = rows(lots[order[0]], STATES), lots[order[0]]
        dim = keys.assign_keys(scd2.timelines(first, ["id"], ["city"], "day"), ["id", scd2.START], "sk")
        for n in order[1:]:
            before = {(r.id, str(r.effective_start_date)): r.sk for r in dim.collect()}
            dim = scd2.merge_states(dim, rows(taken, STATES), rows(lots[n], STATES), ["id"], ["city"], "day", "sk")
            after = {(r.id, str(r.effective_start_date)): r.sk for r in dim.collect()}
            assert len(set(after.values())) == len(after) and all(after[k] == before[k] for k in after.keys() & before.keys())
            taken = taken + lots[n]
        assert versions(dim) == whole
    corrected = scd2.merge_states(
        scd2.timelines(rows(lots[0], STATES), ["id"], ["city"], "day"), rows(lots[0], STATES), rows([("2", "y", "2024-01-01")], STATES), ["id"], ["city"], "day"
    )
    assert ("2", "y", "2024-01-01", None, True) in versions(corrected)


def test_lineage_closure(rows):
    edges = [("a", "b"), ("b", "c"), ("a", "c"), ("a", "b"), ("c", "d"), ("x", "x")]
    out = quality.lineage_closure(rows(edges, "source_table string, target_table string")).collect()
    assert {(r.target_table, r.source_table, r.steps) for r in out} == {
        ("b", "a", 1), ("c", "a", 1), ("c", "b", 1), ("d", "c", 1), ("d", "a", 2), ("d", "b", 2), ("x", "x", 1),
    }


def test_changes(rows):
    schema = "id string, v string, part int, at int"
    before = rows([("1", "a", 1, 5), ("2", "a", 1, 5), ("3", None, 1, 5), ("4", "a", 1, 5), ("5", "a", 1, 5), (None, "a", 1, 5)], schema)
    after = rows([("1", "b", 2, 4), ("2", "b", 2, 6), ("3", None, 1, 9), ("6", "n", 3, 1), (None, "z", 1, 9)], schema)
    part = F.col("part").cast("string")
    out = ledger.changes(before, after, ["id"], ["v"], part, "at")
    assert table(out.drop("after"), "id") == [("2", "changed", "1", "2"), ("6", "new", None, "3")]
    decided = rows([("1",), ("1",), ("4",), ("7",)], "id string")
    out = ledger.changes(before, after, ["id"], ["v"], part, "at", decided)
    assert table(out.drop("after"), "id") == [("1", "changed", "1", "2"), ("2", "changed", "1", "2"), ("4", "removed", "1", None), ("6", "new", None, "3")]
    touched = ledger.changed_keys(out.drop("after"), ["id"])
    assert table(touched, "id", "part") == [("1", "1"), ("1", "2"), ("2", "1"), ("2", "2"), ("4", "1"), ("6", "3")]


def test_latest_row_in_one_scan(spark, tmp_path):
    """With row identities the input is read once and rows without a key still all pass."""
    data = [(i % 3 if i < 9 else None, i) for i in range(14)] + [(None, 13)]
    spark.createDataFrame(data, "k int, v int").repartition(3).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t")).select("*", row_id())
    latest = dedup.keep_latest(df, ["k"], ["v"], row_id=["_row"]).drop("_row")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan parquet") == 1 and "WindowGroupLimit" in plan and "Union" not in plan
    assert sorted((r.k is None, r.v) for r in latest.collect()) == [(False, 6), (False, 7), (False, 8)] + [(True, v) for v in (9, 10, 11, 12, 13, 13)]
    assert sorted(map(tuple, dedup.keep_latest(df.drop("_row"), ["k"], ["v"]).collect()), key=str) == sorted(map(tuple, latest.collect()), key=str)


def test_checks_by_value_share_one_pass(spark, rows, tmp_path):
    rows([(1, "a", 10), (1, "b", 10), (2, "b", 11), (None, None, None), (3, "c", 99), (3, "c", 99)], "id int, name string, ref int").write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    parent, names = rows([(10,), (11,), (11,), (None,)], "pk bigint"), rows([("a",), ("c",)], "name string")
    checks = [quality.unique("id"), quality.unique("id", "name"), quality.references("ref", parent, "pk"), quality.references("name", names, "name")]
    out = quality.run_checks(df, checks, "t", "2024-01-01")
    assert out._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert [(r.check_name, r.actual_value, r.is_passed) for r in out.collect()] == [
        ("duplicate_count_id", "2", False), ("duplicate_count_id,name", "1", False), ("referential_ref", "2", False), ("referential_name", "2", False),
    ]
    empty = quality.run_checks(df.limit(0), checks, "t", "2024-01-01")
    assert all(r.actual_value == "0" and r.is_passed for r in empty.collect())


def test_sums_kept_up_equal_sums_of_all_rows(rows):
    """Groups that lose an edge, all rows, or nothing; new groups, NULL keys and NULL values, an unchanged row."""
    from starbuild.operators.upkeep import Sums

    schema = "g string, v int"
    kept = [("a", 5), ("a", 7), ("b", None), (None, 3), ("e", 1)]
    left = [("a", 1), ("a", 9), ("c", 4), ("b", 2), ("e", 1), ("d", 6)]
    came = [("a", 6), ("f", None), (None, 8), ("d", 6)]
    amount = "cast(coalesce(v, 0) AS decimal(9,2))"
    sums = Sums(("g",), ("g", "v"), {"total": amount, "known": "if(v IS NULL, 0L, 1L)"}, {"v": "cast(v AS decimal(9,2))"})
    before, after = rows(kept + left, schema), rows(kept + came, schema)
    changes = rows([(*r, -1) for r in left] + [(*r, 1) for r in came], schema + ", _sign int")
    got = sums.kept_up(sums.of(before), changes, after)
    want = sums.of(after)
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    nothing = sums.kept_up(sums.of(before), changes.limit(0), before)
    assert sorted(map(str, nothing.collect())) == sorted(map(str, sums.of(before).collect()))
    plain = Sums(("g",), ("g", "v"), {"total": amount})
    assert sorted(map(str, plain.kept_up(plain.of(before), changes, after).collect())) == sorted(map(str, plain.of(after).collect()))


def test_sums_of_untouched_edges_do_not_read_the_rows(rows, spark, monkeypatch):
    from starbuild.operators.upkeep import Sums

    schema = "g string, v int"
    sums = Sums(("g",), ("g", "v"), {"total": "v"}, {"v": "v"})
    stored = sums.of(rows([("a", 1), ("a", 2), ("a", 3)], schema))
    changes = rows([("a", 2, -1), ("b", 2, 1)], schema + ", _sign int")
    unread = spark.range(1).selectExpr("cast(raise_error('read') AS string) AS g", "1 AS v")
    got = {r.g: (r["rows"], r.total, r.v_min, r.v_max) for r in sums.kept_up(stored, changes, unread).collect()}
    assert got == {"a": (2, 4, 1, 3), "b": (1, 2, 2, 2)}


def test_changes_move_only_the_compared_columns_of_earlier_rows(spark, tmp_path):
    spark.range(4).selectExpr("id AS k", "id AS v", "'x' AS carried_along").write.parquet(str(tmp_path / "before"))
    before = spark.read.parquet(str(tmp_path / "before"))
    after = before.select("k", (F.col("v") * 2).alias("v"))
    found = ledger.changes(before, after, ["k"], ["v"], F.lit("p"))
    assert "carried_along" not in found._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.change) for r in found.collect()) == [(1, "changed"), (2, "changed"), (3, "changed")]


def test_whole_changes_shuffle_each_side_once(spark, tmp_path):
    """Against all rows there are: new, changed, removed and unchanged ones, and rows without a key, which all stay."""
    schema = "id string, v string, part int, at int"
    before = [("1", "a", 1, 5), ("2", "a", 1, 5), ("3", None, 1, 5), ("4", "a", 1, 5), (None, "q", 1, 5)]
    raw = [("1", "b", 2, 4), ("1", "a", 2, 3), ("2", "a", 1, 6), ("3", None, 1, 9), ("6", "n", 3, 1), (None, "z", 1, 9), (None, "z", 1, 9)]
    for name, data in (("before", before), ("raw", raw)):
        spark.createDataFrame(data, schema).repartition(2).write.parquet(str(tmp_path / name))
    read = spark.read.parquet
    after = dedup.keep_latest(read(str(tmp_path / "raw")).select("*", row_id()), ["id"], ["at"], row_id=["_row"], with_apart=True).drop("_row")
    broadcast = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        found = ledger.whole_changes(read(str(tmp_path / "before")), after, ["id"], ["v", "part"], F.col("part").cast("string"), "at")
        plan = found._jdf.queryExecution().executedPlan().toString()
        got = [(r.id or "", r.change, r.part_before, r.part_after, tuple(r.row or ()), r.latest) for r in found.collect()]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", broadcast)
    assert plan.count("Exchange hashpartitioning") == 2 and "FullOuter" in plan
    assert sorted(got, key=str) == [
        ("", None, None, "1", (None, "z", 1, 9), 9), ("", None, None, "1", (None, "z", 1, 9), 9),
        ("1", "changed", "1", "2", ("1", "b", 2, 4), 4), ("2", None, "1", "1", ("2", "a", 1, 5), 6),
        ("3", None, "1", "1", ("3", None, 1, 5), 9), ("4", "removed", "1", None, (), None), ("6", "new", None, "3", ("6", "n", 3, 1), 1),
    ]
