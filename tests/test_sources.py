"""Readers, the lake, JDBC options and the incremental file ingest."""

import datetime as dt
import os
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

import __spark_entry__ as contract
from starbuild import session
from starbuild.operators import layout, merge, staging
from starbuild.plans.specs import DAY, INT, SCORE, TEXT, fields
from starbuild.sources import files, jdbc
from starbuild.sources.lake import Lake, partition_label
from starbuild.sources.registry import KeyRegistry
from starbuild.streaming.ingest import ingest_new_files

SCHEMA = fields(("id", INT), ("name", TEXT), ("score", SCORE), ("day", DAY))


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_csv_binds_by_name(spark, tmp_path):
    path = write(tmp_path / "a.csv", "day,extra,score,name,id\n2020-13-01,x,7.5,An,1\n2020-01-02,y,bad,,2\n")
    out = files.read_csv(spark, path, SCHEMA)
    rows = files.read_source(spark, path, SCHEMA).orderBy("id").collect()
    assert out.columns == ["id", "name", "score", "day", "__file"]
    assert [(r.id, r.name, r.score and float(r.score), r.day) for r in rows] == [
        (1, "An", 7.5, None),
        (2, None, None, dt.date(2020, 1, 2)),
    ]


def test_csv_missing_column_is_an_error(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,day\n1,a,2020-01-01\n")
    with pytest.raises(ValueError, match="score"):
        files.read_csv(spark, path, SCHEMA)


def test_csv_files_with_other_headers_fail(spark, tmp_path):
    write(tmp_path / "f" / "a.csv", "id,name,score,day\n1,a,1.0,2020-01-01\n")
    write(tmp_path / "f" / "b.csv", "name,id,score,day\na,1,1.0,2020-01-01\n")
    with pytest.raises(Exception, match="header"):
        files.read_csv(spark, str(tmp_path / "f"), SCHEMA).collect()


def test_json_parquet_and_unknown_format(spark, tmp_path):
    path = write(tmp_path / "a.json", '{"id": 1, "name": "x", "other": 2}\n{"id": 2, "score": 3.25}\n')
    rows = files.read_source(spark, path, SCHEMA, "json").orderBy("id").collect()
    assert [(r.id, r.name, r.score and float(r.score)) for r in rows] == [(1, "x", None), (2, None, 3.25)]
    spark.sql("select 'x' AS name, 5L AS id, '1.5' AS score, '2020-02-30' AS day").write.parquet(str(tmp_path / "p"))
    row = files.read_source(spark, str(tmp_path / "p"), SCHEMA, "parquet").first()
    assert (row.id, row.name, float(row.score), row.day) == (5, "x", 1.5, None)
    with pytest.raises(ValueError, match="xml"):
        files.read_source(spark, path, SCHEMA, "xml")


def test_lineage_columns(spark, tmp_path):
    path = write(tmp_path / "a.csv", "id,name,score,day\n1,a,1.0,2020-01-01\n2,b,1.0,2020-01-01\n")
    at = dt.datetime(2024, 3, 1, 2, 3, 4)
    out = files.ingest(spark, path, SCHEMA, files.batch_id_of(at), at).collect()
    assert {(r._batch_id, str(r._ingested_at)) for r in out} == {("20240301_020304", "2024-03-01 02:03:04")}
    assert all(r._source_file.endswith("a.csv") for r in out)


def batch(spark, name, *ids):
    df = spark.createDataFrame([(i, "n", None, None) for i in ids], SCHEMA)
    return files.with_lineage(df, name, "2024-01-01 00:00:00", source="s")


def test_batches(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for _ in range(2):
        lake.replace_batch(batch(spark, "20240101_000000", 1, 2), "t")
    lake.append_batch(batch(spark, "20240102_000000", 3), "t")
    lake.append_batch(batch(spark, "20240102_000000", 3), "t")
    assert lake.read_bronze("t").count() == 4
    assert lake.read_bronze("t", SCHEMA, "20240101_000000").count() == 2
    wider = T.StructType([*SCHEMA.fields, T.StructField("added", T.StringType())])
    lake.append_batch(batch(spark, "20240103_000000", 4).withColumn("added", F.lit("x")), "t")
    assert lake.read_bronze("t", wider, where=F.col("added").isNotNull(), columns=["id"]).first().id == 4
    assert "added" in lake.read_bronze("t").columns
    plan = lake.read_bronze("t", SCHEMA, "20240101_000000", columns=["id"])._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_batch_id" in plan and "ReadSchema: struct<id:int>" in plan


def test_versions(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    with pytest.raises(ValueError):
        lake.read("gold", "t")
    lake.overwrite(spark.range(3), "gold", "t")
    lake.overwrite(lake.read("gold", "t").where("id > 0"), "gold", "t")
    unfinished = tmp_path / "gold" / "t" / "version=3"
    unfinished.mkdir()
    assert lake.versions("gold", "t") == [1, 2]
    assert lake.read("gold", "t").count() == 2 and lake.read("gold", "t", version=1).count() == 3
    assert lake.overwrite(spark.range(1), "gold", "t") == 3
    lake.drop_versions_before("gold", "t", 3)
    assert lake.versions("gold", "t") == [3]
    lake.append(spark.range(2), "audit", "a")
    lake.append(spark.range(2), "audit", "a")
    assert lake.read("audit", "a").count() == 4


def years(spark, *rows):
    return spark.createDataFrame(list(rows), "k bigint, v string, part string")


def test_only_touched_partitions_are_rewritten(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.range(40).selectExpr("id AS k", "'old' AS v", "cast(id % 4 as int) AS part"), "gold", "t", ["part"])
    folders = lambda version: lake._read_map("gold", "t", version)[0]
    updates = spark.createDataFrame([(1, "new", 1), (41, "new", 1)], "k bigint, v string, part int")
    for version in (2, 3):
        target = lake.read("gold", "t")
        merged = merge.upsert_partitions(target, updates, ["k"], ["part"])
        assert lake.replace_partitions(merged, "gold", "t", ["part"]) == version
        changed = {p for p in folders(version) if folders(version)[p] != folders(version - 1)[p]}
        assert changed == {"1"}
    after = lake.read("gold", "t")
    assert after.count() == 41 and after.where("v = 'new'").count() == 2
    assert lake.read("gold", "t", version=1).where("v = 'old'").count() == 40
    assert lake.read("gold", "t", partitions=["1"]).count() == 11 and lake.read("gold", "t", partitions=["9"]).count() == 0


def test_readers_see_one_version(spark, tmp_path):
    """A reader that began before a rewrite, and one that begins after a stopped one, see the old table."""
    lake = Lake(spark, str(tmp_path))
    odd = years(spark, (1, "a", "2001"), (2, "a", "S/1 x"), (3, "a", None), (4, "a", ""))
    assert lake.overwrite(odd, "gold", "t", ["part"]) == 1
    reader = lake.read("gold", "t")
    # stopped between the folders and the map
    lake._write_parts(years(spark, (1, "b", "2001")), "gold", "t", ["part"])
    assert lake.versions("gold", "t") == [1] and lake.read("gold", "t").where("v = 'b'").count() == 0
    (tmp_path / "gold" / "t" / "map" / "version=2").mkdir()
    assert lake.versions("gold", "t") == [1]
    lake.replace_partitions(years(spark, (1, "c", "2001"), (5, "c", None)), "gold", "t", ["part"])
    assert sorted(r.k for r in lake.read("gold", "t").collect()) == [1, 2, 4, 5]
    assert sorted((r.k, r.v) for r in reader.collect()) == [(i, "a") for i in (1, 2, 3, 4)]
    # a partition can become empty, and a new one can come
    gone = sorted({r[0] for r in odd.select(partition_label(["part"])).collect()})
    lake.replace_partitions(years(spark, (9, "d", "2001")), "gold", "t", ["part"], gone)
    assert [(r.k, r.v) for r in lake.read("gold", "t").collect()] == [(9, "d")]
    with pytest.raises(ValueError, match="rows of other partitions"):
        lake.replace_partitions(years(spark, (9, "d", "1999")), "gold", "t", ["part"], ["2001"])
    lake.replace_partitions(lake.read("gold", "t").limit(0), "gold", "t", ["part"], ["2001"])
    assert lake.read("gold", "t").collect() == [] and lake.read("gold", "t").columns == ["k", "v", "part"]
    lake.drop_versions_before("gold", "t", 4)
    assert lake.versions("gold", "t") == [4] and lake.read("gold", "t").collect() == []
    assert not list((tmp_path / "gold" / "t" / "data").glob("*/__part=*"))
    lake.overwrite(spark.range(2), "gold", "whole")
    with pytest.raises(ValueError, match="not written by partitions"):
        lake.replace_partitions(spark.range(2), "gold", "whole", [])


def test_notes_count_with_their_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    for n in (1, 2):
        lake.write_note(spark.range(n), "ledger", "gold", "t", n)
        lake.overwrite(spark.range(1), "gold", "t", [])
    lake.write_note(spark.range(5), "ledger", "gold", "t", 3)  # stopped before its version
    assert lake.read_notes("ledger", "gold", "t").count() == 3 and lake.read_notes("ledger", "gold", "t", 1).count() == 2
    assert lake.read_notes("ledger", "gold", "t", 2) is None
    lake.overwrite(spark.range(1), "gold", "t", [])
    lake.overwrite(spark.range(1), "gold", "t", [])  # without a note
    assert lake.read_notes("ledger", "gold", "t", 1) is None


def test_a_stopped_merge_leaves_no_closed_version(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    rows = lambda *r: spark.createDataFrame(list(r), "k bigint, is_current boolean")
    lake.overwrite_dimension(rows((1, True), (2, True)), "d")
    overwrite, lake.overwrite = lake.overwrite, None
    with pytest.raises(TypeError):
        lake.overwrite_dimension(rows((1, False), (3, True), (2, True)), "d")
    lake.overwrite = overwrite
    lake.overwrite_dimension(rows((1, True), (2, True)), "d")
    assert sorted(r.k for r in lake.read_dimension("d").collect()) == [1, 2]


def test_keys_are_never_given_out_twice(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))

    def fill(*names):
        registry = KeyRegistry(lake, "d", "sk")
        df = spark.createDataFrame([(None, n, 1) for n in names], "sk bigint, name string, v int")
        return {r.name: r.sk for r in registry.fill(df, ["name"]).collect()}

    assert fill("c", "a") == {"a": 1, "c": 2}
    # a run that stops after the registry was written: its member keeps the key, whoever comes next
    assert fill("a", "x") == {"a": 1, "x": 3}
    assert fill("b", "c") == {"b": 4, "c": 2}
    assert fill("x", None, "a") == {"x": 3, None: 5, "a": 1} and fill(None) == {None: 5}
    # a run that stops while it writes the registry
    lake._folder(f"{tmp_path}/keys/d/version=5/part-0")[0].mkdirs(lake._folder(f"{tmp_path}/keys/d/version=5")[1])
    assert fill("d") == {"d": 6}
    before = lake.versions("keys", "d")
    assert fill("a", "d") == {"a": 1, "d": 6} and lake.versions("keys", "d") == before
    assert fill() == {}
    known = spark.createDataFrame([(7, "old", 1)], "sk bigint, name string, v int")
    KeyRegistry(lake, "e", "sk").seed(known, ["name"])
    filled = KeyRegistry(lake, "e", "sk").fill(known.unionByName(known.selectExpr("cast(null as bigint) AS sk", "'new' AS name", "2 AS v")), ["name"])
    assert {r.name: r.sk for r in filled.collect()} == {"old": 7, "new": 8}


def test_filters_reach_the_scan(spark, tmp_path):
    lake = Lake(spark, str(tmp_path))
    lake.overwrite(spark.range(100).selectExpr("id", "id * 2 AS twice", "'x' AS pad"), "gold", "t")
    plan = lake.read("gold", "t", where=F.col("id") > 90, columns=["twice"])._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,90)]" in plan
    assert "ReadSchema: struct<id:bigint,twice:bigint>" in plan


def test_new_files_only(spark, tmp_path):
    lake, feed = Lake(spark, str(tmp_path / "lake")), tmp_path / "feed"

    def run():
        return ingest_new_files(spark, str(feed), SCHEMA, lake, "t", str(tmp_path / "progress"), "2024-01-01 00:00:00")

    write(feed / "a.csv", "id,name,score,day\n1,a,1.0,2020-01-01\n")
    assert run() == 1 and run() == 0
    write(feed / "b.csv", "id,name,score,day\n2,b,x,2020-01-01\n")
    assert run() == 1
    rows = lake.read_bronze("t", SCHEMA).orderBy("id").collect()
    assert [(r.id, r._batch_id, r.score and float(r.score)) for r in rows] == [
        (1, "stream_00000000", 1.0),
        (2, "stream_00000001", None),
    ]


def test_resent_rows_are_taken_once(spark, tmp_path):
    lake, feed = Lake(spark, str(tmp_path / "lake")), tmp_path / "feed"

    def run():
        before = [] if not feed_runs else lake.read_bronze("t", SCHEMA).collect()
        ingest_new_files(spark, str(feed), SCHEMA, lake, "t", str(tmp_path / "progress"), "2024-01-01 00:00:00", "2 days")
        feed_runs.append(1)
        now = lake.read_bronze("t", SCHEMA).collect()
        return [(r.id, r.name) for r in (Counter(now) - Counter(before)).elements()]

    feed_runs, head = [], "id,name,score,day\n"
    write(feed / "a.csv", head + "1,a,1.0,2020-01-01\n2,,1.0,1990-01-01\n,x,bad,\n")
    assert sorted(map(str, run())) == sorted(map(str, [(1, "a"), (2, None), (None, "x")]))
    # again with one more row, and one that differs in text that does not parse
    write(feed / "b.csv", head + "1,a,1.0,2020-01-01\n,x,bad,\n,x,worse,\n3,c,1.0,1970-01-01\n")
    assert sorted(map(str, run())) == sorted(map(str, [(3, "c"), (None, "x")]))
    write(feed / "c.csv", head + "1,a,1.0,2020-01-01\n2,,1.0,1990-01-01\n")
    assert run() == []


def test_database_feed(spark, monkeypatch):
    """The rows come typed and stamped; a missing column is an error.  The scan itself needs a server and is replaced."""
    source = spark.sql("SELECT '7' AS id, 'x' AS name, 'unused' AS more UNION ALL SELECT 'bad', NULL, ''")
    asked = []

    def scan(spark, url, table, properties, split, where):
        asked.append((url, table, split, where))
        return source

    monkeypatch.setattr(jdbc, "read_table", scan)
    feed = jdbc.Feed("jdbc:x", "public.people", {}, jdbc.Split("id", 0, 100, 4), "id > 0")
    schema = T.StructType([T.StructField("id", T.IntegerType()), T.StructField("name", T.StringType())])
    rows = jdbc.ingest_table(spark, feed, schema, "b1", "2025-01-01 00:00:00")
    assert rows.columns == ["id", "name", *files.LINEAGE]
    got = {(r.id, r.name, r["_source_file"], r["_batch_id"]) for r in rows.collect()}
    assert got == {(7, "x", "jdbc:public.people", "b1"), (None, None, "jdbc:public.people", "b1")}
    assert asked == [("jdbc:x", "public.people", feed.split, "id > 0")]
    with pytest.raises(ValueError, match="missing"):
        jdbc.ingest_table(spark, feed, schema.add("absent", "string"), "b1", "2025-01-01 00:00:00")


def test_jdbc_options():
    url, properties = session.jdbc_settings({"DW_HOST": "h", "DW_USER": "u", "DW_PASSWORD": "secret"})
    assert url == "jdbc:postgresql://h:5432/university_dw" and properties["user"] == "u"
    options = jdbc.read_options(url, "t", properties, jdbc.Split("id", 0, 100, 8))
    assert options["partitionColumn"] == "id" and options["numPartitions"] == "8" and options["dbtable"] == "t"
    assert "partitionColumn" not in jdbc.read_options(url, "t", properties)
    assert jdbc.write_options(url, "t", properties, 4)["truncate"] == "true"
    with pytest.raises(ValueError):
        jdbc.write_table(None, url, "t", properties, mode="ignore")


def test_layout(rows):
    df = rows([(1, "2.345")], "a int, b string")
    out = layout.to_layout(df, fields(("b", SCORE), ("a", TEXT)))
    assert out.dtypes == [("b", "decimal(5,2)"), ("a", "string")]
    with pytest.raises(ValueError, match="zz"):
        layout.to_layout(df, fields(("zz", TEXT)))
    assert dict(layout.assume_valid(df).dtypes)["validation_errors"] == "array<string>"


def test_staged_tables_live_in_the_shared_folder(spark):
    staged = staging.stage(spark.range(3), "x")
    assert spark.conf.get("spark.checkpoint.dir") + "/starbuild/" in staged.inputFiles()[0]
    with staging.staged_tables(spark):
        inner = staging.stage(spark.range(4), "y")
        assert inner.count() == 4
    with pytest.raises(Exception):
        inner.collect()
    assert staged.count() == 3
    staging.discard_staged(spark)
    with pytest.raises(Exception):
        staged.collect()


def test_session_is_reused(spark):
    assert session.get_session() is spark


def test_sweep_leaves_pinned_versions_and_folders_at_work(spark, tmp_path):
    import datetime as dt

    lake = Lake(spark, str(tmp_path / "lake"))
    state = lambda n: spark.range(4).selectExpr("id", "id % 2 AS part", f"{n} AS state")
    lake.overwrite(state(1), "gold", "t", ["part"], lambda _, v: lake.write_note(spark.range(v), "kept", "gold", "t", v))
    for n in (2, 3, 4):
        lake.write_note(spark.range(n), "kept", "gold", "t", n)
        lake.write_note(spark.range(n), "other", "gold", "t", n)
        lake.replace_partitions(state(n).where("part = 1"), "gold", "t", ["part"])
    at_work = lake._write_parts(state(9), "gold", "t", ["part"])  # of a writer that has no map yet
    reader = lake.read("gold", "t", version=2)
    with lake.pin("gold", "t", 2) as held:
        assert held == 2 and lake.sweep("gold", "t", 1, ["kept"]) == [1, 3]
        assert lake.versions("gold", "t") == [2, 4]
        assert sorted((r.id, r.state) for r in reader.collect()) == [(0, 1), (1, 2), (2, 1), (3, 2)]
        later = dt.datetime.now() + dt.timedelta(hours=25)
        assert lake.pinned("gold", "t") == {2} and lake.pinned("gold", "t", later) == set()
    assert lake.read_notes("kept", "gold", "t").count() == 10 and lake.read_notes("other", "gold", "t", 1) is None
    assert lake.sweep("gold", "t") == [2] and lake.sweep("gold", "t") == []
    assert sorted((r.id, r.state) for r in lake.read("gold", "t").collect()) == [(0, 1), (1, 4), (2, 1), (3, 4)]
    assert all((tmp_path / "lake" / "gold" / "t" / folder).exists() for folder in at_work.values())
    with pytest.raises(ValueError, match="no such table version"), lake.pin("gold", "t", 2):
        pass
    with pytest.raises(ValueError, match="always kept"):
        lake.sweep("gold", "t", 0)
    assert not list((tmp_path / "lake" / "pins" / "gold.t").glob("[0-9]*"))


def test_a_stopped_sweep_is_finished_by_the_next(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    for n in range(3):
        lake.overwrite(spark.range(n + 1), "silver", "t", [])
    delete, done = Lake._delete, []

    def stops(self, path):
        if "/data/" in path:
            raise RuntimeError("stopped")
        done.append(path)
        delete(self, path)

    monkeypatch.setattr(Lake, "_delete", stops)
    with pytest.raises(RuntimeError):
        lake.sweep("silver", "t")
    assert lake.versions("silver", "t") == [3] and done
    monkeypatch.setattr(Lake, "_delete", delete)
    assert lake.sweep("silver", "t") == [1, 2] and lake.read("silver", "t").count() == 3
    assert len(list((tmp_path / "lake" / "silver" / "t" / "data").glob("*/__part=*"))) == 1
    assert lake.next_version("silver", "t") == 4


def test_a_reader_that_pins_while_a_sweep_hides_the_version_keeps_it(spark, tmp_path, monkeypatch):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.overwrite(spark.range(1), "silver", "t")
    lake.overwrite(spark.range(2), "silver", "t")
    delete, pins = Lake._delete, []

    def pinned_meanwhile(self, path):
        if path.endswith("version=1/_SUCCESS") and not pins:
            pins.append(lake.pin("silver", "t", 1))
            pins[0].__enter__()
        delete(self, path)

    monkeypatch.setattr(Lake, "_delete", pinned_meanwhile)
    assert lake.sweep("silver", "t") == [] and lake.read("silver", "t", version=1).count() == 1
    pins[0].__exit__(None, None, None)
    assert lake.sweep("silver", "t") == [1]


def test_a_note_of_a_stopped_attempt_does_not_count(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    lake.overwrite(spark.range(1), "silver", "t", [])
    lake.write_note(spark.range(1), "ledger", "silver", "t", 2)  # and then the attempt stopped
    lake.overwrite(spark.range(2), "silver", "t", [], lambda _, v: lake.drop_note("ledger", "silver", "t", v))
    assert lake.read_notes("ledger", "silver", "t", 1) is None


def test_text_feeds_are_compressed_and_read_as_written(spark):
    contract.queries()  # loads the catalogue in its order
    from catalogue import feeds

    rows = spark.range(3).selectExpr("cast(id AS string) AS transaction_id", "'a,b' AS semester_id")
    schema = fields(("transaction_id semester_id", TEXT))
    for name, suffix in (("tuition", "json.gz"), ("enrollments", "csv.gz"), ("students", "parquet")):
        path, kind = feeds._written(rows, name)
        assert all(f.endswith(suffix) for f in os.listdir(path) if f.startswith("part-"))
        assert files.read_source(spark, path, schema, kind).orderBy("transaction_id").collect() == rows.collect()
