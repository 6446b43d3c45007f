"""Build the layers: one plan and one write per table, metrics taken during the write, gates between."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.operators import calendar, dedup, ledger, marts, merge, quality
from starbuild.operators.staging import stage, staged_tables
from starbuild.operators.upkeep import SIGN
from starbuild.plans import university as uni
from starbuild.plans.specs import TEXT, EntitySpec, fields
from starbuild.sources import jdbc
from starbuild.sources.files import batch_id_of, ingest
from starbuild.sources.lake import Lake, partition_label
from starbuild.sources.registry import KeyRegistry

#: Integer and natural key of each dimension.
DIMENSION_KEYS = {
    "dim_department": ("department_key", "department_id"),
    "dim_semester": ("semester_key", "semester_id"),
    "dim_course": ("course_key", "course_id"),
    "dim_student": ("student_key", "student_id"),
}
#: What silver keeps of where a row came from, behind the declared layout.
ORIGIN = fields(("_ingested_at", T.TimestampType()), ("_batch_id", TEXT))
#: Where an entity's rows come from: a path with its format, or a database table.
Feed = tuple[str, str] | jdbc.Feed
#: The stored partial sums of each fact table, from which the marts are made.
MART_SUMS = {
    "fact_enrollment": ("sums_enrollment", marts.ENROLLMENT_SUMS),
    "fact_tuition": ("sums_tuition", marts.PAYMENT_SUMS),
}
SILVER_ORDER = ("departments", "semesters", "courses", "students", "enrollments", "tuition")


class EntityErrors(RuntimeError):
    """Some entities of a run failed; the others were built."""


class Warehouse:
    """The university warehouse under one root folder, built for one run time."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        run_at: dt.datetime,
        gate: bool = True,
        calendar_days: tuple[str, str] = uni.CALENDAR,
        student_rows: tuple[int | None, int | None] = (1, None),
    ):
        """``calendar_days`` bounds the date dimension, ``student_rows`` the rows that the student checks accept."""
        self.spark = spark
        self.lake = Lake(spark, root)
        self.run_at = run_at
        self.as_of = run_at.date()
        self.batch_id = batch_id_of(run_at)
        self.gate = gate
        self.calendar_days = calendar_days
        self.student_rows = student_rows
        self.jobs: list[tuple] = []
        self.lineage: list[tuple] = []
        self.unresolved: list[tuple] = []

    # -- one table ------------------------------------------------------------

    def _record(self, name: str, begun: dt.datetime, status: str, counts: Mapping[str, int], error: str | None):
        known = ("records_processed", "records_inserted", "records_updated", "records_failed")
        self.jobs.append(
            (name, self.batch_id, begun, dt.datetime.now(), status, *[counts.get(k) for k in known], error)
        )

    def _job(self, name: str, sources: Sequence[str], kind: str, work: Callable[[], Mapping[str, int]]) -> None:
        """Do the work of one table, which returns its row counts, and note the run."""
        begun = dt.datetime.now()
        try:
            self._record(name, begun, "success", work(), None)
        except Exception as error:
            self._record(name, begun, "failed", {}, str(error))
            raise
        self.lineage += [(source, name, kind, self.batch_id) for source in sources]

    def _build(
        self,
        name: str,
        sources: Sequence[str],
        kind: str,
        plan: Callable[[], DataFrame],
        save: Callable[[DataFrame], object],
        kept: Callable[[], Column] = lambda: F.lit(True),
    ) -> None:
        """Plan, write once with counts taken on the way, and note the run."""

        def work() -> Mapping[str, int]:
            seen = Observation(name)
            save(plan().observe(seen, *quality.row_flow(kept())))
            return seen.get

        self._job(name, sources, kind, work)

    def _with_unresolved(self, name: str, counts: Mapping[str, int], unresolved: Observation) -> dict[str, int]:
        """``counts`` with the rows that lack a key as failed ones, which are also noted per key."""
        missing, counts, prefix = unresolved.get, dict(counts), "missing_"
        for k in ("records_processed", "records_failed"):
            counts[k] += missing["dropped_rows"]
        self.unresolved += [(name, self.batch_id, k.removeprefix(prefix), n) for k, n in missing.items() if k.startswith(prefix)]
        return counts

    def _each(self, names: Sequence[str], build: Callable[[str], None]) -> None:
        """Build every entity; report all failures together at the end."""
        failures = {}
        for name in names:
            try:
                build(name)
            except Exception as error:
                failures[name] = error
        if failures:
            raise EntityErrors("; ".join(f"{n}: {e}" for n, e in failures.items())) from next(iter(failures.values()))

    def check(self, df: DataFrame, checks: Sequence[quality.Check], table: str) -> None:
        """Run checks, store the results, stop the run if the gate is on and one failed."""
        if not checks:
            return
        results = quality.run_checks(df, checks, table, self.run_at, self.batch_id).persist()
        try:
            self.lake.append(results, "audit", "data_quality_results")
            if self.gate:
                quality.enforce(results)
        finally:
            results.unpersist()

    # -- layers ---------------------------------------------------------------

    def build_bronze(self, feeds: Mapping[str, Feed]) -> None:
        """Ingest each ``entity: (path, format)`` or ``entity: jdbc.Feed``; a repeated run replaces its own batch."""

        def one(name: str) -> None:
            entity, feed = uni.ENTITIES[name], feeds[name]
            stamps = entity.source, self.batch_id, self.run_at
            if isinstance(feed, jdbc.Feed):
                origin, read = feed.origin, lambda: jdbc.ingest_table(self.spark, feed, *stamps)
            else:
                origin, read = feed[0], lambda: ingest(self.spark, feed[0], *stamps, feed[1])
            self._build(
                f"bronze.{entity.bronze_table}",
                [origin],
                "ingest",
                read,
                lambda df: self.lake.replace_batch(df, entity.bronze_table),
            )

        self._each(list(feeds), one)

    def bronze(self, entity: EntitySpec, row_ids: bool = False) -> DataFrame:
        return self.lake.read_bronze(entity.bronze_table, entity.source, row_ids=row_ids)

    def build_silver(self, names: Sequence[str] = SILVER_ORDER, recent_days: int | None = None) -> None:
        """Cleanse each entity.

        Without ``recent_days`` silver is derived from all batches.  With it, only batches that no complete
        version of silver holds, batches rewritten since, and rows ingested in that window are read; only the
        partitions with changed rows are written; and the changes are stored as the version's ledger.  The
        result has the rows that a derivation from all batches has.
        """

        def one(name: str) -> None:
            entity = uni.ENTITIES[name]
            job, sources = f"silver.{entity.silver_table}", [f"bronze.{entity.bronze_table}"]
            contents = self.lake.batch_contents(entity.bronze_table)
            merged = None if recent_days is None else self.lake.read_notes("merged", "silver", entity.silver_table)
            if merged is not None:
                self._job(job, sources, "cleanse", lambda: self._merge_silver(entity, contents, merged, recent_days))
                return

            def note(written: DataFrame, version: int) -> None:
                self.lake.drop_note("ledger", "silver", entity.silver_table, version)
                self._note_merged(entity, version, contents, written.agg(F.max("_ingested_at")).first()[0], whole=True)

            self._build(
                job, sources, "cleanse", lambda: self._cleansed(entity, self.bronze(entity, row_ids=True)),
                lambda df: self.lake.overwrite(df, "silver", entity.silver_table, entity.partition, note),
                lambda: F.col("is_valid"),
            )

        self._each(names, one)

    def _cleansed(
        self, entity: EntitySpec, raw: DataFrame, only: DataFrame | None = None, with_apart: bool = False
    ) -> DataFrame:
        return uni.silver(raw, entity, self.run_at, origin=ORIGIN, only=only, with_apart=with_apart)

    def _note_merged(
        self, entity: EntitySpec, version: int, batches: Mapping[str, str | None], newest: dt.datetime | None, whole: bool = False
    ) -> None:
        """Which batches, with which content (None: gone), the coming version of silver takes in."""
        rows = [(b, c, newest, whole) for b, c in sorted(batches.items())] or [(None, None, newest, whole)]
        note = self.spark.createDataFrame(rows, "_batch_id string, content string, newest timestamp, whole boolean")
        self.lake.write_note(note.coalesce(1), "merged", "silver", entity.silver_table, version)

    def _merge_silver(self, entity: EntitySpec, contents: Mapping[str, str], merged: DataFrame, recent_days: int) -> Mapping[str, int]:
        table, keys, part = entity.silver_table, list(entity.keys), partition_label(entity.partition)
        notes = merged.orderBy("version").collect()  # one row a batch
        begin = max(r.version for r in notes if r.whole)
        known = {r._batch_id: r.content for r in notes if r.version >= begin and r._batch_id}
        newest = max((r.newest for r in notes if r.version >= begin and r.newest), default=None)
        taken = [b for b, content in contents.items() if known.get(b) != content]
        rewritten = [b for b, content in known.items() if content is not None and contents.get(b) != content]
        keyless = dedup.any_null(keys)
        of_taken = F.col("_batch_id").isin(taken)
        raw = self.bronze(entity, row_ids=True)
        is_read = F.coalesce(of_taken | merge.is_recent("_ingested_at", self.as_of, recent_days), F.lit(False))
        recent = raw.where(is_read)
        before = self.lake.read("silver", table)
        compared = [f.name for f in entity.silver]
        dropped = keyless & F.col("_batch_id").isin([*taken, *rewritten])
        whole = self.bronze(entity).where(~is_read).select("_batch_id").isEmpty()
        if whole:  # all batches are read: one pass derives every row and finds what it changes
            fresh = self._cleansed(entity, recent, with_apart=True)
            pairs = stage(ledger.whole_changes(before, fresh, keys, compared, part, "_ingested_at"), f"pairs-{entity.name}")
            after = F.when(F.col("change") != ledger.REMOVED, F.col("row")).alias("after")
            delta = pairs.where("change IS NOT NULL").select(*keys, "change", "part_before", "part_after", after)
            loose = pairs.where(keyless).select("row.*").where(of_taken)
            latest = pairs.agg(F.max("latest")).first()[0]
        else:
            fresh = stage(self._cleansed(entity, recent), f"fresh-{entity.name}")
            # keys that a rewritten batch had decided, or that a batch older than others brings, are decided anew by all batches
            decided = before.where(F.col("_batch_id").isin(rewritten) & ~keyless).select(*keys)
            if newest is not None:
                decided = decided.union(fresh.where((F.col("_ingested_at") < F.lit(newest)) & of_taken & ~keyless).select(*keys))
            decided = stage(decided.distinct(), f"decided-{entity.name}")
            derived = fresh
            if decided.isEmpty():
                decided = None
            else:
                again = self._cleansed(entity, raw, only=decided)
                derived = fresh.join(decided, keys, "left_anti").unionByName(again)
            delta = stage(ledger.changes(before, derived, keys, compared, part, "_ingested_at", decided), f"delta-{entity.name}")
            loose = fresh.where(keyless & of_taken)
            latest = fresh.agg(F.max("_ingested_at")).first()[0]
        touched = {
            r[0]
            for df in (
                delta.select(F.explode(F.array("part_before", "part_after"))),
                loose.select(part),
                before.where(dropped).select(part) if taken or rewritten else loose.limit(0).select(part),
            )
            for r in df.distinct().collect()
            if r[0] is not None
        }
        held = self.lake.read("silver", table, partitions=touched).where(~F.coalesce(dropped, F.lit(False)))
        if whole:
            placed = F.when(F.col("change").isNull(), F.col("part_before")).otherwise(F.col("part_after"))
            rows = pairs.where(~keyless & placed.isin(list(touched))).select("row.*")
            content = held.where(keyless).unionByName(rows).unionByName(loose)
        else:
            held = held.join(delta.select(*keys), keys, "left_anti")
            content = held.unionByName(delta.where("after IS NOT NULL").select("after.*")).unionByName(loose)
        version = self.lake.next_version("silver", table)
        self.lake.write_note(delta.drop("after"), "ledger", "silver", table, version)
        batches = {b: contents.get(b) for b in {*taken, *rewritten}}
        self._note_merged(entity, version, batches, max(filter(None, (newest, latest)), default=None))
        self.lake.replace_partitions(content, "silver", table, entity.partition, sorted(touched))
        valid = F.col("after.is_valid")
        flow = quality.row_flow(valid, F.col("change") == ledger.CHANGED)
        counts = delta.where("after IS NOT NULL").agg(*flow).first().asDict()
        lost = loose.agg(*quality.row_flow(F.col("is_valid"))).first().asDict()
        return {k: counts[k] + lost[k] for k in counts}

    def silver(self, name: str) -> DataFrame:
        return self.lake.read("silver", f"stg_{name}").drop(*ORIGIN.names)

    def gold(self, name: str) -> DataFrame:
        """A gold table; of the student dimension all versions."""
        return self.lake.read_dimension(name) if name == "dim_student" else self.lake.read("gold", name)

    def current_students(self) -> DataFrame:
        """Current versions only; closed ones are not read."""
        return self.lake.read("gold", "dim_student")

    def _gold(self, name: str, sources: Sequence[str], kind: str, plan: Callable[[], DataFrame]) -> None:
        def save(df: DataFrame) -> int:
            if name == "dim_student":
                return self.lake.overwrite_dimension(df, name)
            return self.lake.overwrite(df, "gold", name)

        self._build(f"gold.{name}", sources, kind, plan, save)

    def registry(self, name: str) -> KeyRegistry:
        """The keys of a dimension's members, of all times."""
        key, natural_key = DIMENSION_KEYS[name]
        registry = KeyRegistry(self.lake, name, key)
        if self.lake.exists("gold", name):
            registry.seed(self.gold(name), uni.VERSION_KEYS if name == "dim_student" else [natural_key])
        return registry

    def build_dimensions(self) -> None:
        def before(name: str) -> DataFrame | None:
            return self.lake.read("gold", name) if self.lake.exists("gold", name) else None

        at = self.run_at
        self._gold(
            "dim_date", [], "generate",
            lambda: calendar.date_dimension(self.spark, *self.calendar_days, existing=before("dim_date")),
        )
        self._gold(
            "dim_department", ["silver.stg_departments"], "dimension",
            lambda: uni.dim_department(self.silver("departments"), self.as_of, self.registry("dim_department"), at),
        )
        self._gold(
            "dim_semester", ["silver.stg_semesters"], "dimension",
            lambda: uni.dim_semester(self.silver("semesters"), self.registry("dim_semester"), at),
        )
        self._gold(
            "dim_course", ["silver.stg_courses", "gold.dim_department"], "dimension",
            lambda: uni.dim_course(self.silver("courses"), self.gold("dim_department"), self.registry("dim_course"), at),
        )
        self._gold(
            "dim_student", ["silver.stg_students", "gold.dim_department"], "scd2",
            lambda: uni.dim_student(
                self.silver("students"), self.gold("dim_department"), self.as_of, before("dim_student"), at,
                self.registry("dim_student"),
            ),
        )
        for name, (key, natural_key) in DIMENSION_KEYS.items():
            self.check(self.lake.read("gold", name), uni.dimension_checks(key, natural_key), f"gold.{name}")

    def build_fact(self, name: str, incremental: bool = False) -> None:
        """One fact table; ``incremental`` reads and writes only what changed since its last load."""
        students, semesters, options = self.current_students(), self.gold("dim_semester"), {"days": self.calendar_days, "stamp": self.run_at}
        if name == "fact_enrollment":
            courses = self.gold("dim_course")
            self._fact(
                name, uni.ENROLLMENTS, ("dim_semester", "dim_course"), incremental,
                lambda rows, seen: uni.fact_enrollment(rows, students, courses, semesters, seen=seen, **options),
            )
        else:
            self._fact(
                name, uni.TUITION, ("dim_semester",), incremental,
                lambda rows, seen: uni.fact_tuition(rows, students, semesters, seen=seen, **options),
            )

    def build_facts(self, incremental: bool = False) -> None:
        """Both fact tables, and the checks on them."""
        semesters, courses = self.gold("dim_semester"), self.gold("dim_course")
        for name in ("fact_enrollment", "fact_tuition"):
            self.build_fact(name, incremental)
        versions = self.gold("dim_student")
        self.check(
            self.gold("fact_enrollment"),
            uni.fact_checks("fact_enrollment", versions, semesters, courses),
            "gold.fact_enrollment",
        )
        self.check(
            self.gold("fact_tuition"), uni.fact_checks("fact_tuition", versions, semesters), "gold.fact_tuition"
        )

    def _fact(
        self,
        name: str,
        entity: EntitySpec,
        dims: Sequence[str],
        incremental: bool,
        plan: Callable[[DataFrame, Observation], DataFrame],
    ) -> None:
        """One fact table, parted by semester.

        Beside each version stand the versions it was built from, and the rows that wait for a dimension
        member.  An incremental load takes from the ledger the keys that changed since, adds the waiting rows,
        those whose semester or course has left its dimension and those whose student has a newer version, and
        builds only these anew: the facts are then those of a whole build.
        """
        table, keys, job = entity.silver_table, list(entity.keys), f"gold.{name}"
        sources = [f"silver.{table}", *[f"gold.{d}" for d in ("dim_student", *dims)]]
        built_from = {table: ("silver", self.lake.versions("silver", table)[-1])}
        built_from |= {d: ("gold", self.lake.versions("gold", d)[-1]) for d in ("dim_student", *dims)}
        seen = Observation(f"unresolved {name}")

        def note(version: int, waiting: DataFrame) -> None:
            rows = [(t, n) for t, (_, n) in built_from.items()]
            self.lake.write_note(self.spark.createDataFrame(rows, "source string, source_version int").coalesce(1), "sources", "gold", name, version)
            self.lake.write_note(waiting, "waiting", "gold", name, version)

        def waiting(rows: DataFrame, facts: DataFrame) -> DataFrame:
            valid = rows.where("is_valid").select(*keys, partition_label(entity.partition).alias("part"))
            return valid.join(facts.select(*keys), keys, "left_anti")

        def whole() -> Mapping[str, int]:
            rows, counted = self.silver(entity.name), Observation(name)
            facts = plan(rows, seen).observe(counted, *quality.row_flow(F.lit(True)))

            def before_commit(written: DataFrame, version: int) -> None:
                open_rows = waiting(rows, written)
                self.lake.drop_note("moved", "gold", name, version)
                note(version, open_rows if seen.get["dropped_rows"] else open_rows.limit(0))

            self.lake.overwrite(facts, "gold", name, ["semester_key"], before_commit)
            return self._with_unresolved(job, counted.get, seen)

        def changed(touched_keys: DataFrame) -> Mapping[str, int]:
            parts = [r[0] for r in touched_keys.select("part").distinct().collect()]
            # rows that waited have no fact yet, so there is none to replace
            held_parts = [r[0] for r in touched_keys.where("NOT waited").select("part").distinct().collect()]
            ids = touched_keys.select(*keys).distinct()
            # facts come from valid rows and take no audit columns
            unread = (*ORIGIN.names, "validation_errors", "created_at", "updated_at")
            rows = self.lake.read("silver", table, partitions=parts).where("is_valid").drop(*unread).join(ids, keys, "left_semi")
            rows = stage(rows, f"changed-{entity.name}")
            facts = stage(plan(rows, seen), f"fresh-{name}")
            # a semester's part of silver and its part of the facts
            terms = self.registry("dim_semester").known()
            place = terms.select(partition_label(["semester_id"]).alias("part"), partition_label(["semester_key"]).alias("place"))
            held = {r[0] for r in place.where(F.col("part").isin(held_parts)).select("place").collect()}
            held |= {r[0] for r in facts.select(partition_label(["semester_key"])).distinct().collect()}
            before = self.lake.read("gold", name, partitions=held)
            updated = before.select(*keys).join(facts.select(*keys), keys, "left_semi").count()
            content = before.join(ids, keys, "left_anti").unionByName(facts)
            version = self.lake.next_version("gold", name)
            note(version, waiting(rows, facts))
            reads = MART_SUMS[name][1].reads
            left = before.join(ids, keys, "left_semi").select(*reads, F.lit(-1).alias(SIGN))
            moved = left.unionByName(facts.select(*reads, F.lit(1).alias(SIGN)))
            self.lake.write_note(moved, "moved", "gold", name, version)
            self.lake.replace_partitions(content, "gold", name, ["semester_key"], sorted(held))
            n = facts.count()
            counts = {"records_processed": n, "records_inserted": n - updated, "records_updated": updated, "records_failed": 0}
            return self._with_unresolved(job, counts, seen)

        def work() -> Mapping[str, int]:
            touched_keys = self._touched(name, entity, dims, built_from) if incremental else None
            return whole() if touched_keys is None else changed(touched_keys)

        self._job(job, sources, "fact", work)

    def _touched(
        self, name: str, entity: EntitySpec, dims: Sequence[str], built_from: Mapping[str, tuple[str, int]]
    ) -> DataFrame | None:
        """Keys, with the parts of silver to look in, whose facts may differ since the last load; None: it is not known.

        ``waited`` marks keys of rows that waited for a dimension member.
        """
        table, keys = entity.silver_table, list(entity.keys)
        if not self.lake.exists("gold", name):
            return None
        version = self.lake.versions("gold", name)[-1]
        loaded, open_rows = [self.lake.read_notes(kind, "gold", name, version - 1) for kind in ("sources", "waiting")]
        if loaded is None or open_rows is None:
            return None
        then = {r.source: r.source_version for r in loaded.collect()}
        found = [open_rows.select(*keys, "part", F.lit(True).alias("waited"))]
        known_row = F.lit(False).alias("waited")
        if built_from[table][1] > then[table]:
            entries = self.lake.read_notes("ledger", "silver", table, then[table])
            if entries is None:  # silver was derived anew meanwhile
                return None
            found.append(ledger.changed_keys(entries, keys, distinct=False).select(*keys, "part", known_row))
        for dim in ("dim_student", *dims):
            key, natural_key = DIMENSION_KEYS[dim]
            if dim == "dim_student":
                gone = self.lake.read_closed(dim, then[dim]).select(key)
            else:
                known = self.registry(dim).known()
                if then[dim] in self.lake.versions("gold", dim):
                    known = self.lake.read("gold", dim, version=then[dim])
                gone = known.join(self.gold(dim).select(natural_key), natural_key, "left_anti").select(key)
            gone = stage(gone, f"gone-{dim}")
            if not gone.isEmpty():
                terms = self.registry("dim_semester").known().select("semester_key", partition_label(["semester_id"]).alias("part"))
                hit = self.lake.read("gold", name, columns=list(dict.fromkeys([*keys, "semester_key", key])))
                found.append(hit.join(gone, key, "left_semi").join(terms, "semester_key").select(*keys, "part", known_row))
        return stage(reduce(DataFrame.union, found).distinct(), f"touched-{name}")

    def build_sums(self, name: str, incremental: bool = False) -> DataFrame:
        """The partial sums of one fact table, stored by semester.

        ``incremental`` takes off the rows that left the facts since the sums were stored and adds those that
        came; facts that did not change are not read again, but for groups that lost their smallest or largest value.
        """
        table, sums = MART_SUMS[name]
        now = self.lake.versions("gold", name)[-1]

        def note(version: int) -> None:
            row = self.spark.createDataFrame([(name, now)], "source string, source_version int")
            self.lake.write_note(row.coalesce(1), "sources", "gold", table, version)

        def whole() -> Mapping[str, int]:
            seen = Observation(table)
            rows = sums.of(self.gold(name)).observe(seen, *quality.row_flow(F.lit(True)))
            self.lake.overwrite(rows, "gold", table, ["semester_key"], lambda _, version: note(version))
            return seen.get

        def work() -> Mapping[str, int]:
            if not incremental or not self.lake.exists("gold", table):
                return whole()
            loaded = self.lake.read_notes("sources", "gold", table, self.lake.versions("gold", table)[-1] - 1)
            then = loaded.first().source_version if loaded is not None else None
            if then == now:
                return dict.fromkeys(("records_processed", "records_inserted", "records_updated", "records_failed"), 0)
            moved = None if then is None else self.lake.read_notes("moved", "gold", name, then)
            if moved is None:  # the facts were built anew meanwhile
                return whole()
            parts = [r[0] for r in moved.select(partition_label(["semester_key"])).distinct().collect()]
            stored, rows = [self.lake.read("gold", t, partitions=parts) for t in (table, name)]
            before, seen = stored.count(), Observation(table)
            kept_up = sums.kept_up(stored, moved, rows).observe(seen, *quality.row_flow(F.lit(True)))
            note(self.lake.next_version("gold", table))
            self.lake.replace_partitions(kept_up, "gold", table, ["semester_key"], parts)
            counts = seen.get if parts else {"records_processed": 0, "records_inserted": 0, "records_failed": 0}
            inserted = max(0, counts["records_inserted"] - before)
            return {**counts, "records_inserted": inserted, "records_updated": counts["records_processed"] - inserted}

        self._job(f"gold.{table}", [f"gold.{name}"], "aggregate", work)
        return self.gold(table)

    def build_marts(self, incremental: bool = False) -> None:
        """The marts, from partial sums per semester and student; ``incremental`` keeps the sums up to date."""
        students = self.current_students()
        payments = self.build_sums("fact_tuition", incremental)
        # facts keep the student version of their load, the marts count by the current one
        enrollments = marts.ENROLLMENT_SUMS.combined(
            marts.with_current_key(
                self.build_sums("fact_enrollment", incremental), self.gold("dim_student"), "student_id", "student_key"
            )
        )
        for name, sources, plan in (
            (
                "agg_academic_performance_semester",
                ["gold.sums_enrollment", "gold.dim_student"],
                lambda: marts.academic_from_sums(enrollments, students),
            ),
            (
                "agg_academic_performance",
                ["gold.sums_enrollment", "gold.dim_student"],
                lambda: marts.academic_extended_from_sums(enrollments, students),
            ),
            ("agg_financial_summary", ["gold.sums_tuition"], lambda: marts.financial_from_sums(payments)),
            (
                "agg_cohort_analysis",
                ["gold.dim_student", "gold.sums_enrollment"],
                lambda: marts.cohort_order(marts.cohort_analysis(students, sums=enrollments)),
            ),
        ):
            stamped = F.lit(self.run_at).cast("timestamp")
            self._gold(name, sources, "aggregate", lambda plan=plan: plan().withColumn("updated_at", stamped))

    def export(self, layer: str, table: str, url: str, properties: Mapping[str, str], mode: str = "overwrite") -> None:
        """Copy a finished table to a database: read back from the lake, so both hold the same rows and times."""
        if layer == "bronze":
            df = self.lake.read_bronze(table, batch_id=self.batch_id)
        else:
            df = self.gold(table) if layer == "gold" else self.lake.read(layer, table).drop(*ORIGIN.names)
        jdbc.write_table(df, url, f"{layer}.{table}", properties, mode)

    def write_audit(self) -> None:
        """Store the job and lineage rows of this run, and how many fact rows lacked which key."""
        if self.jobs:
            self.lake.append(quality.job_rows(self.spark, self.jobs), "audit", "etl_job_history")
        if self.lineage:
            self.lake.append(quality.lineage_rows(self.spark, self.lineage), "audit", "data_lineage")
        if self.unresolved:
            self.lake.append(quality.unresolved_rows(self.spark, self.unresolved), "audit", "unresolved_keys")
        self.jobs, self.lineage, self.unresolved = [], [], []

    def sweep(self, keep: int) -> None:
        """Delete superseded versions of silver and gold tables that no reader has pinned.

        The notes on merged batches stay: they are few, and the next incremental run reads them all.
        """
        for layer in ("silver", "gold"):
            for table in self.lake.tables(layer):
                self.lake.sweep(layer, table, keep, ["merged"])

    def run(
        self,
        feeds: Mapping[str, Feed],
        source_checks: bool = True,
        recent_days: int | None = None,
        keep_versions: int | None = None,
    ) -> None:
        """Bronze to marts with the quality gates between the layers; audit rows are always stored.

        With ``recent_days`` silver, the facts and the sums below the marts take in only what is new, and
        rewrite only the partitions where something changed.  With ``keep_versions`` a finished run deletes
        older versions that are not pinned.
        """
        try:
            with staged_tables(self.spark):
                self._run(feeds, source_checks, recent_days)
            if keep_versions is not None:
                self.sweep(keep_versions)
        finally:
            self.write_audit()

    def _run(self, feeds: Mapping[str, Feed], source_checks: bool, recent_days: int | None) -> None:
        names = [n for n in SILVER_ORDER if n in feeds]
        self.build_bronze(feeds)
        if source_checks and "students" in feeds:
            batch = self.lake.read_bronze("raw_students", uni.STUDENTS.source, self.batch_id)
            self.check(batch, uni.bronze_student_checks(self.student_rows), "bronze.raw_students")
        self.build_silver(names, recent_days)
        if source_checks:
            for name in names:
                checks = uni.silver_checks(name, self.run_at, self.student_rows)
                self.check(self.silver(name), checks, f"silver.{uni.ENTITIES[name].silver_table}")
        self.build_dimensions()
        self.build_facts(incremental=recent_days is not None)
        self.build_marts(incremental=recent_days is not None)
