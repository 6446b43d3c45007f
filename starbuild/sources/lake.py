"""Parquet tables under one root folder.

Bronze tables are partitioned by batch.  Silver and gold tables have numbered versions; a
version counts once its ``_SUCCESS`` marker exists, so a reader never sees half a table and
a table can be rebuilt from itself.  A version is either a folder with the whole table, or
a *map*: a small table that names the folder of each partition.  Replacing some partitions
writes new folders and then a new map, so readers of an older version, also those that
began before, keep seeing what it had, and a stopped rewrite is seen by nobody.

Notes belong to a version of a table and are written before it (``write_note``): they count
if that version was completed, and a repeated attempt replaces its own.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Callable, Collection, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_VERSION = "version="
_PART = "__part"


def partition_label(columns: Sequence[str]) -> Column:
    """The partition of a row as text that is safe in a path: plain values as they are, others by their MD5."""

    def one(c: str) -> Column:
        text = F.col(c).cast("string")
        plain = F.when(text.rlike("^[A-Za-z0-9_]{1,64}$"), text).otherwise(F.concat(F.lit("x-"), F.md5(text)))
        return F.when(text.isNull(), F.lit("null-")).otherwise(plain)

    return F.concat_ws(".", *[one(c) for c in columns]) if columns else F.lit("all")


def row_id() -> Column:
    """What tells the rows of Parquet files apart: the file and the place in it, as ``_row``."""
    return F.struct("_metadata.file_path", "_metadata.row_index").alias("_row")


def with_lineage_fields(schema: T.StructType) -> T.StructType:
    """A source schema followed by the lineage columns."""
    return T.StructType(
        [
            *schema.fields,
            T.StructField("_source_file", T.StringType()),
            T.StructField("_ingested_at", T.TimestampType()),
            T.StructField("_batch_id", T.StringType()),
        ]
    )


class Lake:
    """Names and locations of the tables; all reading and writing goes through Spark."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    # -- bronze ---------------------------------------------------------------

    def bronze_path(self, table: str) -> str:
        return f"{self.root}/bronze/{table}"

    def append_batch(self, df: DataFrame, table: str) -> None:
        """Add a batch; running it twice adds it twice."""
        df.write.mode("append").partitionBy("_batch_id").parquet(self.bronze_path(table))

    def replace_batch(self, df: DataFrame, table: str) -> None:
        """Write a batch so that a repeated run replaces just its own partition."""
        (
            df.write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("_batch_id")
            .parquet(self.bronze_path(table))
        )

    def read_bronze(
        self,
        table: str,
        schema: T.StructType | None = None,
        batch_id: str | None = None,
        where: Column | None = None,
        columns: Sequence[str] = (),
        row_ids: bool = False,
    ) -> DataFrame:
        """All batches, or one; ``row_ids`` adds ``_row``, the file and place of each row.

        With the declared ``schema`` batches written before a column was added give NULL
        for it, and no file has to be opened to learn the columns.  Without it the
        schemas of all files are merged.
        """
        if schema is None:
            df = self.spark.read.option("mergeSchema", True).parquet(self.bronze_path(table))
            df = df.withColumn("_batch_id", F.col("_batch_id").cast("string"))
        else:
            df = self.spark.read.schema(with_lineage_fields(schema)).parquet(self.bronze_path(table))
        if row_ids:
            df = df.select("*", row_id())
        if batch_id is not None:
            df = df.where(F.col("_batch_id") == F.lit(batch_id))
        return select_where(df, where, columns)

    def batch_contents(self, table: str) -> dict[str, str]:
        """Every batch with a digest of its files' names, which are new whenever it is written.

        As long as the listing of the table that any scan of it makes: one entry a run.
        """
        base = self.bronze_path(table)
        found = {}
        for name in self._names(base):
            if name.startswith("_batch_id="):
                files = sorted(n for n in self._names(f"{base}/{name}") if not n.startswith((".", "_")))
                found[name.removeprefix("_batch_id=")] = hashlib.md5("\n".join(files).encode()).hexdigest()
        return found

    # -- silver, gold, audit --------------------------------------------------

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _folder(self, path: str):
        folder = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return folder.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), folder

    def _names(self, path: str) -> list[str]:
        fs, folder = self._folder(path)
        return [status.getPath().getName() for status in fs.listStatus(folder)] if fs.exists(folder) else []

    def _numbers(self, path: str) -> list[int]:
        """Numbers of the complete ``version=`` folders."""
        numbers = [int(n.removeprefix(_VERSION)) for n in self._names(path) if n.startswith(_VERSION)]
        done = [n for n in numbers if self._done(f"{path}/{_VERSION}{n}")]
        return sorted(done)

    def _done(self, path: str) -> bool:
        fs, marker = self._folder(f"{path}/_SUCCESS")
        return fs.exists(marker)

    def _mapped(self, layer: str, table: str) -> list[int]:
        return self._numbers(f"{self.table_path(layer, table)}/map")

    def versions(self, layer: str, table: str) -> list[int]:
        """Numbers of the complete versions, oldest first."""
        return sorted({*self._numbers(self.table_path(layer, table)), *self._mapped(layer, table)})

    def next_version(self, layer: str, table: str) -> int:
        return (self.versions(layer, table) or [0])[-1] + 1

    def overwrite(
        self,
        df: DataFrame,
        layer: str,
        table: str,
        partition_by: Sequence[str] | None = None,
        note: Callable[[DataFrame, int], None] | None = None,
    ) -> int:
        """Write the whole table as its next version and return the version number.

        With ``partition_by`` (which may be empty: one partition) single partitions can be replaced later,
        and ``note`` is called with the written rows and the version before this becomes visible.
        """
        version = self.next_version(layer, table)
        if partition_by is None:
            df.write.mode("overwrite").parquet(f"{self.table_path(layer, table)}/{_VERSION}{version}")
        else:
            folders = self._write_parts(df, layer, table, partition_by)
            if note is not None:
                note(self._read_parts(layer, table, folders, df.schema), version)
            self._write_map(layer, table, version, folders, df.schema)
        return version

    def replace_partitions(
        self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str], replaced: Sequence[str] | None = None
    ) -> int:
        """A new version in which ``df`` stands for some partitions, while the others keep their folders.

        ``replaced`` lists the labels of the partitions that ``df`` stands for (also if it has no row of
        one of them); by default those that occur in it.
        """
        if not self._mapped(layer, table):
            raise ValueError(f"{layer}.{table} was not written by partitions")
        folders, schema = self._read_map(layer, table, self.versions(layer, table)[-1])
        written = {} if replaced is not None and not replaced else self._write_parts(df, layer, table, partition_by)
        if replaced is not None and not set(written) <= set(replaced):
            raise ValueError(f"rows of other partitions than {sorted(replaced)}: {sorted(set(written) - set(replaced))}")
        kept = {part: folder for part, folder in folders.items() if part not in (replaced or ())}
        version = self.next_version(layer, table)
        self._write_map(layer, table, version, kept | written, schema)
        return version

    def _write_parts(self, df: DataFrame, layer: str, table: str, partition_by: Sequence[str]) -> dict[str, str]:
        """Write ``df`` to new folders, one a partition: their labels and paths below the table's.

        Rows are brought together by partition before writing, so that a partition has few files;
        adaptive execution splits large ones.
        """
        folder = f"data/{uuid.uuid4().hex}"
        labelled = df.withColumn(_PART, partition_label(partition_by)).hint("rebalance", _PART)
        labelled.write.partitionBy(_PART).parquet(f"{self.table_path(layer, table)}/{folder}")
        names = self._names(f"{self.table_path(layer, table)}/{folder}")
        return {n.removeprefix(f"{_PART}="): f"{folder}/{n}" for n in names if n.startswith(f"{_PART}=")}

    def _write_map(self, layer: str, table: str, version: int, folders: dict[str, str], schema: T.StructType) -> None:
        """The map of a version: one row a partition, and one without a partition for the schema."""
        rows = [(None, schema.json()), *sorted(folders.items())]
        entries = self.spark.createDataFrame(rows, "part string, folder string").coalesce(1)
        entries.write.mode("overwrite").parquet(f"{self.table_path(layer, table)}/map/{_VERSION}{version}")

    def _read_map(self, layer: str, table: str, version: int) -> tuple[dict[str, str], T.StructType]:
        path = f"{self.table_path(layer, table)}/map/{_VERSION}{version}"
        rows = self.spark.read.schema("part string, folder string").parquet(path).collect()
        schema = next(r.folder for r in rows if r.part is None)
        return {r.part: r.folder for r in rows if r.part is not None}, T.StructType.fromJson(json.loads(schema))

    def _newest_path(self, layer: str, table: str) -> str:
        return f"{self.table_path(layer, table)}/{_VERSION}{(self.versions(layer, table) or [1])[-1]}"

    # -- notes to a version ---------------------------------------------------

    def write_note(self, df: DataFrame, kind: str, layer: str, table: str, version: int) -> None:
        """Store ``df`` beside a version that is about to be written."""
        df.write.mode("overwrite").parquet(f"{self.table_path(layer, table)}/{kind}/{_VERSION}{version}")

    def drop_note(self, kind: str, layer: str, table: str, version: int) -> None:
        """Remove what a stopped attempt at the coming version noted, if the present one notes nothing of the kind."""
        self._delete(f"{self.table_path(layer, table)}/{kind}/{_VERSION}{version}")

    def read_notes(self, kind: str, layer: str, table: str, after: int = 0) -> DataFrame | None:
        """Notes of all versions above ``after`` with their ``version``; None if one of these lacks its note.

        Versions that were deleted count: numbers have no gaps, and a note may outlast its version.
        """
        path = f"{self.table_path(layer, table)}/{kind}"
        wanted = range(after + 1, self.next_version(layer, table))
        if not wanted or not set(wanted) <= set(self._numbers(path)):
            return None
        return self.spark.read.option("basePath", path).parquet(*[f"{path}/{_VERSION}{n}" for n in wanted])

    def append(self, df: DataFrame, layer: str, table: str) -> None:
        """Add rows to an append-only table (audit tables)."""
        df.write.mode("append").parquet(self._newest_path(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        return bool(self.versions(layer, table))

    def read(
        self,
        layer: str,
        table: str,
        where: Column | None = None,
        columns: Sequence[str] = (),
        version: int | None = None,
        partitions: Collection[str] | None = None,
    ) -> DataFrame:
        """Latest (or a given) version; filter and projection reach the Parquet scan.

        ``partitions`` limits a table that was written by partitions to some of their labels.
        """
        known = self.versions(layer, table)
        if not known or (version is not None and version not in known):
            raise ValueError(f"no such table version: {layer}.{table} {version or ''}".rstrip())
        chosen = version or known[-1]
        if chosen not in self._mapped(layer, table):
            return select_where(self.spark.read.parquet(f"{self.table_path(layer, table)}/{_VERSION}{chosen}"), where, columns)
        folders, schema = self._read_map(layer, table, chosen)
        wanted = {part: folder for part, folder in folders.items() if partitions is None or part in partitions}
        return select_where(self._read_parts(layer, table, wanted, schema), where, columns)

    def _read_parts(self, layer: str, table: str, folders: dict[str, str], schema: T.StructType) -> DataFrame:
        paths = [f"{self.table_path(layer, table)}/{folder}" for folder in folders.values()]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_all(self, layer: str, table: str) -> DataFrame:
        """The rows of all complete versions together, of a table whose versions add to each other."""
        base = self.table_path(layer, table)
        newest = self.read(layer, table)
        return self.spark.read.schema(newest.schema).parquet(*[f"{base}/{_VERSION}{n}" for n in self._numbers(base)])

    # -- versioned dimensions -------------------------------------------------
    #
    # Current rows are a table like any other.  Closed rows are only ever added: each
    # merge writes the ones it closed under the number of the table version it started
    # from, so a repeated merge replaces its own rows and history is never rewritten.

    def overwrite_dimension(self, df: DataFrame, table: str) -> int:
        """Store a merge result: closed rows first, then the current rows as the next version."""
        before = (self.versions("gold", table) or [0])[-1]
        # the folder by name, so that what a stopped merge closed goes even if this one closes nothing
        closed = df.where(~F.col("is_current"))
        closed.write.mode("overwrite").parquet(f"{self.table_path('gold', f'{table}_closed')}/_closed_from={before}")
        return self.overwrite(df.where(F.col("is_current")), "gold", table)

    def read_dimension(self, table: str) -> DataFrame:
        """All versions: the current rows and every row closed on the way to them."""
        return self.read("gold", table).unionByName(self.read_closed(table))

    def read_closed(self, table: str, since: int = 0) -> DataFrame:
        """Rows closed on the way to the newest version, or only those closed on the way from version ``since``."""
        layout = T.StructType([*self.read("gold", table).schema.fields, T.StructField("_closed_from", T.IntegerType())])
        closed = self.spark.read.schema(layout).parquet(self.table_path("gold", f"{table}_closed"))
        newest = self.versions("gold", table)[-1]
        return closed.where(F.col("_closed_from").between(F.lit(since), F.lit(newest - 1))).drop("_closed_from")

    def drop_versions_before(self, layer: str, table: str, version: int) -> None:
        """Delete versions older than the given one, their notes, and partition folders that no version names any more."""
        base = self.table_path(layer, table)
        for old in self.versions(layer, table):
            if old < version:
                for path in [base, *[f"{base}/{n}" for n in self._names(base) if not n.startswith(_VERSION) and n != "data"]]:
                    self._delete(f"{path}/{_VERSION}{old}")
        named = {f for n in self._mapped(layer, table) for f in self._read_map(layer, table, n)[0].values()}
        for write in self._names(f"{base}/data"):
            for part in self._names(f"{base}/data/{write}"):
                if part.startswith(f"{_PART}=") and f"data/{write}/{part}" not in named:
                    self._delete(f"{base}/data/{write}/{part}")

    # -- retention by use -----------------------------------------------------
    #
    # A reader that works on a version for long pins it: an empty file that names the
    # version and when the pin ends.  A sweep first hides a superseded version by taking
    # its marker away, then looks for pins again, and only then deletes.  A reader first
    # pins, then looks whether the version is still to be seen.  Whichever comes first,
    # a version that a reader took for granted stays.

    def _pins_path(self, layer: str, table: str) -> str:
        return f"{self.root}/pins/{layer}.{table}"

    def pinned(self, layer: str, table: str, now: dt.datetime | None = None) -> set[int]:
        """Versions that a reader has pinned, whose pin has not ended."""
        seconds = (now or dt.datetime.now()).timestamp()
        pins = [name.split("-") for name in self._names(self._pins_path(layer, table)) if not name.startswith(".")]
        return {int(version) for version, ends, _ in pins if int(ends) > seconds}

    @contextmanager
    def pin(
        self, layer: str, table: str, version: int | None = None, hours: float = 24, now: dt.datetime | None = None
    ) -> Iterator[int]:
        """Hold a version (the newest by default) against sweeps while inside, ``hours`` at most; gives its number."""
        ends = int(((now or dt.datetime.now()) + dt.timedelta(hours=hours)).timestamp())
        while True:
            chosen = version or (self.versions(layer, table) or [0])[-1]
            held = f"{self._pins_path(layer, table)}/{chosen}-{ends}-{uuid.uuid4().hex}"
            self._touch(held)
            if chosen in self.versions(layer, table):
                break
            self._delete(held)
            if version is not None or not self.versions(layer, table):
                raise ValueError(f"no such table version: {layer}.{table} {version or ''}".rstrip())
        try:
            yield chosen
        finally:
            self._delete(held)

    def sweep(
        self, layer: str, table: str, keep: int = 1, kept_notes: Collection[str] = (), now: dt.datetime | None = None
    ) -> list[int]:
        """Delete versions that are superseded by ``keep`` newer ones and not pinned; return their numbers.

        With them go their notes, but those of the kinds in ``kept_notes``, and the partition folders that
        only they named.  Folders that no version ever named are not touched: a writer may be at work on
        them.  A sweep that stopped is finished by the next.
        """
        if keep < 1:
            raise ValueError("the newest version is always kept")
        base, visible = self.table_path(layer, table), self.versions(layer, table)
        if not visible:
            return []
        old = [n for n in self._any_numbers(base) | self._any_numbers(f"{base}/map") if n < visible[-keep:][0]]
        swept, freed = [], set()
        for n in sorted(old):
            path = f"{base}/map/{_VERSION}{n}" if n in self._any_numbers(f"{base}/map") else f"{base}/{_VERSION}{n}"
            self._delete(f"{path}/_SUCCESS")
            if n in self.pinned(layer, table, now):
                self._touch(f"{path}/_SUCCESS")
                continue
            if path.startswith(f"{base}/map/"):
                freed |= set(self._read_map(layer, table, n)[0].values())
            swept.append(n)
        named = {f for n in self._mapped(layer, table) for f in self._read_map(layer, table, n)[0].values()}
        for folder in sorted(freed - named):
            self._delete(f"{base}/{folder}")
        # the maps go last: they tell the next sweep what one that stops here has left
        kinds = [n for n in self._names(base) if not n.startswith(_VERSION) and n not in ("data", "map", *kept_notes)]
        for n in swept:
            for path in (base, *[f"{base}/{kind}" for kind in kinds], f"{base}/map"):
                self._delete(f"{path}/{_VERSION}{n}")
        return swept

    def tables(self, layer: str) -> list[str]:
        """Names of the tables of a layer that have versions."""
        return sorted(n for n in self._names(f"{self.root}/{layer}") if self.exists(layer, n))

    def _any_numbers(self, path: str) -> set[int]:
        return {int(n.removeprefix(_VERSION)) for n in self._names(path) if n.startswith(_VERSION)}

    def _touch(self, path: str) -> None:
        fs, file = self._folder(path)
        fs.create(file, True).close()

    def _delete(self, path: str) -> None:
        fs, folder = self._folder(path)
        fs.delete(folder, True)


def select_where(df: DataFrame, where: Column | None = None, columns: Sequence[str] = ()) -> DataFrame:
    """Filtered and projected scan."""
    if where is not None:
        df = df.where(where)
    return df.select(*columns) if columns else df
