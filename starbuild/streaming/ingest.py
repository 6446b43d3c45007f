"""Ingest only the files that arrived since the last run.

The same bronze ingest as :func:`starbuild.sources.files.ingest`, with Spark's file
stream remembering which files were taken.  A run ends when the new files are used up.

With a window, rows of files that are sent again (under another name, or with more rows) are
left out while the stream still remembers them.  The watermark is on the time at which a row is
taken in, not on a time inside of it: so no row is ever late, and none is lost.  What is sent
again after the window passes, and the silver layer decides it as it decides any repeated row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from starbuild.functions.values import row_hash
from starbuild.sources.files import with_lineage
from starbuild.sources.lake import Lake


def ingest_new_files(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    lake: Lake,
    table: str,
    progress: str,
    ingested_at,
    resent_within: str | None = None,
) -> int:
    """Take every unseen CSV file under ``path`` into the bronze table; return the number of micro-batches.

    ``progress`` is the folder holding the stream's progress; keep it between runs.
    Columns must come in schema order; a file with another header fails the run.  A
    micro-batch that is run again replaces its own partition.

    ``resent_within`` (an interval, "2 days") takes rows that are equal in all columns, as text, once within
    that time, whichever files they stand in.  The stream then holds one hash a row for so long, in as many
    partitions as the session shuffles into on its first run; set it, or leave it out, for good.
    """
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in schema])
    files = (
        spark.readStream.option("header", True)
        .option("enforceSchema", False)
        .schema(strings)
        .csv(path)
        .select("*", F.col("_metadata.file_path").alias("__file"))
    )
    if resent_within is not None:
        seen = files.withColumns({"__seen": row_hash(*[F.col(f"`{f.name}`") for f in schema]), "__taken": F.current_timestamp()})
        files = seen.withWatermark("__taken", resent_within).dropDuplicatesWithinWatermark(["__seen"]).drop("__seen", "__taken")
    done = []

    def take(batch: DataFrame, number: int) -> None:
        typed = batch.select(*[F.col(f.name).try_cast(f.dataType).alias(f.name) for f in schema], "__file")
        lake.replace_batch(with_lineage(typed, f"stream_{number:08d}", ingested_at), table)
        done.append(number)

    query = (
        files.writeStream.foreachBatch(take)
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(done)
