"""Exact dedup by content sort.

Rows are range-partitioned by sampled splitters over the normalised text and sorted
there (an external sort), so equal texts lie next to each other; a window over the
sorted rows compares each whole text with its neighbour and settles the run.  The
splitters are samples of a short lead of the text with its SHA-256 behind it: they stay
small for the driver however long a text is, and documents with the same opening still
spread.  The comparison is of whole texts.

A text that fills more than a fraction of a partition is salted over several
partitions; its size and largest identifier were added up (partially before the
shuffle) when such texts were looked for, so its parts agree.

Defined cases: a NULL text counts as empty; a NULL identifier loses to any other; of
repeated rows with the same identifier exactly one stays; an empty table gives an empty
result; other columns pass through untouched inside ``row``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import ascii_lower, packed, shuffle_partitions, stage, text_or_empty

#: Characters of a text that lead the sort key.
LEAD = 24
#: A text is salted when its rows exceed this fraction of an even partition.
HOT = 0.25


def content_sort(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row as ``row`` with ``keep_id``, ``group_size``, ``kept`` and ``text_sha256``."""
    limit = max(1.0, docs.count() * HOT / shuffle_partitions(docs))
    digest = F.sha2(ascii_lower(text_or_empty(text_col)), 256)
    # at most partitions / HOT rows, as each stands for `limit` rows of the input
    hot = stage(
        docs.groupBy(digest.alias("sha"))
        .agg(F.count("*").alias("hot_size"), F.max(F.col(f"`{id_col}`")).alias("hot_id"))
        .where(F.col("hot_size") > limit),
        "hot-texts",
    )
    keyed = packed(docs, ascii_lower(text_or_empty(text_col)).alias("norm")).select(
        "row", F.substring("norm", 1, LEAD).alias("lead"), F.sha2("norm", 256).alias("sha")
    )
    parts = F.ceil(F.col("hot_size") / F.lit(limit))
    salt = F.when(F.col("hot_size").isNotNull(), F.pmod(F.xxhash64(f"row.{id_col}"), parts)).otherwise(F.lit(0))
    ranged = (
        keyed.join(F.broadcast(hot), "sha", "left")
        .withColumn("salt", salt.cast("long"))
        .repartitionByRange("lead", "sha", "salt")
        .withColumn("norm", ascii_lower(F.coalesce(F.col(f"row.{text_col}").cast("string"), F.lit(""))))
    )
    run = Window.partitionBy("lead", "sha", "salt", "norm")
    place = F.row_number().over(run.orderBy(F.col(f"row.{id_col}").desc_nulls_last()))
    return (
        ranged.select(
            "row",
            "sha",
            place.alias("place"),
            F.coalesce("hot_size", F.count("*").over(run)).alias("group_size"),
            F.when(F.col("hot_size").isNotNull(), F.col("hot_id"))
            .otherwise(F.max(f"row.{id_col}").over(run))
            .alias("keep_id"),
        )
        .withColumn("kept", (F.col("place") == 1) & F.col("keep_id").eqNullSafe(F.col(f"row.{id_col}")))
        .select("row", "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))
    )


def distinct_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with their columns as they came."""
    return content_sort(docs, id_col, text_col).where("kept").select("row.*")
