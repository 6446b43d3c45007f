"""Mixing sources to target weights by Poisson replication.

Each source has a mean repetition rate: its target weight times the whole size over its
own size (UTF-8 bytes plus one a document).  A document's count is the inverse of the
Poisson distribution with that mean at a uniform number hashed from seed and identifier;
the document is repeated so often, and all repetitions are sorted globally by another
hash.  The choice depends on nothing but seed, identifier and the source's rate, so a
rerun or a lost executor gives the same corpus.

A rate over ``PART`` is a sum of independent equal parts, each inverted at its own
number, so the tables stay short.  Without weights, sources are tempered: weight in
proportion to the square root of the size.

Defined cases: a NULL source is a source of its own; sources that the weights do not
name get weight 0 and drop out; a NULL identifier hashes as the empty text; a NULL text
counts one byte; repeated rows get the same count, an empty table gives an empty result;
other columns pass through inside ``row``.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starbuild.llm.common import null_safe_key, packed, stage

SEED = "mix-1"
#: Largest mean that is inverted in one piece.
PART = 16.0
#: Entries of an inversion table: P(Poisson(16) > 80) is below 1e-25.
ENTRIES = 80
DECIMALS = 12


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5; exact in a double."""
    text = F.concat_ws(":", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("double") / float(1 << 52)


def _table(mean: Column) -> Column:
    """The cumulative Poisson distribution at 0 .. ENTRIES - 1."""
    log_factorial = [0.0]
    import math

    for k in range(1, ENTRIES):
        log_factorial.append(log_factorial[-1] + math.log(k))
    terms = F.array(*[F.exp(k * F.log(mean) - mean - v) for k, v in enumerate(log_factorial)])
    sums = F.aggregate(
        terms,
        F.struct(F.lit(0.0).alias("sum"), F.array().cast("array<double>").alias("all")),
        lambda a, x: F.struct((a["sum"] + x).alias("sum"), F.array_append(a["all"], F.round(a["sum"] + x, DECIMALS)).alias("all")),
    )
    return sums["all"]


def rates(docs: DataFrame, weights: Mapping[str, float] | None = None, text_col: str = "text", source_col: str = "source") -> DataFrame:
    """Per source ``k``: size, ``rate``, number of equal ``parts`` and the inversion table of one part."""
    size = F.coalesce(F.octet_length(F.col(f"`{text_col}`").cast("string")), F.lit(0)) + 1
    name = F.col(f"`{source_col}`").cast("string")
    sized = docs.groupBy(null_safe_key(name).alias("k"), name.alias("name")).agg(F.sum(size.cast("long")).alias("size"))
    if weights is None:
        sized = sized.withColumn("weight", F.sqrt("size"))
    else:
        given = F.lit(0.0)
        for source, weight in weights.items():
            given = F.when(F.col("name").eqNullSafe(F.lit(source)), F.lit(float(weight))).otherwise(given)
        sized = sized.withColumn("weight", given)
    whole = sized.agg(F.sum("weight").alias("weights"), F.sum("size").alias("sizes"))
    rated = sized.join(F.broadcast(whole)).withColumn(
        "rate", F.round(F.col("weight") / F.col("weights") * F.col("sizes") / F.col("size"), 9)
    )
    rated = rated.where("rate > 0").withColumn("parts", F.ceil(F.col("rate") / PART))
    return stage(rated.select("k", "size", "rate", "parts", _table(F.col("rate") / F.col("parts")).alias("table")), "mixing-rates")


def replicate(
    docs: DataFrame,
    weights: Mapping[str, float] | None = None,
    seed: str = SEED,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
) -> DataFrame:
    """Rows as ``row`` with ``rate``, ``copies``, ``copy`` (from 0) and ``place`` (the sort hash), in global hash order."""
    rated = rates(docs, weights, text_col, source_col)
    identifier = F.col(f"row.`{id_col}`")
    drawn = F.aggregate(
        F.sequence(F.lit(1).cast("long"), F.col("parts")),
        F.lit(0),
        lambda total, part: total + F.size(F.filter("table", lambda c: c < uniform(F.lit(seed), identifier, part))),
    )
    joined = packed(docs, null_safe_key(F.col(f"`{source_col}`")).alias("k")).join(rated, "k")
    counted = joined.select("row", "rate", drawn.cast("long").alias("copies")).where("copies > 0")
    copied = counted.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("copies") - 1)).alias("copy"))
    place = F.md5(F.concat_ws(":", F.lit(seed), F.lit("place"), F.coalesce(identifier.cast("string"), F.lit("")), F.col("copy").cast("string")))
    return copied.withColumn("place", place).orderBy("place", "copy")


def mixed(docs: DataFrame, weights: Mapping[str, float] | None = None, seed: str = SEED, **columns: str) -> DataFrame:
    """The replicated documents in global hash order, with their columns as they came."""
    return replicate(docs, weights, seed, **columns).select("row.*")
