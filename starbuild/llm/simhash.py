"""SimHash near-dedup with distributed vantage-point trees.

Fingerprints (64 bits over the XXH64 of word shingles) are made distinct with their
smallest identifier first, so exact copies cost one entry.  The search for pairs within
``radius`` bits runs in a tree of vantage points spread over shards:

* Level j measures the Hamming distance to the vantage point over its own block of
  bits, and splits at the block's middle distance.  A distance over part of the bits is
  still a metric in the triangle bound, and as the blocks are disjoint the bounds of all
  levels add up: whoever is `a` away from the other side of one level and `b` of another
  needs at least a + b differing bits.  A branch is pruned when that sum exceeds the
  radius.  This prunes far more than whole-fingerprint distances, which hardly vary
  between unrelated documents.
* Each fingerprint lives in one shard and is sent as a query to the shards that its ball
  overlaps; of two shards only the lower asks, which finds every pair once.
* Inside a shard, fingerprints are ordered by their distance to a local vantage point;
  a query is compared only with the rings that the triangle bound leaves, and each such
  pair is checked exactly.

A shard with more than ``BLOCK`` entries is dealt out as pairs of blocks.  A task emits
not all pairs but, per query, one link to each group found so far (a spanning forest),
so thousands of near copies give thousands of links.  The depth follows the number of
fingerprints.  At uniform fingerprints queries per fingerprint grow with the cube of the
depth (about 8 at 64 shards, 60 at 4,096).

Defined cases: a text without words has fingerprint zero and is linked like any other; a
NULL text has no words; a NULL identifier never names a group that has another; repeated
rows share a fingerprint; an empty table gives an empty result; other columns pass
through inside ``row``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import packed, stage
from starbuild.llm.components import components

SHINGLE = 3
RADIUS = 3
SEED = 42
#: Fingerprints aimed at per shard.
LEAF = 4096
#: Entries of a shard, or queries to it, that one task takes at most.
BLOCK = 32768
_STEP = 65536
_VANTAGE = np.uint64(0x9E3779B97F4A7C15)


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """SimHash of one text in UTF-8, as an unsigned integer."""
    words = text.lower().split()  # for bytes: A-Z only, and ASCII white space only
    if not words:
        return 0
    size = min(shingle, len(words))
    ones, total = np.zeros(64, np.int64), len(words) - size + 1
    for at in range(0, total, _STEP):
        part = words[at : min(at + _STEP, total) + size - 1]
        shingles = map(b" ".join, zip(*[part[i:] for i in range(size)]))
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles, repeat(SEED)), "<u8", len(part) - size + 1)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int32)
    return int(np.packbits(ones * 2 > total, bitorder="little").view("<u8")[0])


def with_fingerprint(docs: DataFrame, text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """The rows as ``row`` with their fingerprint ``fp`` (a bigint with the same bits)."""

    @F.arrow_udf("long")
    def prints(texts: pa.Array) -> pa.Array:
        found = [fingerprint(t.as_buffer().to_pybytes() if t.is_valid else b"", shingle) for t in texts.cast(pa.large_binary())]
        return pa.array(np.array(found, np.uint64).view(np.int64))

    return packed(docs, F.col(f"`{text_col}`").cast("string").alias("_text")).select("row", prints("_text").alias("fp"))


def _blocks(depth: int) -> list[np.uint64]:
    """Disjoint bit blocks, one a level, of the largest odd width that fits: odd widths split in half."""
    width = 64 // depth
    width -= 1 - width % 2
    return [np.uint64(((1 << width) - 1) << (width * j)) for j in range(depth)]


def _route(fps: np.ndarray, depth: int, radius: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Home shard of each fingerprint; and the (rows, shards) that their balls reach above the home."""
    home = np.zeros(len(fps), np.int64)
    if not depth:
        return home, []
    gaps = []
    for j, mask in enumerate(_blocks(depth)):
        middle = int(mask).bit_count() // 2
        d = np.bitwise_count((fps ^ _VANTAGE) & mask).astype(np.int64)
        home |= (d > middle).astype(np.int64) << j
        gaps.append(np.where(d > middle, d - middle, middle + 1 - d))
    reached = []
    for size in range(1, radius + 1):
        for levels in combinations(range(depth), size):
            other = home ^ sum(1 << j for j in levels)
            rows = np.flatnonzero((sum(gaps[j] for j in levels) <= radius) & (other > home))
            if len(rows):
                reached.append((rows, other[rows]))
    return home, reached


def _routed(prints: DataFrame, depth: int, radius: int) -> DataFrame:
    """Rows (shard, fp, own): each fingerprint at home, and as a query where its ball overlaps."""

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            home, reached = _route(fps, depth, radius)
            for own, rows, shards in [(True, np.arange(len(fps)), home), *[(False, r, s) for r, s in reached]]:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(shards), pa.array(fps[rows].view(np.int64)), pa.array(np.full(len(rows), own))],
                    names=["shard", "fp", "own"],
                )

    return prints.select("fp").mapInArrow(route, "shard long, fp long, own boolean")


def spanning_links(members: np.ndarray, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """For each query, a link to one member of every group of members that it touches; touched groups merge."""
    vantage = members[0]
    member_ring, query_ring = np.bitwise_count(members ^ vantage), np.bitwise_count(queries ^ vantage)
    order = np.argsort(member_ring, kind="stable")
    members, member_ring = members[order], member_ring[order]
    group = np.arange(len(members))
    out: list[tuple[np.uint64, np.uint64]] = []
    for ring in np.unique(query_ring):
        low = np.searchsorted(member_ring, max(0, int(ring) - radius))
        high = np.searchsorted(member_ring, int(ring) + radius, side="right")
        near, asking = members[low:high], queries[query_ring == ring]
        step = max(1, 4_000_000 // max(1, len(near)))
        for at in range(0, len(asking), step):
            part = asking[at : at + step]
            q, m = np.nonzero(np.bitwise_count(part[:, None] ^ near[None, :]) <= radius)
            differ = part[q] != near[m]
            q, m = q[differ], m[differ] + low
            ends = np.flatnonzero(np.r_[q[1:] != q[:-1], True]) + 1 if len(q) else []
            begin = 0
            for end in ends:
                groups, first = np.unique(group[m[begin:end]], return_index=True)
                out += [(part[q[begin]], members[x]) for x in m[begin:end][first]]
                if len(groups) > 1:
                    group[np.isin(group, groups[1:])] = groups[0]
                begin = end
    found = np.array(out, np.uint64).reshape(-1, 2)
    return found[:, 0], found[:, 1]


def links(prints: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Links ``u``-``v`` between distinct fingerprints ``fp``, enough to connect all that are within ``radius`` bits."""
    count = prints.count()
    depth = min(21, max(0, int(np.ceil(np.log2(max(1, count) / leaf)))))
    routed = stage(_routed(prints, depth, radius), "simhash-routed")
    # at most 2 ** depth rows, about one for each `leaf` fingerprints
    sizes = stage(
        routed.groupBy("shard").agg(
            F.ceil(F.sum(F.col("own").cast("long")) / BLOCK).alias("member_blocks"), F.ceil(F.count("*") / BLOCK).alias("query_blocks")
        ),
        "simhash-shards",
    )
    placed = routed.join(sizes, "shard").where("member_blocks > 0")
    part = F.xxhash64(F.lit(1), "fp")
    asked = placed.select(
        "shard", "fp", F.lit(False).alias("member"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("member_blocks") - 1)).alias("mb"), F.pmod(part, "query_blocks").alias("qb")
    )
    kept = placed.where("own").select(
        "shard", "fp", F.lit(True).alias("member"), F.pmod(part, "member_blocks").alias("mb"), F.explode(F.sequence(F.lit(0).cast("long"), F.col("query_blocks") - 1)).alias("qb")
    )

    def search(table: pa.Table) -> pa.Table:
        fps = table.column("fp").to_numpy().view(np.uint64)
        member = table.column("member").to_numpy()
        u = v = np.empty(0, np.uint64)
        if member.any() and not member.all():
            u, v = spanning_links(fps[member], fps[~member], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return asked.union(kept).groupBy("shard", "mb", "qb").applyInArrow(search, "u long, v long")


def groups(printed: DataFrame, radius: int = RADIUS, leaf: int = LEAF) -> DataFrame:
    """Per distinct ``fp``: ``component`` (smallest identifier ``id`` reachable) and ``keeper`` (its fingerprint)."""
    prints = stage(printed.groupBy("fp").agg(F.min("id").alias("id")), "simhash-prints")
    roots = components(links(prints, radius, leaf))
    placed = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    best = placed.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "fp")).alias("best"))
    return placed.join(best, "root").select("fp", F.col("best.id").alias("component"), F.col("best.fp").alias("keeper"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One slim row per document: identifier ``id``, fingerprint ``fp``, ``component`` and ``keeper``."""
    slim = docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text"))
    printed = stage(with_fingerprint(slim, "text", shingle).select("row.id", "fp"), "simhash-docs")
    return printed.join(groups(printed, radius), "fp").select("id", "fp", "component", "keeper")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """One document of each group, the one with the smallest identifier, with its columns as they came."""
    rows = stage(with_fingerprint(docs, text_col, shingle), "simhash-rows")
    mine = F.col(f"row.`{id_col}`")
    found = groups(rows.select(mine.alias("id"), "fp"), radius)
    chosen = found.where("fp = keeper").select("fp", F.col("component").alias("_id"))
    first = Window.partitionBy("fp").orderBy(F.xxhash64(F.to_json("row")))
    return (
        rows.join(chosen, "fp")
        .where(mine.eqNullSafe(F.col("_id")))
        .withColumn("_n", F.row_number().over(first))
        .where("_n = 1")
        .select("row.*")
    )
