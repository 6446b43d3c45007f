"""Sharding by balanced label propagation, with shard sizes in rows at most one apart.

Documents with equal texts are linked.  Linked documents start in a hashed shard; in each
round a document wishes to move to the shard that holds most of its neighbours (to one of
several if they need several; equal counts are decided by a hash that changes with the
round).  While there is free room only shards that have some count; when it is used up,
the 16 x 16 sums of the wishes tell which can be met by exchanges along cycles of shards,
which need none.  A round is a grouped count (text and shard, added up before the shuffle),
a ranking of each text's shards and a join back; who moves is decided by a hash, whole
groups at a time while they are small against a shard and document by document when they
are not.  Rounds go on until exchanges move less than a thousandth of the linked documents.

Documents without links cost no cut wherever they lie: they level the shards at the end.
Rows are ranked in each shard (linked ones first) by counts per bucket and a rank within
the bucket, so no task orders a whole shard; what exceeds the quota fills the gaps of the
others, and the ranks are the slots.

Defined cases: NULL texts count as empty and are linked to each other; NULL identifiers
and repeated rows are rows like others; an empty table gives an empty result; other
columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starbuild.llm.common import stage, text_or_empty

SHARDS = 16
#: A round that moves less than this share of the linked documents is the last.
WORTH = 0.001
#: Groups up to this share of a shard move as a whole.
SMALL = 1 / 6
#: Rows aimed at per bucket when ranking.
BUCKET = 2000


def _chance(*parts: Column) -> Column:
    return F.pmod(F.xxhash64(*parts), F.lit(1 << 30)) / float(1 << 30)


def _route(left: dict[tuple[int, int], float], begin: int, end: int) -> list[tuple[int, int]] | None:
    """The shortest way from ``begin`` to ``end`` over what is ``left``."""
    came, reached = {begin: begin}, [begin]
    for node in reached:
        if node == end:
            way = []
            while node != begin:
                way.append((came[node], node))
                node = came[node]
            return way
        for (i, j), n in left.items():
            if i == node and n > 0 and j not in came:
                came[j] = i
                reached.append(j)
    return None


def met_wishes(wishes: dict[tuple[int, int], float], room: dict[int, float]) -> dict[tuple[int, int], float]:
    """How much of each wish (from, to) can be met without any shard growing beyond its free ``room``.

    Free room is a place of its own: a shard gives what it has room for, and every shard may take from it.  So
    exchanges and moves into free room alike are cycles, and each of them uses up one wish or room at least.
    """
    free = -1
    left = {e: float(n) for e, n in wishes.items()}
    left |= {(j, free): float(n) for j, n in room.items() if n > 0} | {(free, i): float("inf") for i in room}
    met = dict.fromkeys(wishes, 0.0)
    for i, j in sorted(wishes):
        while left[i, j] > 0 and (way := _route(left, j, i)) is not None:
            cycle = [(i, j), *way]
            amount = min(left[e] for e in cycle)
            for e in cycle:
                left[e] -= amount
                if e in met:
                    met[e] += amount
    return met


def _moved(linked: DataFrame, room: dict[int, float], quota: float, turn: int, only_open: bool) -> tuple[DataFrame, float]:
    """One round: ``linked`` with each row's new ``shard``, and how many rows were to move."""
    count = len(room)
    held = linked.groupBy("g", "size", "shard").agg(F.count("*").alias("n"))
    # at most one entry a shard, those with most of the group first; it needs the first few
    tie = F.xxhash64(F.lit(turn), "g", "shard").alias("tie")
    ranked = F.sort_array(F.collect_list(F.struct("n", tie, "shard")), asc=False)
    need = F.ceil(F.col("size") / quota).cast("int")
    homes = held.groupBy("g", "size").agg(F.transform(ranked, lambda x: x.shard).alias("ranked"))
    # groups that already stand in no more shards than they need stay
    homes = homes.where(F.size("ranked") > need).withColumn("need", need)
    has_room = F.array(*[F.lit(room[j] > 0) for j in range(count)])
    targets = F.filter("ranked", lambda j: F.get(has_room, j)) if only_open else F.col("ranked")
    homes = stage(homes.select("g", "ranked", "need", F.slice(targets, F.lit(1), F.col("need")).alias("targets")), "shard-homes")
    here = F.array_position("ranked", F.col("shard"))
    # only ever to shards with more of the group
    better = F.filter("targets", lambda j: F.array_position("ranked", j) < here)
    going = (here > F.col("need")) & (F.size(better) > 0)
    wishes = held.join(homes, "g").where(going)
    wishes = wishes.select("shard", F.explode(better).alias("to"), (F.col("n") / F.size(better)).alias("n"))
    # at most one entry for each two shards
    asked = {(r["shard"], r["to"]): r["n"] for r in wishes.groupBy("shard", "to").agg(F.sum("n").alias("n")).collect()}
    if only_open:  # one share for all who wish to go to a shard, so that a group goes as a whole
        wished = {j: sum(n for (_, t), n in asked.items() if t == j) for j in room}
        met = {(i, j): n * min(1.0, room[j] / wished[j]) for (i, j), n in asked.items()}
    else:
        met = met_wishes(asked, room)
    shares = F.array(*[F.lit(met[i, j] / asked[i, j] if (i, j) in asked else 0.0) for i in range(count) for j in range(count)])
    who = F.when(F.col("size") <= quota * SMALL, F.xxhash64("g")).otherwise(F.col("u"))
    to = F.get(better, F.pmod(F.xxhash64(F.lit(turn), F.lit("to"), who), F.size(better)).cast("int"))
    goes = going & (_chance(F.lit(turn), who) < F.get(shares, F.col("shard") * count + to))
    after = linked.join(homes, "g", "left").withColumn("shard", F.when(goes, to).otherwise(F.col("shard")))
    return after.select(*linked.columns), sum(met.values())


def _propagated(linked: DataFrame, total: int, shards: int, worth: float) -> DataFrame:
    """Moves into free room while they are worth a round, else exchanges, until these are not worth one either."""
    quota, turn, only_open = total / shards, 0, True
    linked = stage(linked, "shard-linked")
    while True:
        loads = {r["shard"]: r["n"] for r in linked.groupBy("shard").agg(F.count("*").alias("n")).collect()}
        room = {j: max(0, int(quota) - loads.get(j, 0)) for j in range(shards)}
        least = max(1.0, worth * sum(loads.values()))
        only_open = only_open and sum(room.values()) >= least
        after, moved = _moved(linked, room, quota, turn, only_open)
        turn += 1
        if moved >= least:
            linked, only_open = stage(after, "shard-linked"), True
        elif only_open:
            only_open = False
        else:
            return linked


def balanced_shards(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, worth: float = WORTH
) -> DataFrame:
    """``id``, ``size`` (bytes plus one), ``crc``, ``shard`` and ``slot`` (gapless in the shard) of every row."""
    text = text_or_empty(text_col)
    slim = docs.select(
        F.col(f"`{id_col}`").alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("bytes"),
        F.crc32(text.cast("binary")).alias("crc"),
        F.md5(text).alias("g"),
    )
    slim = stage(slim.withColumn("u", F.xxhash64("g", "id")), "shard-docs")
    total = slim.count()
    start = F.pmod("u", F.lit(shards)).cast("int")
    groups = slim.groupBy("g").agg(F.count("*").alias("size"))
    sized = stage(slim.join(groups.where("size > 1"), "g", "left").withColumn("shard", start), "shard-sized")
    linked = _propagated(sized.where("size IS NOT NULL"), total, shards, worth)
    rows = linked.unionByName(sized.where("size IS NULL"))
    # rank within the shard: linked rows first, groups together
    buckets = max(1, total // (shards * BUCKET))
    spread = F.when(F.col("size") <= BUCKET, F.xxhash64("g")).otherwise(F.col("u"))
    bucket = F.pmod(spread, F.lit(buckets)) + F.when(F.col("size").isNull(), buckets).otherwise(0)
    rows = rows.withColumn("bucket", bucket.cast("long"))
    filled = rows.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = stage(filled.select("shard", "bucket", before.alias("before"), "n"), "shard-offsets")
    load = {r["shard"]: r["n"] for r in offsets.groupBy("shard").agg(F.sum("n").alias("n")).collect()}
    cap = {j: total // shards + (j < total % shards) for j in range(shards)}
    place = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("g", "u")) - 1
    ranked = rows.join(offsets.drop("n"), ["shard", "bucket"]).withColumn("rank", F.col("before") + place)
    # rows beyond a shard's quota, numbered through all shards, fill the others' gaps in order
    quota, surplus = F.lit(0), F.lit(0)
    seen = 0
    for j in range(shards):
        quota = F.when(F.col("shard") == j, cap[j]).otherwise(quota)
        surplus = F.when(F.col("shard") == j, seen - cap[j]).otherwise(surplus)
        seen += max(0, load.get(j, 0) - cap[j])
    number = F.col("rank") + surplus
    to, slot, filled_to = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for j in range(shards):
        gap = max(0, cap[j] - load.get(j, 0))
        inside = (number >= filled_to) & (number < filled_to + gap)
        to = F.when(inside, j).otherwise(to)
        slot = F.when(inside, number - filled_to + load.get(j, 0)).otherwise(slot)
        filled_to += gap
    stays = F.col("rank") < quota
    return ranked.select(
        "id",
        F.col("bytes").alias("size"),
        "crc",
        F.when(stays, F.col("shard")).otherwise(to).cast("int").alias("shard"),
        F.when(stays, F.col("rank")).otherwise(slot).cast("long").alias("slot"),
    )
