"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Ring.  Every shard has ``points`` places on a ring of hashes; a row's key (its id) hashes to
a place, and the next point clockwise is its home.  The arcs that end in a point are the
ring's units: ``shards * points`` of them, whatever the number of rows.

Bounded loads.  A shard takes its capacity and no more.  Rows that find their shard full go
on clockwise, point by point, until one has room.  All rows take their steps together: a row
that has walked fewer points goes first, then the one from the earlier arc, then the one
with the smaller hash (then id, size, checksum).  So what an arc's rows do is decided by
the arcs' row counts alone: the first so many stay, the next so many go to the next point,
and so on.  These runs are worked out from one count for each arc, and a row's shard and
slot follow from its rank in its arc.

With ``slack`` 0 the capacities add up to the number of rows and differ by one at most, so
the shards' row counts do too, however the ids repeat.  With a positive slack every shard
may hold that part more than the mean, and fewer rows move when a shard is added.

DataFrame functions only: the ranks come from ``_ranks.positions`` (sorted ranges), the arc
is found by a binary search in the ring's points, and the runs (a bounded number for each arc)
are sent to every task.

Defined cases: a null text has size 1 and the checksum of the empty text; a null id is hashed as the
empty text; rows with equal ids spread along the ring once their shard is full; equal rows are
told apart by an unspecified order; an empty table gives an empty result; very long texts are
only measured and summed; other columns are ignored.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._ranks import positions
from ._util import cut

SHARDS = 16
#: Points of a shard on the ring.
POINTS = 64


def ring_hash(key: Column) -> Column:
    """The first 60 bits of the key's MD5: a place on the ring."""
    return F.conv(F.substring(F.md5(key.cast("binary")), 1, 15), 16, 10).cast("long")


def ring(spark: SparkSession, shards: int = SHARDS, points: int = POINTS) -> list[tuple[int, int]]:
    """(place, shard) of all points, clockwise.  A shard's points don't depend on the other shards."""
    every = spark.range(shards * points).select(
        F.floor(F.col("id") / points).alias("shard"), (F.col("id") % points).alias("point"))
    key = F.concat_ws("/", F.lit("shard"), F.col("shard"), F.col("point"))
    rows = every.select(ring_hash(key).alias("place"), "shard").orderBy("place", "shard").collect()
    return [(r["place"], int(r["shard"])) for r in rows]


def capacities(rows: int, shards: int, slack: float = 0.0) -> list[int]:
    """How many rows each shard takes."""
    if slack:
        return [-int(-(1 + slack) * rows // shards)] * shards
    return [rows // shards + (s < rows % shards) for s in range(shards)]


def runs(counts: list[int], owners: list[int], room: list[int]) -> list[list[tuple[int, int, int]]]:
    """Of each arc's rows in their order: (first rank, shard, slot of the first) of its runs.

    ``counts``: rows of each arc; ``owners``: the shard of the point each arc ends in;
    ``room``: the shards' capacities, at least as many as there are rows in all.
    """
    room, used = list(room), [0] * len(room)
    out: list[list[tuple[int, int, int]]] = [[] for _ in counts]
    placed = [0] * len(counts)
    walking = [a for a, n in enumerate(counts) if n]
    step = 0
    while walking:
        for arc in walking:
            shard = owners[(arc + step) % len(owners)]
            n = min(room[shard], counts[arc] - placed[arc])
            if n:
                out[arc].append((placed[arc], shard, used[shard]))
                placed[arc] += n
                used[shard] += n
                room[shard] -= n
        walking = [a for a in walking if placed[a] < counts[a]]
        step += 1
    return out


def arc_of(place: Column, points: list[tuple[int, int]]) -> Column:
    """The number of the first point at or after ``place`` (the first of all after the last), by halving steps."""
    ends = F.expr(f"array({', '.join(f'{p}L' for p, _ in points)})")
    steps = [1 << k for k in reversed(range(len(points).bit_length()))]

    def halve(found: Column, step: Column) -> Column:
        at = found + step  # is the point number at - 1 (element at of the array) still before the place?
        return F.when((at <= len(points)) & (F.get(ends, at - 1) < place), at).otherwise(found)

    before = F.aggregate(F.array(*[F.lit(s) for s in steps]), F.lit(0), halve)
    return F.when(before == len(points), 0).otherwise(before)


def sharded(docs: DataFrame, shards: int = SHARDS, points: int = POINTS, slack: float = 0.0) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot per row of ``docs`` (doc_id, text).

    size: the text's bytes in UTF-8 plus one; slot: the row's number in its shard, from 0.
    """
    spark = docs.sparkSession
    places = ring(spark, shards, points)
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       (F.octet_length(text) + 1).cast("long").alias("size"),
                       F.crc32(text.cast("binary")).alias("text_crc32"))
    rows = rows.withColumn("place", ring_hash(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))))
    rows = cut(rows.withColumns({"arc": arc_of(F.col("place"), places), "_row": F.monotonically_increasing_id()}))
    # one number for each arc
    found = {r["arc"]: r["n"] for r in rows.groupBy("arc").agg(F.count("*").alias("n")).collect()}
    counts = [found.get(a, 0) for a in range(len(places))]
    taken = runs(counts, [s for _, s in places], capacities(sum(counts), shards, slack))
    starts = [0]
    for n in counts:
        starts.append(starts[-1] + n)
    run = "struct<first: long, shard: long, slot: long>"
    text = json.dumps([{"arc": a, "start": starts[a], "runs": [dict(zip(("first", "shard", "slot"), x)) for x in r]}
                       for a, r in enumerate(taken)])
    plan = spark.range(1).select(F.inline(F.from_json(
        F.lit(text), f"array<struct<arc: long, start: long, runs: array<{run}>>>")))
    placed = positions(rows, F.col("arc"), F.col("place"), F.col("doc_id"), F.col("size"), F.col("text_crc32"),
                       F.col("_row"))
    placed = placed.join(F.broadcast(plan), "arc").withColumn("rank", F.col("position") - F.col("start"))
    last = F.aggregate("runs", F.lit(None).cast(run),
                       lambda held, r: F.when(r["first"] <= F.col("rank"), r).otherwise(held))
    placed = placed.withColumn("run", last)
    return placed.select("doc_id", "size", "text_crc32", F.col("run.shard").cast("int").alias("shard"),
                         (F.col("run.slot") + F.col("rank") - F.col("run.first")).alias("slot"))
