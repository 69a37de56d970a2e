"""Shared pieces of the text operators: inputs, lineage cuts, counts by key.

Blocks.  Several operators work on *blocks*: runs of whole documents of about
``BLOCK_BYTES`` of text, packed by one task as numpy arrays.  ``global_counts``
adds up per-block counts of 64-bit keys over all blocks: every block sends each
distinct key once (so a hot key costs one entry per block), the key space is cut
into equal ranges, and each range answers the blocks that asked.  A text longer than a
block is a block by itself unless the operator cuts it.
"""

from __future__ import annotations

import ctypes
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import checkpoint_dir

BLOCK_BYTES = 12 << 20
#: Keys that one task of ``global_counts`` holds, about.
KEYS_PER_RANGE = 1 << 20
#: Edges that one partition of ``components`` holds, about.
EDGES = 100_000


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole ``documents`` table, the two columns that operators read."""
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")


def cut(df: DataFrame) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read from there on.

    The files go when nothing refers to them any more (Spark's context cleaner).
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def anew(df: DataFrame) -> DataFrame:
    """``df`` without a known partitioning by key, where it lies.

    A join side that is already partitioned by the key is not shuffled again, and
    adaptive skew handling then cannot split the other side.
    """
    return df.coalesce(max(2, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))))


def tidy(f):
    """``f`` (over Arrow batches, or over the table of a group) that gives freed memory back to the
    system when it is done: a worker that waits for its next task then holds what it needs."""
    def give_back() -> None:
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except AttributeError:  # not with every C library
            pass

    def run(data):
        out = f(data)
        if isinstance(out, pa.Table):
            give_back()
            return out
        return passed_on(out)

    def passed_on(batches):
        yield from batches
        del batches
        give_back()

    return run


def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """The rows of Arrow batches as tuples of Python values, one at a time (a row may be a large block)."""
    for b in batches:
        columns = b.columns
        for i in range(b.num_rows):
            yield tuple(c[i].as_py() for c in columns)


def chunks(batches: Iterator[pa.RecordBatch], text_at: int = 1,
           limit: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """Rows gathered until their text (column ``text_at``) holds ``limit`` characters."""
    out, held = [], 0
    for row in rows_of(batches):
        out.append(row)
        held += len(row[text_at] or "") + 64
        if held >= limit:
            yield out
            out, held = [], 0
    if out:
        yield out


def batch_of(schema: pa.Schema, rows: list[tuple]) -> pa.RecordBatch:
    cols = zip(*rows) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(cols, schema)],
                                      schema=schema)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit words (two multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def sums_by(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of the counts of each."""
    order = np.argsort(keys, kind="stable")
    k = keys[order]
    first = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    return k[first], (np.add.reduceat(counts[order].astype(np.int64), first) if len(k)
                      else np.zeros(0, np.int64))


def pack(a: np.ndarray) -> bytes:
    """An array as compressed bytes, one byte plane after the other.

    64-bit unsigned arrays are ascending keys and are kept as differences.
    """
    if a.dtype == np.uint64:
        a = np.diff(a, prepend=np.uint64(0))
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(-1, a.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def unpack(b: bytes, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b), np.uint8).reshape(size, -1)
    a = np.ascontiguousarray(planes.T).reshape(-1).view(kind)
    return np.cumsum(a, dtype=np.uint64) if kind is np.uint64 else a


def block_number(n: int) -> int:
    """A number for the n-th block of this task, unique in the job."""
    return (TaskContext.get().partitionId() << 32) | n


def global_counts(blocks: DataFrame, entries: int, made_by=None) -> tuple[DataFrame, DataFrame]:
    """Per block and key, the key's count over all blocks.

    ``blocks``: block_id long (unique), keys (``pack`` of uint64, ascending), counts
    (``pack`` of uint32).  ``entries``: about how many keys all blocks hold.  ``made_by``:
    a function over Arrow batches that makes these columns of those of ``blocks`` (in the
    same worker; a ``mapInArrow`` before this one would keep a second worker for each task).

    Returns (answers, classes).  answers: block_id, answers (array of part, totals,
    flags, for ``answer_arrays``; totals are whole, up to 2^63), in the order of the block's keys.  flags: 1, another
    block holds the key too; 2, this block stands for the key (of the blocks that
    count it above 0, exactly one).  classes: class (bits of the total: 1 is a total of
    1, 2 of 2 or 3, and so on), keys (distinct), total (sum of their totals).
    """
    bits = max(1, math.ceil(math.log2(max(2, entries / KEYS_PER_RANGE))))

    def deal(batches):
        schema = pa.schema([("part", pa.int32()), ("block_id", pa.int64()), ("keys", pa.binary()),
                            ("counts", pa.binary())])
        for bid, kb, cb in rows_of(made_by(batches) if made_by else batches):
            k, c = unpack(kb, np.uint64), unpack(cb, np.uint32)
            at = np.searchsorted(k, np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
            at = np.r_[at, len(k)]
            cuts = [(int(p), slice(at[p], at[p + 1])) for p in np.flatnonzero(at[1:] > at[:-1])]
            for i in range(0, len(cuts), 256):
                yield batch_of(schema, [(p, bid, pack(k[x]), pack(c[x])) for p, x in cuts[i:i + 256]])

    def total(table: pa.Table) -> pa.Table:
        rows = sorted(rows_of(table.to_batches()), key=lambda r: r[1])
        each = [unpack(r[2], np.uint64) for r in rows]
        n = [len(x) for x in each]
        k = np.concatenate(each)
        c = np.concatenate([unpack(r[3], np.uint32) for r in rows])
        order = np.argsort(k, kind="stable")
        s = k[order]
        new = np.r_[True, s[1:] != s[:-1]]
        first = np.flatnonzero(new)
        group = np.cumsum(new) - 1
        sc = c[order].astype(np.int64)
        tot = np.add.reduceat(sc, first)
        size = np.diff(np.r_[first, len(s)])
        # the first entry of a key that has a count above 0 stands for it
        own = np.minimum.reduceat(np.where(sc > 0, np.arange(len(s)), len(s)), first)
        totals, flags = np.empty(len(k), np.int64), np.empty(len(k), np.uint8)
        totals[order] = tot[group]
        flags[order] = (size[group] > 1) | ((own[group] == np.arange(len(s))).astype(np.uint8) << 1)
        kind = np.frexp(tot.astype(np.float64))[1]
        stats = np.stack([np.bincount(kind, minlength=64),
                          np.bincount(kind, weights=tot, minlength=64).astype(np.int64)])
        stats[:, 0] = 0  # keys without a count
        ends = np.cumsum(n)
        return pa.table({
            "block_id": pa.array([r[1] for r in rows] + [-1], pa.int64()),
            "part": pa.array([r[0] for r in rows] + [rows[0][0]], pa.int32()),
            "totals": pa.array([pack(totals[e - m:e]) for e, m in zip(ends, n)]
                               + [stats.astype(np.int64).tobytes()], pa.binary()),
            "flags": pa.array([pack(flags[e - m:e]) for e, m in zip(ends, n)] + [None], pa.binary()),
        })

    def spread(batches):
        schema = pa.schema([("class", pa.int32()), ("keys", pa.int64()), ("total", pa.int64())])
        for (stats,) in rows_of(batches):
            a = np.frombuffer(stats, np.int64).reshape(2, 64)
            yield batch_of(schema, [(i, *map(int, a[:, i])) for i in range(64) if a[:, i].any()])

    dealt = (blocks if made_by else blocks.select("block_id", "keys", "counts")).mapInArrow(
        tidy(deal), "part int, block_id long, keys binary, counts binary")
    raw = cut(dealt.groupBy("part").applyInArrow(
        tidy(total), "block_id long, part int, totals binary, flags binary"))
    answers = raw.where("block_id >= 0").groupBy("block_id").agg(
        F.sort_array(F.collect_list(F.struct("part", "totals", "flags"))).alias("answers"))
    classes = raw.where("block_id < 0").select("totals").mapInArrow(
        spread, "class int, keys long, total long").groupBy("class").agg(F.sum("keys").alias("keys"),
                                                                        F.sum("total").alias("total"))
    return answers, classes


def answer_arrays(answers: list | None) -> tuple[np.ndarray, np.ndarray]:
    """Totals (in 32 bits where all of a part fit, which takes less memory) and flags of a block, in the order of its keys."""
    if not answers:
        return np.zeros(0, np.uint32), np.zeros(0, np.uint8)

    def totals(b: bytes) -> np.ndarray:
        a = unpack(b, np.int64)
        return a.astype(np.uint32) if a.max(initial=0) <= 0xFFFFFFFF else a

    return (np.concatenate([totals(a["totals"]) for a in answers]),
            np.concatenate([unpack(a["flags"], np.uint8) for a in answers]))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """node, component (its smallest member) for the nodes of undirected ``edges``.

    Alternating large-star and small-star steps; each step is one grouped
    minimum (combined before the shuffle) and one join, cut after every round.
    A round has as many partitions as its edges need: up to ``EDGES`` of them lie in
    one, where nothing is shuffled, so a few edges don't cost thousands of tasks.
    """

    def sized(e: DataFrame):
        """The edges in as many partitions as they need, their number and the sum of their hashes."""
        e = cut(e.where("u <> v").distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return e.coalesce(max(1, -(-now[0] // EDGES))), now

    def lowest(x: DataFrame) -> DataFrame:
        """``x`` with m, the smallest v of its u."""
        if now[0] <= EDGES:  # a join would shuffle even what lies in one partition
            return x.withColumn("m", F.min("v").over(Window.partitionBy("u")))
        return x.join(x.groupBy("u").agg(F.min("v").alias("m")), "u")

    e, now = sized(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")))
    before = None
    while now != before:
        before = now
        ways = F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))
        both = e.select(F.explode(ways).alias("way")).select("way.*")
        large = lowest(both).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
        large = large.where("u <> v").distinct()
        # of each node, the edge to its minimum stays; the others go from there to it
        e, now = sized(lowest(large).select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"),
                                            F.col("m").alias("v")))
    return e.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        e.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
