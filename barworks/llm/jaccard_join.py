"""Components of documents whose shingle sets are similar: a size-aware join.

A document's set holds its distinct shingles of ``WORDS`` words (64-bit hashes); two
documents link when ``100 * |A & B| >= PERCENT * |A | B|``.

Keys of a set.  Two sets that link share a key:
* light sets (size up to a boundary): every subset of the fixed size that a partner
  of a feasible light size forces them to share;
* heavy sets, and light ones that a heavy set can reach: the inverted-list keys, that
  is, the ``n - ceil(0.85 n) + least_lists(n)`` first shingles, rare ones first (by a
  fixed-size table of hashed counts over the whole corpus, then by hash), of which a
  linked set shares ``least_lists`` of the smaller size or more.  That is a share of the
  size: by chance a set has keys in common with some others, and the more the larger the
  corpus, but not that many.
The boundary is the largest size up to which enumerating subsets costs no more than
scanning lists, summed over the sizes as counted in the corpus.

Linking without pairs inside groups.  Equal sets are one class.  Keys that one
document alone holds are dropped (``global_counts``), and documents left with too few.
Then rounds: every class meets at most one partner, the most typical member of another
component in its lists that shares most keys with it; the pair is verified and the
components grow.  When a round links nothing more (or after ``ROUNDS``), all pairs in
different components that pass the filters are verified, so no link between components
is lost; pairs inside a component need no check.  The filters: sizes, and for list keys
the number of shared ones.  A pair comes out of one list only.

Defined cases: null or blank texts have the empty set, n_shingles 0 and are their own
component; rows with the same id are one document that has the links of all its
texts; rows with a null id link with nothing and have a null component; a text longer than
a block is a block by itself, so memory is bounded by the longest text; other columns
are ignored.
"""

from __future__ import annotations

from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import (anew, answer_arrays, batch_of, block_number, chunks, components, cut, global_counts, mix64, pack,
                    rows_of, tidy, unpack)
from .lm_scoring import tokenised

WORDS, PERCENT = 4, 85
ROUNDS = 2
#: List keys of a document that are carried along to its lists at most.
CARRIED = 96
#: Characters of a block; bits of the table that spares documents without candidates.
BLOCK, SPARE_BITS = 2 << 20, 24
#: List keys that linked sets share at least (fewer if the sets are smaller), and one of so many shingles.
LISTS, LISTS_OF = 8, 10
#: Bits of the table of hashed counts, its slices, the largest size for subsets, the cost of scanning one list.
TABLE_BITS, SLICES, MOST_LIGHT, SCAN = 22, 64, 24, 4


def shingle_sets(texts: list[str | None], words: int = WORDS) -> list[np.ndarray]:
    """Ascending distinct shingle hashes of each text."""
    tokens, lens, hashes = tokenised(texts)
    h = hashes[tokens]
    roll = np.zeros(len(h), np.uint64)
    for i in range(words):  # a shingle's hash at its first word
        part = np.zeros(len(h), np.uint64)
        part[:len(h) - i] = h[i:]
        roll = mix64(roll + part + np.uint64(i + 1))
    out, at = [], 0
    for n in lens.tolist():
        n_words = n - 1  # the end mark is no word
        if n_words >= words:
            out.append(np.unique(roll[at:at + n_words - words + 1]))
        elif n_words:
            out.append(np.array([xxhash.xxh3_64_intdigest(h[at:at + n_words].tobytes(), seed=n_words)], np.uint64))
        else:
            out.append(np.zeros(0, np.uint64))
        at += n
    return out


def need(n: int, percent: int = PERCENT) -> int:
    """Least overlap of a set of size n with any linked set."""
    return -(-percent * n // 100)


def least_lists(n, percent: int = PERCENT):
    """List keys that a set of size n (a number or an array) shares with any linked set that isn't smaller."""
    return np.minimum(need(n, percent), np.maximum(LISTS, -(-n // LISTS_OF)))


def overlap(n: int, m: int, percent: int = PERCENT) -> int:
    """Least overlap of linked sets of sizes n and m."""
    return -(-percent * (n + m) // (100 + percent))


def can_be_first(percent: int = PERCENT) -> F.Column:
    """Whether linked sets (sizes n_a and n_b) can have their first shared shingle at places at_a and at_b: from
    there on each has to hold all that they share."""
    ahead = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    return ahead >= F.ceil(percent * (F.col("n_a") + F.col("n_b")) / (100 + percent))


def subset_sizes(n: int, light: int, percent: int = PERCENT) -> list[int]:
    """The sizes of shared subsets with feasible light partners."""
    return sorted({overlap(n, m, percent) for m in range(need(n, percent), min(light, 100 * n // percent) + 1)})


def boundary(sizes: dict[int, int], percent: int = PERCENT) -> int:
    """The largest light size: subsets cost no more than lists up to there."""
    best = 0
    for light in range(1, MOST_LIGHT + 1):
        few = sum(c * sum(comb(n, k) for k in subset_sizes(n, light, percent)) for n, c in sizes.items() if n <= light)
        lists = sum(c * SCAN * (n - need(n, percent) + 1) for n, c in sizes.items() if n <= light)
        if few <= lists:
            best = light
    return best


def keys_of(s: np.ndarray, freq: np.ndarray, light: int, percent: int) -> tuple[np.ndarray, np.ndarray, float]:
    """Keys, their positions (-1 for subsets) and how common the set's shingles are."""
    n = len(s)
    f = freq[s >> np.uint64(64 - TABLE_BITS)]
    order = np.lexsort((s, f))
    keys, at = [], []
    if n > light or 100 * n >= percent * (light + 1):
        head = s[order[:n - need(n, percent) + int(least_lists(n, percent))]]
        keys.append(head)
        at.append(np.arange(len(head)))
    if n <= light:
        for k in subset_sizes(n, light, percent):
            for sub in combinations(range(n), k):
                keys.append(np.array([xxhash.xxh3_64_intdigest(s[list(sub)].tobytes(), seed=k)], np.uint64))
                at.append(np.array([-1]))
    return np.concatenate(keys), np.concatenate(at).astype(np.int32), float(np.log2(1 + f.astype(np.float64)).mean())


def corpus_table(docs: DataFrame, words: int) -> tuple[np.ndarray, dict[int, int]]:
    """Hashed counts of all documents' shingles (fixed size), and how many sets have each light size."""
    width = (1 << TABLE_BITS) // SLICES

    def count(batches):
        schema = pa.schema([("slice", pa.int32()), ("counts", pa.binary())])
        table, sizes = np.zeros(1 << TABLE_BITS, np.int32), np.zeros(width, np.int32)
        for rows in chunks(batches, limit=BLOCK):
            sets = shingle_sets([t for _, t in rows], words)
            cell, times = np.unique((np.concatenate(sets) >> np.uint64(64 - TABLE_BITS)).astype(np.int32),
                                    return_counts=True)
            table[cell] += times
            sizes += np.bincount([min(len(s), MOST_LIGHT + 1) for s in sets], minlength=width)
        if sizes.any():
            yield batch_of(schema, [(i, pack(table[i * width:(i + 1) * width])) for i in range(SLICES)]
                           + [(SLICES, pack(sizes))])

    def add(table: pa.Table) -> pa.Table:
        total = sum(unpack(b, np.int32).astype(np.int64) for b in table["counts"].to_pylist())
        return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "counts": pa.array([pack(np.minimum(total, 2**31 - 1).astype(np.int32))], pa.binary())})

    shape = "slice int, counts binary"
    got = {r["slice"]: unpack(r["counts"], np.int32) for r in
           docs.mapInArrow(tidy(count), shape).groupBy("slice").applyInArrow(tidy(add), shape).collect()}
    if not got:
        return np.zeros(1 << TABLE_BITS, np.int32), {}
    sizes = {n: int(got[SLICES][n]) for n in range(1, MOST_LIGHT + 1)}
    return np.concatenate([got[i] for i in range(SLICES)]), sizes


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id per row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    table, sizes = corpus_table(docs, words)
    light = boundary(sizes, percent)
    shared = docs.sparkSession.sparkContext.broadcast(table)  # TABLE_BITS fix its size

    def to_blocks(batches):
        schema = pa.schema([("block_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("sizes", pa.binary()),
                            ("prints", pa.binary()), ("commons", pa.binary()), ("n_keys", pa.binary()),
                            ("keys", pa.binary()), ("spots", pa.binary()), ("total", pa.int64())])
        for b, rows in enumerate(chunks(batches, limit=BLOCK)):
            seen, prints, commons, n_keys, keys, spots, sizes = set(), [], [], [], [], [], []
            for (doc_id, _), s in zip(rows, shingle_sets([t for _, t in rows], words)):
                sizes.append(len(s))
                fp = xxhash.xxh3_128_digest(s.tobytes())
                prints.append(fp)
                if not len(s) or doc_id is None or fp in seen:
                    k, at, common = np.zeros(0, np.uint64), np.zeros(0, np.int32), 0.0
                else:  # equal sets of a block need their keys once
                    k, at, common = keys_of(s, shared.value, light, percent)
                    seen.add(fp)
                commons.append(common)
                n_keys.append(len(k))
                keys.append(k)
                spots.append(at)
            keys = np.concatenate(keys)
            yield batch_of(schema, [(block_number(b), [i for i, _ in rows], pack(np.array(sizes, np.int32)),
                                     b"".join(prints), pack(np.array(commons, np.float32)),
                                     pack(np.array(n_keys, np.int32)), keys.tobytes(), pack(np.concatenate(spots)),
                                     len(keys))])

    blocks = cut(docs.mapInArrow(
        tidy(to_blocks), "block_id long, ids array<long>, sizes binary, prints binary, commons binary, n_keys binary, "
                   "keys binary, spots binary, total long"))

    def to_rows(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("n", pa.int32()), ("print", pa.binary())])
        for ids, sizes, prints in rows_of(batches):
            yield batch_of(schema, [(i, n, prints[16 * k:16 * k + 16]) for k, (i, n) in
                                    enumerate(zip(ids, unpack(sizes, np.int32).tolist()))])

    def to_keys(batches):
        schema = pa.schema([("block_id", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        for bid, keys in rows_of(batches):
            k, c = np.unique(np.frombuffer(keys, np.uint64), return_counts=True)
            yield batch_of(schema, [(bid, pack(k), pack(c.astype(np.uint32)))])

    def to_postings(batches):
        schema = pa.schema([("key", pa.int64()), ("doc_id", pa.int64()), ("n", pa.int32()), ("at", pa.int32()),
                            ("common", pa.float32())])
        for ids, sizes, commons, n_keys, keys, spots, answers in rows_of(batches):
            k = np.frombuffer(keys, np.uint64)
            totals, _ = answer_arrays(answers)
            if not len(k):
                continue
            n_keys, sizes, spots = unpack(n_keys, np.int32), unpack(sizes, np.int32), unpack(spots, np.int32)
            row = np.repeat(np.arange(len(n_keys)), n_keys)
            live = totals[np.searchsorted(np.unique(k), k)] > 1
            # the smallest set that can be linked shares as many
            least = least_lists(need(sizes.astype(np.int64), percent), percent)
            lists = np.bincount(row[live & (spots >= 0)], minlength=len(sizes)) >= np.maximum(least, 1)
            subsets = np.bincount(row[live & (spots < 0)], minlength=len(sizes)) > 0
            # two linked sets meet in one of these; the last list keys only told whether to drop the set
            early = spots <= (sizes - need(sizes.astype(np.int64), percent))[row]
            use = np.flatnonzero(live & (lists | subsets)[row] & early)
            row, spots = row[use], spots[use]
            who = np.array([-1 if i is None else i for i in ids], np.int64)
            out = pa.RecordBatch.from_arrays(
                [pa.array(k[use].view(np.int64)), pa.array(who[row]), pa.array(sizes[row]),
                 pa.array(spots), pa.array(unpack(commons, np.float32)[row])], schema=schema)
            for i in range(0, len(use), 1 << 16):
                yield out.slice(i, 1 << 16)

    rows = blocks.select("ids", "sizes", "prints").mapInArrow(tidy(to_rows), "doc_id long, n int, print binary")
    n_keys = blocks.agg(F.sum("total")).first()[0] or 0
    answers, _ = global_counts(blocks.select("block_id", "keys"), n_keys, to_keys)
    postings = blocks.join(answers, "block_id").select(
        "ids", "sizes", "commons", "n_keys", "keys", "spots", "answers").mapInArrow(
        tidy(to_postings), "key long, doc_id long, n int, at int, common float")

    # classes of equal sets: the smallest id stands for them
    classes = cut(rows.where("n > 0").groupBy("print").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies")))
    same = classes.where("copies > 1").select("print", "rep")
    moved = (rows.join(anew(same), "print").where("doc_id <> rep").select("doc_id", "rep").distinct())
    postings = (postings.join(anew(moved), "doc_id", "left").withColumn("doc_id", F.coalesce("rep", "doc_id"))
                .groupBy("key", "doc_id").agg(F.max("n").alias("n"), F.max("at").alias("at"),
                                              F.max("common").alias("common")))
    postings = cut(postings)
    postings = cut(postings.join(anew(postings.groupBy("key").agg(F.count("*").alias("c")).where("c > 1")), "key")
                   .drop("c"))

    cell = F.shiftrightunsigned(F.xxhash64("doc_id"), 64 - SPARE_BITS).cast("int")

    def sieve(ids: DataFrame):
        """A bit table of fixed size with the cells of ``ids``: what it lets through is joined
        exactly afterwards, what it stops needn't be moved."""

        def to_bits(table: pa.Table) -> pa.Table:
            bits = np.zeros(1 << 15, bool)
            bits[table["cell"].to_numpy() & 0x7FFF] = True
            return pa.table({"slice": table["slice"][:1],
                             "bits": pa.array([np.packbits(bits).tobytes()], pa.binary())})

        bits = np.zeros((1 << SPARE_BITS) // 8, np.uint8)
        for r in (ids.select(cell.alias("cell")).distinct().withColumn("slice", F.shiftright("cell", 15))
                  .groupBy("slice").applyInArrow(tidy(to_bits), "slice int, bits binary").collect()):
            bits[r["slice"] << 12:(r["slice"] + 1) << 12] = np.frombuffer(r["bits"], np.uint8)
        shared_bits = docs.sparkSession.sparkContext.broadcast(bits)  # SPARE_BITS fix its size

        def let_through(batch: pa.RecordBatch) -> pa.RecordBatch:
            at = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False)
            return batch.filter(pa.array((shared_bits.value[at >> 3] >> (7 - (at & 7)) & 1).astype(bool)))

        return let_through

    # the full sets of the documents that still have a key in common with another
    wanted = postings.select("doc_id").distinct()
    some = sieve(wanted)

    def to_sets(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("set", pa.binary())])
        for batch in batches:
            for part in chunks([some(batch)], limit=BLOCK):
                yield batch_of(schema, [(r[0], pack(s)) for r, s in
                                        zip(part, shingle_sets([r[1] for r in part], words))])

    sets = cut(docs.where("doc_id is not null").select("doc_id", "text", cell).mapInArrow(
        tidy(to_sets), "doc_id long, set binary").join(wanted, "doc_id", "left_semi"))

    def verified(pairs: DataFrame) -> DataFrame:
        """The linked ones of distinct ``pairs`` (a, b)."""
        ends = sieve(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")))

        def pick(batches):
            for batch in batches:
                yield ends(batch).select(["doc_id", "set"])

        def compare(batches):
            schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
            for batch in batches:
                out = []
                for a, b, x, y in rows_of([batch]):
                    x, y = unpack(x, np.uint64), unpack(y, np.uint64)
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    if both and 100 * both >= percent * (len(x) + len(y) - both):
                        out.append((a, b))
                yield batch_of(schema, out)

        used = sets.select("doc_id", "set", cell).mapInArrow(tidy(pick), "doc_id long, set binary")
        return (pairs.join(used.withColumnsRenamed({"doc_id": "a", "set": "x"}), "a")
                .join(used.withColumnsRenamed({"doc_id": "b", "set": "y"}), "b").select("a", "b", "x", "y")
                .mapInArrow(tidy(compare), "a long, b long"))

    def fits(n: str, m: str) -> F.Column:
        """Length filter."""
        return 100 * F.least(n, m) >= percent * F.greatest(n, m)

    def bound(n: str, m: str) -> F.Column:
        """Postings' list keys that linked sets of these sizes share at least.

        All common shingles up to the smaller of the two last of these keys are shared ones;
        of the others there are at most as many as one set has after them."""
        low = [F.ceil(percent * F.col(c) / 100) for c in (n, m)]
        shared = F.ceil(percent * (F.col(n) + F.col(m)) / (100 + percent))
        return F.greatest(F.lit(1), shared - F.greatest(*low) + 1)

    links = tried = None
    labelled = postings.withColumn("component", F.col("doc_id"))
    for _ in range(ROUNDS):
        # the most typical member of each list, for the members of other components
        tops = (labelled.groupBy("key").agg(F.max(F.struct("common", "doc_id", "n", "component")).alias("top"),
                                            F.min("component").alias("lo"), F.max("component").alias("hi"))
                .where("lo <> hi").drop("lo", "hi"))
        met = (labelled.join(anew(tops), "key").where(F.col("component") != F.col("top.component"))
               .select("doc_id", "n", "at", F.col("top.doc_id").alias("with"), F.col("top.n").alias("m"))
               .where(fits("n", "m")))
        # keys led by another member aren't counted here, so a pair is tried from a few shared keys on
        best = (met.groupBy("doc_id", "with").agg(F.count("*").alias("c"), F.min("at").alias("at"))
                .where("at < 0 or c > 3").groupBy("doc_id").agg(F.max(F.struct("c", "with")).alias("best")))
        pairs = best.select(F.least("doc_id", "best.with").alias("a"), F.greatest("doc_id", "best.with").alias("b")).distinct()
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = cut(pairs)
        new = cut(verified(pairs))
        tried = pairs if tried is None else cut(anew(tried.unionByName(pairs)))
        if new.isEmpty():
            break
        links = new if links is None else cut(anew(links.unionByName(new)))
        labels = components(links)
        labelled = (postings.join(anew(labels.withColumnRenamed("node", "doc_id")), "doc_id", "left")
                    .withColumn("component", F.coalesce("component", "doc_id")))
        # lists within one component have nothing more to tell
        mixed = (labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
                 .where("lo <> hi").select("key"))
        labelled = cut(labelled.join(anew(mixed), "key"))
        postings = labelled.drop("component")
    # all that is left: pairs in a common list whose components differ
    # with a document's list keys at hand, a pair comes out of one list only, that of its first shared
    # key, and only if it shares enough of them; long lists aren't carried, their pairs are counted
    own = (labelled.where("at >= 0").groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct("at", "key"))).alias("own"))
           .where(F.size("own") <= CARRIED)
           .select("doc_id", F.col("own.key").alias("own")))
    mixed = labelled.drop("common").join(anew(own), "doc_id", "left")
    x, y = (mixed.select("key", *(F.col(c).alias(c + side) for c in ("doc_id", "n", "at", "component", "own")))
            for side in ("_a", "_b"))
    both = F.array_intersect("own_a", "own_b")
    once = can_be_first(percent) & (F.get(both, 0) == F.col("key")) & (F.size(both) >= bound("n_a", "n_b"))
    rest = (x.join(y, "key").where("doc_id_a < doc_id_b and component_a <> component_b").where(fits("n_a", "n_b"))
            .where((F.col("at_a") < 0) | F.col("own_a").isNull() | F.col("own_b").isNull() | once)
            .groupBy(F.col("doc_id_a").alias("a"), F.col("doc_id_b").alias("b"), "n_a", "n_b")
            .agg(F.count("*").alias("c"), F.min("at_a").alias("at"),
                 F.count_if(F.col("own_a").isNotNull() & F.col("own_b").isNotNull()).alias("sure"))
            .where((F.col("at") < 0) | (F.col("sure") > 0) | (F.col("c") >= bound("n_a", "n_b"))).select("a", "b"))
    if tried is not None:
        rest = rest.join(tried, ["a", "b"], "left_anti")
    new = verified(cut(rest))
    labels = components(new if links is None else new.unionByName(links))

    # from classes back to documents
    out = rows.join(anew(same), "print", "left").withColumn("rep", F.coalesce("rep", "doc_id"))
    return out.join(anew(labels.withColumnRenamed("node", "rep")), "rep", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "rep")).alias("component_id"))
