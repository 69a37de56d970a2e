"""Benchmark decontamination by latent semantic retrieval.

1. Benchmark items are cut into passages of at most ``PASSAGE`` words: one after the
   other, and overlapping ones at every ``STRIDE``-th word and at the item's end, so that
   any ``PASSAGE`` words of an item share ``COPY`` of them with a passage.  Word weights
   are inverse document frequencies over all documents (one counting pass).
2. A randomised SVD of the weighted passage-by-word matrix gives the latent space: the
   matrix stays in Spark, each round multiplies it with a thin matrix and adds up the
   parts (words by ``RANK``), and only that thin sum is orthonormalised on the driver.
3. Every document is read in windows of three runs of ``RUN`` words (so that each span
   of ``2 * RUN + 1`` words lies inside one window), folded into the latent space and
   compared with all passages by cosine, as one matrix product per block of windows.
4. For window and passage pairs above ``COSINE``, the longest common subsequence of the
   item's passage and the text around the window decides: at least ``COPY`` of the
   passage's words, or at least ``PARAPHRASE`` of them and at least ``COPY`` of the answer,
   which is the item's last sentence.  The words must lie within ``STRETCH`` times the
   passage's length; an answer beyond the passage's ends, as far away as in the item,
   times ``STRETCH``.

The benchmark is the stated query set: it is taken in blocks of ``BLOCK`` passages, so what
a task holds is bounded; documents are never shuffled.

Defined cases: null texts count as empty and match nothing; items without words match
nothing, repeated items are reported each; an empty benchmark leaves all documents clean;
repeated rows and null ids are searched like any other; of very long texts the words and the
sums of their runs are held, and compared with the passages a bounded part at a time;
other columns are kept.
"""

from __future__ import annotations

import math
import re
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import batch_of, chunks, rows_of, tidy

RUN, PASSAGE, STRIDE, RANK, BLOCK = 32, 64, 24, 128, 4096
#: Rows whose words are held at once, and runs of a text that are compared at once.
ROWS, RUNS = 512, 1024
COSINE, COPY, PARAPHRASE, STRETCH = 0.4, 0.8, 0.6, 1.5
#: Words in more than this share of the documents have no weight, but for the rarest of each passage.
COMMON, RAREST = 0.2, 8
POWER_ROUNDS = 2
_DROP = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def words_of(text: str | None) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return (text or "").lower().encode().translate(None, _DROP).split()


def passages(items: list[tuple[int, str]]) -> list[tuple[int, list[bytes], list[bytes], int, int]]:
    """(item, words, the item's answer, words of the answer's way before and after the passage) of every passage."""
    out = []
    for item, text in items:
        words = words_of(text)
        last = re.split(r"(?<=[.!?])\s+", (text or "").strip())[-1]
        answer = max(0, len(words) - len(words_of(last)))
        starts = {at for at in range(0, len(words), PASSAGE) if at == 0 or len(words) - at >= 8}
        if len(words) > PASSAGE:
            starts |= {*range(0, len(words) - PASSAGE, STRIDE), len(words) - PASSAGE}
        for at in sorted(starts):
            part = words[at:at + PASSAGE]
            out.append((item, part, words[answer:], max(0, at - answer), len(words) - at - len(part)))
    return out


def common(a: list[bytes], b: list[bytes]) -> int:
    """Length of the longest common subsequence (one bit per word of ``a``)."""
    places: dict[bytes, int] = {}
    for i, w in enumerate(a):
        places[w] = places.get(w, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for w in b:
        if m := places.get(w):
            u = row & m
            row = (row + u | row - u) & full
    return len(a) - row.bit_count()


def spots(near: list[bytes], wide: int, step: int) -> list[list[bytes]]:
    """Overlapping stretches of ``wide`` words."""
    return [near[at:at + wide] for at in range(0, max(1, len(near) - wide + step), step)]


def matches(part: list[bytes], answer: list[bytes], near: list[bytes], beyond: list[bytes] | None = None) -> float:
    """The share of the passage found near, or 0 when that is no leak.

    ``beyond``: the text to look for the answer in, if the passage doesn't hold all of it.
    """
    n = len(part)
    if common(part, near) < PARAPHRASE * n:
        return 0.0
    wide = math.ceil(STRETCH * n)
    step = max(1, n // 8)
    answered = lambda spot: common(answer, spot) >= COPY * len(answer) > 0
    best, there = 0.0, None
    for spot in spots(near, wide, step):
        got = common(part, spot)
        if got < PARAPHRASE * n or got / n <= best:
            continue
        if got < COPY * n and beyond is not None and there is None:
            reach = max(wide, math.ceil(STRETCH * len(answer)))
            there = any(map(answered, spots(beyond, reach, step)))
        if got >= COPY * n or (answered(spot) if beyond is None else there):
            best = got / n
    return best


def document_frequencies(docs: DataFrame, vocabulary: set[bytes]) -> tuple[dict[bytes, int], int]:
    """In how many documents each benchmark word occurs, and the number of documents."""
    known = docs.sparkSession.sparkContext.broadcast(vocabulary)  # words of one benchmark block

    def count(batches):
        schema = pa.schema([("word", pa.binary()), ("n", pa.int64())])
        seen: dict[bytes, int] = {}
        total = 0
        for (text,) in rows_of(batches):
            total += 1
            for w in known.value.intersection(words_of(text)):
                seen[w] = seen.get(w, 0) + 1
        yield batch_of(schema, [*seen.items(), (b"", total)])

    got = docs.select("text").mapInArrow(tidy(count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))
    freq = {bytes(r["word"]): r["n"] for r in got.collect()}
    return freq, freq.pop(b"", 0)


def latent_space(matrix: DataFrame, n_words: int, rank: int) -> np.ndarray:
    """Words by rank: right singular directions of the rows (cols array, weights array)."""
    spark = matrix.sparkSession
    rank = min(rank, n_words)

    def product(q: np.ndarray) -> np.ndarray:
        """The matrix's transpose times the matrix times ``q``, added up over partitions."""
        shared = spark.sparkContext.broadcast(q)

        def part(batches):
            schema = pa.schema([("slice", pa.int32()), ("part", pa.binary())])
            out = np.zeros((n_words, rank))
            for cols, weights in rows_of(batches):
                c, w = np.array(cols, np.int64), np.array(weights)
                np.add.at(out, c, w[:, None] * (w @ shared.value[c])[None, :])
            for k, at in enumerate(range(0, n_words, 4096)):
                yield batch_of(schema, [(k, out[at:at + 4096].tobytes())])

        def add(table: pa.Table) -> pa.Table:
            total = sum(np.frombuffer(b) for b in table["part"].to_pylist())
            return pa.table({"slice": table["slice"][:1].cast(pa.int32()), "part": pa.array([total.tobytes()], pa.binary())})

        rows = (matrix.mapInArrow(tidy(part), "slice int, part binary").groupBy("slice")
                .applyInArrow(tidy(add), "slice int, part binary").orderBy("slice").collect())
        return np.concatenate([np.frombuffer(r["part"]) for r in rows]).reshape(n_words, rank)

    q = np.linalg.qr(np.random.default_rng(7).standard_normal((n_words, rank)))[0]
    for _ in range(POWER_ROUNDS):
        q = np.linalg.qr(product(q))[0]
    # the small problem in that basis orders the directions by their strength
    values, turn = np.linalg.eigh(q.T @ product(q))
    strong = values > 1e-10 * max(values.max(), 1e-300)
    return (q @ turn[:, strong])[:, ::-1].astype(np.float32)


def leaks(docs: DataFrame, benchmark: DataFrame, rank: int = RANK, cosine: float = COSINE) -> DataFrame:
    """``docs`` (with a column text) and ``leaks``: array of (item_id, cosine, share)."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    found = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("cosine", T.DoubleType()),
                                      T.StructField("share", T.DoubleType())]))
    out = docs.drop("leaks").withColumn("leaks", F.lit(None).cast(found))
    rows = [(r["item_id"], r["text"]) for r in items.toLocalIterator()]
    parts = sorted(passages(rows), key=lambda p: (p[0] is None, p[0] or 0, p[1:]))
    for at in range(0, len(parts), BLOCK):
        out = _search(out, docs, parts[at:at + BLOCK], rank, cosine, found)
    return out.withColumn("leaks", F.coalesce("leaks", F.array().cast(found)))


def _search(out: DataFrame, docs: DataFrame, parts: list, rank: int, cosine: float, found) -> DataFrame:
    spark = docs.sparkSession
    freq, total = document_frequencies(docs, {w for _, p, *_ in parts for w in p})
    weighed = {w for w, n in freq.items() if n <= COMMON * total}
    for _, p, *_ in parts:
        weighed.update(sorted(set(p), key=lambda w: (freq.get(w, 0), w))[:RAREST])
    vocabulary = sorted({w for _, p, *_ in parts for w in p} & weighed)
    number = {w: i for i, w in enumerate(vocabulary)}
    idf = np.log((1 + total) / (1 + np.array([freq.get(w, 0) for w in vocabulary]))) + 0.1
    rows = []
    for _, p, *_ in parts:
        c, n = np.unique([number[w] for w in p if w in number], return_counts=True)
        w = n * idf[c]
        rows.append((c.tolist(), (w / np.linalg.norm(w)).tolist()))
    matrix = spark.createDataFrame(rows, "cols array<int>, weights array<double>")
    space = latent_space(matrix, len(vocabulary), rank)
    fold = (idf[:, None] * space).astype(np.float32)
    target = np.stack([np.array(w, np.float32) @ space[c] for c, w in rows])
    target /= np.maximum(np.linalg.norm(target, axis=1, keepdims=True), 1e-12)
    state = spark.sparkContext.broadcast((number, fold, target, parts))  # one benchmark block

    def search(batches):
        number, fold, target, parts = state.value
        find, none = number.get, repeat(-1)

        def windows(texts):
            """Latent sums of all runs of the texts, and where each text's runs start."""
            runs = [-(-len(words) // RUN) for words in texts]  # every text starts a new run
            bounds = [0, *np.cumsum(runs).tolist()]
            a = np.full(bounds[-1] * RUN, -1, np.int32)
            for words, b in zip(texts, bounds):
                a[b * RUN:b * RUN + len(words)] = np.fromiter(map(find, words, none), np.int32, len(words))
            sums = np.zeros((len(a) // RUN, fold.shape[1]), np.float32)
            for lo in range(0, len(sums), 2048):
                hi = min(len(sums), lo + 2048)
                part = a[lo * RUN:hi * RUN]
                at = np.flatnonzero(part >= 0)
                if len(at):
                    r = at // RUN
                    first = np.flatnonzero(np.r_[True, r[1:] != r[:-1]])
                    sums[lo + r[first]] = np.add.reduceat(fold[part[at]], first, axis=0)
            return sums, bounds

        def found_in(words, sums):
            """Items that the text holds: (cosine, share) of each.  ``sums``: of its runs."""
            hits = {}
            for lo in range(0, len(sums), RUNS):  # a bounded part of a long text at a time
                own = sums[lo:lo + RUNS + 2]
                wide = own.copy()  # a run and the two after it
                wide[:-1] += own[1:]
                wide[:-2] += own[2:]
                wide = wide[:RUNS]
                norm = np.linalg.norm(wide, axis=1, keepdims=True)
                cos = wide @ target.T / np.maximum(norm, 1e-6)
                at, near, known = -1, [], set()
                for r, j in np.argwhere(cos >= cosine).tolist():
                    k = lo + r
                    item, part, last, ahead, behind = parts[j]
                    if hits.get(item, (0, 0))[1] >= 1:
                        continue
                    if k != at:  # a passage may reach over the window's ends
                        at, near = k, words[max(0, (k - 1) * RUN):(k + 4) * RUN]
                        known = set(near)
                    # no more words can be in common than occur in both
                    if sum(map(known.__contains__, part)) < PARAPHRASE * len(part):
                        continue
                    beyond = None
                    if ahead or behind:
                        beyond = words[max(0, (k - 1) * RUN - math.ceil(STRETCH * ahead)):
                                       (k + 4) * RUN + math.ceil(STRETCH * behind)]
                    share = matches(part, last, near, beyond)
                    if share > hits.get(item, (0, 0))[1]:
                        hits[item] = (float(cos[r, j]), share)
            return sorted(hits.items(), key=lambda h: (h[0] is None, h[0] or 0))

        kind = pa.list_(pa.struct([("item_id", pa.int64()), ("cosine", pa.float64()), ("share", pa.float64())]))
        for whole in batches:
            for lo in range(0, whole.num_rows, ROWS):
                batch = whole.slice(lo, ROWS)
                texts = [words_of(t) for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
                before = batch.column(batch.schema.get_field_index("leaks")).to_pylist()
                sums, bounds = windows(texts)
                answer = [(old or []) + [{"item_id": i, "cosine": c, "share": s} for i, (c, s) in found_in(words, sums[b:e])]
                          for words, b, e, old in zip(texts, bounds, bounds[1:], before)]
                names = [n for n in batch.schema.names if n != "leaks"]
                yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(answer, kind)], names=[*names, "leaks"])

    source = out.select(*(c for c in out.columns if c != "leaks"), "leaks")
    return source.mapInArrow(tidy(search), source.schema)
