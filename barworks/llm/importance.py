"""Importance resampling towards a target by hashed n-gram features.

Features of a text are its runs of one to three words; each falls into one of
``BUCKETS`` buckets.  A bucket's gain is the log ratio of its smoothed share in the
target's texts to its share in all documents, a document's weight is the sum of the
gains of its features, and the documents with the highest weight plus Gumbel noise
(a number drawn from the id) are drawn: sampling without replacement with
probabilities in proportion to exp(weight / 1000).

Open-addressed table.  A task works on batches of about ``BATCH`` bytes.  Every n-gram of
a batch is a slice of one buffer (words joined by one space).  The slices' 64-bit xxhash
keys are computed by numpy and the n-grams interned in a table with linear probing: a
slot holds the first slice that claimed it, a rival goes on unless its key and its bytes
are those of that slice.  Slots carry a bucket (the crc32 is computed once for each slot)
and a count; the slot ids of the occurrences gather the gains.

Two passes over the documents: one adds up the slots' counts by bucket (``BUCKETS``
numbers for each task), one gathers the gains (``BUCKETS`` numbers sent to each task).
Ranks come from ``_ranks.positions``: no task sees all rows.

Defined cases: null and empty texts have no features, weight 0 and fewer words than any
positive minimum; a null id draws its noise from the empty text and comes last among equal
scores; repeated rows are ranked one after the other, in an unspecified order; an empty
table gives an empty result, an empty target gains that are all computed from T = 0; very
long texts are read in parts of at most ``BATCH`` bytes (or one word) that repeat the last
two words of the part before; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._ranks import positions
from ._util import batch_of, cut, rows_of

BUCKETS = 10_000
#: Words of the longest feature.
LONGEST = 3
MIN_WORDS = 20
#: Hundredths of the documents with at least MIN_WORDS words that are drawn.
PERCENT = 5
SEED = 42
#: Bytes of a batch.
BATCH = 1 << 20
_SPACE = 32
#: Bytes of words as they are compared; the others are spaces.
_LOWER = bytes(b | 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else _SPACE
               for b in range(256))
#: Slices below this length are hashed by numpy, longer ones by the library, one by one.
_SHORT = 32

# The five primes of the 64-bit xxhash.
_P1, _P2, _P3, _P4, _P5 = map(np.uint64, (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9,
                                          0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5))


def _crc_table() -> np.ndarray:
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> np.uint32(1)) ^ np.uint32(0xEDB88320), t >> np.uint32(1))
    return t


_CRC = _crc_table()


def _turn(x: np.ndarray, bits: int) -> np.ndarray:
    return (x << np.uint64(bits)) | (x >> np.uint64(64 - bits))


class Slices:
    """Slices of a buffer: their xxhash64 keys, crc32 values and equality, by numpy."""

    def __init__(self, data: np.ndarray):
        self.data = np.r_[data, np.zeros(8, np.uint8)]
        self.bytes = memoryview(self.data.tobytes())
        n = len(data)
        # the eight bytes from every place on as one number
        self.eight = np.zeros(n + 1, np.uint64)
        for k in range(8):
            self.eight[:n] |= self.data[k:k + n].astype(np.uint64) << np.uint64(8 * k)

    def _by_length(self, lens: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """Numbers of the short slices of each length; 0 stands for all others."""
        kind = np.where(lens < _SHORT, lens, 0).astype(np.uint8)
        order = np.argsort(kind, kind="stable")
        ends = np.cumsum(np.bincount(kind, minlength=_SHORT))
        for length, (a, b) in enumerate(zip(np.r_[0, ends[:-1]], ends)):
            if b > a:
                yield length, order[a:b]

    def keys(self, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint64)
        for n, which in self._by_length(lens):
            if n == 0:
                out[which] = [xxhash.xxh64_intdigest(self.bytes[s:s + m])
                              for s, m in zip(starts[which].tolist(), lens[which].tolist())]
                continue
            s = starts[which]
            h = np.full(len(s), _P5 + np.uint64(n), np.uint64)
            for at in range(0, n - 7, 8):
                h = _turn(h ^ _turn(self.eight[s + at] * _P2, 31) * _P1, 27) * _P1 + _P4
            at = n & ~7
            if n & 4:
                h = _turn(h ^ (self.eight[s + at] & np.uint64(0xFFFFFFFF)) * _P1, 23) * _P2 + _P3
                at += 4
            for at in range(at, n):
                h = _turn(h ^ self.data[s + at].astype(np.uint64) * _P5, 11) * _P1
            h = (h ^ (h >> np.uint64(33))) * _P2
            h = (h ^ (h >> np.uint64(29))) * _P3
            out[which] = h ^ (h >> np.uint64(32))
        return out

    def crc32(self, starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
        out = np.empty(len(starts), np.uint32)
        for n, which in self._by_length(lens):
            if n == 0:
                out[which] = [zlib.crc32(self.bytes[s:s + m])
                              for s, m in zip(starts[which].tolist(), lens[which].tolist())]
                continue
            s = starts[which]
            c = np.full(len(s), 0xFFFFFFFF, np.uint32)
            for at in range(n):
                c = _CRC[(c ^ self.data[s + at]) & np.uint32(255)] ^ (c >> np.uint32(8))
            out[which] = ~c
        return out

    def same(self, a: np.ndarray, b: np.ndarray, lens: np.ndarray) -> np.ndarray:
        """Whether the slices of the given lengths from ``a`` and from ``b`` hold the same bytes."""
        out = np.ones(len(a), bool)
        less = np.flatnonzero(lens < 8)
        off = self.eight[a[less]] ^ self.eight[b[less]]
        out[less] = (off << (np.uint64(64) - np.uint64(8) * lens[less].astype(np.uint64))) == 0
        some = np.flatnonzero((lens >= 8) & (lens < 256))
        at = 0
        while len(some):
            place = np.minimum(at, lens[some] - 8)
            out[some] &= self.eight[a[some] + place] == self.eight[b[some] + place]
            at += 8
            some = some[lens[some] > at]
        for i in np.flatnonzero(lens >= 256).tolist():
            n = int(lens[i])
            out[i] = self.bytes[a[i]:a[i] + n] == self.bytes[b[i]:b[i] + n]
        return out


def interned(slices: Slices, starts: np.ndarray, lens: np.ndarray,
             keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The table (a slice's number in each claimed slot, else -1) and the slot of each slice."""
    size = 1 << max(4, (2 * len(starts)).bit_length())
    holder = np.full(size, -1, np.int64)
    slot = (keys & np.uint64(size - 1)).astype(np.int64)
    open_ = np.arange(len(starts))
    while len(open_):
        at = slot[open_]
        free = holder[at] < 0
        holder[at[free]] = open_[free]  # of several claims one stays
        held = holder[at]
        same = (keys[held] == keys[open_]) & (lens[held] == lens[open_])
        check = np.flatnonzero(same & (held != open_))
        same[check] = slices.same(starts[held[check]], starts[open_[check]], lens[open_[check]])
        open_ = open_[~same]
        slot[open_] = (slot[open_] + 1) & (size - 1)
    return holder, slot


def parts_of(text: bytes, limit: int = BATCH) -> Iterator[tuple[bytes, int]]:
    """A text cut at spaces into parts, and how many words of each repeat the part before."""
    at, context = 0, []
    while True:
        end = len(text)
        if end - at > limit:
            end = text.rfind(b" ", at + 1, at + limit)
            if end < 0:
                end = text.find(b" ", at + limit)
            if end < 0:
                end = len(text)
        part = text[at:end]
        yield (b" ".join([*context, part]) if context else part), len(context)
        if end == len(text):
            return
        context = [*context, *part.rsplit(None, LONGEST - 1)[-(LONGEST - 1):]][-(LONGEST - 1):]
        at = end


def batches_of(rows: Iterator[tuple], text_at: int, limit: int = BATCH) -> Iterator[list[tuple]]:
    """(number of the row, part of its text, words that repeat) gathered into batches; and the rows' other values."""
    out, held = [], 0
    for row in rows:
        for part, repeated in parts_of((row[text_at] or "").encode().translate(_LOWER), limit):
            out.append((row, part, repeated))
            held += len(part) + 64
            if held >= limit:
                yield out
                out, held = [], 0
    if out:
        yield out


def features(parts: list[tuple]) -> tuple[Slices, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The n-grams of (_, text, repeated words): slices, starts, lengths, part numbers; new words by part."""
    at = np.cumsum([0] + [len(p) + 1 for _, p, _ in parts])
    raw = np.frombuffer(b" ".join(p for _, p, _ in parts) + b" ", np.uint8)
    word = raw != _SPACE
    edge = np.diff(np.r_[False, word, False].astype(np.int8))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    part = np.searchsorted(at, start, "right") - 1
    # one space after each word: every n-gram is a slice
    data = raw[word | np.r_[False, word[:-1]]]
    lens = end - start
    place = np.cumsum(lens + 1) - lens - 1
    n = len(start)
    first = np.searchsorted(part, np.arange(len(parts)))
    new = np.arange(n) - first[part] >= np.array([r for *_, r in parts], np.int64)[part]
    starts, sizes, of = [], [], []
    for k in range(min(LONGEST, n)):
        keep = np.flatnonzero((part[:n - k] == part[k:]) & new[k:])
        starts.append(place[keep])
        sizes.append(place[keep + k] + lens[keep + k] - place[keep])
        of.append(part[keep])
    empty = [np.zeros(0, np.int64)]
    return (Slices(data), np.concatenate(starts or empty), np.concatenate(sizes or empty),
            np.concatenate(of or empty), np.bincount(part[new], minlength=len(parts)))


def slots_of(parts: list[tuple], buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of the table's claimed slots: bucket and count; of the occurrences: slot and part; new words by part."""
    slices, starts, lens, part, words = features(parts)
    holder, slot = interned(slices, starts, lens, slices.keys(starts, lens))
    claimed = np.flatnonzero(holder >= 0)
    number = np.empty(len(holder), np.int64)
    number[claimed] = np.arange(len(claimed))
    first = holder[claimed]
    bucket = (slices.crc32(starts[first], lens[first]) % np.uint32(buckets)).astype(np.int64)
    slot = number[slot]
    return bucket, np.bincount(slot, minlength=len(claimed)), slot, part, words


def bucket_counts(texts: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """How many features of all texts (column text) fall into each bucket."""

    def count(batches):
        total = np.zeros(buckets, np.int64)
        for parts in batches_of(rows_of(batches), 0):
            bucket, n, *_ = slots_of(parts, buckets)
            total += np.bincount(bucket, weights=n, minlength=buckets).astype(np.int64)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.array(total[some], pa.int64())],
                                         names=["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    found = texts.select("text").mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in found.collect():  # one row for each bucket at most
        out[bucket] = n
    return out


def bucket_gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed share in the target over that in the corpus."""
    buckets = len(corpus)
    all_s, all_t = float(corpus.sum() + buckets), float(target.sum() + buckets)
    return np.array([math.floor(1000 * math.log((t + 1) * all_s / ((s + 1) * all_t)))
                     for s, t in zip(corpus.astype(np.float64).tolist(), target.astype(np.float64).tolist())], np.int64)


def noise(doc_id: int | None, seed: int = SEED) -> int:
    """Gumbel noise in thousandths, drawn from the id."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weighed(docs: DataFrame, gains: np.ndarray, seed: int = SEED) -> DataFrame:
    """doc_id, n_words, n_features, weight, score per row of ``docs`` (doc_id, text)."""
    schema = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_features", pa.int64()),
                        ("weight", pa.int64()), ("score", pa.int64())])

    def weigh(batches):
        row, sums, out = None, None, []
        for parts in batches_of(rows_of(batches), 1):
            bucket, _, slot, part, words = slots_of(parts, len(gains))
            n = np.bincount(part, minlength=len(parts))
            # a batch's sums are far below 2^53, so the doubles are exact
            gain = np.bincount(part, weights=gains[bucket][slot], minlength=len(parts)).astype(np.int64)
            for (r, *_), w, f, g in zip(parts, words.tolist(), n.tolist(), gain.tolist()):
                if r is not row:
                    if row is not None:
                        out.append((row[0], *sums, sums[2] + noise(row[0], seed)))
                    row, sums = r, [0, 0, 0]
                sums = [sums[0] + w, sums[1] + f, sums[2] + g]
            yield batch_of(schema, out)
            out = []
        if row is not None:
            yield batch_of(schema, [(row[0], *sums, sums[2] + noise(row[0], seed))])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        weigh, "doc_id long, n_words long, n_features long, weight long, score long")


def resampled(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS,
              buckets: int = BUCKETS, seed: int = SEED) -> DataFrame:
    """doc_id, n_features, weight, score, rank (1, 2, ... of the drawn ones, else null), n_words per row of ``docs``.

    ``docs``: doc_id, text; ``target``: text.  Of the documents with at least ``min_words``
    words, ``percent`` hundredths (rounded down) are drawn.
    """
    gains = bucket_gains(bucket_counts(docs, buckets), bucket_counts(target, buckets))
    rows = cut(weighed(docs, gains, seed))
    fit = F.col("n_words") >= min_words
    drawn = percent * rows.where(fit).count() // 100
    rows = rows.withColumns({"_fit": fit, "_row": F.monotonically_increasing_id()})
    placed = positions(rows, F.col("_fit").desc(), F.col("score").desc(), F.col("doc_id").asc_nulls_last(),
                       F.col("_row").asc())
    return placed.select("doc_id", "n_features", "weight", "score",
                         F.when(F.col("_fit") & (F.col("position") < drawn), F.col("position") + 1).alias("rank"),
                         "n_words")
