"""Repeated strings of ``SPAN`` bytes: blockwise suffix sorting with a difference cover.

Every byte covered by a ``SPAN``-byte string that also starts elsewhere (any document)
is removed.  Such a string is a suffix's prefix; suffixes that share it are neighbours
in sorted order.  Only suffixes that can have such a neighbour are sorted:

1. Windows (``SPAN`` bytes from each start) are dealt into *pieces* by their content:
   consecutive starts whose windows have the same smallest ``GRAM``-byte gram, at an
   offset in the same ``STEP`` wide range.  All windows of a piece hold its *core*, and
   equal windows lie in pieces with equal cores.  Cores and whole pieces are counted
   over the corpus by hash (``global_counts``).  A piece whose core occurs once has no
   repeated window; a piece that occurs twice is repeated in every window.
2. The pieces between, whose core occurs elsewhere in another piece, form the suffix
   buckets, one for each core; every distinct piece of the core goes there once.  A
   bucket's suffixes are sorted by their first ``COVER_MOD`` bytes; long ties are
   resolved by the ranks of a difference-cover sample: for any two positions some
   offset below ``COVER_MOD`` puts both on sampled positions, whose ranks were computed
   beforehand, so no comparison reads further text.  Buckets are taken one after the
   other, in batches of ``BATCH`` bytes, which bounds memory.
3. Neighbours that agree in ``SPAN`` bytes are repeated.

A core that more than ``hot`` positions share isn't sent to one task: the windows of its
pieces are counted one by one by hash instead, which spreads evenly.

Equality of counted strings is equality of 64-bit hashes.

Defined cases: null text counts as empty; texts shorter than ``SPAN`` bytes lose
nothing; repeated rows (also of one id) are separate texts and so remove each other;
ids may be null; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import answer_arrays, batch_of, block_number, chunks, cut, global_counts, mix64, pack, rows_of, tidy, unpack

SPAN, GRAM, STEP = 400, 256, 73
BLOCK, BATCH, PIECES_PER_TASK, HOT = 4 << 20, 1 << 20, 20_000, 10_000
#: A difference cover modulo COVER_MOD (every difference occurs).
COVER_MOD = 64
COVER = (1, 2, 3, 6, 15, 17, 35, 43, 60)
_BASE = 0x5851F42D4C957F2D


def _byte_values() -> np.ndarray:
    return mix64(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hashes:
    """Polynomial hashes of any substring of a text, from prefix sums."""

    def __init__(self, text: np.ndarray):
        n = len(text)
        self.back = _powers(pow(_BASE, -1, 1 << 64), n + 1)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_byte_values()[text] * _powers(_BASE, n + 1)[:n], out=self.sums[1:])

    def grams(self, k: int) -> np.ndarray:
        return mix64((self.sums[k:] - self.sums[:-k]) * self.back[:len(self.back) - k])

    def at(self, start: np.ndarray, length, salt: int) -> np.ndarray:
        length = np.asarray(length)
        h = (self.sums[start + length] - self.sums[start]) * self.back[start]
        return mix64(mix64(h + np.uint64(salt)) + length.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


class Pieces:
    """The pieces of a block: first and last start, where the core starts and its offset range, hashes of core and
    whole piece."""

    def __init__(self, data: bytes, lens: np.ndarray):
        self.text = np.frombuffer(data, np.uint8)
        self.lens = lens
        none = np.zeros(0, np.int64)
        self.lo = self.hi = self.middle = self.part = none
        self.core = self.whole = np.zeros(0, np.uint64)
        n = len(data)
        if n < SPAN:
            return
        h = Hashes(self.text)
        low = h.grams(GRAM)
        # the smallest gram of each window, the leftmost of equal ones
        low >>= np.uint64(32)
        low <<= np.uint64(32)
        low |= np.arange(len(low), dtype=np.uint64)
        width, k = SPAN - GRAM + 1, 1
        while 2 * k <= width:
            low = np.minimum(low[:-k], low[k:])
            k *= 2
        if width > k:
            low = np.minimum(low[:len(low) - (width - k)], low[width - k:])
        anchor = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
        ends = np.repeat(np.cumsum(lens), lens)
        start = np.flatnonzero(np.arange(SPAN, SPAN + len(anchor)) <= ends[:len(anchor)])
        if not len(start):
            return
        anchor = anchor[start]
        part = (anchor - start) // STEP
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (part[1:] != part[:-1])])
        self.lo, self.hi = start[new], start[np.r_[new[1:] - 1, len(start) - 1]]
        self.part = part = part[new]
        # all windows of the piece hold the bytes from here on
        self.middle = anchor[new] - STEP * part
        self.core = h.at(self.middle, SPAN - STEP + 1, 1) + part.astype(np.uint64)
        self.core = mix64(self.core) | np.uint64(1)
        self.whole = (h.at(self.lo, self.hi - self.lo + SPAN, 2) + part.astype(np.uint64)) & ~np.uint64(1)

    def keys(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct core (odd) and piece (even) hashes, their counts, and where each core and each piece is in them."""
        keys, at, counts = np.unique(np.concatenate([self.core, self.whole]), return_inverse=True, return_counts=True)
        return keys, counts, at

    def places(self, at: np.ndarray) -> bytes:
        """All that later steps need to know of the pieces, packed for ``Placed``."""
        return b"".join((len(x).to_bytes(8, "little") + x for x in (
            pack(np.diff(self.lo, prepend=0).astype(np.int32)), pack((self.hi - self.lo).astype(np.uint8)),
            pack((self.middle - self.lo).astype(np.uint8)), pack(self.part.astype(np.uint8)), pack(at.astype(np.int32)))))


class Placed:
    """A block and its pieces as the first step found them: the text isn't hashed again."""

    def __init__(self, lens: bytes, data: bytes, places: bytes):
        self.text, self.lens = unpack(data, np.uint8), unpack(lens, np.int64)
        parts, i = [], 0
        for kind in (np.int32, np.uint8, np.uint8, np.uint8, np.int32):
            n = int.from_bytes(places[i:i + 8], "little")
            parts.append(unpack(places[i + 8:i + 8 + n], kind).astype(np.int64))
            i += 8 + n
        steps, width, middle, self.part, self.at = parts
        self.lo = np.cumsum(steps)
        self.hi, self.middle = self.lo + width, self.lo + middle

    def bucket(self, j: int) -> int:
        """The same number for pieces of equal cores."""
        m = self.middle[j]
        return xxhash.xxh3_64_intdigest(self.text[m:m + SPAN - STEP + 1], seed=int(self.part[j])) - (1 << 63)

    def windows(self, pick: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and hashes of all windows of the picked pieces."""
        n = self.hi[pick] - self.lo[pick] + 1
        starts = np.repeat(self.lo[pick] - np.r_[0, np.cumsum(n)[:-1]], n) + np.arange(n.sum())
        return starts, Hashes(self.text).at(starts, SPAN, 3)

    def judged(self, answers, hot: int):
        """Of each piece: repeated throughout; open; to be sent for others; core too frequent."""
        totals, flags = answer_arrays(answers)
        c, w = self.at[:len(self.lo)], self.at[len(self.lo):]
        all_core, all_whole = totals[c], totals[w]
        repeated = all_whole > 1
        open_ = ~repeated & (all_core > 1)
        # one occurrence of a repeated piece stands for all, if its core has other pieces
        first = np.zeros(len(w), bool)
        first[np.unique(w, return_index=True)[1]] = True
        stands = repeated & first & ((flags[w] & 2) > 0) & (all_core > all_whole)
        return repeated, open_, stands, all_core > hot


def _offsets() -> np.ndarray:
    """For residues i, j: an offset that puts both on the cover."""
    out = np.zeros((COVER_MOD, COVER_MOD), np.int64)
    for a in reversed(COVER):
        for b in reversed(COVER):
            for i in range(COVER_MOD):
                out[i, (i + b - a) % COVER_MOD] = (a - i) % COVER_MOD
    return out


def repeated_suffixes(pieces: list[bytes]) -> list[np.ndarray]:
    """Of each piece, which window starts have an equal window elsewhere in ``pieces``.

    The suffixes that start a window are sorted (first bytes, then cover ranks).
    """
    lens = np.array([len(p) for p in pieces])
    gap = bytes(COVER_MOD + 8)
    text = gap.join(pieces) + gap
    begin = np.r_[0, np.cumsum(lens + len(gap))[:-1]]
    raw = np.frombuffer(text + bytes(8), np.uint8)
    word = np.zeros(len(text), np.uint64)  # 8 bytes from each position, first byte highest
    for i in range(8):
        got = np.frombuffer(raw, ">u8", (len(raw) - i) // 8, i).astype(np.uint64)
        word[i::8] = got[:len(word[i::8])]
    left = np.zeros(len(text), np.int64)  # bytes to the end of the piece
    for b, n in zip(begin, lens):
        left[b:b + n] = np.arange(n, 0, -1)
    # ranks of the sampled suffixes, by doubling
    cover = np.zeros(COVER_MOD, bool)
    cover[list(COVER)] = True
    sample = np.flatnonzero((left > 0) & cover[np.arange(len(text)) % COVER_MOD])
    heads = [word[sample + 8 * i] for i in range(COVER_MOD // 8)]
    keys = [np.minimum(left[sample], COVER_MOD)] + heads[::-1]
    order = np.lexsort(keys)
    step = np.zeros(len(sample), bool)
    step[0:1] = True
    for k in keys:
        step[1:] |= k[order][1:] != k[order][:-1]
    rank = np.zeros(len(text) + 1, np.int64)  # 0: past the end of a piece
    rank[sample[order]] = np.cumsum(step)
    reach = COVER_MOD
    while reach < lens.max():
        there = np.where(left[sample] > reach, rank[np.minimum(sample + reach, len(text))], 0)
        _, fresh = np.unique(rank[sample] * (len(sample) + 1) + there, return_inverse=True)
        rank[sample] = fresh + 1
        reach *= 2
    # the suffixes of the windows by their first bytes
    pos = np.flatnonzero(left >= SPAN)
    heads = [word[pos + 8 * i] for i in range(COVER_MOD // 8)]
    order = np.lexsort(heads[::-1])
    pos = pos[order]
    new = np.zeros(len(pos), bool)
    new[0:1] = True
    for k in heads:
        new[1:] |= k[order][1:] != k[order][:-1]
    group = np.cumsum(new) - 1
    # ties: three-way partition of all groups at once, compared by the cover ranks
    offset = _offsets()
    todo = np.arange(len(pos))
    while True:
        size = np.bincount(group[todo], minlength=len(pos) + 1)
        todo = todo[size[group[todo]] > 1]
        if not len(todo):
            break
        g = group[todo]
        first = np.flatnonzero(np.r_[True, g[1:] != g[:-1]])
        count = np.diff(np.r_[first, len(todo)])
        pivot = np.repeat(pos[todo[first + count // 2]], count)
        mine = pos[todo]
        d = offset[mine % COVER_MOD, pivot % COVER_MOD]
        side = np.sign(rank[mine + d] - rank[pivot + d])
        again = np.lexsort((side, g))
        pos[todo] = mine[again]
        side = side[again]
        # a group keeps its place, so the smaller, equal and larger ones get the numbers of their first places
        new = np.r_[True, (g[1:] != g[:-1]) | (side[1:] != side[:-1])]
        at = np.flatnonzero(new)
        group[todo] = np.repeat(todo[at], np.diff(np.r_[at, len(todo)]))
        todo = todo[side != 0]
    # neighbours that agree in SPAN bytes
    i = np.arange(len(pos) - 1)
    for k in range(0, SPAN, 8):
        i = i[word[pos[i] + k] == word[pos[i + 1] + k]]
    hit = np.zeros(len(text), bool)
    hit[pos[i]] = True
    hit[pos[i + 1]] = True
    return [hit[b:b + max(0, n - SPAN + 1)] for b, n in zip(begin, lens)]


def repeated_removed(docs: DataFrame, hot: int = HOT, text_column: str | None = None) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 per row of ``docs`` (doc_id, text).

    ``text_column``: also give the kept bytes, as a binary column of that name.
    """

    def to_blocks(batches):
        schema = pa.schema([("block_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()),
                            ("data", pa.binary()), ("places", pa.binary()), ("keys", pa.binary()),
                            ("counts", pa.binary()), ("n_keys", pa.int64())])
        for b, rows in enumerate(chunks(batches, limit=BLOCK)):
            texts = [(t or "").encode() for _, t in rows]
            lens = np.array([len(t) for t in texts], np.int64)
            data = b"".join(texts)
            pieces = Pieces(data, lens)
            keys, counts, at = pieces.keys()
            yield batch_of(schema, [(block_number(b), [i for i, _ in rows], pack(lens),
                                     pack(np.frombuffer(data, np.uint8)), pieces.places(at), pack(keys),
                                     pack(counts.astype(np.uint32)), len(keys))])

    blocks = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        tidy(to_blocks), "block_id long, ids array<long>, lens binary, data binary, places binary, keys binary, counts binary, "
                         "n_keys long")
    blocks = cut(blocks)
    answers, _ = global_counts(blocks, blocks.agg(F.sum("n_keys")).first()[0] or 0)
    answers = cut(answers)

    def to_bucket(batches):
        """Pieces for the suffix buckets; hashes of the windows of pieces whose core is too frequent for one."""
        schema = pa.schema([("core", pa.int64()), ("block_id", pa.int64()), ("lo", pa.int32()),
                            ("open", pa.bool_()), ("piece", pa.binary()), ("keys", pa.binary()),
                            ("counts", pa.binary()), ("n_keys", pa.int64())])
        for bid, lens, data, places, got in rows_of(batches):
            p = Placed(lens, data, places)
            _, open_, stands, much = p.judged(got, hot)
            send = np.flatnonzero((open_ | stands) & ~much)
            for i in range(0, len(send), 4096):
                yield batch_of(schema, [(p.bucket(j), bid, int(p.lo[j]), bool(open_[j]),
                                         p.text[p.lo[j]:p.hi[j] + SPAN].tobytes(), None, None, None)
                                        for j in send[i:i + 4096]])
            pick = np.flatnonzero((open_ | stands) & much)
            if len(pick):
                k, c = np.unique(p.windows(pick)[1], return_counts=True)
                yield batch_of(schema, [(None, bid, None, None, None, pack(k), pack(c.astype(np.uint32)), len(k))])

    def sort_bucket(table: pa.Table) -> pa.Table:
        schema = pa.schema([("block_id", pa.int64()), ("lo", pa.int32()), ("bits", pa.binary())])
        rows = sorted(rows_of(table.select(["core", "block_id", "lo", "open", "piece"]).to_batches()))
        out, batch, held = [], [], 0

        def flush():
            for r, hit in zip(batch, repeated_suffixes([r[4] for r in batch])):
                if r[3] and hit.any():
                    out.append((r[1], r[2], np.packbits(hit).tobytes()))

        for k, r in enumerate(rows):
            if held >= BATCH and r[0] != rows[k - 1][0]:
                flush()
                batch, held = [], 0
            batch.append(r)
            held += len(r[4])
        if batch:
            flush()
        return pa.Table.from_batches([batch_of(schema, out)])

    with_counts = blocks.join(answers, "block_id", "left")
    sent = cut(with_counts.select("block_id", "lens", "data", "places", "answers").mapInArrow(
        tidy(to_bucket), "core long, block_id long, lo int, open boolean, piece binary, keys binary, counts binary, "
                   "n_keys long"))
    windows = sent.where("keys is not null").select("block_id", "keys", "counts", "n_keys")
    single, _ = global_counts(windows, windows.agg(F.sum("n_keys")).first()[0] or 0)
    sent = sent.where("piece is not null").select("core", "block_id", "lo", "open", "piece")
    tasks = max(1, -(-sent.count() // PIECES_PER_TASK))
    found = (sent.withColumn("bucket", F.pmod(F.xxhash64("core"), F.lit(tasks)))
             .groupBy("bucket").applyInArrow(tidy(sort_bucket), "block_id long, lo int, bits binary")
             .groupBy("block_id").agg(F.collect_list(F.struct("lo", "bits")).alias("found")))
    single = single.withColumnRenamed("answers", "single")

    def finish(batches):
        fields = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
                  ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
        schema = pa.schema(fields + [(text_column, pa.binary())] * bool(text_column))
        for ids, lens, data, places, got, found, single in rows_of(batches):
            p = Placed(lens, data, places)
            repeated, open_, stands, much = p.judged(got, hot)
            n = len(p.text)
            edge = np.zeros(n + 1, np.int64)
            np.add.at(edge, p.lo[repeated], 1)
            np.add.at(edge, p.hi[repeated] + SPAN, -1)
            starts = [np.flatnonzero(np.unpackbits(np.frombuffer(f["bits"], np.uint8))) + f["lo"] for f in found or []]
            pick = np.flatnonzero((open_ | stands) & much)
            if len(pick):
                s, h = p.windows(pick)
                starts.append(s[answer_arrays(single)[0][np.searchsorted(np.unique(h), h)] > 1])
            for s in starts:
                np.add.at(edge, s, 1)
                np.add.at(edge, s + SPAN, -1)
            gone = np.cumsum(edge[:n]) > 0
            out, at = [], 0
            for doc_id, m in zip(ids, p.lens.tolist()):
                g = gone[at:at + m]
                text = p.text[at:at + m]
                kept = (text[~g] if g.any() else text).tobytes()
                spans = int(g[:1].sum() + (g[1:] & ~g[:-1]).sum())
                out.append((doc_id, m, m - len(kept), spans, hashlib.sha256(kept).hexdigest())
                           + (kept, ) * bool(text_column))
                at += m
            yield batch_of(schema, out)

    result = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return (with_counts.join(found, "block_id", "left").join(single, "block_id", "left")
            .select("ids", "lens", "data", "places", "answers", "found", "single")
            .mapInArrow(tidy(finish), result + (f", {text_column} binary" if text_column else "")))
