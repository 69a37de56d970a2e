"""SentencePiece encoding by suffix-array matching, and decoding.

A model of the BPE kind with byte fallback is given (its pieces and scores); the text is
what the model's own library sees: a space in front, spaces as the word mark.  No piece
has a mark after another character, so texts are cut before each run of marks, and a
batch is indexed by its distinct segments:

1. The segments are joined to one text, and its suffixes are sorted.
2. Every piece is looked up by binary search; the suffixes in its range are the places
   where it occurs.  Each place is an edge of that segment's lattice.
3. The edges are sorted by where they end, and relaxed in that order, for all segments
   of the batch at once.  At every position exactly one last piece is right: an edge is
   accepted when byte-pair merging would keep the boundary between it and the piece that
   was accepted where it starts.  (Pieces that merging can't build are left out;
   characters without a piece are edges of one byte each.)
4. The accepted edges are followed back from the segments' ends.

Whether two pieces may stand side by side is decided by undoing merges from the later one
down: the boundary falls when the parts that touch it at some moment merge earlier.

Decoding joins the pieces' bytes, turns marks to spaces and drops the space in front.

Defined cases: null text counts as empty and has no pieces; the mark's own character in
a text is read as a space (as the library does), so it decodes as a space; repeated rows
and null ids are encoded like any other; parts of a batch are cut between rows only, so
memory is bounded by the longest text (some hundred bytes for each of its bytes); other
columns are kept.
"""

from __future__ import annotations

import heapq
import re
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from ._util import tidy

MARK = "▁"
#: Bytes of text whose segments are indexed together.
BLOCK = 1 << 20
_SEGMENTS = re.compile(" *[^ ]+| +").findall
_NEVER = np.int64(1) << 40


class Model:
    """Pieces of a model in merge order (single characters and bytes first), and how each is merged."""

    def __init__(self, path: str):
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        words = [i for i in range(sp.get_piece_size())
                 if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        text = {i: sp.id_to_piece(i).replace(MARK, " ") for i in words}
        if any(re.search("[^ ] ", t) for t in text.values()):
            raise ValueError("a piece has a word mark after another character")
        single = [i for i in words if len(text[i]) == 1]
        longer = sorted((i for i in words if len(text[i]) > 1), key=lambda i: (-sp.get_score(i), i))
        of_text = {text[i]: k for k, i in enumerate([*single, *longer], 256)}
        self.split: dict[int, tuple[int, int]] = {}
        kept = set(range(256, 256 + len(single)))
        for k, i in enumerate(longer, 256 + len(single)):
            last = self._merged(text[i], of_text)
            if last:
                self.split[k] = last
                kept.add(k)
        #: by own number: bytes 0-255, characters, merged pieces
        n = 256 + len(words)
        self.left, self.right = np.arange(n), np.arange(n)
        for k, (a, b) in self.split.items():
            self.left[k], self.right[k] = a, b
        pair = sorted((a * n + b, k) for k, (a, b) in self.split.items())
        self.pair_key = np.array([p for p, _ in pair] + [1 << 62], np.int64)
        self.pair_to = np.array([k for _, k in pair] + [0], np.int64)
        self.size = n
        self.ids = np.zeros(n, np.int32)
        self.bytes: list[bytes] = [bytes([b]) for b in range(256)]
        for b in range(256):
            self.ids[b] = sp.piece_to_id(f"<0x{b:02X}>")
        for k, i in enumerate([*single, *longer], 256):
            self.ids[k] = i
            self.bytes.append(text[i].encode())
        self.usable = np.array(sorted(kept))
        self.first_merged = 256 + len(single)
        #: by the model's number, for decoding
        self.shown = {int(i): b for i, b in zip(self.ids, self.bytes)}

    @staticmethod
    def _merged(text: str, of_text: dict[str, int]) -> tuple[int, int] | None:
        """The last merge that builds ``text``, or None if merging ends in other pieces."""
        parts: list[str | None] = list(text)
        after = [*range(1, len(parts)), -1]
        before = list(range(-1, len(parts) - 1))
        heap = [(of_text[x], i) for i in range(len(parts) - 1) if (x := text[i:i + 2]) in of_text]
        heapq.heapify(heap)
        last = None
        while heap:
            k, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j < 0 or of_text.get(parts[i] + parts[j]) != k:
                continue
            last = (of_text.get(parts[i], -1), of_text.get(parts[j], -1))
            parts[i] += parts[j]
            parts[j] = None
            after[i] = n = after[j]
            if n >= 0:
                before[n] = i
                if (x := of_text.get(parts[i] + parts[n])) is not None:
                    heapq.heappush(heap, (x, i))
            if (h := before[i]) >= 0 and (x := of_text.get(parts[h] + parts[i])) is not None:
                heapq.heappush(heap, (x, h))
        return last if parts[0] == text and last and min(last) >= 0 else None

    def side_by_side(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Whether merging keeps the boundary between pieces ``a`` and ``b``."""
        ok = np.ones(len(a), bool)
        at = np.arange(len(a))
        a, b = a.copy(), b.copy()
        limit = np.full(len(a), _NEVER)
        while len(at):
            key = a * self.size + b
            where = np.searchsorted(self.pair_key, key)
            merged = np.where(self.pair_key[where] == key, self.pair_to[where], _NEVER)
            broken = merged < limit
            ok[at[broken]] = False
            # undo the later merge of the two; when that side is a character, the other one
            undo_a = (a > b) & (self.right[a] != a)
            undo_b = ~undo_a & (self.left[b] != b)
            undo_a |= ~undo_a & ~undo_b & (self.right[a] != a)
            live = ~broken & (undo_a | undo_b)
            limit = np.where(undo_a, a, np.where(undo_b, b + 1, limit))
            a, b = np.where(undo_a, self.right[a], a), np.where(undo_b & ~undo_a, self.left[b], b)
            at, a, b, limit = at[live], a[live], b[live], limit[live]
        return ok


def segment_pieces(segments: list[bytes], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Pieces (own numbers) of all segments in turn, and how many each segment has."""
    text = b"\xff".join(segments) + b"\xff"
    n = len(text)
    begin = np.r_[0, np.cumsum([len(s) + 1 for s in segments])[:-1]].astype(np.int64)
    lens = np.array([len(s) for s in segments], np.int64)
    t = np.frombuffer(text, np.uint8)
    of = np.repeat(np.arange(len(segments)), lens + 1)
    # the suffix array, as deep as the longest piece
    depth = max(len(model.bytes[k]) for k in model.usable)
    padded = np.frombuffer(text + bytes(depth), np.uint8)
    prefix = np.lib.stride_tricks.as_strided(padded, (n, depth), (1, 1))
    words = [np.ascontiguousarray(prefix[:, k:k + 8]) for k in range(0, depth, 8)]
    words = [np.pad(w, ((0, 0), (0, 8 - w.shape[1]))).view(">u8").reshape(-1).astype(np.uint64) for w in words]
    suffixes = np.argsort(words[0])
    head = words[0][suffixes]
    same = head[1:] == head[:-1]
    # ties that go on after eight bytes are sorted by the rest (a suffix that ends there needs no order)
    ended = (prefix[:, :8] == 0xFF).any(1)[suffixes]
    slots = np.flatnonzero((np.r_[False, same] | np.r_[same, False]) & ~ended)
    tied = suffixes[slots]
    suffixes[slots] = tied[np.lexsort([*(w[tied] for w in words[:0:-1]), head[slots]])]
    del words, head, ended
    # every piece's occurrences are a range of it
    ordered = np.ascontiguousarray(prefix[suffixes]).view(f"S{depth}").reshape(-1)
    pieces = [model.bytes[k] for k in model.usable]
    low = np.searchsorted(ordered, np.array(pieces, f"S{depth}"))
    high = np.searchsorted(ordered, np.array([p + b"\xff" * (depth - len(p)) for p in pieces], f"S{depth}"), "right")
    del ordered
    found = high - low
    kind = np.repeat(model.usable.astype(np.int32), found)
    start = suffixes[np.repeat(low - np.r_[0, np.cumsum(found)[:-1]], found) + np.arange(found.sum())].astype(np.int32)
    size = np.array([len(b) for b in model.bytes], np.int32)
    # characters without a piece of their own: their bytes
    alone = (t & 0xC0 != 0x80) & (t != 0xFF)
    own = kind < model.first_merged
    alone[start[own]] = False
    leads = np.flatnonzero((t & 0xC0) != 0x80)
    by_byte = np.flatnonzero(np.repeat(alone[leads], np.diff(np.r_[leads, n])) & (t != 0xFF))
    kind = np.concatenate([kind, t[by_byte].astype(np.int32)])
    start = np.concatenate([start, by_byte.astype(np.int32)])
    # edges by the offset of their end in the segment
    end = start + size[kind]
    offset = (np.arange(n) - begin[of]).astype(np.int32)[start] + size[kind]
    small = offset.astype(np.uint16) if lens.max(initial=0) < 1 << 16 else offset
    order = np.argsort(small, kind="stable").astype(np.int32)
    del small, end
    kind, start, offset = kind[order], start[order], offset[order]
    del order
    last = np.full(n + 1, -1, np.int32)
    rounds = np.flatnonzero(np.r_[True, offset[1:] != offset[:-1], True]) if len(offset) else np.zeros(1, int)
    first = np.zeros(n + 1, bool)
    first[begin] = True
    for lo, hi in zip(rounds[:-1], rounds[1:]):
        k, s = kind[lo:hi], start[lo:hi]
        e = s + size[k]
        good = first[s]
        check = np.flatnonzero(~good & (last[s] >= 0))
        if len(check):
            key, back = np.unique(last[s[check]].astype(np.int64) * model.size + k[check], return_inverse=True)
            good[check] = model.side_by_side(key // model.size, key % model.size)[back]
        last[e[good]] = k[good]
    # back from the ends
    here = begin + lens
    chosen = np.zeros(n + 1, bool)
    live = np.flatnonzero(lens > 0)
    here = here[live]
    stop = begin[live]
    while len(here):
        chosen[here] = True
        here = here - size[last[here]]
        go = here > stop
        here, stop = here[go], stop[go]
    at = np.flatnonzero(chosen)
    counts = np.bincount(of[at - 1], minlength=len(segments)) if len(at) else np.zeros(len(segments), int)
    return last[at], counts


def encode_batch(texts: list[str | None], model: Model) -> tuple[np.ndarray, np.ndarray]:
    """Ids of all texts in turn, and how many each text has."""
    number = defaultdict(count().__next__)
    parts, n_parts = [], []
    for t in texts:
        got = _SEGMENTS(" " + t.replace(MARK, " ")) if t else []
        parts.append(np.fromiter(map(number.__getitem__, got), np.int64, len(got)))
        n_parts.append(len(got))
    if not number:
        return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
    pieces, counts = segment_pieces([s.encode() for s in number], model)
    parts = np.concatenate(parts)
    size = counts[parts]
    first = np.r_[0, np.cumsum(counts)[:-1]][parts]
    ends = np.cumsum(size)
    ids = model.ids[pieces[np.repeat(first - (ends - size), size) + np.arange(size.sum())]]
    per_text = np.add.reduceat(np.r_[size, 0], np.r_[0, np.cumsum(n_parts)[:-1]]) * (np.array(n_parts) > 0)
    return ids, per_text


def decode(ids, model: Model) -> str:
    """The text of a list of ids."""
    data = b"".join(map(model.shown.__getitem__, ids))
    return data[1:].decode("utf-8", "replace")


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """``docs`` with n_pieces, ids and round_trip (decoding gives the text, marks read as spaces)."""
    added = ("n_pieces", "ids", "round_trip")
    source = docs.drop(*(c for c in docs.columns if c in added))
    schema = T.StructType([*source.schema, T.StructField("n_pieces", T.LongType()),
                           T.StructField("ids", T.ArrayType(T.IntegerType())),
                           T.StructField("round_trip", T.BooleanType())])
    m = Model(path)  # travels with the function; as large as the vocabulary

    def add(batches):
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("text"))
            held = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            # rows in parts of bounded text
            cuts = np.flatnonzero(np.diff(held // BLOCK)) + 1
            for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
                part = column.slice(lo, hi - lo).to_pylist()
                ids, sizes = encode_batch(part, m)
                ends = np.r_[0, np.cumsum(sizes)]
                whole = ids.tolist()
                right = [decode(whole[a:b], m) == (t or "").replace(MARK, " ")
                         for t, a, b in zip(part, ends, ends[1:])]
                listed = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [*batch.slice(lo, hi - lo).columns, pa.array(sizes, pa.int64()), listed, pa.array(right)],
                    names=[*batch.schema.names, *added])

    return source.mapInArrow(tidy(add), schema)
