"""Token counts by heap-and-linked-list byte-pair merging.

A word starts as one symbol per byte (the last one carries the end-of-word mark).
All adjacent pairs that have a merge rank lie in a heap; the lowest rank (leftmost
on ties) is popped, its two symbols become one in a linked list, and the pairs with
the new neighbours are pushed.  The count is symbols minus merges: no identifiers
are made.  Words never cross white space, so the count of a white-space-free run is
kept in a bounded per-task table and whole texts are sums over their runs.

Defined cases: a null text counts as empty (0 bytes, 0 tokens); the marker strings
of the vocabulary count one token each wherever they stand; rows are never merged,
so repeated rows and null ids come back as they are; of very long texts one white-space-free
run is merged at a time; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from ._util import batch_of, chunks

OVER = 2048
_OUT = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_tokens", pa.int64()),
                  ("over_limit", pa.bool_())])


def byte_symbols() -> dict[int, str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(rest)}


class PairCounter:
    """Counts the tokens of texts under one ``tokenizers`` BPE file with word ends."""

    def __init__(self, path: str, kept: int = 400_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.rank = {tuple(m if isinstance(m, list) else m.split(" ")): i
                     for i, m in enumerate(spec["model"]["merges"])}
        self.end = spec["model"]["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.words = regex.compile(pattern).findall
        marks = [t["content"] for t in spec["added_tokens"]]
        self.marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")")
        self.first = {m[0] for m in marks}
        self.symbol = byte_symbols()
        self.kept, self.runs, self.known = kept, {}, {}
        # white space as the vocabulary's own patterns see it
        self.odd = re.compile("[\x1c-\x1f]").search
        self.gaps = regex.compile(r"[\p{White_Space}]+").split

    def merges(self, word: str) -> int:
        """Tokens of one word: symbols minus merges."""
        sym = [self.symbol[b] for b in word.encode()]
        n = len(sym)
        if n < 2:
            return n
        sym[-1] += self.end
        left, right = list(range(-1, n - 1)), [*range(1, n), -1]
        rank, heap = self.rank, []
        for i in range(n - 1):
            r = rank.get((sym[i], sym[i + 1]))
            if r is not None:
                heap.append((r, i))
        heapq.heapify(heap)
        merged = 0
        while heap:
            r, i = heapq.heappop(heap)
            j = right[i]
            if sym[i] is None or j < 0 or rank.get((sym[i], sym[j])) != r:
                continue  # one of the two has been merged meanwhile
            sym[i] += sym[j]
            sym[j] = None
            k = right[i] = right[j]
            merged += 1
            if k >= 0:
                left[k] = i
                if (r := rank.get((sym[i], sym[k]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (h := left[i]) >= 0 and (r := rank.get((sym[h], sym[i]))) is not None:
                heapq.heappush(heap, (r, h))
        return n - merged

    def word(self, word: str) -> int:
        """``merges`` through a bounded table."""
        n = self.known.get(word)
        if n is None:
            n = self.merges(word)
            if len(self.known) >= self.kept:
                self.known.clear()
            if len(word) <= 64:
                self.known[word] = n
        return n

    def run(self, run: str) -> int:
        """Tokens of a run without white space."""
        total = 0
        for part in self.marks.split(run) if self.first & set(run) else (run,):
            if self.marks.fullmatch(part):
                total += 1
            elif part:
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                total += sum(map(self.word, self.words(part)))
        return total

    def count(self, text: str) -> int:
        runs = self.gaps(text) if self.odd(text) else text.split()
        known, total = self.runs, 0
        for r in runs:
            c = known.get(r)
            if c is None:
                c = self.run(r)
                if len(known) >= self.kept:
                    known.clear()
                if len(r) <= 64:
                    known[r] = c
            total += c
        return total


def token_counts(docs: DataFrame, path: str, over: int = OVER) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = PairCounter(path)
        for rows in chunks(batches):
            out = []
            for doc_id, text in rows:
                n = counter.count(text or "")
                out.append((doc_id, len((text or "").encode()), n, n > over))
            yield batch_of(_OUT, out)

    return docs.select(docs["doc_id"].cast("long"), "text").mapInArrow(
        count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
