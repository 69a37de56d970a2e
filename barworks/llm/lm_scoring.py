"""Language-model scores by a weighted backoff automaton.

Model: word bigrams over add-half unigrams, learnt from the training documents.
States are the root (no known context) and one per training word; the state of a
word ``u`` has an arc for each word seen after it, with weight

    log10((1 - f(u)) * c(u, w) / c(u) + f(u) * p(w)),

and a failure arc to the root with weight ``log10 f(u)``; the root's arcs have the
unigram weights ``log10 p(w)``, ``p(w) = (c(w) + 0.5) / (N + 0.5 * (V + 1))``, which
leave mass for one unknown word.  All weights leaving a state through its arcs and
failure arc sum to one.  ``f(u) = (1 + c(u)) ** -fall``: ``fall`` is chosen so that the
failures this expects over all training tokens are as many as the bigrams that occur
once, the leave-one-out count of tokens whose bigram is new.

A text is read once from left to right: the state is the last word (the end mark
before the first); an arc adds its weight; without one, the failure arc's weight is
added and the root's arc taken; an unknown word leads to the root.

Distribution.  Documents are packed into blocks of tokens.  Word counts and bigram
counts are added up over all blocks by ``global_counts``; each block gets back the
counts of its own words and bigrams, that is, the part of the automaton its texts can
reach, and its texts are traversed there.  Keys are 64-bit hashes of words and pairs.

Defined cases: null text counts as empty (the end mark alone); the crc32 of a null id
is that of the empty text; without training documents N and V are 0 and all tokens
unknown; repeated rows are separate documents; a text longer than a block is a block by
itself, so memory is bounded by the longest text; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from itertools import count

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._util import answer_arrays, batch_of, block_number, chunks, cut, global_counts, mix64, pack, rows_of, unpack

FOLDS, HELD_OUT = 5, 1
#: Characters of a block.
BLOCK = 6 << 20
END = b""


def held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % FOLDS == HELD_OUT


def tokenised(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens (as ranks of their hashes), tokens per text, ascending word hashes.

    Lower-casing and splitting bytes touches exactly A-Z and ASCII white space.
    """
    number = defaultdict(count().__next__)
    number[END]
    parts, lens = [], []
    for t in texts:
        words = (t or "").encode().lower().split()
        words.append(END)
        parts.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
        lens.append(len(words))
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, number), np.uint64, len(number))
    order = np.argsort(h)
    rank = np.empty(len(h), np.int32)
    rank[order] = np.arange(len(h), dtype=np.int32)
    return rank[np.concatenate(parts)], np.array(lens, np.int32), h[order]


def pairs_of(tokens: np.ndarray, hashes: np.ndarray) -> tuple:
    """Distinct bigrams of a block by ascending hash: first, second, hash; and each token's bigram."""
    prev = np.empty(len(tokens), np.int64)
    # all texts end with the mark, so it precedes each first token
    prev[0] = np.searchsorted(hashes, np.uint64(xxhash.xxh3_64_intdigest(END)))
    prev[1:] = tokens[:-1]
    pair, at = np.unique(prev * len(hashes) + tokens, return_inverse=True)
    u, w = pair // len(hashes), pair % len(hashes)
    key = mix64(hashes[u] ^ mix64(hashes[w] + np.uint64(0x9E3779B9)))
    order = np.argsort(key, kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return u[order], w[order], key[order], place[at]


def failure_fall(words: list[tuple[int, int]], once: int) -> float:
    """The exponent of ``f``: (distinct words, their tokens) by class, bigrams that occur once."""
    low, high = 0.01, 5.0
    for _ in range(60):
        mid = (low + high) / 2
        if sum(total * (1 + total / n) ** -mid for n, total in words) > once:
            low = mid
        else:
            high = mid
    return low


def lm_scores(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``."""

    def to_blocks(batches):
        schema = pa.schema([("block_id", pa.int64()), ("ids", pa.list_(pa.int64())), ("lens", pa.binary()),
                            ("tokens", pa.binary()), ("keys", pa.binary()), ("counts", pa.binary()),
                            ("all_counts", pa.binary()), ("n_train", pa.int64())])
        for n, rows in enumerate(chunks(batches, limit=BLOCK)):
            tokens, lens, hashes = tokenised([t for _, t in rows])
            train = np.repeat([not held_out(i) for i, _ in rows], lens)
            counts = np.bincount(tokens[train], minlength=len(hashes)).astype(np.uint32)
            every = np.bincount(tokens, minlength=len(hashes)).astype(np.uint32)
            rank = np.empty(len(hashes), np.int32)  # frequent words get small numbers, which pack well
            rank[np.argsort(every, kind="stable")[::-1]] = np.arange(len(hashes), dtype=np.int32)
            yield batch_of(schema, [(block_number(n), [i for i, _ in rows], pack(lens), pack(rank[tokens]),
                                     pack(hashes), pack(counts), pack(every), int(train.sum()))])

    def load(ids, lens, tokens, keys, every):
        word = np.argsort(unpack(every, np.uint32), kind="stable")[::-1]
        held = np.array([held_out(i) for i in ids], bool)
        return unpack(lens, np.int32), word[unpack(tokens, np.int32)], unpack(keys, np.uint64), held

    blocks = cut(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        to_blocks, "block_id long, ids array<long>, lens binary, tokens binary, keys binary, counts binary, "
                   "all_counts binary, n_train long"))
    # every text is in one block, so a block has no more distinct words or pairs than tokens
    n_train, n_bytes = blocks.agg(F.sum("n_train"), F.sum(F.octet_length("tokens"))).first()
    n_train = n_train or 0
    words, word_classes = global_counts(blocks, (n_bytes or 0) // 8)

    def to_pairs(batches):
        schema = pa.schema([("block_id", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
        for bid, *row in rows_of(batches):
            lens, tokens, hashes, held = load(*row)
            _, _, key, at = pairs_of(tokens, hashes)
            counts = np.bincount(at[np.repeat(~held, lens)], minlength=len(key))
            yield batch_of(schema, [(bid, pack(key), pack(counts.astype(np.uint32)))])

    text = ["ids", "lens", "tokens", "keys", "all_counts"]
    pairs, pair_classes = global_counts(blocks.select("block_id", *text).mapInArrow(
        to_pairs, "block_id long, keys binary, counts binary"), (n_bytes or 0) // 3)
    known = [(r["keys"], r["total"]) for r in word_classes.orderBy("class").collect()]
    once = pair_classes.where("class = 1").agg(F.sum("keys")).first()[0] or 0
    fall = failure_fall(known, once)
    floor = n_train + 0.5 * (sum(n for n, _ in known) + 1)

    def score(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                            ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                            ("score", pa.float64())])
        for ids, *row, for_words, for_pairs in rows_of(batches):
            lens, tokens, hashes, held = load(ids, *row)
            c = answer_arrays(for_words)[0].astype(np.float64)
            seen = answer_arrays(for_pairs)[0].astype(np.float64)
            u, w, _, at = pairs_of(tokens, hashes)
            unigram = (c + 0.5) / floor
            # arcs of the automaton's part that this block reaches: from a word's state, else from the root
            f = (1 + c[u]) ** -fall
            weight = np.log10(np.where(c[u] > 0, (1 - f) * seen / np.maximum(c[u], 1) + f * unigram[w], unigram[w]))
            starts = np.r_[0, np.cumsum(lens)[:-1]]
            base = np.add.reduceat(np.log10(unigram)[tokens], starts)
            n_known = np.add.reduceat((c[tokens] > 0).astype(np.int64), starts)
            model = np.add.reduceat(weight[at], starts)
            yield batch_of(schema, [(i, bool(h), int(n), int(k), n_train, float(b), float(m)) for i, h, n, k, b, m
                                    in zip(ids, held, lens, n_known, base, model)])

    # the answers meet first, so that the blocks are moved once; the number of parts is given, as a
    # part made from several small ones would hold many blocks
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    answers = words.withColumnRenamed("answers", "for_words").join(
        pairs.withColumnRenamed("answers", "for_pairs"), "block_id").repartition(parts, "block_id")
    return blocks.select("block_id", *text).repartition(parts, "block_id").join(answers, "block_id").select(
        *text, "for_words", "for_pairs").mapInArrow(
        score, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
               "base_score double, score double")
