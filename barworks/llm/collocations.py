"""Collocations: frequent phrases whose words stand together more often than their parts foretell.

Per language, phrases of 2 to ``LONGEST`` words that occur at least ``LEAST`` times within
pieces (texts split at punctuation and line ends).  A phrase is scored by its weakest cut:
the least floor(1000 * a * n / (l * r)) over its cuts into a left and a right part.

Fingerprints.  Documents are packed into blocks of numbered words.  A word's fingerprint is
a polynomial of its bytes and an n-gram's a polynomial of its words' fingerprints, modulo
2^64: prefix sums of value * base^place give each n-gram's polynomial as a difference,
shifted back by the inverse power (Rabin-Karp, all places at once).  A block sends each
distinct fingerprint once with its count; ``global_counts`` adds the counts up and answers
the blocks that asked, so the pointer of a fingerprint is the block and its first place there.

Levels.  A phrase can only be frequent when the phrases inside it are, so the fingerprints
of longer n-grams are made and sent only where the shorter ones turned out frequent.  A sum
over colliding fingerprints is never too small, so nothing frequent is lost.

Verification.  Only n-grams with a frequent fingerprint become text.  Within a block all
occurrences of a fingerprint are compared, word by word, with the first one; the blocks send
their phrases, packed by ranges of fingerprints, and each range adds the counts up once more
by the text itself.  So counts are exact whatever collides, and no other text is written.

Defined cases: null text counts as empty, a null language as ``und``; repeated rows count
again; an empty table, or one without frequent phrases, gives an empty result; very long
texts are cut into parts of at most ``BLOCK`` bytes (or one word) that repeat the last words
of the part before, whose phrases are counted once; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._util import answer_arrays, batch_of, block_number, cut, global_counts, mix64, pack, rows_of, unpack

LONGEST = 5
#: Occurrences of a phrase that count as frequent.
LEAST = 100
#: Rows of each language.
LEAD = 2000
#: Longer phrases with this percentage of a phrase's occurrences take its place.
COVER = 100
UNKNOWN = "und"
#: Bytes of a block.
BLOCK = 4 << 20
#: Phrase lengths whose fingerprints are counted in one round.
ROUNDS = ((1, 2), (3, 4, 5))
#: Words of the corpus for each range of fingerprints whose phrases one task adds up.
WORDS_PER_RANGE = 1 << 21

#: The texts' bytes: letters in lower case, a line end for each splitting character, spaces.
_BYTES = bytes(b | 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b
               for b in range(256))
_BASE, _WORD_BASE = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93
_PACKED = ("block_id long, n_words long, langs array<string>, words binary, ids binary, lens binary, "
           "skips binary, of binary")
_COLUMNS = [f.split()[0] for f in _PACKED.split(", ")]


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i modulo 2^64 for i below n."""
    def up(x: int) -> np.ndarray:
        a = np.full(n, x, np.uint64)
        a[:1] = 1
        return np.cumprod(a, dtype=np.uint64)
    return up(base), up(pow(base, -1, 1 << 64))


def polynomials(values: np.ndarray, base: int, starts: np.ndarray, lens: np.ndarray | int) -> np.ndarray:
    """The polynomials of the runs of ``values``, from prefix sums."""
    there, back = powers(base, len(values))
    prefix = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * there, dtype=np.uint64, out=prefix[1:])
    return (prefix[starts + lens] - prefix[starts]) * back[starts] if len(values) else np.zeros(0, np.uint64)


def word_prints(words: list[bytes], chunk: int = 1 << 20) -> np.ndarray:
    """Fingerprints of words, by chunks of their bytes."""
    letters = mix64(np.arange(1, 257, dtype=np.uint64))
    out, at = np.zeros(len(words), np.uint64), 0
    while at < len(words):
        end, held = at, 0
        while end < len(words) and (end == at or held + len(words[end]) <= chunk):
            held += len(words[end])
            end += 1
        if held > chunk:  # one long word: its chunks' polynomials, moved to their places
            w = words[at]
            for i in range(0, len(w), chunk):
                part = letters[np.frombuffer(w[i:i + chunk], np.uint8)]
                h = polynomials(part, _BASE, np.zeros(1, np.int64), len(part))
                out[at:end] += h * np.uint64(pow(_BASE, i, 1 << 64))
        else:
            lens = np.fromiter(map(len, words[at:end]), np.int64, end - at)
            data = letters[np.frombuffer(b"".join(words[at:end]), np.uint8)]
            out[at:end] = polynomials(data, _BASE, np.cumsum(lens) - lens, lens)
        at = end
    return mix64(out + np.uint64(1))


class Block:
    """The words of a block as numbers, with the fingerprints of its n-grams."""

    def __init__(self, langs, words, ids, lens, skips, of):
        self.langs = langs
        self.words = zstandard.ZstdDecompressor().decompress(words).split(b"\n") if words else []
        self.ids = unpack(ids, np.int32)
        lens, skips, of = unpack(lens, np.int32), unpack(skips, np.uint8), unpack(of, np.int32)
        self.piece = np.repeat(np.arange(len(lens), dtype=np.int32), lens)
        first = np.cumsum(lens) - lens
        #: words that this block counts, and not the one before
        self.new = np.arange(len(self.ids)) - first[self.piece] >= skips[self.piece]
        self.lang = of[self.piece]
        there, self.back = powers(_WORD_BASE, len(self.ids))
        self.prefix = np.zeros(len(self.ids) + 1, np.uint64)
        np.cumsum(word_prints(self.words)[self.ids] * there, dtype=np.uint64, out=self.prefix[1:])
        salts = [mix64(np.frombuffer(x.encode() + bytes(8 - len(x.encode()) % 8), np.uint64)) for x in langs]
        self.salt = np.array([np.bitwise_xor.reduce(mix64(s + np.arange(1, len(s) + 1, dtype=np.uint64)))
                              for s in salts], np.uint64)

    def grams(self, n: int, known: dict[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places and keys of the n-grams whose parts of the longest known length are frequent."""
        size = len(self.ids) - n + 1
        if size <= 0:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        keep = self.piece[:size] == self.piece[n - 1:]
        for m, often in known.items():
            if m == max(known):
                for j in range(n - m + 1):
                    keep &= often[j:j + size]
        at = np.flatnonzero(keep)
        h = (self.prefix[at + n] - self.prefix[at]) * self.back[at]
        return at, mix64(mix64(h + np.uint64(n)) ^ self.salt[self.lang[at]])

    def walk(self, answered: list, least: int):
        """With the rounds' answers so far: the next round's (keys, counts), or after the last
        one the frequent n-grams, as (n, places, numbers of their keys, first place and key of each number)."""
        known: dict[int, np.ndarray] = {}
        last = []
        for levels, answers in zip(ROUNDS, [*answered, None]):
            found = [(n, *self.grams(n, known)) for n in levels]
            keys, first, number = np.unique(np.concatenate([k for *_, k in found]),
                                            return_index=True, return_inverse=True)
            places = np.concatenate([at for _, at, _ in found])
            if answers is None:
                new = np.concatenate([self.new[at + n - 1] for n, at, _ in found])
                return keys, np.bincount(number, weights=new, minlength=len(keys)).astype(np.uint32)
            often = answer_arrays(answers[0])[0] >= least
            at_key = 0
            for n, at, k in found:
                which = number[at_key:at_key + len(k)]
                at_key += len(k)
                keep = often[which] if len(keys) else np.zeros(0, bool)
                known[n] = np.zeros(len(self.ids), bool)
                known[n][at[keep]] = True
                keep &= self.new[at + n - 1]
                last.append((n, at[keep], which[keep], places[first], keys))
        return last

    def phrases(self, frequent: list) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
        """words, places, counts, keys of the frequent n-grams: occurrences compared with the first."""
        for n, at, which, first, keys in frequent:
            model = first[which]
            same = self.lang[at] == self.lang[model]
            for j in range(n):
                same &= self.ids[at + j] == self.ids[model + j]
            counts = np.bincount(which[same], minlength=len(first))
            some = np.flatnonzero(counts)
            yield n, first[some], counts[some], keys[some]
            if not same.all():  # occurrences under a fingerprint of other words
                odd: Counter = Counter()
                place = {}
                for i, k in zip(at[~same].tolist(), which[~same].tolist()):
                    words = (int(self.lang[i]), *self.ids[i:i + n].tolist())
                    odd[words] += 1
                    place[words] = i, k
                at_, k = np.array(list(place.values())).T
                yield n, at_, np.array([odd[w] for w in place]), keys[k]

    def packed_phrases(self, frequent: list, bits: int) -> Iterator[tuple]:
        """part, langs, lang numbers, texts, counts: this block's frequent phrases and, as empty
        ones, its words by language, dealt by the upper bits of their keys."""
        sizes = np.bincount(self.lang[self.new], minlength=len(self.langs))
        words = pa.array(self.words, pa.binary())
        texts, langs, counts = [pa.array([b""] * len(sizes), pa.binary())], [np.arange(len(sizes))], [sizes]
        keys = [np.zeros(len(sizes), np.uint64)]
        for n, at, c, k in self.phrases(frequent):
            parts = [words.take(pa.array(self.ids[at + j])) for j in range(n)]
            texts.append(parts[0] if n == 1 else pc.binary_join_element_wise(*parts, b" "))
            langs.append(self.lang[at])
            counts.append(c)
            keys.append(k)
        part = (np.concatenate(keys) >> np.uint64(64 - bits)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        text = pa.concat_arrays(texts).take(pa.array(order))
        lang, count_ = np.concatenate(langs)[order].astype(np.int32), np.concatenate(counts)[order].astype(np.int64)
        part = part[order]
        cuts = np.flatnonzero(np.r_[True, part[1:] != part[:-1], True])
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            data = zstandard.ZstdCompressor(level=1).compress(b"\n".join(text[a:b].to_pylist()))
            yield int(part[a]), self.langs, pack(lang[a:b]), data, pack(count_[a:b])


def merged(table: pa.Table, least: int) -> pa.Table:
    """lang, phrase, n of one range's rows (langs, lang numbers, texts, counts): sums by the text."""
    tables = []
    for langs, of, texts, counts in rows_of(table.to_batches()):
        text = pa.array(zstandard.ZstdDecompressor().decompress(texts).split(b"\n"), pa.binary())
        lang = pa.DictionaryArray.from_arrays(pa.array(unpack(of, np.int32)), pa.array(langs, pa.string()))
        tables.append(pa.table({"lang": lang.cast(pa.string()), "phrase": text,
                                "n": pa.array(unpack(counts, np.int64))}))
    found = pa.concat_tables(tables).group_by(["lang", "phrase"]).aggregate([("n", "sum")])
    found = found.filter(pc.or_(pc.equal(pc.binary_length(found["phrase"]), 0), pc.greater_equal(found["n_sum"], least)))
    return pa.table({"lang": found["lang"], "phrase": found["phrase"].cast(pa.string()), "n": found["n_sum"]})


def parts_of(text: bytes, limit: int) -> Iterator[bytes]:
    """A text cut before separators; each part but the first starts with one."""
    at = 0
    while len(text) - at > limit:
        end = max(text.rfind(b" ", at + 1, at + limit), text.rfind(b"\n", at + 1, at + limit))
        if end < 0:  # a word longer than the limit
            ends = [e for e in (text.find(b" ", at + limit), text.find(b"\n", at + limit)) if e >= 0]
            if not ends:
                break
            end = min(ends)
        yield text[at:end]
        at = end
    yield text[at:]


def pieces_of(text: bytes, limit: int) -> Iterator[tuple[int, list[tuple[list[bytes], int]]]]:
    """For each part: its bytes, and its pieces as words and how many of them the part before counts."""
    context: list[bytes] = []
    for part in parts_of(text, limit):
        out, words, skip = [], [], 0
        for k, piece in enumerate(part.split(b"\n")):
            words, skip = piece.split(), 0
            if k == 0:
                words, skip = context + words, len(context)
            if len(words) > skip:
                out.append((words, skip))
        context = words[-(LONGEST - 1):]
        yield len(part), out


def packed(rows: Iterator[tuple], limit: int) -> Iterator[tuple]:
    """Blocks (without their number) of rows (lang, text)."""
    def close():
        n = np.concatenate(ids) if ids else np.zeros(0, np.int32)
        order = np.argsort(np.bincount(n, minlength=len(number)), kind="stable")[::-1]
        rank = np.empty(len(number), np.int32)  # frequent words get small numbers, which pack well
        rank[order] = np.arange(len(number), dtype=np.int32)
        words = list(number)
        text = zstandard.ZstdCompressor(level=1).compress(b"\n".join([words[i] for i in order.tolist()]))
        n_words = np.bincount(of, weights=np.array(lens) - np.array(skips), minlength=len(langs)).astype(np.int64)
        return (int(n_words.sum()), list(langs), text, pack(rank[n]), pack(np.array(lens, np.int32)),
                pack(np.array(skips, np.uint8)), pack(np.array(of, np.int32)))

    def fresh():
        return defaultdict(count().__next__), defaultdict(count().__next__), [], [], [], [], 0

    number, langs, ids, lens, skips, of, held = fresh()
    for lang, text in rows:
        for size, pieces in pieces_of((text or "").encode().translate(_BYTES), limit):
            for words, skip in pieces:
                ids.append(np.fromiter(map(number.__getitem__, words), np.int32, len(words)))
                lens.append(len(words))
                skips.append(skip)
                of.append(langs[lang])
            held += size + 64
            if held >= limit:
                if ids:
                    yield close()
                number, langs, ids, lens, skips, of, held = fresh()
    if ids:
        yield close()


def frequent_phrases(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, phrase, words, n for all phrases of ``docs`` (lang, text) that occur ``least`` times;
    and one row for each language with an empty phrase, words = 0 and the number of its words."""

    def to_blocks(batches):
        schema = pa.schema([("block_id", pa.int64()), ("n_words", pa.int64()), ("langs", pa.list_(pa.string())),
                            *((c, pa.binary()) for c in _COLUMNS[3:])])
        for k, row in enumerate(packed(rows_of(batches), BLOCK)):
            yield batch_of(schema, [(block_number(k), *row)])

    def keys_of(rounds):
        def keys(batches):
            schema = pa.schema([("block_id", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
            for bid, _, *row in rows_of(batches):
                k, c = Block(*row[:6]).walk([row[6 + i:7 + i] for i in range(rounds)], least)
                yield batch_of(schema, [(bid, pack(k), pack(c))])
        return keys

    def to_phrases(batches):
        schema = pa.schema([("part", pa.int32()), ("langs", pa.list_(pa.string())), ("of", pa.binary()),
                            ("texts", pa.binary()), ("counts", pa.binary())])
        for _, _, *row in rows_of(batches):
            block = Block(*row[:6])
            found = block.walk([row[6 + i:7 + i] for i in range(len(ROUNDS))], least)
            for row in block.packed_phrases(found, bits):
                yield batch_of(schema, [row])

    asked = cut(docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text")
                .mapInArrow(to_blocks, _PACKED))
    # a block has no more distinct n-grams of a length than words
    entries = asked.agg(F.sum("n_words")).first()[0] or 0
    bits = max(1, (entries // WORDS_PER_RANGE).bit_length())
    for i in range(len(ROUNDS)):
        answers, _ = global_counts(asked.mapInArrow(keys_of(i), "block_id long, keys binary, counts binary"), entries)
        answers = answers.select(F.col("block_id").alias("_b"), F.col("answers").alias(f"round_{i}"))
        asked = asked.join(answers, F.col("block_id") == F.col("_b"), "left").drop("_b")
    found = asked.mapInArrow(to_phrases, "part int, langs array<string>, of binary, texts binary, counts binary")
    found = found.groupBy("part").applyInArrow(lambda t: merged(t.select(["langs", "of", "texts", "counts"]), least),
                                               "lang string, phrase string, n long")
    words = F.when(F.col("phrase") == "", 0).otherwise(F.size(F.split("phrase", " ")))
    return found.select("lang", "phrase", words.alias("words"), "n")


def collocations(docs: DataFrame, least: int = LEAST, lead: int = LEAD, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's first ``lead`` phrases of ``docs`` (lang, text)."""
    # used several times: the phrases, their parts, the phrases that hold them, and the sizes
    found = cut(frequent_phrases(docs, least))
    sizes = found.where("words = 0").select("lang", F.col("n"))
    known = found.where("words > 0").select("lang", F.col("phrase").alias("part"), F.col("n").alias("f"))
    phrases = found.where("words > 1").select("lang", "phrase", "words", F.col("n").alias("a"))
    cuts = phrases.select("*", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.withColumn("left", F.array_join(F.slice(F.split("phrase", " "), 1, F.col("k")), " "))
    cuts = cuts.withColumn("right", F.expr("substring(phrase, length(left) + 2)"))
    cuts = (cuts.join(known.select("lang", F.col("part").alias("left"), F.col("f").alias("l")), ["lang", "left"])
            .join(known.select("lang", F.col("part").alias("right"), F.col("f").alias("r")), ["lang", "right"])
            .join(sizes, "lang"))
    # decimals of 38 digits hold the products; div drops the fraction
    wide = {c: f"cast({c} as decimal(20, 0))" for c in "anlr"}
    cuts = cuts.withColumn("score", F.expr("(1000 * {a} * {n}) div ({l} * {r})".format(**wide)))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "l", "r", "a", "n")).alias("best"))
    # a phrase inside any longer one lies inside one that is longer by a word and at least as frequent
    words = F.split("phrase", " ")
    inside = F.array(F.array_join(F.slice(words, 1, F.size(words) - 1), " "),
                     F.array_join(F.slice(words, 2, F.size(words) - 1), " "))
    longer = phrases.where("words > 2").select("lang", F.explode(inside).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("within"))
    kept = best.join(longer, ["lang", "phrase"], "left").where(
        F.col("within").isNull() | (100 * F.col("within") < cover * F.col("best.a")))
    rows = kept.select("lang", "phrase", *(F.col(f"best.{c}").alias(c) for c in ("a", "l", "r", "n", "score")))
    order = [F.col("score").desc(), F.col("a").desc(), F.col("phrase").asc()]
    some = F.row_number().over(Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(64))).orderBy(*order))
    rows = rows.withColumn("_some", some).where(F.col("_some") <= lead).drop("_some")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")
    return rows.withColumn("rank", rank).where(F.col("rank") <= lead).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
