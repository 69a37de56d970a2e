"""Importance resampling against a plain version, and its table of slices against dictionaries."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from barworks.llm import importance as I
from barworks.llm import queries
from barworks.llm._ranks import positions
from barworks.llm._util import documents

from helpers import EDGES, SF, ascii_lower, frame


def grams(text):
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text))
    return [b" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)], len(words)


def brute(rows, target):
    def buckets(text):
        return Counter(zlib.crc32(g) % 10000 for g in grams(text)[0])

    each = [buckets(t) for _, t in rows]
    s, t = sum(each, Counter()), sum(map(buckets, target), Counter())
    big_s, big_t = s.total(), t.total()
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (big_s + 10000) / ((s[b] + 1) * (big_t + 10000)))) for b in s}
    out = []
    for (doc_id, text), c in zip(rows, each):
        weight = sum(gain[b] * n for b, n in c.items())
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((doc_id, c.total(), weight, score, grams(text)[1]))
    fit = sorted((r for r in out if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    drawn = [(r, i + 1) for i, r in enumerate(fit[:5 * len(fit) // 100])]
    rest = Counter(out) - Counter(r for r, _ in drawn)
    return sorted(((*r[:4], i, r[4]) for r, i in [*drawn, *((r, None) for r in rest.elements())]), key=str)


def test_table_documents(spark):
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    target = [r["text"] for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = queries.op11_importance_resampling(spark, SF)
    assert got.columns == ["doc_id", "n_features", "weight", "score", "rank", "n_words"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, target)


def test_edges(spark):
    rows = EDGES * 3 + [(20, "wörd " * 30), (None, "wörd " * 30)] + [(30 + i, f"a b c {i} " * 9) for i in range(60)]
    target = ["the cat sat on the mat", None, "a b c", ""]
    goal = spark.createDataFrame([(1, t) for t in target], "item_id long, text string")
    assert sorted((tuple(r) for r in I.resampled(frame(spark, rows), goal).collect()), key=str) == brute(rows, target)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string")
    some = frame(spark, [(1, "one two three")])
    assert I.resampled(none, some).collect() == []
    assert [tuple(r) for r in I.resampled(some, none).collect()] == [
        t if t[4] is None else t for t in brute([(1, "one two three")], [])]


def test_a_text_of_many_batches(spark):
    random.seed(5)
    long = " ".join(f"w{random.randint(0, 9000)}" for _ in range(700_000)) + " " + "y" * (3 << 20) + " end of it"
    assert len(long) > 6 << 20
    rows = [(1, "one two three " * 10), (2, long), (3, "w1 w2 w3 " * 10)]
    goal = spark.createDataFrame([("w1 w2 w3 w4",)], "text string")
    assert sorted((tuple(r) for r in I.resampled(frame(spark, rows), goal).collect()), key=str) == brute(
        rows, ["w1 w2 w3 w4"])


def test_parts_hold_each_feature_once():
    random.seed(6)
    for limit in (1, 7, 40):
        for _ in range(40):
            texts = [" ".join(random.choice(["a", "bb", "ccc", " ", "d" * 30]) for _ in range(random.randint(0, 30)))
                     for _ in range(4)]
            rows = [(i, t) for i, t in enumerate(texts)]
            got = [Counter() for _ in texts]
            for parts in I.batches_of(iter(rows), 1, limit):
                s, starts, lens, part, _ = I.features(parts)
                for a, n, p in zip(starts, lens, part):
                    got[parts[p][0][0]][bytes(s.bytes[a:a + n])] += 1
            assert got == [Counter(grams(t)[0]) for t in texts]


def test_slices_against_the_libraries():
    random.seed(7)
    data = random.randbytes(4000)
    s = I.Slices(np.frombuffer(data, np.uint8))
    starts = np.array([random.randrange(3900) for _ in range(2000)])
    lens = np.minimum([random.choice([1, 2, 7, 8, 9, 31, 32, 33, 90, 300]) for _ in starts], 4000 - starts)
    assert s.keys(starts, lens).tolist() == [xxhash.xxh64_intdigest(data[a:a + n]) for a, n in zip(starts, lens)]
    assert s.crc32(starts, lens).tolist() == [zlib.crc32(data[a:a + n]) for a, n in zip(starts, lens)]


@pytest.mark.parametrize("keys", [lambda k: k, lambda k: k & np.uint64(3), lambda k: k * np.uint64(0)])
def test_slots_tell_colliding_keys_apart(keys):
    """Equal slices share a slot and different ones never, whatever the keys."""
    random.seed(8)
    words = [w for w in (bytes([97 + i]) * n for i in range(6) for n in (1, 2, 7, 8, 9, 40, 300))]
    picked = [random.choice(words) for _ in range(600)]
    data = b" ".join(picked)
    lens = np.array([len(w) for w in picked])
    starts = np.cumsum(lens + 1) - lens - 1
    s = I.Slices(np.frombuffer(data, np.uint8))
    holder, slot = I.interned(s, starts, lens, keys(s.keys(starts, lens)))
    of = {}
    for w, x in zip(picked, slot.tolist()):
        assert of.setdefault(w, x) == x and picked[holder[x]] == w
    assert len(set(of.values())) == len(of)


def test_positions_of_rows_with_equal_keys(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, 7).otherwise(F.col("id") % 50).alias("k"), "id")
    got = positions(df.repartition(5), F.col("k").desc(), F.col("id").asc()).collect()
    assert [(r["k"], r["id"]) for r in sorted(got, key=lambda r: r["position"])] == sorted(
        ((r["k"], r["id"]) for r in got), key=lambda r: (-r[0], r[1]))
    assert sorted(r["position"] for r in got) == list(range(1000))
