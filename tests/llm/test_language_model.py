"""Language-model scores against a dictionary version."""

import math
import zlib
from collections import Counter

import numpy as np

from barworks.llm import _util as U
from barworks.llm import lm_scoring as M
from barworks.llm._util import documents

from helpers import EDGES, SF, ascii_lower, frame


def brute(rows):
    held = [zlib.crc32(b"" if d is None else str(d).encode()) % 5 == 1 for d, _ in rows]
    texts = [ascii_lower(t).split() + [b""] for _, t in rows]
    one, two = Counter(), Counter()
    for t, h in zip(texts, held):
        if not h:
            one.update(t)
            two.update(zip([b""] + t, t))
    n, v = sum(one.values()), len(one)
    classes = {}
    for c in one.values():
        classes.setdefault(math.frexp(c)[1], []).append(c)
    fall = M.failure_fall([(len(x), sum(x)) for _, x in sorted(classes.items())], sum(c == 1 for c in two.values()))
    p = lambda w: (one[w] + 0.5) / (n + 0.5 * (v + 1))

    def step(u, w):
        if not one[u]:
            return p(w)
        f = (1 + one[u]) ** -fall
        return (1 - f) * two[u, w] / one[u] + f * p(w)

    out = []
    for (d, _), h, t in zip(rows, held, texts):
        out.append((d, h, len(t), sum(one[w] > 0 for w in t), n, sum(math.log10(p(w)) for w in t),
                    sum(math.log10(step(u, w)) for u, w in zip([b""] + t, t))))
    return out, (p, step, one)


def same(got, want):
    key = lambda r: (str(r[0]), r[2], r[5])
    for g, w in zip(sorted(map(tuple, got), key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert math.isclose(g[5], w[5], rel_tol=1e-9) and math.isclose(g[6], w[6], rel_tol=1e-9)


def test_scores(spark):
    rows = EDGES + [(20 + i, f"word{i % 9} the cat sat {i % 4} the end") for i in range(40)]
    same(M.lm_scores(frame(spark, rows)).collect(), brute(rows)[0])


def test_scores_of_the_table_over_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(M, "BLOCK", 40_000)
    rows = [tuple(r) for r in documents(spark, SF).collect()]
    got = M.lm_scores(documents(spark, SF)).collect()
    want = brute(rows)[0]
    same(got, want)
    held = [w for w in want if w[1]]
    assert sum(w[6] for w in held) > sum(w[5] for w in held)  # the model beats its base on texts it hasn't seen


def test_totals_above_32_bits(spark):
    """Counts over all blocks are whole: two blocks that hold a word 4,294,967,000 times each."""
    most = 4_294_967_000
    keys = np.array([5, 7, 1 << 63], np.uint64)
    rows = [(b, bytearray(U.pack(keys)), bytearray(U.pack(np.array([most, 1 + b, 0], np.uint32)))) for b in range(2)]
    blocks = spark.createDataFrame(rows, "block_id long, keys binary, counts binary")
    answers, classes = U.global_counts(blocks, 6)
    for r in answers.collect():
        assert U.answer_arrays(r["answers"])[0].tolist() == [2 * most, 3, 0]
    assert {(r["keys"], r["total"]) for r in classes.collect()} == {(1, 2 * most), (1, 3)}


def test_weights_of_a_state_sum_to_one():
    _, (p, step, one) = brute([(2, "a b a c"), (3, "b a b d")])
    unknown = p(b"never")
    for u in (b"a", b"b", b""):
        f = step(u, b"never") / unknown
        assert math.isclose(sum(step(u, w) for w in one) + f * unknown, 1)


def test_nothing_to_learn_from(spark):
    held = next(i for i in range(100) if M.held_out(i))
    r = M.lm_scores(frame(spark, [(held, "a b")])).collect()[0]
    assert r["train_tokens"] == 0 and r["n_known"] == 0 and r["n_tokens"] == 3 and r["held_out"]
    assert M.lm_scores(frame(spark, [])).collect() == []
