"""Quality classifier: ordinal cumulative-link regression on graded ratings.

Grades from ``labels``: 0 toxic, 1 of low quality, 2 good.  A text is a set of hashed
features (its words and punctuation runs, and the ranges that a few ratios of the
whole text fall into); one weight vector is shared by all grades and ordered
thresholds cut its score: ``P(grade <= k) = sigmoid(threshold_k - score)``.  The
result is the expected grade and the tail probability ``P(grade >= CUT)``, which the
selection compares with ``LEAST``.

The model is fitted on a bounded sample of labelled documents (``SAMPLE`` rows with
the smallest hash of their id).  An L1 penalty chooses the features, so that words
without bearing get no weight and long texts don't add up noise; the weights of the
chosen ones are then fitted without it.  All documents are scored, whole.

Defined cases: null text counts as empty; label rows with a null in any column are
ignored, of several rows for an id the lowest grade counts; when the sample holds
fewer than two grades there is no model and every document has the one grade (2
without labels); repeated rows and null ids are scored like any other; very long texts
are scored one at a time; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import batch_of, chunks, tidy

SAMPLE = 12_000
BITS = 20
CUT, LEAST = 2, 0.5
GRADES = 3
#: The L1 penalty is this over the root of the number of sampled texts.
PENALTY, ROUNDS, RATE = 0.04, 400, 0.3
#: A feature of fewer sampled texts has no weight.
LEAST_TEXTS = 5
#: And one that the penalty leaves less weight.
LEAST_WEIGHT = 0.1
_TOKENS = re.compile(r"[^\W_]+|[^\w\s]+|_+")


def _bin(name: str, part: float, whole: float) -> str:
    """A ratio as the name of one of eight ranges."""
    return f"\t{name}{int(8 * part / whole) if whole else 9}"


class Features:
    """Distinct hashed features of texts; the hashes of words go through a bounded table."""

    def __init__(self, kept: int = 300_000):
        self.known, self.kept = {}, kept

    def number(self, token: str) -> int:
        n = self.known.get(token)
        if n is None:
            n = zlib.crc32(token.encode("utf-8", "replace")) & ((1 << BITS) - 1)
            if len(self.known) >= self.kept:
                self.known.clear()
            if len(token) <= 64:
                self.known[token] = n
        return n

    def of(self, text: str) -> np.ndarray:
        tokens = _TOKENS.findall(text.lower())
        words = text.split()
        distinct = set(tokens)
        marks = sum(1 for t in tokens if not t[0].isalnum())
        upper = sum(map(str.isupper, words))
        again = sum(map(str.__eq__, words, words[1:]))
        shapes = (_bin("distinct", len(set(words)), len(words)), _bin("marks", marks, len(tokens)),
                  _bin("upper", upper, len(words)), _bin("again", again, len(words)))
        return np.unique(np.fromiter(map(self.number, [*distinct, *shapes]), np.int32, len(distinct) + len(shapes)))


def _sigmoid(x):
    return 0.5 * (1 + np.tanh(0.5 * x))


def fit(rows: list[tuple[np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
    """Weights and thresholds from (features, grade): proximal steps with per-coordinate rates."""
    y = np.array([g for _, g in rows])
    n = len(rows)
    col = np.concatenate([f for f, _ in rows])
    row = np.repeat(np.arange(n), [len(f) for f, _ in rows])
    used, n_texts = np.unique(col, return_counts=True)
    used = used[n_texts >= LEAST_TEXTS]
    have = np.isin(col, used)
    row, col = row[have], np.searchsorted(used, col[have])
    w, gw = np.zeros(len(used)), np.full(len(used), 1e-8)
    share = np.clip(np.array([(y <= k).mean() for k in range(GRADES - 1)]), 1e-3, 1 - 1e-3)
    t = np.log(share / (1 - share)) + 1e-3 * np.arange(GRADES - 1)
    gt = np.full(GRADES - 1, 1e-8)
    rows_of_grade = [np.flatnonzero(y == k) for k in range(GRADES)]
    for penalty in (PENALTY / np.sqrt(n), 0.0):  # the penalty chooses the features, whose weights are then fitted without it
        for _ in range(ROUNDS):
            s = np.bincount(row, weights=w[col], minlength=n)
            edge = np.concatenate([[-np.inf], t, [np.inf]])
            hi, lo = _sigmoid(edge[y + 1] - s), _sigmoid(edge[y] - s)
            p = np.maximum(hi - lo, 1e-9)
            ds = (1 - hi - lo) / n
            dt = np.zeros(GRADES - 1)
            for k in range(GRADES - 1):
                a, b = rows_of_grade[k], rows_of_grade[k + 1]
                dt[k] = ((-hi * (1 - hi) / p)[a].sum() + (lo * (1 - lo) / p)[b].sum()) / n
            g = np.bincount(col, weights=ds[row], minlength=len(used))
            gw += g * g
            gt += dt * dt
            rate = RATE / np.sqrt(gw)
            w = w - rate * g
            w = np.sign(w) * np.maximum(np.abs(w) - rate * penalty, 0)
            t = np.maximum.accumulate(t - RATE / np.sqrt(gt) * dt)
        chosen = np.abs(w) > LEAST_WEIGHT
        have = chosen[col]
        row, col, used, w = row[have], (np.cumsum(chosen) - 1)[col[have]], used[chosen], w[chosen]
        gw = np.full(len(used), 1e-8)
    weights = np.zeros(1 << BITS, np.float32)
    weights[used] = w
    return weights, t


def training_rows(docs: DataFrame, labels: DataFrame, sample: int) -> list[tuple[np.ndarray, int]]:
    """Features and grades of the bounded sample, in the order of ids."""
    grade = (F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2))
    graded = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), "quality", "toxic").dropna()
              .groupBy("doc_id").agg(F.min(grade).cast("int").alias("grade"))
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample))

    def encode(batches):
        schema = pa.schema([("doc_id", pa.int64()), ("grade", pa.int32()), ("features", pa.binary())])
        features = Features()
        for rows in chunks(batches):
            yield batch_of(schema, [(i, g, features.of(t or "").tobytes()) for i, t, g in rows])

    got = (docs.join(F.broadcast(graded), "doc_id")  # at most ``sample`` rows
           .select("doc_id", "text", "grade").mapInArrow(tidy(encode), "doc_id long, grade int, features binary"))
    table = got.toArrow().to_pylist()
    table.sort(key=lambda r: (r["doc_id"], r["features"]))
    return [(np.frombuffer(r["features"], np.int32), r["grade"]) for r in table]


def graded(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """``docs`` with expected_grade, tail and kept added (docs needs doc_id, text)."""
    added = ("expected_grade", "tail", "kept")
    docs = docs.drop(*added)
    rows = training_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), labels, sample)
    grades = {g for _, g in rows}
    if len(grades) < 2:
        only = min(grades, default=GRADES - 1)
        return docs.select("*", F.lit(float(only)).alias("expected_grade"),
                           F.lit(float(only >= CUT)).alias("tail"), F.lit(only >= CUT).alias("kept"))
    weights, thresholds = fit(rows)
    model = docs.sparkSession.sparkContext.broadcast(weights)  # 2 ** BITS numbers

    def score(batches):
        features = Features()
        for batch in batches:
            text = batch.column(batch.schema.get_field_index("text"))
            s = np.array([model.value[features.of(t.as_py() or "")].sum() for t in text], float).reshape(-1)
            above = 1 - _sigmoid(thresholds[None, :] - s[:, None])  # P(grade > k)
            tail = above[:, CUT - 1]
            cols = [pa.array(above.sum(1)), pa.array(tail), pa.array(tail >= LEAST)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *cols],
                                             names=[*batch.schema.names, "expected_grade", "tail", "kept"])

    schema = T.StructType(list(docs.schema))
    for name, kind in zip(added, ("double", "double", "boolean")):
        schema = schema.add(name, kind)
    return docs.mapInArrow(tidy(score), schema)
