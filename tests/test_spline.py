"""The spline against a dense solve for all pieces' coefficients."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barworks.functions import spline as S


def dense(x, y):
    """Coefficients of all cubic pieces from continuity up to the second derivative and not-a-knot ends."""
    n = len(x)
    a, r = np.zeros((4 * (n - 1), 4 * (n - 1))), np.zeros(4 * (n - 1))
    row = 0

    def put(piece, t, order, sign=1.0):
        c = [np.array([1, t, t * t, t ** 3]), np.array([0, 1, 2 * t, 3 * t * t]), np.array([0, 0, 2, 6 * t]),
             np.array([0, 0, 0, 6.0])][order]
        a[row, 4 * piece:4 * piece + 4] += sign * c
    for i in range(n - 1):
        h = x[i + 1] - x[i]
        for t, v in ((0, y[i]), (h, y[i + 1])):
            put(i, t, 0)
            r[row] = v
            row += 1
        for order in (1, 2) if i < n - 2 else ():
            put(i, h, order)
            put(i + 1, 0, order, -1.0)
            row += 1
    for i in (0, n - 3):
        put(i, 0, 3)
        put(i + 1, 0, 3, -1.0)
        row += 1
    return np.linalg.solve(a, r).reshape(-1, 4)


def expected(values):
    known = [i for i, v in enumerate(values) if v is not None]
    out = list(values)
    x, y = np.array(known, float), np.array([values[i] for i in known])
    if len(known) >= 4:
        c = dense(x, y)
    elif len(known) >= 2:
        c = None
        poly = np.polyfit(x, y, len(known) - 1)
    for i in range(known[0], known[-1]) if known else ():
        if values[i] is None:
            if c is None:
                out[i] = float(np.polyval(poly, i))
            else:
                k = int(np.searchsorted(x, i) - 1)
                t = i - x[k]
                out[i] = float(c[k] @ [1, t, t * t, t ** 3])
    return out


@pytest.mark.parametrize("block,halo", [(128, 64), (40, 39)])
def test_spline_against_a_dense_solve(spark, block, halo):
    rnd = random.Random(1)
    series = {f"S{k}": [None if rnd.random() < 0.4 else rnd.uniform(0, 100) for _ in range(n)]
              for k, n in enumerate([1, 2, 3, 4, 5, 6, 9, 30, 200, 420])}
    series |= {"none": [None] * 5, "one": [None, 2.0, None], "two": [None, 2.0, None, 5.0, None],
               "three": [1.0, None, 2.0, None, None, 7.0], "four": [1.0, None, 2.0, None, None, 7.0, None, 3.0],
               "cubic": [None if i % 3 else float(i ** 3 - 5 * i) for i in range(31)]}
    rows = [(s, i, v) for s, vs in series.items() for i, v in enumerate(vs)]
    df = spark.createDataFrame(rows, "symbol string, t long, v double")
    got = S.interpolate_spline(df, ["symbol"], ["t"], ["v"], F.floor(F.col("t") / 30), block, halo)
    found = {(r["symbol"], r["t"]): r["v"] for r in got.collect()}
    assert len(found) == len(rows)
    for s, vs in series.items():
        for i, v in enumerate(expected(vs)):
            g = found[s, i]
            assert (g is None) == (v is None) and (v is None or g == pytest.approx(v, rel=1e-8, abs=1e-8)), (s, i, g, v)
    assert found["cubic", 29] == pytest.approx(29 ** 3 - 5 * 29)
