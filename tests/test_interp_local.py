"""C13 / C29 local polynomial interpolation against a brute-force numpy version."""

import random

import numpy as np

from barworks.operators import clean as C


def _brute(vals, degree):
    out = list(vals)
    known = [i for i, v in enumerate(vals) if v is not None]
    for i, v in enumerate(vals):
        if v is not None:
            continue
        before = [k for k in known if k < i][-2:]
        after = [k for k in known if k > i][:2]
        if not before:
            out[i] = None
            continue
        if not after:
            out[i] = None if degree == 3 else vals[before[-1]]
            continue
        if degree == 3:
            pts = before + after
        else:
            pts = [before[-1], after[0]]
            cand = []
            if len(before) == 2:
                cand.append((i - before[0], 0, before[0]))
            if len(after) == 2:
                cand.append((after[1] - i, 1, after[1]))
            if cand:
                pts.append(min(cand)[2])
        xs = np.array([p + 1 for p in pts], dtype=float)
        ys = np.array([vals[p] for p in pts], dtype=float)
        coef = np.polyfit(xs, ys, len(pts) - 1)
        out[i] = float(np.polyval(coef, i + 1))
    return out


def test_local_polynomials_match_numpy(spark):
    import datetime as dt
    rnd = random.Random(3)
    rows, series = [], {}
    for s in ("A", "B"):
        vals = [None if rnd.random() < 0.35 else round(rnd.uniform(10, 20), 2) for _ in range(40)]
        series[s] = vals
        for i, v in enumerate(vals):
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=i), v, i))
    df = spark.createDataFrame(rows, "symbol string, date date, close double, load_seq long")
    for deg, fn in ((3, C.fill_cubic), (2, C.fill_quadratic)):
        got = {(r["symbol"], r["load_seq"]): r["close"] for r in fn(df, ["close"]).collect()}
        for s, vals in series.items():
            exp = _brute(vals, deg)
            for i, e in enumerate(exp):
                g = got[(s, i)]
                assert (g is None and e is None) or abs(g - e) < 1e-6, (deg, s, i, g, e)


def test_local_polynomials_split_plan(spark):
    import datetime as dt
    from pyspark.sql import functions as F
    from barworks.functions.series import SPLIT_CONF
    rnd = random.Random(5)
    rows = []
    for s in ("A", "B"):
        for i in range(60):
            v = None if rnd.random() < 0.4 else round(rnd.uniform(10, 20), 2)
            rows.append((s, dt.date(2024, 1, 1) + dt.timedelta(days=i), v, i))
    df = spark.createDataFrame(rows, "symbol string, date date, close double, load_seq long")
    for fn in (C.fill_cubic, C.fill_quadratic):
        plain = {(r["symbol"], r["load_seq"]): r["close"] for r in fn(df, ["close"]).collect()}
        spark.conf.set(SPLIT_CONF, "week")
        try:
            split = {(r["symbol"], r["load_seq"]): r["close"] for r in fn(df, ["close"]).collect()}
        finally:
            spark.conf.unset(SPLIT_CONF)
        assert plain.keys() == split.keys()
        for k in plain:
            a, b = plain[k], split[k]
            assert (a is None and b is None) or abs(a - b) < 1e-9, (k, a, b)
