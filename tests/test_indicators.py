"""Recurrence scans and indicators against plain loops."""

import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barworks.functions import recurrence as R
from barworks.functions import series as S
from barworks.operators import indicators as I

DAY = dt.date(2020, 1, 30)


def bars(spark, n=90, symbols=2, seed=3, gaps=True):
    rnd = random.Random(seed)
    rows = []
    for s in range(symbols):
        price = 100.0
        for i in range(n):
            price = max(1.0, price + rnd.uniform(-3, 3)) if i % 17 else price
            low, high = price - rnd.uniform(0, 2), price + rnd.uniform(0, 2)
            close = None if gaps and rnd.random() < 0.1 else price
            rows.append((f"S{s}", DAY + dt.timedelta(days=i + i // 5 * 2), low, high, low, close))
    return spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double"), rows


def by_row(df, *cols):
    return {(r["symbol"], r["date"]): tuple(r[c] for c in cols) for r in df.collect()}


def close_to(got, want):
    assert got.keys() == want.keys()
    for k in got:
        for a, b in zip(got[k], want[k]):
            assert (a is None) == (b is None), (k, got[k], want[k])
            assert a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9), (k, got[k], want[k])


def series_of(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def ema_loop(values, span):
    out, y = [], None
    for v in values:
        y = v if y is None else y + (v - y) * 2 / (span + 1)
        out.append(y)
    return out


def wilder_loop(values, n):
    """Values from the first change on; NULL before the seed."""
    out, y, seed = [], None, []
    for v in values:
        if y is None:
            seed.append(v)
            y = sum(seed) / n if len(seed) == n else None
        else:
            y += (v - y) / n
        out.append(y)
    return out


def expected(rows, spans=(20, 50, 200), periods=(14, 21), n=14):
    want = {}
    for s, all_ in series_of(rows).items():
        v = [r for r in all_ if r[5] is not None]
        close = [r[5] for r in v]
        emas = [ema_loop(close, x) for x in spans]
        line = [a - b for a, b in zip(ema_loop(close, 12), ema_loop(close, 26))]
        signal = ema_loop(line, 9)
        change = [b - a for a, b in zip(close, close[1:])]
        rsis = []
        for p in periods:
            up, down = wilder_loop([max(c, 0) for c in change], p), wilder_loop([max(-c, 0) for c in change], p)
            rsis.append([None] + [None if u is None else 50.0 if u + d == 0 else 100 * u / (u + d) for u, d in zip(up, down)])
        tr, plus, minus = [], [], []
        for a, b in zip(v, v[1:]):
            tr.append(max(b[3] - b[4], abs(b[3] - a[5]), abs(b[4] - a[5])))
            up, down = b[3] - a[3], a[4] - b[4]
            plus.append(up if up > down and up > 0 else 0.0)
            minus.append(down if down > up and down > 0 else 0.0)
        atr, p, m = wilder_loop(tr, n), wilder_loop(plus, n), wilder_loop(minus, n)
        dx = [100 * abs(x - y) / (x + y) if x + y else 0.0 for x, y in zip(p, m) if x is not None]
        adx = [None] * n + wilder_loop(dx, n)
        for i, r in enumerate(v):
            want[s, r[1]] = (*[x[i] for x in rsis], *[e[i] for e in emas], line[i], signal[i], line[i] - signal[i],
                             ([None] + atr)[i], adx[i] if i < len(adx) else None)
        for r in all_:
            want.setdefault((s, r[1]), (None,) * 10)
    return want


COLUMNS = ("rsi_14", "rsi_21", "ema_20", "ema_50", "ema_200", "macd_line", "macd_signal", "macd_histogram", "atr", "adx")


@pytest.mark.parametrize("bucket,block", [(None, None), ("week", 2), ("year", 7)])
def test_indicator_table_against_loops(spark, bucket, block):
    df, rows = bars(spark)
    b = None if bucket is None else F.date_trunc(bucket, "date")
    close_to(by_row(I.indicator_table(df, b, block, 64), *COLUMNS), expected(rows))


def test_parts_agree_with_the_table(spark):
    df, rows = bars(spark, n=70)
    want = {k: dict(zip(COLUMNS, v)) for k, v in expected(rows).items()}
    for got, cols in ((I.ema(df), ["ema_20", "ema_50", "ema_200"]), (I.macd(df), ["macd_line", "macd_signal"]),
                      (I.rsi(df), ["rsi_14", "rsi_21"]), (I.atr(df), ["atr"]), (I.adx(df), ["adx"])):
        close_to(by_row(got, *cols), {k: tuple(v[c] for c in cols) for k, v in want.items()})


def test_bands_and_stochastic(spark):
    df, rows = bars(spark, n=60)
    want = {}
    for s, all_ in series_of(rows).items():
        v = [r for r in all_ if r[5] is not None]
        ks = []
        for i, r in enumerate(v):
            last = v[max(0, i - 13):i + 1]
            low, high = min(x[4] for x in last), max(x[3] for x in last)
            ks.append(None if len(last) < 14 else 50.0 if high == low else 100 * (r[5] - low) / (high - low))
            c = [x[5] for x in v[max(0, i - 19):i + 1]]
            mid = sum(c) / len(c)
            dev = math.sqrt(sum((x - mid) ** 2 for x in c) / len(c))
            d = ks[max(0, i - 2):]
            d = sum(d) / 3 if len(d) == 3 and None not in d else None
            want[s, r[1]] = ((mid + 2 * dev, mid, mid - 2 * dev) if len(c) == 20 else (None,) * 3) + (ks[-1], d)
        for r in all_:
            want.setdefault((s, r[1]), (None,) * 5)
    cols = ("bb_upper", "bb_middle", "bb_lower", "stoch_k", "stoch_d")
    b, k = I.bands(df, block=25), I.stochastic(df, block=25)
    got = {x: y + by_row(k, *cols[3:])[x] for x, y in by_row(b, *cols[:3]).items()}
    close_to(got, want)
    close_to(by_row(I.indicator_table(df), *cols), want)


def test_rsi_rule_and_flat_series(spark):
    flat = spark.createDataFrame([("A", DAY + dt.timedelta(days=i), 5.0) for i in range(20)]
                                 + [("B", DAY + dt.timedelta(days=i), 5.0 + i) for i in range(20)]
                                 + [("C", DAY + dt.timedelta(days=i), 50.0 - i) for i in range(20)],
                                 "symbol string, date date, close double")
    got = I.rsi_rule(I.rsi(flat)).filter(F.col("date") == DAY + dt.timedelta(days=19)).collect()
    assert {r["symbol"]: (r["rsi_14"], r["action"]) for r in got} == {
        "A": (50.0, "HOLD"), "B": (100.0, "SELL"), "C": (0.0, "BUY")}
    first = I.rsi_rule(I.rsi(flat)).filter(F.col("date") == DAY).collect()
    assert {r["action"] for r in first} == {None}


def test_recurrence_skips_null_and_takes_a_long_bucket(spark):
    """One bucket of 3,000 rows, with a decay whose inverse powers would overflow unblocked."""
    rnd = random.Random(4)
    values = [None if rnd.random() < 0.2 else rnd.uniform(-1, 1) for _ in range(3000)]
    df = spark.createDataFrame([("S", i, v) for i, v in enumerate(values)], "symbol string, t long, v double")
    got = R.recur(df, ["symbol"], ["t"], {"y": R.Recurrence(F.col("v"), 0.1), "z": R.mean_of(3, F.col("v"))},
                  bucket=F.lit(0))
    y, z, want = 0.0, None, {}
    for i, v in enumerate(values):
        if v is not None:
            y = 0.1 * y + v
            z = v if z is None else z + (v - z) / 2
        want["S", i] = (y, 0.0 if z is None else z)
    got = {("S", r["t"]): (r["y"], r["z"]) for r in got.collect()}
    first = next(i for i, v in enumerate(values) if v is not None)
    close_to({k: v for k, v in got.items() if k[1] >= first}, {k: v for k, v in want.items() if k[1] >= first})


def test_empty_series_and_one_row(spark):
    df, _ = bars(spark, n=1, gaps=False)
    rows = I.indicator_table(df).collect()
    assert len(rows) == 2 and all(r["rsi_14"] is None and r["ema_20"] is not None for r in rows)
    assert I.indicator_table(df.limit(0)).collect() == []


def test_place_and_previous_in_one(spark):
    rnd = random.Random(5)
    df = spark.createDataFrame([(f"S{i % 3}", i, rnd.random()) for i in range(100)], "symbol string, t long, v double")
    got = S.with_place(df, ["symbol"], ["t"], ["v"], F.floor(F.col("t") / 8))
    want = S.with_prev(S.with_position(df, ["symbol"], ["t"]), ["symbol"], ["t"], ["v"])
    cols = ["symbol", "t", "pos", "prev_v"]
    assert sorted(map(tuple, got.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))
