"""Cleaning: the reference's own frames plus properties."""

import datetime as dt

from pyspark.sql import functions as F

from barworks.operators import clean as C

D0 = dt.date(2023, 1, 1)


def _frame(spark, rows, cols="open double, high double, low double, close double, volume double"):
    data = [("AAPL", D0 + dt.timedelta(days=i), *[None if v is None else float(v) for v in r], i)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, f"symbol string, date date, {cols}, load_seq long")


def _by_day(df):
    return {r["date"]: r for r in df.collect()}


def test_reference_cleaner_frame(spark):
    rows = [(100, 105, 95, 102, 1000), (101, 106, 96, 103, 2000), (None, 107, 97, 104, None),
            (103, 108, 110, 105, 4000), (104, 99, 98, 106, 5000)]
    out = _by_day(C.clean_bars(_frame(spark, rows)))
    assert len(out) == 5
    d3, d4, d5 = (out[D0 + dt.timedelta(days=i)] for i in (2, 3, 4))
    assert d3["open"] == 101 and d3["volume"] == 2000          # forward fill
    assert (d4["high"], d4["low"]) == (110, 103)                # swap, then low lowered to open
    assert d5["high"] == 106                                    # raised to open, then close
    for r in out.values():
        assert r["high"] >= max(r["open"], r["close"]) and r["low"] <= min(r["open"], r["close"])


def test_reference_negative_frame(spark):
    rows = [(100, 105, 95, 102), (-10, 106, 96, 103), (103, 107, -5, 104)]
    df = _frame(spark, rows, "open double, high double, low double, close double")
    out = _by_day(C.clean_bars(df))
    assert out[D0 + dt.timedelta(days=1)]["open"] == 10
    assert out[D0 + dt.timedelta(days=1)]["low"] == 10
    assert out[D0 + dt.timedelta(days=2)]["low"] == 5


def test_empty_frame_stays_empty(spark):
    df = _frame(spark, [])
    assert C.clean_bars(df).count() == 0


def test_clean_is_idempotent_and_fill_keeps_values(spark):
    from barworks.sources import fixtures as fx
    b = fx.bars_dirty(spark, "/root/testdata/sf0.001")
    once = C.clean_bars(b)
    twice = C.clean_bars(once)
    cols = ["symbol", "date", "open", "high", "low", "close", "volume"]
    assert once.select(*cols).exceptAll(twice.select(*cols)).count() == 0
    filled = C.fill_forward(b)
    j = b.alias("a").join(filled.alias("b"), ["symbol", "date", "load_seq"])
    assert j.filter(F.col("a.close").isNotNull() & (F.col("a.close") != F.col("b.close"))).count() == 0


def test_repair_bounds(spark):
    from barworks.sources import fixtures as fx
    r = C.ohlc_repair(fx.vendor_a(spark, "/root/testdata/sf0.001"))
    bad = r.filter((F.col("high") < F.greatest("open", "close")) | (F.col("low") > F.least("open", "close")))
    assert bad.count() == 0


def test_linear_edges(spark):
    rows = [(None, 1, 1, None, 1), (1, 1, 1, 10, 1), (None, 1, 1, None, 1), (3, 1, 1, 30, 1),
            (None, 1, 1, None, 1)]
    out = C.fill_linear(_frame(spark, rows), ["open", "close"]).orderBy("date").collect()
    assert [r["open"] for r in out] == [None, 1, 2, 3, 3]        # leading stays, trailing = last
    assert [r["close"] for r in out] == [None, 10, 20, 30, 30]


def test_outlier_caps_iqr(spark):
    rows = [(1, 1, 1, v, 1) for v in (10, 11, 12, 13, 1000)]
    out = C.cap_outliers(_frame(spark, rows), "iqr", cols=["close"]).agg(F.max("close")).first()[0]
    # q1 = 11, q3 = 13 -> upper bound 13 + 3 * 2 = 19
    assert out == 19


def test_negative_methods(spark):
    rows = [(-1, 2, 1, 2, 1), (5, 6, 4, 5, 1), (-2, 6, 4, 5, 1)]
    df = _frame(spark, rows)
    col = lambda m: [r["open"] for r in C.negative_prices(df, m).orderBy("date").collect()]
    assert col("absolute") == [1, 5, 2]
    assert col("previous") == [5, 5, 5]
    assert col("minimum") == [0.01, 5, 0.01]
    assert col("nan") == [None, 5, None]
