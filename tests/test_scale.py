"""The choice of plans by the size of the input."""

import os

from pyspark.sql import functions as F

from barworks.functions import scale
from barworks.functions import series as S
from barworks.operators import reconcile as R
from barworks.operators import shape as P
from barworks.operators import views as Vw
from barworks.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def test_size_of_the_largest_input(spark, tmp_dir):
    bars, orders = fx.bars(spark, SF), fx.history(spark, SF)
    sizes = {n: os.path.getsize(f"{SF}/{n}.parquet") for n in ("events", "orders")}
    assert scale.largest_input(bars) == sizes["events"]
    assert scale.largest_input(bars.join(orders.select("date"), "date")) == max(sizes.values())
    assert scale.is_small(bars)
    assert not scale.is_small(bars.limit(1).checkpoint().join(spark.createDataFrame([("A",)], "symbol string"), "symbol"))


def test_series_are_cut_beyond_a_small_input(spark):
    bars = fx.bars(spark, SF)
    assert S._resolve(bars, ["date"], None) is None and S._resolve_block(bars, None) is None
    spark.conf.set(scale.SMALL_CONF, "1000")
    try:
        assert S._resolve(bars, ["date"], None) is not None and S._resolve_block(bars, None) == S.FRAME_BLOCK
        spark.conf.set(S.SPLIT_CONF, "none")
        assert S._resolve(bars, ["date"], None) is None
    finally:
        spark.conf.unset(scale.SMALL_CONF)
        spark.conf.unset(S.SPLIT_CONF)


def test_newest_first(spark):
    rows = P.date_range(fx.bars(spark, SF), newest_first=True).select("date", "symbol").collect()
    assert [r["date"] for r in rows] == sorted((r["date"] for r in rows), reverse=True)
    same = [r["symbol"] for r in rows if r["date"] == rows[0]["date"]]
    assert same == sorted(same)
    old = P.date_range(fx.bars(spark, SF), newest_first=False).select("date").collect()
    assert [r["date"] for r in old] == sorted(r["date"] for r in old)
    bt = [r["created_at"] for r in Vw.successful_backtests(fx.backtest_results(spark, SF), newest_first=True).collect()]
    assert bt == sorted(bt, reverse=True)


def test_tiered_fetch_from_the_other_vendor(spark):
    """cross_source fills a gap with the value of the vendor that was not chosen."""
    a, b = fx.vendor_a(spark, SF), fx.bars_b(spark, SF)
    got = R.tiered_fetch(a, b, "cross_source").filter("imputed").select("symbol", "date", "source", "close")
    other = {(r["symbol"], r["date"], r["source"]): r["close"] for df in (a, b) for r in df.collect()}
    filled = 0
    for r in got.collect():
        own = other[r["symbol"], r["date"], r["source"]]
        if own is None:
            rival = next((v for (s, d, src), v in other.items() if (s, d) == (r["symbol"], r["date"]) and src != r["source"]), None)
            assert r["close"] == rival
            filled += rival is not None
        else:
            assert r["close"] == own
    assert filled > 5


def test_small_inputs_are_known_before_any_job(spark):
    """Deciding reads file sizes only."""
    df = fx.bars(spark, SF).withColumn("x", F.raise_error(F.lit("evaluated")))
    assert scale.is_small(df)
