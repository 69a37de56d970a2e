"""The segmented (bucketed) series windows equal the one-window-per-key forms."""

import random

from pyspark.sql import functions as F

from barworks.functions import series as S


def _series(spark, n_sym=3, n=120, seed=7):
    rnd = random.Random(seed)
    rows = []
    for s in range(n_sym):
        for i in range(n):
            v = None if rnd.random() < 0.3 else round(rnd.uniform(1, 100), 2)
            rows.append((f"S{s}", i, v))
    return spark.createDataFrame(rows, "symbol string, t long, v double")


def _same(a, b, cols):
    x = sorted(tuple(r) for r in a.select("symbol", "t", *cols).collect())
    y = sorted(tuple(r) for r in b.select("symbol", "t", *cols).collect())
    assert x == y


def test_prev_fill_position_interp_split_equal(spark):
    df = _series(spark)
    bucket = F.floor(F.col("t") / 7)
    _same(S.with_prev(df, ["symbol"], ["t"], ["v"]), S.with_prev(df, ["symbol"], ["t"], ["v"], bucket),
          ["prev_v"])
    _same(S.with_next(df, ["symbol"], ["t"], ["v"]), S.with_next(df, ["symbol"], ["t"], ["v"], bucket),
          ["next_v"])
    for d in ("forward", "backward"):
        _same(S.fill(df, ["symbol"], ["t"], {"f": F.col("v")}, d),
              S.fill(df, ["symbol"], ["t"], {"f": F.col("v")}, d, bucket), ["f"])
    _same(S.with_position(df, ["symbol"], ["t"]), S.with_position(df, ["symbol"], ["t"], bucket=bucket),
          ["pos"])
    _same(S.interpolate_linear(df, ["symbol"], ["t"], ["v"]),
          S.interpolate_linear(df, ["symbol"], ["t"], ["v"], bucket), ["v"])


def test_first_n_matches_window(spark):
    from pyspark.sql.window import Window
    from barworks.operators.reports import first_n
    df = _series(spark, 4, 200).filter(F.col("v").isNotNull())
    got = first_n(df, ["symbol"], [F.col("v"), F.col("t")], 5, salt_buckets=16)
    w = Window.partitionBy("symbol").orderBy("v", "t")
    exp = df.withColumn("rank", F.row_number().over(w)).filter("rank <= 5")
    _same(got, exp, ["v", "rank"])


def test_rolling_halo_blocks_equal_plain(spark):
    df = _series(spark, 3, 150)

    def build(w):
        return {"m": F.percentile("v", 0.5).over(w.rowsBetween(-6, 0)),
                "l": F.lag("v", 7).over(w), "s": F.sum("v").over(w.rowsBetween(-7, 0))}
    plain = S.rolling(df, ["symbol"], ["t"], 7, build)
    split = S.rolling(df, ["symbol"], ["t"], 7, build, bucket=F.floor(F.col("t") / 20), block=9)
    _same(plain, split, ["m", "l", "s"])
