"""Exact per-group percentiles: brackets from bounded summaries equal Spark's percentile."""

import random

import pytest
from pyspark.sql import functions as F

from barworks.functions import quantiles as Q
from barworks.functions.quantiles import bracketed_percentiles, multi_percentiles

PS = [0.0, 0.01, 0.25, 0.5, 0.75, 0.99, 1.0]
NAMES = [f"p{int(100 * p)}" for p in PS]


def builtin(df):
    cols = [F.percentile(c, F.array(*[F.lit(p) for p in PS])).alias(c) for c in ("v", "w")]
    return {r["k"]: (r["v"], r["w"]) for r in df.groupBy("k").agg(*cols).collect()}


def same(df):
    spec = {"v": (PS, NAMES), "w": (PS, [f"w{n}" for n in NAMES])}
    got = {r["k"]: tuple(r)[1:] for r in bracketed_percentiles(df, ["k"], spec).collect()}
    want = builtin(df)
    empty = {k for k, (v, w) in want.items() if v is None and w is None}
    assert set(want) - empty <= set(got) <= set(want)
    for k, vals in got.items():
        flat = [*(want[k][0] or [None] * len(PS)), *(want[k][1] or [None] * len(PS))]
        for a, b in zip(vals, flat):
            assert (a is None) == (b is None) and (a is None or a == pytest.approx(b, rel=1e-12, abs=1e-12)), (k, vals, flat)


def test_percentiles_equal_builtin(spark):
    rnd = random.Random(11)
    rows = [("HOT", float(rnd.randint(0, 500)), rnd.uniform(0, 1)) for _ in range(3000)]
    rows += [(f"K{i % 7}", rnd.uniform(-5, 5), None if i % 3 else float(i)) for i in range(400)]
    rows += [("ONE", 42.0, None), ("NULLS", None, None), (None, 1.0, 2.0), (None, 3.0, 2.0)]
    same(spark.createDataFrame(rows, "k string, v double, w double"))


def test_large_groups_keep_only_their_brackets(spark):
    """Half a million distinct values in one key: the ranked rows are a small share of them."""
    df = spark.range(500_000, numPartitions=8).select(
        F.lit("A").alias("k"), F.pow((F.col("id") * 7919 % 500_000) / 1000.0, 3).alias("v"),
        (F.col("id") % 1000).cast("double").alias("w"))
    same(df)
    out = bracketed_percentiles(df, ["k"], {"v": ([0.25, 0.5], ["a", "b"])})
    assert "percentile(" not in out._jdf.queryExecution().executedPlan().toString()
    sizes = df.groupBy("k").agg(F.percentile_approx("v", [0.5 - Q.MARGIN, 0.5 + Q.MARGIN], Q.ACCURACY).alias("q"))
    lo, hi = sizes.first()["q"]
    assert df.filter(F.col("v").between(lo, hi)).count() < 500_000 * 4 * Q.MARGIN


@pytest.mark.parametrize("kind", ["equal", "skewed", "heavy tail"])
def test_odd_distributions(spark, kind):
    v = {"equal": F.lit(3.5), "skewed": F.when(F.col("id") % 100 < 99, 0.0).otherwise(F.col("id") * 1.0),
         "heavy tail": F.exp(F.col("id") / 700.0)}[kind]
    same(spark.range(200_000, numPartitions=5).select(F.lit("A").alias("k"), v.alias("v"), (-v).alias("w")))


def test_the_plan_follows_the_size_of_the_input(spark, tmp_dir):
    """A small file is read by the built-in aggregate; a large one, or an unknown size, by brackets."""
    import os
    path = os.path.join(tmp_dir, "v")
    spark.range(100).select(F.lit("A").alias("k"), F.col("id").cast("double").alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    spec = {"v": ([0.5], ["m"])}

    def plan(d):
        return multi_percentiles(d, ["k"], spec)._jdf.queryExecution().executedPlan().toString()
    assert "percentile(v" in plan(df)
    spark.conf.set("spark.barworks.small.input", "10")
    try:
        assert "percentile(v" not in plan(df) and multi_percentiles(df, ["k"], spec).first()["m"] == 49.5
    finally:
        spark.conf.unset("spark.barworks.small.input")
