"""Plan guards: shapes that do not scale must not appear in any registered query."""

import re

import pytest

from barworks.plans import QUERIES

SF = "/root/testdata/sf0.001"
# a frame from the current (or a later) row to UNBOUNDED FOLLOWING is
# re-aggregated for every row by Spark: quadratic per partition
QUADRATIC_FRAME = re.compile(r"RowFrame, (currentrow\$\(\)|\d+), unboundedfollowing\$\(\)")


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("stream_")))
def test_no_quadratic_frames_or_cartesian(spark, name):
    plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert not QUADRATIC_FRAME.search(plan), name
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
    # Python runs on executors only in the F1 pandas-strategy query
    python_ops = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
                  "MapInArrow", "FlatMapGroupsInArrow")
    if name != "strategy_signals_pandas":
        assert not any(op in plan for op in python_ops), name
    else:
        assert "FlatMapGroupsInPandas" in plan


def test_guard_detects_the_quadratic_frame(spark):
    from pyspark.sql import functions as F
    from pyspark.sql.window import Window
    df = spark.range(10).withColumn("k", F.lit(1))
    w = Window.partitionBy("k").orderBy("id").rowsBetween(0, Window.unboundedFollowing)
    bad = df.withColumn("f", F.first("id", ignorenulls=True).over(w))
    assert QUADRATIC_FRAME.search(bad._jdf.queryExecution().executedPlan().toString())
