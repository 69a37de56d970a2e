"""Every registered query against its DuckDB twin on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from barworks.sources.tables import TABLES

SF = "/root/testdata/sf0.001"


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else f"{round(v, 6):.6f}"
    if isinstance(v, dict):
        return str({k: _norm(x) for k, x in sorted(v.items())})
    if isinstance(v, (list, tuple)):
        return str([_norm(x) for x in v])
    return str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.execute(entry.oracle_sql()[name])
    dcols = [d[0] for d in rel.description]
    assert sorted(sdf.columns) == sorted(dcols)
    order = sorted(sdf.columns)
    srows = sorted(tuple(_norm(r[c]) for c in order) for r in sdf.collect())
    drows = sorted(tuple(_norm(r[dcols.index(c)]) for c in order) for r in rel.fetchall())
    assert srows == drows


SPLIT_SET = ["daily_returns", "risk_metrics", "issue_summary", "clean_bars", "fill_linear",
             "volume_rolling_median", "tiered_impute", "integrity", "date_gaps", "strategy_signals"]


@pytest.mark.parametrize("name", SPLIT_SET)
def test_split_plan_matches_oracle(spark, con, name):
    """The session-wide split plan (weekly segments, 16-row halo blocks) gives
    the same rows as the SQL twin."""
    spark.conf.set("spark.barworks.series.split", "week")
    spark.conf.set("spark.barworks.series.block", "16")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.unset("spark.barworks.series.split")
        spark.conf.unset("spark.barworks.series.block")


LARGE_SET = ["daily_returns", "risk_metrics", "issue_summary", "clean_bars", "outliers_iqr", "fill_median", "interp_cubic",
             "tiered_impute", "date_gaps", "strategy_signals", "tick_issues"]


@pytest.mark.parametrize("name", LARGE_SET)
def test_plan_for_a_large_input_matches_oracle(spark, con, name):
    """What is chosen beyond a small input gives the same rows."""
    spark.conf.set("spark.barworks.small.input", "0")
    try:
        test_query_matches_oracle(spark, con, name)
    finally:
        spark.conf.unset("spark.barworks.small.input")
