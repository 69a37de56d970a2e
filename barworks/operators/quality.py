"""Warehouse quality queries.

All are aggregates with partial (map-side) aggregation; the ratios of the
second level stay in the plan as another aggregate over the per-symbol rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import safe_div
from ..functions.series import with_prev

# Thresholds of the daily quality checks.
MIN_SYMBOLS_UPDATED = 50
GAP_DAYS = 3
GAP_LOOKBACK_DAYS = 30
DUPLICATE_LOOKBACK_DAYS = 7
NULL_WEIGHT, ZERO_WEIGHT = 50, 30


def coverage_stats(bars: DataFrame) -> DataFrame:
    """A3."""
    return bars.agg(F.count_distinct("symbol").alias("unique_symbols"),
                    F.count(F.lit(1)).alias("total_records"),
                    F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"),
                    F.count_distinct("date").alias("unique_dates"))


def quality_by_symbol(bars: DataFrame) -> DataFrame:
    """A4."""
    any_null = (F.col("open").isNull() | F.col("high").isNull() | F.col("low").isNull()
                | F.col("close").isNull())
    return bars.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(any_null).alias("null_ohlc_count"),
        F.count_if(F.col("volume").isNull() | (F.col("volume") == 0)).alias("zero_volume_count"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def quality_score(bars: DataFrame) -> DataFrame:
    """A5: share of symbols with NULL OHLC / zero volume and the score
    max(0, 100 - 50*share_null - 30*share_zero); no symbols -> score 0."""
    return score_of(quality_by_symbol(bars))


def score_of(q: DataFrame) -> DataFrame:
    """A5 from rows of A4, one per symbol."""
    s = q.agg(F.count(F.lit(1)).alias("total_symbols"),
              F.count_if(F.col("null_ohlc_count") > 0).alias("symbols_with_null_ohlc"),
              F.count_if(F.col("zero_volume_count") > 0).alias("symbols_with_zero_volume"))
    n = F.col("total_symbols")
    share_null = safe_div(F.col("symbols_with_null_ohlc"), n)
    share_zero = safe_div(F.col("symbols_with_zero_volume"), n)
    return s.select("*",
                    F.coalesce(share_null * 100, F.lit(0.0)).alias("null_ohlc_percentage"),
                    F.coalesce(share_zero * 100, F.lit(0.0)).alias("zero_volume_percentage"),
                    F.when(n > 0, F.greatest(F.lit(0.0), 100 - share_null * NULL_WEIGHT
                                             - share_zero * ZERO_WEIGHT))
                     .otherwise(F.lit(0.0)).alias("quality_score"))


def updated_on(bars: DataFrame, day: Column) -> DataFrame:
    """Symbols with a bar on ``day`` (the day before as_of); flag below 50."""
    c = bars.filter(F.col("date") == day).agg(
        F.count_distinct("symbol").alias("symbols_updated_yesterday"))
    return c.withColumn("below_threshold",
                        F.col("symbols_updated_yesterday") < MIN_SYMBOLS_UPDATED)


def date_gaps(bars: DataFrame, as_of: Column, days: int = GAP_LOOKBACK_DAYS,
              gap: int = GAP_DAYS) -> DataFrame:
    """Per symbol, gaps longer than ``gap`` days within the last ``days``."""
    b = bars.filter(F.col("date") >= F.date_sub(as_of, days)).select("symbol", "date")
    b = with_prev(b, ["symbol"], ["date"], ["date"])
    g = b.select("symbol", F.datediff("date", "prev_date").alias("gap_days"))
    return g.filter(F.col("gap_days") > gap).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("gap_count"))


def duplicate_keys(bars: DataFrame, as_of: Column, days: int = DUPLICATE_LOOKBACK_DAYS) -> DataFrame:
    """(symbol, date) groups with more than one row in the last ``days``."""
    b = bars.filter(F.col("date") >= F.date_sub(as_of, days))
    return (b.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("duplicate_count"))
             .filter(F.col("duplicate_count") > 1))


def quality_checks(bars: DataFrame, as_of: Column) -> DataFrame:
    """The three daily checks as one issues frame with a pass flag.

    All three come from ONE count per (symbol, date) over the last 30 days:
    symbols with a row on the day before as_of, (symbol, date) groups with
    more than one row in the last 7 days, and symbols with a gap of more than
    3 days between consecutive distinct dates (duplicate rows only add
    zero-day gaps, so distinct dates give the same gaps as rows)."""
    recent = bars.filter(F.col("date") >= F.date_sub(as_of, GAP_LOOKBACK_DAYS))
    days = recent.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("_n"))
    days = with_prev(days, ["symbol"], ["date"], ["date"])
    per = days.groupBy("symbol").agg(
        F.max(F.col("date") == F.date_sub(as_of, 1)).alias("_upd"),
        F.count_if((F.col("_n") > 1) & (F.col("date") >= F.date_sub(as_of, DUPLICATE_LOOKBACK_DAYS)))
         .alias("_dups"),
        F.count_if(F.datediff("date", "prev_date") > GAP_DAYS).alias("_gaps"))
    t = per.agg(F.count_if("_upd").alias("upd"), F.count_if(F.col("_gaps") > 0).alias("gaps"),
                F.sum("_dups").cast("bigint").alias("dups"))
    return t.selectExpr(
        f"stack(3, 'symbols_updated_yesterday', upd, upd >= {MIN_SYMBOLS_UPDATED}, "
        "'symbols_with_gaps', gaps, gaps = 0, 'duplicate_groups', dups, dups = 0) "
        "AS (check_name, value, passed)")


def latest_date(bars: DataFrame) -> DataFrame:
    """A10: newest date per symbol plus one overall row (symbol NULL)."""
    per = bars.groupBy("symbol").agg(F.max("date").alias("latest_date"))
    overall = per.agg(F.max("latest_date").alias("latest_date")).select(
        F.lit(None).cast("string").alias("symbol"), "latest_date")
    return per.unionByName(overall)


def segment_validation(bars: DataFrame) -> DataFrame:
    """Per segment rows, symbols, first/last date and sources."""
    return bars.groupBy("segment").agg(
        F.count(F.lit(1)).alias("total_rows"), F.count_distinct("symbol").alias("unique_symbols"),
        F.min("date").alias("earliest_date"), F.max("date").alias("latest_date"),
        F.count_distinct("source").alias("sources"))


def history_completeness(bars: DataFrame, expected_latest: Column) -> DataFrame:
    """A3 plus a gap flag when the newest date is older than expected."""
    return coverage_stats(bars).withColumn("has_gap", F.col("latest_date") < expected_latest)


def signal_performance(signals: DataFrame, paper: DataFrame, manual: DataFrame,
                       as_of: Column, days: int = 30) -> DataFrame:
    """J7 + A9: signals LEFT JOIN paper LEFT JOIN manual on signal_id (fan-out
    kept, as in the reference SQL), then per strategy and confidence."""
    s = signals.filter(F.col("timestamp") >= as_of - F.make_dt_interval(days=F.lit(days)))
    p = paper.select("signal_id", F.col("pnl").alias("paper_pnl"))
    m = manual.select("signal_id", F.col("pnl").alias("manual_pnl"))
    j = s.join(p, "signal_id", "left").join(m, "signal_id", "left")

    def win(c):
        return safe_div(F.count_if(F.col(c) > 0), F.count(c)) * 100
    return j.groupBy(F.col("strategy").alias("strategy_name"), "confidence").agg(
        F.count(F.lit(1)).alias("total_signals"),
        F.avg("paper_pnl").alias("avg_paper_pnl"), F.avg("manual_pnl").alias("avg_manual_pnl"),
        win("paper_pnl").alias("paper_win_rate"), win("manual_pnl").alias("manual_win_rate"))
