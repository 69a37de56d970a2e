"""Warehouse quality queries (A3-A12, W2, J7, A9) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import quality as Q
from ..operators.views import latest
from ..sources import fixtures as fx
from .registry import query

_SEG = ("CASE CAST(substr(symbol, 2) AS BIGINT) % 3 WHEN 0 THEN 'large_cap' "
        "WHEN 1 THEN 'mid_cap' ELSE 'small_cap' END")
_BOTH = [("both_src", "SELECT * FROM vendor_a UNION ALL SELECT * FROM bars_b")]


@query("coverage_stats", """
SELECT count(DISTINCT symbol) AS unique_symbols, count(*) AS total_records,
       min(date) AS earliest_date, max(date) AS latest_date, count(DISTINCT date) AS unique_dates
FROM bars""", ("bars",))
def coverage_stats(spark, sf_dir):
    """A3."""
    return Q.coverage_stats(fx.bars(spark, sf_dir))


_A4 = """
SELECT symbol, count(*) AS record_count,
       count_if(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) AS null_ohlc_count,
       count_if(volume IS NULL OR volume = 0) AS zero_volume_count,
       min(date) AS first_date, max(date) AS last_date
FROM bars_dirty GROUP BY symbol"""


@query("quality_by_symbol", _A4, ("bars_dirty",))
def quality_by_symbol(spark, sf_dir):
    """A4 on the faulty bars."""
    return Q.quality_by_symbol(fx.bars_dirty(spark, sf_dir))


@query("quality_score", """
SELECT * EXCLUDE (sn, sz), coalesce(sn * 100, 0.0) AS null_ohlc_percentage, coalesce(sz * 100, 0.0) AS zero_volume_percentage,
       CASE WHEN total_symbols > 0 THEN greatest(0.0, 100 - sn * 50 - sz * 30) ELSE 0.0 END AS quality_score
FROM (SELECT *, CASE WHEN total_symbols = 0 THEN NULL ELSE symbols_with_null_ohlc / total_symbols END AS sn,
             CASE WHEN total_symbols = 0 THEN NULL ELSE symbols_with_zero_volume / total_symbols END AS sz
      FROM (SELECT count(*) AS total_symbols, count_if(null_ohlc_count > 0) AS symbols_with_null_ohlc,
                   count_if(zero_volume_count > 0) AS symbols_with_zero_volume FROM a4))""",
       ("bars_dirty",), extra=[("a4", _A4)],
       doubles="null_ohlc_percentage zero_volume_percentage quality_score")
def quality_score(spark, sf_dir):
    """A5."""
    return Q.quality_score(fx.bars_dirty(spark, sf_dir))


@query("updated_yesterday", """
SELECT count(DISTINCT symbol) AS symbols_updated_yesterday,
       count(DISTINCT symbol) < 50 AS below_threshold
FROM bars_b WHERE date = (SELECT max(date) FROM bars_b) - INTERVAL 1 DAY""", ("bars_b",))
def updated_yesterday(spark, sf_dir):
    """A6."""
    b = fx.bars_b(spark, sf_dir)
    return Q.updated_on(b, F.date_sub(latest(b, "date"), 1))


_GAPS = """
SELECT symbol, count(*) AS gap_count FROM (
  SELECT symbol, date_diff('day', lag(date) OVER (PARTITION BY symbol ORDER BY date), date) AS gap_days
  FROM {src} WHERE date >= (SELECT max(date) FROM {src}) - INTERVAL 30 DAY)
WHERE gap_days > 3 GROUP BY symbol"""


@query("date_gaps", _GAPS.format(src="bars_b"), ("bars_b",))
def date_gaps(spark, sf_dir):
    """W2 on the secondary vendor (it drops days)."""
    b = fx.bars_b(spark, sf_dir)
    return Q.date_gaps(b, latest(b, "date"))


_DUPS = """
SELECT symbol, date, count(*) AS duplicate_count FROM bars_dirty
WHERE date >= (SELECT max(date) FROM bars_dirty) - INTERVAL 7 DAY
GROUP BY symbol, date HAVING count(*) > 1"""


@query("duplicate_keys", _DUPS, ("bars_dirty",))
def duplicate_keys(spark, sf_dir):
    """A7."""
    return Q.duplicate_keys(fx.bars_dirty(spark, sf_dir), fx.event_day_as_of(spark, sf_dir))


@query("quality_checks", """
SELECT 'symbols_updated_yesterday' AS check_name, count(DISTINCT symbol) AS value,
       count(DISTINCT symbol) >= 50 AS passed
FROM bars_dirty WHERE date = (SELECT max(date) FROM bars_dirty) - INTERVAL 1 DAY
UNION ALL SELECT 'symbols_with_gaps', count(*), count(*) = 0 FROM gaps
UNION ALL SELECT 'duplicate_groups', count(*), count(*) = 0 FROM dups""", ("bars_dirty",),
       extra=[("gaps", _GAPS.format(src="bars_dirty")), ("dups", _DUPS)])
def quality_checks(spark, sf_dir):
    """A8."""
    return Q.quality_checks(fx.bars_dirty(spark, sf_dir), fx.event_day_as_of(spark, sf_dir))


@query("latest_date", """
SELECT symbol, max(date) AS latest_date FROM bars_b GROUP BY symbol
UNION ALL SELECT CAST(NULL AS VARCHAR), max(date) FROM bars_b""", ("bars_b",))
def latest_date(spark, sf_dir):
    """A10."""
    return Q.latest_date(fx.bars_b(spark, sf_dir))


@query("segment_validation", f"""
SELECT {_SEG} AS segment, count(*) AS total_rows, count(DISTINCT symbol) AS unique_symbols,
       min(date) AS earliest_date, max(date) AS latest_date, count(DISTINCT source) AS sources
FROM both_src GROUP BY 1""", ("vendor_a", "bars_b"), extra=_BOTH)
def segment_validation(spark, sf_dir):
    """A11."""
    return Q.segment_validation(fx.both_vendors(spark, sf_dir).withColumn("segment", fx.segment_of()))


@query("history_completeness", """
SELECT count(DISTINCT symbol) AS unique_symbols, count(*) AS total_records,
       min(date) AS earliest_date, max(date) AS latest_date, count(DISTINCT date) AS unique_dates,
       max(date) < (SELECT max(CAST(ts AS DATE)) FROM events) AS has_gap
FROM bars_b""", ("bars_b",))
def history_completeness(spark, sf_dir):
    """Expected latest = newest event day."""
    from ..sources.tables import table
    e = table(spark, sf_dir, "events", "ts")
    return Q.history_completeness(fx.bars_b(spark, sf_dir), e.agg(F.max(F.to_date("ts"))).scalar())


@query("signal_performance", """
SELECT s.strategy AS strategy_name, s.confidence, count(*) AS total_signals,
       avg(p.pnl) AS avg_paper_pnl, avg(m.pnl) AS avg_manual_pnl,
       CASE WHEN count(p.pnl) = 0 THEN NULL ELSE count_if(p.pnl > 0) / count(p.pnl) END * 100
         AS paper_win_rate,
       CASE WHEN count(m.pnl) = 0 THEN NULL ELSE count_if(m.pnl > 0) / count(m.pnl) END * 100
         AS manual_win_rate
FROM signals s LEFT JOIN paper_trades p ON s.signal_id = p.signal_id
LEFT JOIN manual_trades m ON s.signal_id = m.signal_id
WHERE s.timestamp >= (SELECT max(timestamp) FROM signals) - INTERVAL 30 DAY
GROUP BY s.strategy, s.confidence""", ("signals", "paper_trades", "manual_trades"),
       doubles="confidence avg_paper_pnl avg_manual_pnl paper_win_rate manual_win_rate")
def signal_performance(spark, sf_dir):
    """J7 + A9."""
    s = fx.signals(spark, sf_dir)
    return Q.signal_performance(s, fx.paper_trades(spark, sf_dir), fx.manual_trades(spark, sf_dir),
                                latest(s, "timestamp"))


_RUN = "(dayofmonth(date) - 1) // 11"


@query("ingestion_log", f"""
SELECT run, min(first) AS start_date, max(last) AS end_date, CAST(sum(n) AS BIGINT) AS records_count, count(*) AS symbols_count,
       greatest(0.0, 100 - 50.0 * count_if(nulls > 0) / count(*) - 30.0 * count_if(zeros > 0) / count(*)) AS run_score,
       any_value(quality_score) AS quality_score, any_value(total_symbols) AS total_symbols, 'kiteconnect' AS source
FROM (SELECT {_RUN} AS run, symbol, CAST(count(*) AS BIGINT) AS n, min(date) AS first, max(date) AS last,
             count_if(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) AS nulls,
             count_if(coalesce(volume, 0) = 0) AS zeros FROM bars_dirty GROUP BY ALL)
JOIN (SELECT run, count(*) AS total_symbols,
             greatest(0.0, 100 - 50.0 * count_if(nulls > 0) / count(*) - 30.0 * count_if(zeros > 0) / count(*)) AS quality_score
      FROM (SELECT r.run, symbol, count_if(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL) AS nulls,
                   count_if(coalesce(volume, 0) = 0) AS zeros
            FROM (SELECT unnest([0, 1, 2]) AS run) r JOIN bars_dirty ON {_RUN} <= r.run GROUP BY ALL)
      GROUP BY run) USING (run)
GROUP BY run""", ("bars_dirty",), doubles="run_score quality_score")
def ingestion_log(spark, sf_dir):
    """Quality score per ingestion run (the month in three runs): each run adds its own aggregates;
    the score so far equals one pass over all rows up to the run."""
    from ..operators import ingestion as G
    from ..sources.io import remove_path
    from ..streaming.quotes import scratch
    bars = fx.bars_dirty(spark, sf_dir)
    path = scratch(spark, "ingestion")
    for run in range(3):
        rows = bars.filter(F.expr("(dayofmonth(date) - 1) div 11") == run)
        G.log_run(rows, path, run, F.current_timestamp(), fx.PRIMARY_SOURCE)
    log = G.ingestion_log(spark, path).drop("created_at").checkpoint()
    remove_path(spark, path)
    return log
