"""Report queries (A23-A27, V30) and their SQL twins."""

from __future__ import annotations

from ..operators import checks as V
from ..operators import quality as Q
from ..operators import reports as Rp
from ..sources import fixtures as fx
from .registry import query

_SEGMENTS = """
SELECT a.segment, a.symbols_requested, a.symbols_successful,
       a.symbols_requested - a.symbols_successful AS symbols_failed,
       CAST(a.total_records AS BIGINT) AS total_records,
       CASE WHEN a.symbols_requested - a.symbols_successful = 0 THEN 'completed' ELSE 'partial' END
         AS status,
       coalesce(l.failed_symbols, CAST([] AS VARCHAR[])) AS failed_symbols
FROM (SELECT segment, count(DISTINCT symbol) AS symbols_requested,
             count(DISTINCT CASE WHEN status = 'success' THEN symbol END) AS symbols_successful,
             coalesce(sum(CASE WHEN status = 'success' THEN records END), 0) AS total_records
      FROM run_log GROUP BY segment) a
LEFT JOIN (SELECT segment, list(symbol ORDER BY symbol) AS failed_symbols FROM (
             SELECT segment, symbol, row_number() OVER (PARTITION BY segment ORDER BY symbol) AS rn
             FROM (SELECT DISTINCT segment, symbol FROM run_log WHERE status <> 'success'))
           WHERE rn <= 10 GROUP BY segment) l USING (segment)"""


@query("segment_report", _SEGMENTS, ("run_log",))
def segment_report(spark, sf_dir):
    """A23 + A24 per segment."""
    return Rp.segment_report(fx.run_log(spark, sf_dir))


@query("pipeline_report", """
SELECT *, CASE WHEN total_failed = 0 THEN 'completed successfully'
               WHEN success_rate >= 90 THEN 'completed with minor issues'
               ELSE 'completed with significant issues' END AS verdict
FROM (SELECT *, coalesce(CASE WHEN total_symbols = 0 THEN NULL
                              ELSE total_successful * 100.0 / total_symbols END, 0.0) AS success_rate
      FROM (SELECT CAST(sum(symbols_requested) AS BIGINT) AS total_symbols,
                   CAST(sum(symbols_successful) AS BIGINT) AS total_successful,
                   CAST(sum(symbols_failed) AS BIGINT) AS total_failed FROM seg))""",
       ("run_log",), doubles="success_rate", extra=[("seg", _SEGMENTS)])
def pipeline_report(spark, sf_dir):
    """A24 totals and verdict."""
    return Rp.pipeline_report(fx.run_log(spark, sf_dir))


@query("pull_counts", """
SELECT count(*) AS symbols_attempted, count_if(status = 'success') AS successful,
       count_if(status = 'no_data') AS no_data,
       count_if(status = 'validation_failed') AS validation_failed,
       CAST(coalesce(sum(CASE WHEN status = 'success' THEN records END), 0) AS BIGINT)
         AS records_inserted
FROM run_log""", ("run_log",))
def pull_counts(spark, sf_dir):
    """A25."""
    return Rp.pull_counts(fx.run_log(spark, sf_dir))


_PATTERN = ("concat(error_type, ':', array_to_string(string_split_regex("
            "regexp_replace(message, '^\\s+|\\s+$', '', 'g'), '\\s+')[1:5], ' '))")


@query("error_patterns", f"""
SELECT b.pattern, b.count, b.first_seen, b.last_seen, e.examples
FROM best b LEFT JOIN (
  SELECT pattern, list(message ORDER BY timestamp, message) AS examples FROM (
    SELECT k.*, row_number() OVER (PARTITION BY pattern ORDER BY timestamp, message) AS rn
    FROM keyed k WHERE pattern IN (SELECT pattern FROM best)) WHERE rn <= 3 GROUP BY pattern) e
USING (pattern)""", ("error_log",), extra=[
    ("keyed", f"SELECT *, {_PATTERN} AS pattern FROM error_log"),
    ("best", "SELECT pattern, count(*) AS count, min(timestamp) AS first_seen, "
             "max(timestamp) AS last_seen FROM keyed GROUP BY pattern "
             "ORDER BY count DESC, first_seen, pattern LIMIT 10")])
def error_patterns(spark, sf_dir):
    """A27 top 10 patterns (O2) with up to three examples (O3)."""
    return Rp.error_patterns(fx.error_log(spark, sf_dir))


@query("error_totals", f"""
SELECT count(*) AS total_errors, count(DISTINCT {_PATTERN}) AS unique_patterns FROM error_log""",
       ("error_log",))
def error_totals(spark, sf_dir):
    """A27 totals."""
    return Rp.error_totals(fx.error_log(spark, sf_dir))


@query("weekly_report", """
SELECT (SELECT count(DISTINCT tradingsymbol) FROM instruments) AS universe_size,
       c.*, (SELECT CASE WHEN count(*) > 0 THEN greatest(0.0,
                 100 - count_if(n_null > 0) / count(*) * 50 - count_if(n_zero > 0) / count(*) * 30)
                 ELSE 0.0 END
             FROM (SELECT symbol, count_if(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL)
                          AS n_null, count_if(volume IS NULL OR volume = 0) AS n_zero
                   FROM bars_dirty GROUP BY symbol)) AS quality_score
FROM (SELECT count(DISTINCT symbol) AS unique_symbols, count(*) AS total_records,
             min(date) AS earliest_date, max(date) AS latest_date,
             count(DISTINCT date) AS unique_dates FROM bars) c""",
       ("instruments", "bars", "bars_dirty"), doubles="quality_score")
def weekly_report(spark, sf_dir):
    """Universe size, coverage (A3) and quality score (A5) in one row."""
    u = fx.instruments(spark, sf_dir).withColumnRenamed("tradingsymbol", "symbol")
    return Rp.weekly_report(u, Q.coverage_stats(fx.bars(spark, sf_dir)),
                            Q.quality_score(fx.bars_dirty(spark, sf_dir)))


_J = ", ".join(f"""count_if(CASE WHEN p_{c} = 0 THEN CASE WHEN f_{c} <> 0 THEN CAST('inf' AS DOUBLE) END
                 ELSE abs(f_{c} / p_{c} - 1) END > 0.2) AS jumps_{c}""" for c in ("open", "high", "low", "close"))
_FF = ", ".join(f"last_value({c} IGNORE NULLS) OVER (PARTITION BY symbol, source ORDER BY date, load_seq "
                f"ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f_{c}" for c in ("open", "high", "low", "close"))
_LAG = ", ".join(f"lag(f_{c}) OVER (PARTITION BY symbol, source ORDER BY date, load_seq) AS p_{c}"
                 for c in ("open", "high", "low", "close"))


@query("integrity", f"""
SELECT a.symbol, a.source, a.row_count, a.row_count >= 20 AS enough_rows,
       CAST(coalesce(d.duplicate_count, 0) AS BIGINT) AS duplicate_count, a.missing_value_count,
       a.missing_value_count / (a.row_count * 5) AS missing_share,
       a.jumps_open, a.jumps_high, a.jumps_low, a.jumps_close,
       a.min_present > 0 AND a.row_count >= 20 AND a.missing_value_count / (a.row_count * 5) <= 0.05
         AS is_valid
FROM (SELECT symbol, source, count(*) AS row_count,
             CAST(sum((open IS NULL)::INT + (high IS NULL)::INT + (low IS NULL)::INT
                      + (close IS NULL)::INT + (volume IS NULL)::INT) AS BIGINT) AS missing_value_count,
             least(count(open), count(high), count(low), count(close), count(volume)) AS min_present,
             {_J}
      FROM (SELECT *, {_LAG} FROM (SELECT *, {_FF} FROM bars_dirty))
      GROUP BY symbol, source) a
LEFT JOIN (SELECT symbol, source, sum(n - 1) AS duplicate_count FROM (
             SELECT symbol, source, count(*) AS n FROM bars_dirty
             GROUP BY symbol, source, date, open, high, low, close, volume) GROUP BY symbol, source) d
USING (symbol, source)""", ("bars_dirty",), doubles="missing_share")
def integrity(spark, sf_dir):
    """V30 on the faulty bars."""
    return V.integrity(fx.bars_dirty(spark, sf_dir))
