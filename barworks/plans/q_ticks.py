"""Quote validation queries (T1-T13) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ticks as T
from ..sources import fixtures as fx
from .registry import query

_TB = """
SELECT t.*, t.ohlc.open AS open, t.ohlc.high AS high, t.ohlc.low AS low, t.ohlc.close AS close,
       a.avg_volume,
       open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL
         AND volume IS NOT NULL AS full_ohlcv,
       CAST((SELECT max(CAST(ts AS DATE)) FROM ticks) AS TIMESTAMP) AS as_of,
       strftime(ts, '%H:%M:%S.%f') AS tod
FROM ticks t LEFT JOIN (SELECT symbol, avg(volume) AS avg_volume FROM ticks GROUP BY symbol) a
  USING (symbol)"""

_LIMIT = ("CASE category WHEN 'normal' THEN 0.20::DOUBLE WHEN 'et' THEN 0.10::DOUBLE "
          "WHEN 'etf' THEN 0.10::DOUBLE WHEN 'index' THEN 0.05::DOUBLE "
          "WHEN 'illiquid' THEN 0.05::DOUBLE ELSE 0.20::DOUBLE END")

_CHECKS = [
    ("required_fields", "error", "false", "symbol", "NULL", "symbol IS NULL"),
    ("required_fields", "error", "false", "timestamp", "NULL", "ts IS NULL"),
    ("ohlc", "error", "false", "high", "high", "full_ohlcv AND high < greatest(open, close)"),
    ("ohlc", "error", "false", "low", "low", "full_ohlcv AND low > least(open, close)"),
    *[("ohlc", "error", "false", c, c, f"full_ohlcv AND {c} <= 0") for c in ("open", "high", "low", "close")],
    ("price_range", "warning", "false", "price_range", "greatest(open, high, low, close)",
     "full_ohlcv AND greatest(open, high, low, close) > 100000"),
    ("price_range", "error", "false", "price_range", "least(open, high, low, close)",
     "full_ohlcv AND least(open, high, low, close) < 0.01"),
    ("volume", "error", "false", "volume", "volume", "volume < 0"),
    ("volume", "warning", "true", "volume", "volume",
     "avg_volume IS NOT NULL AND volume > avg_volume * 5.0"),
    ("circuit_breaker", "critical", "true", "circuit_breaker",
     "abs((close - previous_close) / previous_close)",
     f"close IS NOT NULL AND previous_close > 0 AND "
     f"abs((close - previous_close) / previous_close) >= {_LIMIT}"),
    ("timestamp", "warning", "false", "timestamp", "NULL", "ts > as_of + INTERVAL 300 SECOND"),
    ("market_hours", "info", "true", "market_hours", "NULL", "isodow(ts) >= 6"),
    ("market_hours", "warning", "true", "market_hours", "NULL",
     "NOT (isodow(ts) >= 6) AND ts IS NOT NULL AND NOT ("
     "(tod >= '09:15:00.000000' AND tod <= '15:30:00.000000') OR "
     "(tod >= '09:00:00.000000' AND tod < '09:15:00.000000') OR "
     "(tod >= '15:40:00.000000' AND tod <= '16:00:00.000000'))"),
    ("price_gap", "warning", "true", "price_gap", "abs((open - previous_close) / previous_close)",
     "open IS NOT NULL AND previous_close > 0 AND abs((open - previous_close) / previous_close) > 0.10"),
]

# Messages of the critical results and failed errors, by (check, field, value).
_MESSAGES = """CASE
WHEN "check" = 'required_fields' THEN 'Missing required field: ' || field
WHEN "check" = 'ohlc' AND value <= 0 AND NOT crossed THEN 'Non-positive price for ' || field
WHEN "check" = 'ohlc' AND field = 'high' THEN 'High price below open or close'
WHEN "check" = 'ohlc' THEN 'Low price above open or close'
WHEN "check" = 'price_range' THEN 'Extremely low price' WHEN "check" = 'volume' THEN 'Negative volume'
ELSE 'Circuit breaker limit reached' END"""

_TR = "\nUNION ALL\n".join(
    f"SELECT event_id, symbol, ts, '{c}' AS \"check\", '{lv}' AS level, {ok} AS is_valid, "
    f"'{f}' AS field, CAST({v} AS DOUBLE) AS value FROM tb WHERE {cond}"
    for c, lv, ok, f, v, cond in _CHECKS)


def _results(spark, sf_dir):
    as_of = fx.event_day_as_of(spark, sf_dir).cast("timestamp_ntz")
    return T.tick_results(fx.ticks(spark, sf_dir), as_of, fx.tick_volumes(spark, sf_dir))


# the same rows with the place of their check in the run
_TN = "\nUNION ALL\n".join(
    f"SELECT event_id, {n} AS nth, '{c}' AS \"check\", '{lv}' AS level, {ok} AS is_valid, '{f}' AS field, "
    f"CAST({v} AS DOUBLE) AS value, {n in (2, 3)} AS crossed FROM tb WHERE {cond}"
    for n, (c, lv, ok, f, v, cond) in enumerate(_CHECKS))


@query("tick_issues", _TR, ("ticks",), doubles="value", extra=[("tb", _TB)])
def tick_issues(spark, sf_dir):
    """One row per (quote, check result)."""
    return T.tick_issues(_results(spark, sf_dir))


@query("tick_summary", """
SELECT b.event_id, b.symbol, coalesce(r.total, 0) AS total_checks, coalesce(r.passed, 0) AS passed,
       coalesce(r.failed, 0) AS failed, coalesce(r.info, 0) AS info_count,
       coalesce(r.warning, 0) AS warning_count, coalesce(r.error, 0) AS error_count,
       coalesce(r.critical, 0) AS critical_count,
       CASE WHEN coalesce(r.total, 0) > 0 THEN r.passed * 100.0 / r.total ELSE 0.0 END AS success_rate,
       coalesce(r.failed, 0) = 0 AND coalesce(r.critical, 0) = 0 AS is_valid,
       coalesce(r.critical_issues, []::VARCHAR[]) AS critical_issues, coalesce(r.errors, []::VARCHAR[]) AS errors
FROM tb b LEFT JOIN (
  SELECT event_id, count(*) AS total, count_if(is_valid) AS passed, count_if(NOT is_valid) AS failed,
         count_if(level = 'info') AS info, count_if(level = 'warning') AS warning,
         count_if(level = 'error') AS error, count_if(level = 'critical') AS critical,
         list(message ORDER BY nth) FILTER (level = 'critical') AS critical_issues,
         list(message ORDER BY nth) FILTER (level = 'error' AND NOT is_valid) AS errors
  FROM tn GROUP BY event_id) r USING (event_id)""", ("ticks",), doubles="success_rate",
       extra=[("tb", _TB), ("tn", f"SELECT *, {_MESSAGES} AS message FROM ({_TN})")])
def tick_summary(spark, sf_dir):
    """T12-T13 per quote."""
    as_of = fx.event_day_as_of(spark, sf_dir).cast("timestamp_ntz")
    return T.quote_summary(fx.ticks(spark, sf_dir), as_of, fx.tick_volumes(spark, sf_dir))
