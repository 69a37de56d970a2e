"""Shaping queries (P1-P22) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shape as P
from ..operators.views import latest
from ..sources import fixtures as fx
from ..sources.tables import table
from .registry import query

D = "open high low close volume"


def _vendor_frame(spark, sf_dir):
    """The second vendor as landed: vendor column names, text dates, suffixed tickers."""
    b = fx.bars_b(spark, sf_dir)
    return b.select(P.add_suffix("symbol").alias("Ticker"),
                    F.date_format("date", "yyyy-MM-dd").alias("Date"),
                    F.col("open").alias("Open"), F.col("high").alias("High"),
                    F.col("low").alias("Low"), F.col("close").alias("Close"),
                    F.col("close").alias("Adj Close"), F.col("volume").alias("Volume"))


@query("standardize", """
SELECT regexp_replace(concat(symbol, '.NS'), '\\.NS$', '') AS symbol, date, open, high, low, close,
       close AS adj_close, volume
FROM bars_b""", ("bars_b",), doubles=D + " adj_close")
def standardize(spark, sf_dir):
    """P1 on a vendor-shaped frame."""
    return P.standardize(_vendor_frame(spark, sf_dir))


@query("keep_last", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date
                                                           ORDER BY load_seq DESC) AS rn
                            FROM bars_dirty) WHERE rn = 1""", ("bars_dirty",), doubles=D)
def keep_last(spark, sf_dir):
    """P2."""
    return P.keep_last_per_date(fx.bars_dirty(spark, sf_dir))


_SEG = ("CASE CAST(substr(symbol, 2) AS BIGINT) % 3 WHEN 0 THEN 'large_cap' "
        "WHEN 1 THEN 'mid_cap' ELSE 'small_cap' END")


@query("segment_shape", f"""
SELECT symbol, date, TIMESTAMP '2024-01-31 00:00:00' AS timestamp, open, high, low, close, volume,
       close AS adjusted_close, 'Unknown' AS sector,
       CASE WHEN contains(t, 'large_cap') THEN 'large_cap' WHEN contains(t, 'mid_cap') THEN 'mid_cap'
            ELSE 'small_cap' END AS market_cap_segment,
       'yfinance' AS data_source, 1.0::DOUBLE AS data_quality_score,
       TIMESTAMP '2024-01-31 00:00:00' AS created_at
FROM (SELECT *, concat({_SEG}, '_price_data') AS t FROM bars_b)""", ("bars_b",),
       doubles=D + " adjusted_close data_quality_score")
def segment_shape(spark, sf_dir):
    """Rows of the per-segment tables (segment from the table name)."""
    b = fx.bars_b(spark, sf_dir)
    return P.segment_shape(b, F.concat(fx.segment_of(), F.lit("_price_data")), "yfinance",
                           F.lit("2024-01-31 00:00:00").cast("timestamp_ntz"))


def _landed_text(spark, sf_dir):
    """Faulty bars landed as text: junk in open (k % 37) and date (k % 41)."""
    d = fx.bars_dirty(spark, sf_dir)
    k = F.col("load_seq")
    return d.select(
        "symbol",
        F.when(k % 41 == 0, F.lit("bad-date")).otherwise(F.col("date").cast("string")).alias("date"),
        F.when(k % 37 == 0, F.lit("n/a")).otherwise(F.col("open").cast("string")).alias("open"),
        *[F.col(c).cast("string").alias(c) for c in ("high", "low", "close", "volume")],
        "load_seq")


@query("coerce_dropna", """
SELECT symbol, date, open, high, low, close, volume, load_seq FROM (
  SELECT symbol, CASE WHEN load_seq % 41 = 0 THEN NULL ELSE date END AS date,
         CASE WHEN load_seq % 37 = 0 THEN NULL ELSE open END AS open, high, low, close, volume,
         load_seq FROM bars_dirty)
WHERE date IS NOT NULL AND close IS NOT NULL""", ("bars_dirty",), doubles=D)
def coerce_dropna(spark, sf_dir):
    """P4 on text-landed bars."""
    return P.coerce_dropna(_landed_text(spark, sf_dir))


@query("flatten_quotes", """
SELECT symbol, ts, coalesce(last_price, 0.0) AS last_price, coalesce(ohlc.open, 0.0) AS open,
       coalesce(ohlc.high, 0.0) AS high, coalesce(ohlc.low, 0.0) AS low,
       coalesce(ohlc.close, 0.0) AS close, coalesce(volume, 0.0) AS volume
FROM ticks""", ("ticks",), doubles=D + " last_price")
def flatten_quotes(spark, sf_dir):
    """P5."""
    return P.flatten_quotes(fx.ticks(spark, sf_dir))


@query("month_ranges", """
SELECT strategy_id, start_date, end_date, greatest(m, start_date) AS range_start,
       least(last_day(m), end_date) AS range_end
FROM (SELECT *, CAST(unnest(generate_series(date_trunc('month', start_date),
                                            date_trunc('month', end_date), INTERVAL 1 MONTH)) AS DATE) AS m
      FROM (SELECT strategy_id, min(CAST(backtest_date AS DATE)) AS start_date,
                   max(CAST(backtest_date AS DATE)) AS end_date
            FROM strategy_performance GROUP BY strategy_id))
WHERE greatest(m, start_date) <= end_date""", ("strategy_performance",))
def month_ranges(spark, sf_dir):
    """Each strategy's backtest span split into month ranges (inclusive end)."""
    p = fx.strategy_performance(spark, sf_dir)
    spans = p.groupBy("strategy_id").agg(F.min(F.to_date("backtest_date")).alias("start_date"),
                                         F.max(F.to_date("backtest_date")).alias("end_date"))
    return P.month_ranges(spans, "start_date", "end_date")


@query("symbol_range", """
SELECT * FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 14 DAY""", ("bars",),
       doubles=D)
def symbol_range(spark, sf_dir):
    """Open-ended date range over every symbol (start = as_of - 14 days)."""
    return P.date_range(fx.bars(spark, sf_dir), start=F.date_sub(fx.event_day_as_of(spark, sf_dir), 14))


@query("recent_rows", """
SELECT * FROM intraday_bars WHERE ts >= (SELECT max(ts) FROM intraday_bars) - INTERVAL 24 HOUR""",
       ("intraday_bars",), doubles=D)
def recent_rows(spark, sf_dir):
    """Last 24 hours of intraday rows before the newest row."""
    b = fx.intraday_bars(spark, sf_dir)
    return P.recent_rows(b, latest(b, "ts"), 24)


_SESSION = """
CASE WHEN isodow(ts) >= 6 THEN 'weekend'
     WHEN strftime(ts, '%H:%M:%S.%f') BETWEEN '09:15:00.000000' AND '15:30:00.000000' THEN 'regular'
     WHEN strftime(ts, '%H:%M:%S.%f') BETWEEN '09:00:00.000000' AND '09:15:00.000000' THEN 'pre_market'
     WHEN strftime(ts, '%H:%M:%S.%f') BETWEEN '15:40:00.000000' AND '16:00:00.000000' THEN 'post_market'
     ELSE 'closed' END"""


@query("session_label", f"""
SELECT event_id, ts, {_SESSION} AS session, {_SESSION} = 'regular' AS market_open FROM events""")
def session_label(spark, sf_dir):
    """P15 + P16 per event."""
    e = table(spark, sf_dir, "events", "event_id", "ts")
    return e.select("event_id", "ts", P.session_label("ts").alias("session"),
                    P.market_open("ts").alias("market_open"))


def _scored_signals(spark, sf_dir):
    s = fx.signals(spark, sf_dir)
    return s.withColumn("signal", F.col("confidence") * 2 - 1)


_DECISIONS = """
SELECT symbol, signal_id, timestamp, action, confidence, strategy, signal,
       CASE WHEN signal > 0.5 AND confidence > 0.6 THEN 'BUY'
            WHEN signal < -0.5 AND confidence > 0.6 THEN 'SELL' ELSE 'HOLD' END AS decision
FROM (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) AS rn
      FROM (SELECT *, confidence * 2 - 1 AS signal FROM signals)) WHERE rn = 1"""


@query("trading_decisions", _DECISIONS, ("signals",), doubles="confidence signal")
def trading_decisions(spark, sf_dir):
    """P20: latest signal per symbol -> BUY / SELL / HOLD."""
    return P.trading_decisions(_scored_signals(spark, sf_dir))


@query("position_size", """
SELECT d.*, p.price, CAST(floor(CASE WHEN p.price = 0 THEN NULL
                                     ELSE 100000.0 * 0.05 * d.confidence / p.price END) AS BIGINT)
                     AS quantity
FROM dec d JOIN (SELECT symbol, max_by(close, date) AS price FROM bars GROUP BY symbol) p USING (symbol)
WHERE d.decision = 'BUY' AND quantity > 0""", ("signals", "bars"),
       doubles="confidence signal price", extra=[("dec", _DECISIONS)])
def position_size(spark, sf_dir):
    """BUY decisions sized on cash 100000 at the latest close."""
    d = P.trading_decisions(_scored_signals(spark, sf_dir)).filter(F.col("decision") == "BUY")
    px = fx.bars(spark, sf_dir).groupBy("symbol").agg(F.max_by("close", "date").alias("price"))
    return P.position_size(d.join(px, "symbol"), F.lit(100000.0))


@query("exit_flags", """
SELECT symbol, entry_price, last_price,
       CASE WHEN entry_price = 0 THEN NULL ELSE (last_price - entry_price) / entry_price END AS pnl_pct,
       CASE WHEN (last_price - entry_price) / entry_price < -0.05 THEN 'stop_loss'
            WHEN (last_price - entry_price) / entry_price > 0.15 THEN 'take_profit' END AS exit_reason
FROM (SELECT symbol, min_by(close, date) AS entry_price FROM bars GROUP BY symbol)
JOIN (SELECT symbol, max_by(last_price, ts) AS last_price FROM ticks GROUP BY symbol) USING (symbol)""",
       ("bars", "ticks"), doubles="entry_price last_price pnl_pct")
def exit_flags(spark, sf_dir):
    """P22 + J10: positions opened at each symbol's first close, marked to the
    latest quote."""
    pos = fx.bars(spark, sf_dir).groupBy("symbol").agg(F.min_by("close", "date").alias("entry_price"))
    q = fx.ticks(spark, sf_dir).groupBy("symbol").agg(F.max_by("last_price", "ts").alias("last_price"))
    return P.exit_flags(pos, q).select("symbol", "entry_price", "last_price", "pnl_pct", "exit_reason")
