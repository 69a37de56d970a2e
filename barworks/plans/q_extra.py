"""Readers, writers, streams and helpers by themselves, each on whole derived tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.series import with_prev
from ..operators import clean as C
from ..operators import shape as P
from ..operators import ticks as T
from ..operators import views as Vw
from ..sources import fixtures as fx
from ..sources import io as S
from ..sources.tables import table
from ..streaming import quotes as K
from .q_shape import _landed_text
from .registry import query

D = "open high low close volume"
_BARS = ["symbol", "date", "open", "high", "low", "close", "volume", "load_seq"]


def _and_gone(spark, path, rows):
    """``rows`` of a scratch folder, kept in a checkpoint; the folder is removed."""
    K.checkpoint_dir(spark)
    rows = rows.checkpoint()
    S.remove_path(spark, path)
    return rows


@query("table_read", """
SELECT symbol, date, open, high, low, close, volume, load_seq FROM bars
WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""", ("bars",), doubles=D)
def table_read(spark, sf_dir):
    """Bars written by date and read back by range."""
    path = K.scratch(spark, "read")
    S.write_table(fx.bars(spark, sf_dir), path)
    return _and_gone(spark, path, S.read_bars(spark, path, start="2024-01-05", end="2024-01-20").select(*_BARS))


@query("table_daily_append", """
SELECT symbol, date, open, high, low, close, volume, load_seq FROM (
  SELECT symbol, CASE WHEN load_seq % 41 = 0 THEN NULL ELSE date END AS date,
         CASE WHEN load_seq % 37 = 0 THEN NULL ELSE open END AS open, high, low, close, volume, load_seq FROM bars_dirty)
WHERE date IS NOT NULL AND close IS NOT NULL""", ("bars_dirty",), doubles=D)
def table_daily_append(spark, sf_dir):
    """Bars landed as text, coerced, stamped and appended in two loads."""
    path = K.scratch(spark, "append")
    landed = _landed_text(spark, sf_dir)
    for odd in (0, 1):
        S.daily_append(landed.filter(F.col("load_seq") % 2 == odd), path, F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    return _and_gone(spark, path, spark.read.parquet(path).select(*_BARS))


@query("table_signals", """
SELECT CAST(signal_id AS VARCHAR) AS signal_id, symbol, action, confidence, strategy,
       TIMESTAMP '2024-02-01 09:00:00' AS created_at, CAST(timestamp AS DATE) AS date FROM signals""",
       ("signals",), doubles="confidence")
def table_signals(spark, sf_dir):
    """Signal rows cast to a table's schema, stamped and appended by day."""
    path = K.scratch(spark, "signals")
    rows = fx.signals(spark, sf_dir).withColumn("date", F.to_date("timestamp"))
    schema = spark.createDataFrame([], "signal_id string, symbol string, action string, confidence double, "
                                       "strategy string, created_at timestamp_ntz, date date").schema
    S.ensure_table(spark, path, schema)
    S.append_table(rows, path, schema, F.lit("2024-02-01 09:00:00"))
    return _and_gone(spark, path, S.read_table(spark, path, schema))


@query("table_expire", """
SELECT symbol, date, open, high, low, close, volume, load_seq FROM bars WHERE date >= DATE '2024-01-16'""",
       ("bars",), doubles=D)
def table_expire(spark, sf_dir):
    """Days before a cutoff dropped as whole partitions."""
    path = K.scratch(spark, "expire")
    S.write_table(fx.bars(spark, sf_dir), path)
    S.expire_partitions(spark, path, "2024-01-16")
    return _and_gone(spark, path, S.read_bars(spark, path).select(*_BARS))


@query("json_backup", "SELECT symbol, event_id, last_price, volume, CAST(ts AS DATE) AS date FROM ticks", ("ticks",),
       doubles="last_price volume")
def json_backup(spark, sf_dir):
    """Quotes backed up as JSON lines by day and read back."""
    path = K.scratch(spark, "backup")
    q = fx.ticks(spark, sf_dir).select("symbol", "event_id", "last_price", "volume", F.to_date("ts").alias("date"))
    S.backup_json(q, path)
    return _and_gone(spark, path, spark.read.schema(q.schema).json(path).select(*q.columns))


@query("universe_from_json", """
SELECT DISTINCT symbol FROM (
  SELECT tradingsymbol AS symbol FROM instruments
  UNION ALL SELECT concat('S', user_id) FROM events WHERE user_id % 31 = 0 AND user_id % 2 = 0)""", ("instruments",))
def universe_from_json(spark, sf_dir):
    """A universe file with one list per sector, read back, with custom symbols."""
    path = K.scratch(spark, "universe")
    listed = fx.instruments(spark, sf_dir).select(fx.sector_of("tradingsymbol").alias("sector"), "tradingsymbol")
    sectors = listed.groupBy("sector").agg(F.collect_list("tradingsymbol").alias("symbols"))
    doc = sectors.agg(F.map_from_entries(F.collect_list(F.struct("sector", "symbols"))).alias("sectors"))
    doc.select(F.to_json(F.struct("sectors")).alias("value")).coalesce(1).write.text(path)
    custom = table(spark, sf_dir, "events", "user_id").filter("user_id % 31 = 0 AND user_id % 2 = 0").select(
        F.concat(F.lit("S"), "user_id").alias("symbol"))
    found = S.trading_universe({"all": S.universe_symbols(spark, path)}, ["all"], custom)
    return _and_gone(spark, path, found)


@query("portfolio_columns", """
SELECT portfolio_id AS account, symbol || '.NS' AS ticker, position_date AS date, market_value AS value,
       unrealized_pnl AS pnl FROM portfolio_positions""", ("portfolio_positions",), doubles="value pnl")
def portfolio_columns(spark, sf_dir):
    """Field names mapped, the vendor's symbol suffix added."""
    p = fx.portfolio_positions(spark, sf_dir).select("portfolio_id", P.add_suffix("symbol").alias("tradingsymbol"),
                                                     "position_date", "market_value", "unrealized_pnl")
    return P.rename_portfolio(p, {"portfolio_id": "account", "tradingsymbol": "ticker", "position_date": "date",
                                  "market_value": "value", "unrealized_pnl": "pnl"})


@query("source_names", """
SELECT CASE doc.source WHEN 'web' THEN 'yahoo_finance' WHEN 'code' THEN 'nse_official' ELSE 'unknown' END AS source, count(*) AS n
FROM documents doc GROUP BY 1""")
def source_names(spark, sf_dir):
    """Source names as vendors write them, normalised and counted."""
    raw = (F.when(F.col("source") == "web", "YFinance").when(F.col("source") == "code", "NSE").otherwise(F.col("source")))
    d = table(spark, sf_dir, "documents", "source").select(P.normalise_source(raw).alias("source"))
    return d.groupBy("source").agg(F.count(F.lit(1)).alias("n"))


@query("tick_required", """
SELECT event_id, CASE WHEN event_id % 53 = 0 THEN NULL ELSE symbol END AS symbol, 'required_fields' AS "check",
       'error' AS level, false AS is_valid, field
FROM (SELECT *, 'symbol' AS field FROM ticks WHERE event_id % 53 = 0
      UNION ALL SELECT *, 'timestamp' FROM ticks WHERE event_id % 59 = 0)""", ("ticks",))
def tick_required(spark, sf_dir):
    """Quotes that lack a symbol or a time."""
    t = fx.ticks(spark, sf_dir).withColumns({"symbol": F.when(F.col("event_id") % 53 != 0, F.col("symbol")),
                                             "ts": F.when(F.col("event_id") % 59 != 0, F.col("ts"))})
    found = T.tick_issues(T.tick_results(t, fx.event_day_as_of(spark, sf_dir).cast("timestamp_ntz"),
                                         fx.tick_volumes(spark, sf_dir)))
    return found.filter("check = 'required_fields'").drop("ts", "value")


@query("tick_types", """
SELECT concat('S', user_id) AS symbol, 'data_types' AS "check", 'error' AS level, false AS is_valid, 'last_price' AS field
FROM events WHERE event_id % 43 = 0
UNION ALL
SELECT concat('S', user_id), 'timestamp', 'error', false, 'timestamp' FROM events WHERE event_id % 47 = 0""")
def tick_types(spark, sf_dir):
    """Quotes landed as text, some values of which don't parse."""
    e = table(spark, sf_dir, "events", "event_id", "user_id", "value", "ts")
    raw = e.select(F.concat(F.lit("S"), "user_id").alias("symbol"),
                   F.when(F.col("event_id") % 43 == 0, "n/a").otherwise(F.col("value").cast("string")).alias("last_price"),
                   F.when(F.col("event_id") % 47 == 0, "soon").otherwise(F.col("ts").cast("string")).alias("ts"))
    return T.raw_type_issues(raw).drop("value")


@query("stream_live_signals", "SELECT * EXCLUDE (strategy) FROM signals", ("signals",), doubles="confidence")
def stream_live_signals(spark, sf_dir):
    """K4: the live signal document of each signal, kept in a keyed table."""
    sig = K.signal_records(K.file_stream(spark, sf_dir, "events"))
    out, ck = K.scratch(spark, "live-signals"), K.scratch(spark, "ck-live-signals")
    K.live_signals(sig, out, ck).awaitTermination()
    return K.taken(spark, out, ck)


@query("new_dates", """
SELECT b.* FROM bars b LEFT JOIN (SELECT symbol, max(date) AS latest FROM bars
                                  WHERE date <= DATE '2024-01-15' AND load_seq % 3 <> 0 GROUP BY symbol) t USING (symbol)
WHERE t.latest IS NULL OR b.date > t.latest""", ("bars",), doubles=D)
def new_dates(spark, sf_dir):
    """K6: of all bars, those newer than what a table holds of their symbol."""
    b = fx.bars(spark, sf_dir)
    return K.new_dates_only(b, b.filter("date <= DATE'2024-01-15' AND load_seq % 3 <> 0"))


@query("impute_custom", """
SELECT symbol, date, open, high, low, coalesce(close, -1) AS close, coalesce(volume, -1) AS volume, load_seq, source
FROM vendor_a""", ("vendor_a",), doubles=D)
def impute_custom(spark, sf_dir):
    """The dispatcher with a function of the caller."""
    return C.impute(fx.vendor_a(spark, sf_dir), "custom", custom=lambda c: F.coalesce(c, F.lit(-1)))


@query("price_changes", """
SELECT symbol, date, lag(close) OVER w AS prev_close, close - lag(close) OVER w AS change,
       (open - lag(open) OVER w) / nullif(lag(open) OVER w, 0) AS open_pct,
       (close - lag(close) OVER w) / nullif(lag(close) OVER w, 0) AS close_pct,
       CAST(date_diff('day', lag(date) OVER w, date) AS INTEGER) AS days
FROM bars WINDOW w AS (PARTITION BY symbol ORDER BY date)""", ("bars",), doubles="prev_close change open_pct close_pct")
def price_changes(spark, sf_dir):
    """Previous close, changes and days since the previous bar, on monthly buckets."""
    b = with_prev(fx.bars(spark, sf_dir), ["symbol"], ["date"], ["date", "open", "close"], F.date_trunc("month", "date"))
    pct = {f"{c}_pct": F.try_divide(F.col(c) - F.col(f"prev_{c}"), F.col(f"prev_{c}")) for c in ("open", "close")}
    return b.select("symbol", "date", "prev_close", (F.col("close") - F.col("prev_close")).alias("change"),
                    *[x.alias(n) for n, x in pct.items()], F.datediff("date", "prev_date").alias("days"))


@query("price_newest_first", """
SELECT symbol, date, close FROM bars WHERE date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'""", ("bars",),
       doubles="close")
def price_newest_first(spark, sf_dir):
    """P10, O1: a range of days, newest first."""
    d = lambda x: F.lit(x).cast("date")
    return P.date_range(fx.bars(spark, sf_dir).select("symbol", "date", "close"), d("2024-01-10"), d("2024-01-20"),
                        newest_first=True)


@query("strategy_validation", """
SELECT strategy_id AS strategy, year(created_at) || '-Q' || quarter(created_at) AS time_period,
       max(CAST(created_at AS DATE)) AS validation_date, count(DISTINCT ticker) AS num_tickers,
       count_if(success) * 100.0 / count(*) AS success_rate, CAST(sum(CAST(total_return_pct AS DECIMAL(18, 6))) FILTER (success) AS DOUBLE) / count(total_return_pct) FILTER (success) AS avg_return,
       CAST(sum(CAST(sharpe_ratio AS DECIMAL(18, 6))) FILTER (success) AS DOUBLE) / count(sharpe_ratio) FILTER (success) AS avg_sharpe, max(max_drawdown_pct) FILTER (success) AS max_drawdown,
       CAST(sum(CAST(win_rate_pct AS DECIMAL(18, 6))) FILTER (success) AS DOUBLE) / count(win_rate_pct) FILTER (success) AS win_rate, count(*) AS total_backtest_runs,
       CAST(sum(CAST(avg_confidence AS DECIMAL(18, 6))) FILTER (success) AS DOUBLE) / count(avg_confidence) FILTER (success) AS confidence_score
FROM backtest_results GROUP BY 1, 2""", ("backtest_results",),
       doubles="success_rate avg_return avg_sharpe max_drawdown win_rate confidence_score")
def strategy_validation(spark, sf_dir):
    """Validation summary of strategies by quarter."""
    return Vw.strategy_validation(fx.backtest_results(spark, sf_dir))
