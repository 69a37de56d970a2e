"""View queries (W1, W3, A13-A22, J8-J9, P12-P13, U1) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import views as Vw
from ..sources import fixtures as fx
from .registry import query


@query("bars_build", "SELECT * FROM bars", ("bars",), doubles="open high low close volume")
def bars_build(spark, sf_dir):
    """Daily OHLCV bars mapped from events (FIXTURES 2.1)."""
    return fx.bars(spark, sf_dir)


@query("daily_returns", """
SELECT symbol, date, close, lag(close) OVER w AS prev_close,
       CASE WHEN lag(close) OVER w = 0 THEN NULL
            ELSE (close - lag(close) OVER w) / lag(close) OVER w END AS daily_return,
       volume, concat('SEC', CAST(substr(symbol, 2) AS BIGINT) % 7) AS sector
FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 2 YEAR
WINDOW w AS (PARTITION BY symbol ORDER BY date)""", ("bars",),
       doubles="close prev_close daily_return volume")
def daily_returns(spark, sf_dir):
    """W1."""
    return Vw.daily_returns(fx.bars(spark, sf_dir).withColumn("sector", fx.sector_of()),
                            fx.event_day_as_of(spark, sf_dir))


@query("daily_returns_split", """
SELECT symbol, date, close, lag(close) OVER w AS prev_close,
       CASE WHEN lag(close) OVER w = 0 THEN NULL
            ELSE (close - lag(close) OVER w) / lag(close) OVER w END AS daily_return,
       volume, concat('SEC', CAST(substr(symbol, 2) AS BIGINT) % 7) AS sector
FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 2 YEAR
WINDOW w AS (PARTITION BY symbol ORDER BY date)""", ("bars",),
       doubles="close prev_close daily_return volume")
def daily_returns_split(spark, sf_dir):
    """W1 with the series split into weekly buckets (the hot-symbol plan)."""
    return Vw.daily_returns(fx.bars(spark, sf_dir).withColumn("sector", fx.sector_of()),
                            fx.event_day_as_of(spark, sf_dir),
                            bucket=F.date_trunc("week", "date"))


_RISK_SQL = """
SELECT symbol, date, annualized_volatility, var_95, annualized_return,
       CASE WHEN annualized_volatility = 0 THEN NULL
            ELSE annualized_return / annualized_volatility END AS sharpe_ratio
FROM (
  SELECT symbol, date, stddev_samp(r) OVER w * sqrt(252.0) AS annualized_volatility,
         quantile_cont(r, 0.05) OVER w AS var_95, avg(r) OVER w * 252 AS annualized_return
  FROM (SELECT * FROM (
          SELECT symbol, date,
                 CASE WHEN lag(close) OVER p = 0 THEN NULL
                      ELSE (close - lag(close) OVER p) / lag(close) OVER p END AS r
          FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 252 DAY
          WINDOW p AS (PARTITION BY symbol ORDER BY date)) WHERE r IS NOT NULL)
  WINDOW w AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 251 PRECEDING AND CURRENT ROW))
WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 30 DAY"""


@query("risk_metrics", _RISK_SQL, ("bars",),
       doubles="annualized_volatility var_95 annualized_return sharpe_ratio")
def risk_metrics(spark, sf_dir):
    """W3 real form: rolling 252-row volatility, 5% VaR, return, Sharpe."""
    return Vw.risk_metrics(fx.bars(spark, sf_dir), fx.event_day_as_of(spark, sf_dir))


@query("risk_metrics_split", _RISK_SQL, ("bars",),
       doubles="annualized_volatility var_95 annualized_return sharpe_ratio")
def risk_metrics_split(spark, sf_dir):
    """W3 on the split plan: weekly segments for the lag, 16-row halo blocks
    for the 252-row rolling frame (tiny blocks so the fixture crosses many)."""
    return Vw.risk_metrics(fx.bars(spark, sf_dir), fx.event_day_as_of(spark, sf_dir),
                           bucket=F.date_trunc("week", "date"), block=300)


@query("strategy_metrics", """
SELECT strategy_id, symbol, CAST(backtest_date AS DATE) AS date,
       avg(sharpe_ratio) AS avg_sharpe_ratio, avg(total_return) AS avg_total_return,
       max(max_drawdown) AS max_drawdown, avg(win_rate) AS avg_win_rate,
       count(*) AS total_backtests, sqrt(var_pop(total_return)) AS return_volatility
FROM strategy_performance
WHERE backtest_date >= (SELECT max(backtest_date) FROM strategy_performance) - INTERVAL 1 YEAR
GROUP BY strategy_id, symbol, CAST(backtest_date AS DATE)""", ("strategy_performance",),
       doubles="avg_sharpe_ratio avg_total_return max_drawdown avg_win_rate return_volatility")
def strategy_metrics(spark, sf_dir):
    """A13."""
    p = fx.strategy_performance(spark, sf_dir)
    return Vw.strategy_metrics(p, Vw.latest(p, "backtest_date"))


@query("portfolio_summary", """
SELECT portfolio_id, position_date, count(DISTINCT symbol) AS total_positions,
       sum(market_value) AS total_market_value, sum(unrealized_pnl) AS total_unrealized_pnl,
       sum(realized_pnl) AS total_realized_pnl, sum(total_invested) AS total_invested,
       CASE WHEN sum(total_invested) = 0 THEN NULL
            ELSE sum(unrealized_pnl + realized_pnl) / sum(total_invested) END AS total_return_pct,
       avg(risk_score) AS avg_risk_score
FROM portfolio_positions
WHERE position_date >= (SELECT max(position_date) FROM portfolio_positions) - INTERVAL 90 DAY
GROUP BY portfolio_id, position_date""", ("portfolio_positions",),
       doubles="total_market_value total_unrealized_pnl total_realized_pnl total_invested "
               "total_return_pct avg_risk_score")
def portfolio_summary(spark, sf_dir):
    """A14 + J8."""
    p = fx.portfolio_positions(spark, sf_dir)
    return Vw.portfolio_summary(p, Vw.latest(p, "position_date"))


def _banded(column: str, bands: list[tuple[float, str]], last: str, above: bool) -> str:
    """A label by the first band that the value lies above (or below)."""
    sign = ">" if above else "<"
    return " ".join(["CASE", *(f"WHEN {column} {sign} {x} THEN '{name}'" for x, name in bands), f"ELSE '{last}' END"])


# Labels, their bounds, and the names of the averaged columns.
_RETURN_BANDS = [(15, "High Performer"), (5, "Medium Performer"), (0, "Low Performer")]
_RISK_BANDS = [(5, "Low Risk"), (15, "Medium Risk")]
_AVERAGES = {"strategy_avg_return": "total_return_pct", "strategy_avg_sharpe": "sharpe_ratio",
             "strategy_avg_drawdown": "max_drawdown_pct", "strategy_avg_win_rate": "win_rate_pct",
             "strategy_avg_outperformance": "outperformance_pct"}
_PARAMETERS = {"period_param": "period", "lookback_param": "lookback", "adaptive_param": "adaptive_thresholds"}

# Every successful backtest beside what windows over its strategy's rows say.
_DASHBOARD = f"""
SELECT strategy_id, ticker, created_at::DATE AS backtest_date, created_at, total_return_pct, sharpe_ratio,
       max_drawdown_pct, win_rate_pct, outperformance_pct, total_trades, avg_confidence,
       date_part('year', created_at)::INTEGER AS backtest_year,
       date_part('month', created_at)::INTEGER AS backtest_month,
       {_banded("total_return_pct", _RETURN_BANDS, "Underperformer", True)} AS performance_category,
       {_banded("max_drawdown_pct", _RISK_BANDS, "High Risk", False)} AS risk_category,
       {", ".join(f"strategy_params ->> '$.{path}' AS {name}" for name, path in _PARAMETERS.items())},
       {", ".join(f"avg({column}) OVER own AS {name}" for name, column in _AVERAGES.items())},
       stddev_samp(total_return_pct) OVER own AS return_volatility, count(*) OVER own AS total_backtests,
       max(nth) OVER own AS tickers_tested, CAST(max(created_at) OVER own AS DATE) AS last_backtest_date
FROM (SELECT *, dense_rank() OVER (PARTITION BY strategy_id ORDER BY ticker) AS nth
      FROM backtest_results WHERE success)
WINDOW own AS (PARTITION BY strategy_id)"""


@query("backtest_dashboard", _DASHBOARD, ("backtest_results",),
       doubles="total_return_pct sharpe_ratio max_drawdown_pct win_rate_pct outperformance_pct "
               "avg_confidence strategy_avg_return return_volatility strategy_avg_sharpe "
               "strategy_avg_drawdown strategy_avg_win_rate strategy_avg_outperformance")
def backtest_dashboard(spark, sf_dir):
    """J9 + A15 + P17-P19."""
    return Vw.backtest_dashboard(fx.backtest_results(spark, sf_dir))


@query("successful_backtests", """
SELECT backtest_id, strategy_id, ticker, created_at, total_return_pct, sharpe_ratio,
       max_drawdown_pct, win_rate_pct, outperformance_pct, total_trades, avg_confidence,
       strategy_params
FROM backtest_results WHERE success""", ("backtest_results",),
       doubles="total_return_pct sharpe_ratio max_drawdown_pct win_rate_pct outperformance_pct "
               "avg_confidence")
def successful_backtests(spark, sf_dir):
    """P13."""
    return Vw.successful_backtests(fx.backtest_results(spark, sf_dir))


@query("sharpe_by_strategy", """
SELECT strategy_id, avg(sharpe_ratio) AS avg_sharpe_ratio FROM backtest_results
WHERE success GROUP BY strategy_id""", ("backtest_results",), doubles="avg_sharpe_ratio")
def sharpe_by_strategy(spark, sf_dir):
    """A18."""
    return Vw.sharpe_by_strategy(fx.backtest_results(spark, sf_dir))


@query("heatmap_drawdown", """
SELECT strategy_id, ticker, avg(max_drawdown_pct) AS avg_max_drawdown_pct FROM backtest_results
WHERE success AND max_drawdown_pct IS NOT NULL GROUP BY strategy_id, ticker""",
       ("backtest_results",), doubles="avg_max_drawdown_pct")
def heatmap_drawdown(spark, sf_dir):
    """A19 drawdown heat map."""
    return Vw.heatmap(fx.backtest_results(spark, sf_dir), "max_drawdown_pct", "avg_max_drawdown_pct")


@query("heatmap_win_rate", """
SELECT strategy_id, ticker, avg(win_rate_pct) AS avg_win_rate_pct FROM backtest_results
WHERE success AND win_rate_pct IS NOT NULL GROUP BY strategy_id, ticker""",
       ("backtest_results",), doubles="avg_win_rate_pct")
def heatmap_win_rate(spark, sf_dir):
    """A19 win-rate heat map."""
    return Vw.heatmap(fx.backtest_results(spark, sf_dir), "win_rate_pct", "avg_win_rate_pct")


@query("timeline", """
SELECT CAST(created_at AS DATE) AS date, strategy_id, avg(total_return_pct) AS avg_total_return_pct
FROM backtest_results GROUP BY 1, 2""", ("backtest_results",), doubles="avg_total_return_pct")
def timeline(spark, sf_dir):
    """A20."""
    return Vw.timeline(fx.backtest_results(spark, sf_dir))


@query("outperformance_hist", """
SELECT CAST(floor(outperformance_pct / CAST(10 AS DOUBLE)) AS BIGINT) * CAST(10 AS DOUBLE) AS bin_start, count(*) AS backtests
FROM backtest_results WHERE success GROUP BY 1""", ("backtest_results",), doubles="bin_start")
def outperformance_hist(spark, sf_dir):
    """A21."""
    return Vw.outperformance_hist(fx.backtest_results(spark, sf_dir))


@query("scatter_trades_win_rate", """
SELECT strategy_id, total_trades, win_rate_pct, total_return_pct FROM backtest_results
WHERE total_trades IS NOT NULL AND win_rate_pct IS NOT NULL""", ("backtest_results",),
       doubles="win_rate_pct total_return_pct")
def scatter_trades_win_rate(spark, sf_dir):
    """A22 trades vs win rate (size: return)."""
    return Vw.scatter(fx.backtest_results(spark, sf_dir), "total_trades", "win_rate_pct",
                      ("total_return_pct",))


@query("scatter_return_drawdown", """
SELECT strategy_id, total_return_pct, max_drawdown_pct FROM backtest_results
WHERE total_return_pct IS NOT NULL AND max_drawdown_pct IS NOT NULL""", ("backtest_results",),
       doubles="total_return_pct max_drawdown_pct")
def scatter_return_drawdown(spark, sf_dir):
    """A22 return vs drawdown."""
    return Vw.scatter(fx.backtest_results(spark, sf_dir), "total_return_pct", "max_drawdown_pct")


@query("daily_signals", """
SELECT CAST(timestamp AS DATE) AS date, symbol AS ticker, count(*) AS signal_count,
       avg(confidence) AS avg_confidence, count_if(action = 'BUY') AS buy_signals,
       count_if(action = 'SELL') AS sell_signals, count_if(action = 'HOLD') AS hold_signals
FROM signals
WHERE CAST(timestamp AS DATE) >= (SELECT max(CAST(timestamp AS DATE)) FROM signals) - INTERVAL 30 DAY
GROUP BY 1, 2""", ("signals",), doubles="avg_confidence")
def daily_signals(spark, sf_dir):
    """A16."""
    s = fx.signals(spark, sf_dir)
    return Vw.daily_signals(s, s.agg(F.max(F.to_date("timestamp"))).scalar())


@query("hot_tier", """
SELECT *, 'hot' AS data_tier FROM bars
WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 90 DAY""", ("bars",),
       doubles="open high low close volume")
def hot_tier(spark, sf_dir):
    """P12."""
    return Vw.hot_tier(fx.bars(spark, sf_dir), fx.event_day_as_of(spark, sf_dir))


@query("table_counts", """
SELECT 'price_data' AS table_name, count(*) AS row_count, round(count(*) * CAST(0.001 AS DOUBLE), 2) AS estimated_mb
FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 30 DAY
UNION ALL
SELECT 'signals', count(*), round(count(*) * CAST(0.001 AS DOUBLE), 2) FROM signals
WHERE CAST(timestamp AS DATE) >= (SELECT max(CAST(timestamp AS DATE)) FROM signals) - INTERVAL 30 DAY""",
       ("bars", "signals"), doubles="estimated_mb")
def table_counts(spark, sf_dir):
    """U1."""
    b, s = fx.bars(spark, sf_dir), fx.signals(spark, sf_dir)
    sd = F.to_date("timestamp")
    return Vw.table_counts({
        "price_data": (b, F.col("date") >= F.date_sub(fx.event_day_as_of(spark, sf_dir), 30)),
        "signals": (s, sd >= F.date_sub(s.agg(F.max(sd)).scalar(), 30))})


@query("table_metrics", """
SELECT 'ohlcv_data' AS table_name, count(*) AS row_count, 'native table' AS table_type
FROM bars WHERE date >= (SELECT max(date) FROM bars) - INTERVAL 7 DAY""", ("bars",))
def table_metrics(spark, sf_dir):
    """A17."""
    b = fx.bars(spark, sf_dir)
    return Vw.table_metrics(b, F.col("date") >= F.date_sub(fx.event_day_as_of(spark, sf_dir), 7),
                            "ohlcv_data")
