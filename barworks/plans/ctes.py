"""SQL (DuckDB dialect) twins of ``barworks.sources.fixtures``.

``with_ctes(body, *names)`` prefixes a query with the CTEs it names and the
CTEs those depend on, in dependency order.
"""

from __future__ import annotations

_CTES: dict[str, tuple[tuple[str, ...], str]] = {}


def _cte(name: str, sql: str, *deps: str) -> None:
    _CTES[name] = (deps, sql)


_cte("bars_uid", """
SELECT user_id AS uid, CAST(ts AS DATE) AS date,
       first(value ORDER BY ts, event_id) AS open, max(value) AS high, min(value) AS low,
       last(value ORDER BY ts, event_id) AS close, CAST(count(*) * 100 AS DOUBLE) AS volume,
       min(event_id) AS load_seq, concat('S', user_id) AS symbol
FROM events GROUP BY user_id, CAST(ts AS DATE)""")

_cte("bars", "SELECT symbol, date, open, high, low, close, volume, load_seq FROM bars_uid",
     "bars_uid")

_cte("dirty_u", """
SELECT uid, symbol, date,
       CASE WHEN load_seq % 11 = 0 THEN -open ELSE open END AS open,
       CASE WHEN load_seq % 13 = 0 THEN low ELSE high END AS high,
       CASE WHEN load_seq % 13 = 0 THEN high ELSE low END AS low,
       CASE WHEN load_seq % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE close END AS close,
       CASE WHEN load_seq % 19 = 0 THEN CAST(NULL AS DOUBLE)
            WHEN load_seq % 17 = 0 THEN 0.0
            WHEN load_seq % 101 = 0 THEN volume * 100000
            ELSE volume END AS volume,
       load_seq
FROM bars_uid""", "bars_uid")

_cte("bars_dirty_u", """
SELECT *, 'kiteconnect' AS source FROM dirty_u
UNION ALL
SELECT uid, symbol, date, open, high, low, close, volume, load_seq + 1000000000 AS load_seq,
       'kiteconnect' AS source FROM dirty_u WHERE load_seq % 23 = 0""", "dirty_u")

_cte("bars_dirty", """
SELECT symbol, date, open, high, low, close, volume, load_seq, source FROM bars_dirty_u""",
     "bars_dirty_u")

_cte("bars_partial", """
SELECT symbol, CASE WHEN uid % 9 = 6 THEN NULL ELSE date END AS date, CASE WHEN uid % 9 = 4 THEN NULL ELSE open END AS open,
       high, low, close, CASE WHEN uid % 9 = 5 THEN NULL ELSE volume END AS volume, load_seq, source
FROM bars_dirty_u""", "bars_dirty_u")

_cte("vendor_a", """
SELECT symbol, date, open, high, low, close, volume, load_seq, source FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, date ORDER BY load_seq) AS rn
  FROM bars_dirty_u WHERE uid % 10 <> 7) WHERE rn = 1""", "bars_dirty_u")

_cte("bars_b", """
SELECT symbol, date, open, high, low,
       close * (1 + (load_seq % 10) / 100.0) AS close,
       volume * (1 + (load_seq % 4) / 10.0) AS volume,
       load_seq, 'yahoo_finance' AS source
FROM bars_uid WHERE load_seq % 29 <> 0 AND uid % 10 <> 3""", "bars_uid")

_cte("intraday_bars", """
SELECT concat('S', user_id) AS symbol, ts, value AS open, value AS high, value AS low,
       value AS close, CAST(json_extract_string(props, '$.k') AS DOUBLE) * 100 AS volume,
       event_id AS load_seq
FROM events""")

_cte("ticks", """
SELECT concat('S', e.user_id) AS symbol, e.ts, e.event_id, e.value AS last_price,
       {'open': b.open, 'high': b.high, 'low': b.low, 'close': b.close} AS ohlc,
       CAST(json_extract_string(e.props, '$.k') AS DOUBLE) * 100 AS volume,
       CASE e.event_type WHEN 'view' THEN 'normal' WHEN 'click' THEN 'index'
            WHEN 'error' THEN 'illiquid' WHEN 'purchase' THEN 'etf' END AS category,
       b.previous_close
FROM events e JOIN (
  SELECT uid, date, open, high, low, close,
         lag(close) OVER (PARTITION BY uid ORDER BY date) AS previous_close
  FROM bars_uid) b ON e.user_id = b.uid AND CAST(e.ts AS DATE) = b.date""", "bars_uid")

_cte("signals", """
SELECT event_id AS signal_id, concat('S', user_id) AS symbol, ts AS timestamp,
       CASE WHEN event_type = 'purchase' THEN 'BUY' WHEN event_type = 'error' THEN 'SELL'
            ELSE 'HOLD' END AS action,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) / 100.0 AS confidence,
       concat('ST', user_id % 5) AS strategy
FROM events""")

_cte("paper_trades", """
SELECT signal_id, pnl, pnl / 50 * 100 AS pnl_percent FROM (
  SELECT event_id AS signal_id, value - 50 AS pnl FROM events WHERE event_id % 2 = 0
  UNION ALL
  SELECT event_id, value - 50 + 1 FROM events WHERE event_id % 2 = 0 AND event_id % 10 = 0)""")

_cte("manual_trades", """
SELECT event_id AS signal_id, 40 - value AS pnl, (40 - value) / 40 * 100 AS pnl_percent
FROM events WHERE event_id % 3 = 0""")

_cte("trades_execution", """
SELECT concat(l_orderkey, '-', l_linenumber) AS trade_id, concat('P', l_partkey) AS symbol,
       l_returnflag AS strategy_id, l_quantity AS quantity,
       CASE WHEN l_quantity = 0 THEN NULL ELSE l_extendedprice / l_quantity END AS price,
       l_tax * l_extendedprice AS fees, CAST(l_shipdate AS DATE) AS trade_date
FROM lineitem""")

_cte("portfolio_positions", """
SELECT l_suppkey AS portfolio_id, concat('P', l_partkey) AS symbol,
       CAST(l_shipdate AS DATE) AS position_date, l_extendedprice AS market_value,
       l_extendedprice * (1 - l_discount) AS total_invested,
       l_extendedprice - l_extendedprice * (1 - l_discount) AS unrealized_pnl,
       l_tax * (l_extendedprice * (1 - l_discount)) AS realized_pnl,
       l_discount * 10 AS risk_score
FROM lineitem""")

_cte("strategy_performance", """
SELECT o_orderpriority AS strategy_id, concat('C', o_custkey % 50) AS symbol,
       o_orderdate AS backtest_date, o_totalprice / 100000 - 1 AS total_return,
       (o_custkey % 30) / 10.0 AS sharpe_ratio, (o_orderkey % 40) / 100.0 AS max_drawdown,
       (o_orderkey % 100) / 100.0 AS win_rate
FROM orders""")

_cte("backtest_results", """
SELECT o_orderkey AS backtest_id, o_orderpriority AS strategy_id,
       concat('C', o_custkey % 50) AS ticker, o_orderdate AS created_at,
       (o_totalprice / 100000 - 1) * 100 AS total_return_pct,
       (o_custkey % 30) / 10.0 AS sharpe_ratio,
       CAST(o_orderkey % 40 AS DOUBLE) AS max_drawdown_pct,
       CAST(o_orderkey % 100 AS DOUBLE) AS win_rate_pct,
       (o_totalprice / 100000 - 1) * 100 - 5 AS outperformance_pct,
       o_orderkey % 50 AS total_trades, (o_custkey % 100) / 100.0 AS avg_confidence,
       o_orderstatus <> 'P' AS success,
       concat('{"period": ', o_custkey % 20, ', "lookback": ', o_orderkey % 30, '}')
         AS strategy_params
FROM orders""")

_cte("error_log", """
SELECT source AS error_type, text AS message,
       TIMESTAMP '2024-01-01 00:00:00' + to_seconds(doc_id) AS timestamp
FROM documents""")

_cte("run_log", """
SELECT c_mktsegment AS segment, c_name AS symbol,
       CASE c_custkey % 5 WHEN 0 THEN 'no_data' WHEN 1 THEN 'validation_failed'
            ELSE 'success' END AS status,
       c_custkey % 250 AS records
FROM customer""")

_cte("history", """
SELECT concat('C', o_custkey % 50) AS symbol, CAST(o_orderdate AS DATE) AS date,
       arg_min(o_totalprice, o_orderkey) / 997 AS open, max(o_totalprice) / 997 AS high,
       min(o_totalprice) / 997 AS low, arg_max(o_totalprice, o_orderkey) / 997 AS close,
       CAST(count(*) * 100 AS DOUBLE) AS volume, min(o_orderkey) AS load_seq
FROM orders GROUP BY 1, 2""")

_cte("corporate_actions", """
SELECT concat('C', o_custkey % 50) AS symbol, CAST(o_orderdate AS DATE) + 1 AS ex_date,
       CASE WHEN o_orderkey % 2 = 0 THEN 'split' ELSE 'dividend' END AS kind,
       CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice / 99700 WHEN o_custkey % 3 = 0 THEN 0.5::DOUBLE
            ELSE CAST(2 + o_custkey % 2 AS DOUBLE) END AS value
FROM orders WHERE o_orderkey % 97 = 0""")

_cte("holidays", """
SELECT CAST(ts AS DATE) AS date FROM events GROUP BY 1 HAVING count(*) % 5 = 0""")

_cte("portfolio_trades", """
SELECT l_orderkey, l_suppkey AS portfolio_id, concat('P', l_partkey) AS symbol, CAST(l_shipdate AS DATE) AS date,
       CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN -1 ELSE 1 END AS sign,
       CAST(l_quantity AS DECIMAL(10, 0)) AS quantity,
       CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 100 // CAST(l_quantity AS BIGINT) AS DECIMAL(14, 0))
         * CAST(0.0001 AS DECIMAL(4, 4)) AS price,
       CAST(CAST(round(l_tax * 100) AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT) AS DECIMAL(14, 0))
         * CAST(0.0001 AS DECIMAL(4, 4)) AS fees
FROM lineitem""")

_cte("instruments", """
SELECT user_id + 1000000 AS instrument_token, concat('S', user_id) AS tradingsymbol,
       'NSE' AS exchange
FROM (SELECT DISTINCT user_id FROM events WHERE user_id % 31 <> 0)""")


def _order(names: tuple[str, ...]) -> list[str]:
    out: list[str] = []

    def visit(n: str) -> None:
        if n in out:
            return
        for d in _CTES[n][0]:
            visit(d)
        out.append(n)

    for n in names:
        visit(n)
    return out


def with_ctes(body: str, *names: str, extra: list[tuple[str, str]] | None = None) -> str:
    """Prefix ``body`` with the named library CTEs plus ``extra`` (name, sql) pairs."""
    parts = [f"{n} AS ({_CTES[n][1]}\n)" for n in _order(names)]
    parts += [f"{n} AS ({sql}\n)" for n, sql in (extra or [])]
    return ("WITH " + ",\n".join(parts) + "\n" if parts else "") + body
