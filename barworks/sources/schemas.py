"""Schemas of the maintained tables (S13), for ``ensure_table``, ``read_table`` and ``append_table``.

A time of day and a JSON document are kept as text.  Tables with a ``created_at`` but no
``date`` are partitioned by the day of ``created_at`` (``with_day``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Names, types and required columns of the tables.
TABLES = {
    "trading_signals": """
        signal_id STRING NOT NULL, symbol STRING NOT NULL, signal_type STRING NOT NULL,
        confidence STRING NOT NULL, entry_price DOUBLE NOT NULL, target_price DOUBLE NOT NULL,
        stop_loss DOUBLE NOT NULL, quantity_suggestion BIGINT NOT NULL,
        risk_reward_ratio DOUBLE NOT NULL, signal_time TIMESTAMP NOT NULL,
        strategy_name STRING NOT NULL, reason STRING, market_data STRING,
        created_at TIMESTAMP NOT NULL""",
    "paper_trades": """
        trade_id STRING NOT NULL, signal_id STRING NOT NULL, symbol STRING NOT NULL,
        action STRING NOT NULL, quantity BIGINT NOT NULL, entry_price DOUBLE NOT NULL,
        target_price DOUBLE NOT NULL, stop_loss DOUBLE NOT NULL, entry_time TIMESTAMP NOT NULL,
        exit_time TIMESTAMP, exit_price DOUBLE, status STRING NOT NULL, pnl DOUBLE NOT NULL,
        pnl_percent DOUBLE NOT NULL, trade_type STRING NOT NULL, strategy_name STRING NOT NULL,
        notes STRING, created_at TIMESTAMP NOT NULL""",
    "manual_trades": """
        trade_id STRING NOT NULL, signal_id STRING, symbol STRING NOT NULL,
        action STRING NOT NULL, quantity BIGINT NOT NULL, entry_price DOUBLE NOT NULL,
        target_price DOUBLE, stop_loss DOUBLE, entry_time TIMESTAMP NOT NULL,
        exit_time TIMESTAMP, exit_price DOUBLE, status STRING NOT NULL, pnl DOUBLE NOT NULL,
        pnl_percent DOUBLE NOT NULL, trade_type STRING NOT NULL, broker_order_id STRING,
        execution_notes STRING, created_at TIMESTAMP NOT NULL""",
    "daily_performance": """
        date DATE NOT NULL, total_signals BIGINT NOT NULL, paper_trades_executed BIGINT NOT NULL,
        manual_trades_suggested BIGINT NOT NULL, manual_trades_executed BIGINT NOT NULL,
        paper_total_pnl DOUBLE NOT NULL, paper_win_rate DOUBLE NOT NULL,
        paper_avg_win DOUBLE NOT NULL, paper_avg_loss DOUBLE NOT NULL,
        paper_profit_factor DOUBLE NOT NULL, manual_total_pnl DOUBLE NOT NULL,
        manual_win_rate DOUBLE NOT NULL, paper_portfolio_value DOUBLE NOT NULL,
        manual_portfolio_value DOUBLE NOT NULL, created_at TIMESTAMP NOT NULL""",
    "portfolio_snapshots": """
        snapshot_id STRING NOT NULL, date DATE NOT NULL, time STRING NOT NULL,
        portfolio_type STRING NOT NULL, total_value DOUBLE NOT NULL, cash_value DOUBLE NOT NULL,
        positions_value DOUBLE NOT NULL, day_pnl DOUBLE NOT NULL, total_pnl DOUBLE NOT NULL,
        active_positions BIGINT NOT NULL, positions_detail STRING,
        created_at TIMESTAMP NOT NULL""",
    "market_data": """
        symbol STRING NOT NULL, date DATE NOT NULL, time STRING NOT NULL, open DOUBLE NOT NULL,
        high DOUBLE NOT NULL, low DOUBLE NOT NULL, close DOUBLE NOT NULL, volume BIGINT NOT NULL,
        interval STRING NOT NULL, source STRING NOT NULL, created_at TIMESTAMP NOT NULL""",
}


def schema(name: str) -> T.StructType:
    """The schema of a table, with its partition column."""
    s = T.StructType.fromDDL(" ".join(TABLES[name].split()))
    return s if "date" in s.fieldNames() else s.add("date", T.DateType())


def with_day(df: DataFrame) -> DataFrame:
    """``date`` from ``created_at`` for tables that have no day of their own."""
    return df if "date" in df.columns else df.withColumn("date", F.to_date("created_at"))
