"""Deterministic mappings from the driver tables to the market-data tables.

Each function derives one logical table (bars, a second vendor, ticks,
signals, trades, positions, backtests, logs) from the landed parquet so the
work of every query grows with the input.  The same mappings exist as SQL
in ``barworks.plans.ctes`` for the DuckDB cross-check.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import table

# Fixed values of the mapping (kept equal to the SQL side).
PRIMARY_SOURCE = "kiteconnect"
SECONDARY_SOURCE = "yahoo_finance"
DUPLICATE_OFFSET = 1_000_000_000
TOKEN_OFFSET = 1_000_000
LOG_EPOCH = "2024-01-01 00:00:00"


def _k(props: str = "props") -> Column:
    return F.get_json_object(F.col(props), "$.k").cast("double")


def bars_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily OHLCV per (user_id, day) of ``events``; keeps ``uid`` for the vendor rules.

    A partial aggregate (min_by/max_by/min/max/count) runs before the shuffle,
    so a hot user only ships one partial row per map task and day.
    """
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value")
    return (e.groupBy(F.col("user_id").alias("uid"), F.to_date("ts").alias("date"))
             .agg(*[F.expr(x) for x in (
                 "min_by(value, struct(ts, event_id)) AS open", "max(value) AS high", "min(value) AS low",
                 "max_by(value, struct(ts, event_id)) AS close", "CAST(count(1) * 100 AS DOUBLE) AS volume",
                 "min(event_id) AS load_seq")])
             .selectExpr("*", "concat('S', uid) AS symbol"))


BAR_COLUMNS = ["symbol", "date", "open", "high", "low", "close", "volume", "load_seq"]


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bars_uid(spark, sf_dir).select(*BAR_COLUMNS)


def _dirty(b: DataFrame) -> DataFrame:
    """Inject the faults; rows with load_seq % 23 = 0 get a second copy
    (load_seq + 1e9) generated in the same pass (explode, no union re-scan)."""
    return b.selectExpr(
        "uid", "symbol", "date",
        "CASE WHEN load_seq % 11 = 0 THEN -open ELSE open END AS open",
        "CASE WHEN load_seq % 13 = 0 THEN low ELSE high END AS high",
        "CASE WHEN load_seq % 13 = 0 THEN high ELSE low END AS low",
        "CASE WHEN load_seq % 7 = 0 THEN CAST(NULL AS DOUBLE) ELSE close END AS close",
        "CASE WHEN load_seq % 19 = 0 THEN CAST(NULL AS DOUBLE) WHEN load_seq % 17 = 0 THEN 0.0D "
        "WHEN load_seq % 101 = 0 THEN volume * 100000 ELSE volume END AS volume",
        f"explode(CASE WHEN load_seq % 23 = 0 THEN array(load_seq, load_seq + {DUPLICATE_OFFSET}) "
        "ELSE array(load_seq) END) AS load_seq")


def bars_dirty(spark: SparkSession, sf_dir: str, keep_uid: bool = False) -> DataFrame:
    """Bars with injected faults: NULL close, negative open, swapped high/low,
    zero/NULL/huge volume and duplicated rows (second copy load_seq + 1e9)."""
    d = _dirty(bars_uid(spark, sf_dir)).withColumn("source", F.lit(PRIMARY_SOURCE))
    return d if keep_uid else d.drop("uid")


def bars_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``bars_dirty`` where some symbols lack a column: open (uid % 9 = 4), volume (5) or date (6)."""
    return bars_dirty(spark, sf_dir, keep_uid=True).selectExpr(
        "symbol", "CASE WHEN uid % 9 <> 6 THEN date END AS date", "CASE WHEN uid % 9 <> 4 THEN open END AS open",
        "high", "low", "close", "CASE WHEN uid % 9 <> 5 THEN volume END AS volume", "load_seq", "source")


def vendor_a(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary vendor: dirty bars, de-duplicated (first load_seq per day), minus uid % 10 = 7."""
    from ..functions.exprs import dedupe
    d = bars_dirty(spark, sf_dir, keep_uid=True).filter(F.col("uid") % 10 != 7)
    return dedupe(d.select(*BAR_COLUMNS, "source"), ["symbol", "date"], "load_seq")


def bars_b(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second vendor: drops load_seq % 29 = 0 and uid % 10 = 3, scales close and volume."""
    b = bars_uid(spark, sf_dir)
    return (b.filter("load_seq % 29 <> 0 AND uid % 10 <> 3")
             .selectExpr("symbol", "date", "open", "high", "low",
                         "close * (1 + (load_seq % 10) / 100.0D) AS close",
                         "volume * (1 + (load_seq % 4) / 10.0D) AS volume", "load_seq",
                         f"'{SECONDARY_SOURCE}' AS source"))


def intraday_bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as intraday bars: open = high = low = close = value."""
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "value", "props")
    v = F.col("value")
    return e.select(F.concat(F.lit("S"), F.col("user_id")).alias("symbol"),
                    F.col("ts"), v.alias("open"), v.alias("high"), v.alias("low"),
                    v.alias("close"), (_k() * 100).alias("volume"),
                    F.col("event_id").alias("load_seq"))


# event_type -> instrument category of the tick mapping.
CATEGORY_BY_EVENT = {"view": "normal", "click": "index", "error": "illiquid", "purchase": "etf"}


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quote per event with the day's OHLC struct and the previous daily close.

    The join key (uid, date) is the grouping key of ``bars_uid``, so the bar
    side is already hash-partitioned for it.
    """
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "value", "props")
    from ..functions.series import with_prev
    b = with_prev(bars_uid(spark, sf_dir), ["uid"], ["date"], ["close"], prefix="previous_")
    cat = F.lit(None).cast("string")
    for ev, c in CATEGORY_BY_EVENT.items():
        cat = F.when(F.col("event_type") == ev, F.lit(c)).otherwise(cat)
    ev = e.select(F.col("user_id").alias("uid"), F.to_date("ts").alias("date"), "event_id",
                  "ts", "value", (_k() * 100).alias("volume"), cat.alias("category"))
    j = ev.join(b.select("uid", "date", "open", "high", "low", "close", "previous_close"),
                ["uid", "date"], "inner")
    return j.select(F.concat(F.lit("S"), F.col("uid")).alias("symbol"), "ts", "event_id",
                    F.col("value").alias("last_price"),
                    F.struct("open", "high", "low", "close").alias("ohlc"),
                    "volume", "category", "previous_close")


def tick_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbol and volume of every quote, from two columns of the events."""
    e = table(spark, sf_dir, "events", "user_id", "props")
    return e.select(F.concat(F.lit("S"), "user_id").alias("symbol"), (_k() * 100).alias("volume"))


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "ts", "user_id", "event_type", "props")
    et = F.col("event_type")
    return e.select(F.col("event_id").alias("signal_id"),
                    F.concat(F.lit("S"), F.col("user_id")).alias("symbol"),
                    F.col("ts").alias("timestamp"),
                    F.when(et == "purchase", "BUY").when(et == "error", "SELL")
                     .otherwise("HOLD").alias("action"),
                    (_k() / 100.0).alias("confidence"),
                    F.concat(F.lit("ST"), F.col("user_id") % 5).alias("strategy"))


def paper_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "value").filter(F.col("event_id") % 2 == 0)
    base = e.select(F.col("event_id").alias("signal_id"), (F.col("value") - 50).alias("pnl"))
    again = base.filter(F.col("signal_id") % 10 == 0).withColumn("pnl", F.col("pnl") + 1)
    return (base.unionByName(again)
                .withColumn("pnl_percent", F.col("pnl") / 50 * 100))


def manual_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "event_id", "value").filter(F.col("event_id") % 3 == 0)
    return e.select(F.col("event_id").alias("signal_id"), (40 - F.col("value")).alias("pnl"),
                    ((40 - F.col("value")) / 40 * 100).alias("pnl_percent"))


def trades_execution(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey",
               "l_returnflag", "l_quantity", "l_extendedprice", "l_tax", "l_shipdate")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_linenumber").alias("trade_id"),
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.col("l_returnflag").alias("strategy_id"),
        F.col("l_quantity").alias("quantity"),
        F.try_divide("l_extendedprice", "l_quantity").alias("price"),
        (F.col("l_tax") * F.col("l_extendedprice")).alias("fees"),
        F.to_date("l_shipdate").alias("trade_date"))


def portfolio_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem", "l_suppkey", "l_partkey", "l_shipdate",
               "l_extendedprice", "l_discount", "l_tax")
    inv = F.col("l_extendedprice") * (1 - F.col("l_discount"))
    return li.select(
        F.col("l_suppkey").alias("portfolio_id"),
        F.concat(F.lit("P"), "l_partkey").alias("symbol"),
        F.to_date("l_shipdate").alias("position_date"),
        F.col("l_extendedprice").alias("market_value"),
        inv.alias("total_invested"),
        (F.col("l_extendedprice") - inv).alias("unrealized_pnl"),
        (F.col("l_tax") * inv).alias("realized_pnl"),
        (F.col("l_discount") * 10).alias("risk_score"))


def strategy_performance(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice",
              "o_orderdate", "o_orderpriority")
    return o.select(
        F.col("o_orderpriority").alias("strategy_id"),
        F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("symbol"),
        F.col("o_orderdate").alias("backtest_date"),
        (F.col("o_totalprice") / 100000 - 1).alias("total_return"),
        ((F.col("o_custkey") % 30) / 10.0).alias("sharpe_ratio"),
        ((F.col("o_orderkey") % 40) / 100.0).alias("max_drawdown"),
        ((F.col("o_orderkey") % 100) / 100.0).alias("win_rate"))


def backtest_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderstatus",
              "o_totalprice", "o_orderdate", "o_orderpriority")
    ret = (F.col("o_totalprice") / 100000 - 1) * 100
    return o.select(
        F.col("o_orderkey").alias("backtest_id"),
        F.col("o_orderpriority").alias("strategy_id"),
        F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("ticker"),
        F.col("o_orderdate").alias("created_at"),
        ret.alias("total_return_pct"),
        ((F.col("o_custkey") % 30) / 10.0).alias("sharpe_ratio"),
        (F.col("o_orderkey") % 40).cast("double").alias("max_drawdown_pct"),
        (F.col("o_orderkey") % 100).cast("double").alias("win_rate_pct"),
        (ret - 5).alias("outperformance_pct"),
        (F.col("o_orderkey") % 50).alias("total_trades"),
        ((F.col("o_custkey") % 100) / 100.0).alias("avg_confidence"),
        (F.col("o_orderstatus") != "P").alias("success"),
        F.concat(F.lit('{"period": '), (F.col("o_custkey") % 20).cast("string"),
                 F.lit(', "lookback": '), (F.col("o_orderkey") % 30).cast("string"),
                 F.lit("}")).alias("strategy_params"))


def error_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return d.select(F.col("source").alias("error_type"), F.col("text").alias("message"),
                    (F.lit(LOG_EPOCH).cast("timestamp_ntz")
                     + F.make_dt_interval(secs=F.col("doc_id").cast("decimal(18,6)"))).alias("timestamp"))


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer", "c_custkey", "c_name", "c_mktsegment")
    k = F.col("c_custkey") % 5
    return c.select(F.col("c_mktsegment").alias("segment"), F.col("c_name").alias("symbol"),
                    F.when(k == 0, "no_data").when(k == 1, "validation_failed")
                     .otherwise("success").alias("status"),
                    (F.col("c_custkey") % 250).alias("records"))


def instruments(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events", "user_id")
    u = e.filter(F.col("user_id") % 31 != 0).distinct()
    return u.select((F.col("user_id") + TOKEN_OFFSET).alias("instrument_token"),
                    F.concat(F.lit("S"), "user_id").alias("tradingsymbol"),
                    F.lit("NSE").alias("exchange"))


# Market-cap segment of a mapped symbol S<n> by n % 3.
SEGMENTS = ("large_cap", "mid_cap", "small_cap")


def segment_of(symbol: str = "symbol") -> Column:
    n = F.substring(F.col(symbol), 2, 32).cast("bigint") % 3
    return F.when(n == 0, SEGMENTS[0]).when(n == 1, SEGMENTS[1]).otherwise(SEGMENTS[2])


def both_vendors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Primary and secondary vendor bars in one frame (``source`` tells them apart)."""
    return vendor_a(spark, sf_dir).unionByName(bars_b(spark, sf_dir))


def event_day_as_of(spark: SparkSession, sf_dir: str) -> Column:
    """Newest event day as a scalar subquery over a one-column scan of events.

    Equal to the newest date of ``bars``, ``bars_dirty`` and ``ticks`` (they keep
    every event day), but without re-running their aggregate or join."""
    return table(spark, sf_dir, "events", "ts").agg(F.max(F.to_date("ts"))).scalar()


def sector_of(symbol: str = "symbol") -> Column:
    """Sector of a mapped symbol ``S<n>``: ``SEC<n % 7>``."""
    return F.concat(F.lit("SEC"), F.substring(F.col(symbol), 2, 32).cast("bigint") % 7)


def history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long daily series: per customer group and order day, the OHLC of the orders' totals
    (in order of their keys) and 100 per order as volume.  Prices are totals over 997, so
    that their means have no ties where results are rounded."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return (o.groupBy(F.concat(F.lit("C"), F.col("o_custkey") % 50).alias("symbol"),
                      F.to_date("o_orderdate").alias("date"))
             .agg(*[F.expr(x) for x in (
                 "min_by(o_totalprice, o_orderkey) / 997 AS open", "max(o_totalprice) / 997 AS high",
                 "min(o_totalprice) / 997 AS low", "max_by(o_totalprice, o_orderkey) / 997 AS close",
                 "CAST(count(1) * 100 AS DOUBLE) AS volume", "min(o_orderkey) AS load_seq")]))


def corporate_actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits and dividends of ``history``: of every 97th order, on the day after it."""
    o = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    return o.filter("o_orderkey % 97 = 0").selectExpr(
        "concat('C', o_custkey % 50) AS symbol", "date_add(to_date(o_orderdate), 1) AS ex_date",
        "CASE WHEN o_orderkey % 2 = 0 THEN 'split' ELSE 'dividend' END AS kind",
        "CASE WHEN o_orderkey % 2 = 1 THEN o_totalprice / 99700 WHEN o_custkey % 3 = 0 THEN 0.5D "
        "ELSE CAST(2 + o_custkey % 2 AS DOUBLE) END AS value")


def holidays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days on which the number of events is divisible by five."""
    e = table(spark, sf_dir, "events", "ts")
    return e.groupBy(F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n")).filter("n % 5 = 0").select("date")


def portfolio_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trades of portfolios; prices (cents times 100 over the quantity, whole) and fees with four decimals."""
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity",
               "l_extendedprice", "l_tax", "l_shipdate")
    return li.selectExpr(
        "l_orderkey", "l_suppkey AS portfolio_id", "concat('P', l_partkey) AS symbol", "to_date(l_shipdate) AS date",
        "CASE WHEN (l_orderkey + l_linenumber) % 3 = 0 THEN 'SELL' ELSE 'BUY' END AS side", "l_quantity AS quantity",
        "CAST(CAST(round(l_extendedprice * 100) AS BIGINT) * 100 div CAST(l_quantity AS BIGINT) AS DECIMAL(18, 0)) "
        "* 0.0001BD AS price",
        "CAST(CAST(round(l_tax * 100) AS BIGINT) * CAST(round(l_extendedprice * 100) AS BIGINT) AS DECIMAL(18, 0)) "
        "* 0.0001BD AS fees")


def daily_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The price of the day's last trade (by order key and price) per symbol; a symbol's rows are together."""
    t = portfolio_trades(spark, sf_dir).select("symbol", "date", "l_orderkey", "price").repartition("symbol")
    return t.groupBy("symbol", "date").agg(
        F.max(F.struct("l_orderkey", "price")).alias("_m")).select("symbol", "date", F.col("_m.price").alias("price"))
