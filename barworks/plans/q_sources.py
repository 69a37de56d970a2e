"""Source-side queries (S2-S5, S9, S14, S15, S21) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import checks as V
from ..operators.views import latest
from ..sources import fixtures as fx
from ..sources import io as S
from ..streaming import quotes as K
from .q_checks import validation_ctes
from .registry import query

D = "open high low close volume"


@query("source_fallback", """
SELECT * FROM vendor_a
UNION ALL
SELECT * FROM bars_b WHERE symbol NOT IN (SELECT DISTINCT symbol FROM vendor_a)""",
       ("vendor_a", "bars_b"), doubles=D)
def source_fallback(spark, sf_dir):
    """Primary vendor per symbol, else the secondary."""
    return S.source_fallback(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


@query("universe_filter", """
SELECT b.* FROM bars b WHERE b.symbol IN (SELECT tradingsymbol FROM instruments)""",
       ("bars", "instruments"), doubles=D)
def universe_filter(spark, sf_dir):
    """One scan of all bars restricted to the instrument universe."""
    u = fx.instruments(spark, sf_dir).select(F.col("tradingsymbol").alias("symbol"))
    return S.for_universe(fx.bars(spark, sf_dir), u)


@query("drop_critical", """
SELECT * FROM vendor_a WHERE symbol NOT IN (SELECT symbol FROM a_iss WHERE severity = 'critical')""",
       ("vendor_a",), doubles=D, extra=validation_ctes("vendor_a", "a_"))
def drop_critical(spark, sf_dir):
    """S3: validated vendor bars without the symbols that have a CRITICAL issue."""
    a = fx.vendor_a(spark, sf_dir)
    return S.drop_critical(a, V.issues_of(V.validate_bars(a)))


@query("instrument_lookup", """
SELECT s.symbol, i.instrument_token
FROM (SELECT DISTINCT concat('S', user_id) AS symbol FROM events) s
LEFT JOIN instruments i ON i.tradingsymbol = s.symbol""", ("instruments",))
def instrument_lookup(spark, sf_dir):
    """Symbol -> token; unknown symbols keep a NULL token."""
    from ..sources.tables import table
    syms = table(spark, sf_dir, "events", "user_id").select(
        F.concat(F.lit("S"), "user_id").alias("symbol")).distinct()
    return S.with_tokens(syms, fx.instruments(spark, sf_dir))


@query("upsert_latest", """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date, source
                                                           ORDER BY load_seq DESC) AS rn
                            FROM bars_dirty) WHERE rn = 1""", ("bars_dirty",), doubles=D)
def upsert_latest(spark, sf_dir):
    """S9 core: last write wins per (symbol, date, source) over the landed rows."""
    return S.latest_per_key(fx.bars_dirty(spark, sf_dir), ["symbol", "date", "source"])


@query("delete_symbol", """
SELECT * FROM bars_dirty WHERE NOT coalesce(symbol = 'S7' AND date = DATE '2024-01-15', false)""",
       ("bars_dirty",), doubles=D)
def delete_symbol(spark, sf_dir):
    """S14 as a rule: every row except symbol S7 on 2024-01-15 (NULL-safe)."""
    cond = (F.col("symbol") == "S7") & (F.col("date") == F.lit("2024-01-15").cast("date"))
    return fx.bars_dirty(spark, sf_dir).filter(S.without(cond))


@query("retention", """
SELECT * FROM bars_dirty WHERE date >= (SELECT max(date) FROM bars_dirty) - INTERVAL 10 DAY""",
       ("bars_dirty",), doubles=D)
def retention(spark, sf_dir):
    """Keep the last 10 days."""
    return S.drop_older(fx.bars_dirty(spark, sf_dir), fx.event_day_as_of(spark, sf_dir), 10, "date")


@query("table_stats", """
SELECT 'bars' AS table_name, count(*) AS row_count FROM bars
UNION ALL SELECT 'signals', count(*) FROM signals
UNION ALL SELECT 'paper_trades', count(*) FROM paper_trades
UNION ALL SELECT 'manual_trades', count(*) FROM manual_trades
UNION ALL SELECT 'backtest_results', count(*) FROM backtest_results
UNION ALL SELECT 'total', CAST((SELECT count(*) FROM bars) + (SELECT count(*) FROM signals)
  + (SELECT count(*) FROM paper_trades) + (SELECT count(*) FROM manual_trades)
  + (SELECT count(*) FROM backtest_results) AS BIGINT)""",
       ("bars", "signals", "paper_trades", "manual_trades", "backtest_results"))
def table_stats(spark, sf_dir):
    """S21."""
    return S.table_stats({"bars": fx.bars(spark, sf_dir), "signals": fx.signals(spark, sf_dir),
                          "paper_trades": fx.paper_trades(spark, sf_dir),
                          "manual_trades": fx.manual_trades(spark, sf_dir),
                          "backtest_results": fx.backtest_results(spark, sf_dir)})


# -- maintained tables: written, changed in place, read back -----------------

def _kept(spark, name: str, work) -> DataFrame:
    """Run ``work(path)`` on a scratch table of the shared folder and keep its rows."""
    path = K.scratch(spark, name)
    work(path)
    return K.taken(spark, path)


@query("table_upsert", """
SELECT symbol, date, open, high, low, CASE WHEN load_seq % 3 = 0 THEN close + 1 ELSE close END AS close, volume,
       CASE WHEN load_seq % 3 = 0 THEN load_seq + 1000000000 ELSE load_seq END AS load_seq
FROM bars""", ("bars",), doubles=D)
def table_upsert(spark, sf_dir):
    """S7 + S9 + S13: a new table, loaded when empty, and a third of its rows written again."""
    bars = fx.bars(spark, sf_dir).select("symbol", "date", "open", "high", "low", "close", "volume", "load_seq")
    again = bars.filter("load_seq % 3 = 0").withColumns(
        {"close": F.col("close") + 1, "load_seq": F.col("load_seq") + 1_000_000_000})

    def work(path):
        S.ensure_table(spark, path, bars.schema)
        S.write_table(bars, path, "WRITE_EMPTY")
        S.upsert(spark, path, again, ["symbol", "date"])
    return _kept(spark, "table-upsert", work).select(*bars.columns)


@query("table_delete", """
SELECT * FROM bars WHERE NOT (symbol = 'S7') AND NOT (date = (SELECT min(date) FROM bars))""",
       ("bars",), doubles=D)
def table_delete(spark, sf_dir):
    """One symbol deleted from every day, then a whole day, which leaves no partition."""
    bars = fx.bars(spark, sf_dir)
    first = bars.agg(F.min("date")).first()[0]

    def work(path):
        S.write_table(bars, path)
        S.delete_where(spark, path, F.col("symbol") == "S7")
        S.delete_where(spark, path, F.col("date") == F.lit(first))
    return _kept(spark, "table-delete", work).select(*bars.columns)


@query("table_backtests", """
SELECT backtest_id, strategy_id, coalesce(total_return_pct, 0.0) AS total_return_pct,
       CASE WHEN success THEN 7 ELSE 0 END AS trades_count, '{}' AS metadata, 'paper' AS mode,
       CASE WHEN success THEN DATE '2024-03-02' ELSE DATE '2024-03-01' END AS date
FROM backtest_results""", ("backtest_results",), doubles="total_return_pct")
def table_backtests(spark, sf_dir):
    """Results saved one day, the successful ones saved again the next: one row for each."""
    results = fx.backtest_results(spark, sf_dir).select("backtest_id", "strategy_id", "total_return_pct", "success")
    day = lambda d: F.lit(f"2024-03-0{d} 10:00:00").cast("timestamp_ntz")

    def work(path):
        S.upsert_backtest(spark, path, results.drop("success"), "paper", day(1))
        S.upsert_backtest(spark, path, results.filter("success").drop("success").withColumn("trades", F.lit(7)),
                          "paper", day(2))
    return _kept(spark, "table-backtests", work).select(
        "backtest_id", "strategy_id", "total_return_pct", "trades_count", "metadata", "mode", "date")


_SEGMENT = "CASE load_seq % 5 WHEN 0 THEN '001' WHEN 1 THEN 'A:B' WHEN 2 THEN 'x/y=%z' WHEN 3 THEN '1' END"


@query("table_text_partitions", f"""
SELECT symbol, date, CASE WHEN load_seq % 3 = 0 THEN close + 1 ELSE close END AS close,
       CASE WHEN load_seq % 3 = 0 THEN load_seq + 1000000000 ELSE load_seq END AS load_seq, {_SEGMENT} AS segment
FROM bars WHERE load_seq % 5 <> 1 AND symbol <> 'S7'""", ("bars",), doubles="close")
def table_text_partitions(spark, sf_dir):
    """S9 + S14 on a table partitioned by a text: values that look like numbers, hold characters
    that paths escape, or are null; a third written again, one value and one symbol deleted."""
    bars = fx.bars(spark, sf_dir).select("symbol", "date", "close", "load_seq", F.expr(_SEGMENT).alias("segment"))
    again = bars.filter("load_seq % 3 = 0").withColumns(
        {"close": F.col("close") + 1, "load_seq": F.col("load_seq") + 1_000_000_000})
    path = K.scratch(spark, "table-text")
    S.write_table(bars, path, partition_by="segment")
    S.upsert(spark, path, again, ["symbol", "date", "segment"], partition_by="segment")
    S.delete_where(spark, path, F.col("segment") == "A:B", "segment")
    S.delete_where(spark, path, F.col("symbol") == "S7", "segment")
    rows = S.stored(spark, path, "segment").checkpoint()
    S.remove_path(spark, path)
    return rows.select(*bars.columns)
