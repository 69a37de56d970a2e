"""Projections, filters and shaping.

Renames are computed from the schema only (driver-side metadata, no data);
everything else is a column expression.
"""

from __future__ import annotations

import re
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import dedupe, is_weekend, safe_div, time_of_day

# The exchange session bounds (inclusive) of the trading-session label.
PRE_MARKET_START = "09:00:00.000000"
REGULAR_START = "09:15:00.000000"
REGULAR_END = "15:30:00.000000"
POST_MARKET_START = "15:40:00.000000"
POST_MARKET_END = "16:00:00.000000"

# Vendor source names -> canonical source.
SOURCE_ALIASES = {"yahoo": "yahoo_finance", "yfinance": "yahoo_finance",
                  "kite": "kiteconnect", "kiteconnect": "kiteconnect",
                  "nse": "nse_official", "bse": "bse_official"}

# Trading decision and sizing rules.
SIGNAL_THRESHOLD = 0.5
MIN_CONFIDENCE = 0.6
POSITION_FRACTION = 0.05
STOP_LOSS = -0.05
TAKE_PROFIT = 0.15

TICKER_SUFFIX = r"\.NS$"


def normalise_name(name: str, ticker: str | None = None) -> str:
    """Lower-case; blanks and dots to '_'; a ('Close', 'X') pair keeps its first level;
    a ``ticker`` at the end of the name is taken off."""
    m = re.match(r"^\('([^']*)',.*\)$", name)
    if m:
        name = m.group(1)
    plain = lambda t: re.sub(r"[ .]", "_", t.strip().lower())
    name = plain(name)
    return name.removesuffix("_" + plain(ticker)) if ticker else name


def standardize(df: DataFrame, symbol: str | Column | None = None,
                suffix: str = TICKER_SUFFIX) -> DataFrame:
    """Normalised names, parsed date, ticker suffix stripped, symbol added.

    A ``date`` column of text or days becomes a date; a column of timestamps, or one
    named ``datetime`` or ``timestamp``, keeps its time of day.  What cannot be read
    is NULL."""
    ticker = symbol if isinstance(symbol, str) else None
    out = df.toDF(*[normalise_name(c, ticker) for c in df.columns])
    for cand in ("date", "datetime", "timestamp"):
        if cand in out.columns:
            kind = out.schema[cand].dataType.typeName()
            timed = cand != "date" or kind.startswith("timestamp")
            value = F.col(cand) if kind.startswith("timestamp") or kind == "date" else F.col(cand).cast("string")
            out = out.withColumn("date", value.try_cast("timestamp_ntz" if timed else "date"))
            break
    if symbol is not None:
        out = out.withColumn("symbol", symbol if isinstance(symbol, Column) else F.lit(symbol))
    elif "ticker" in out.columns:
        out = out.withColumnRenamed("ticker", "symbol")
    if "symbol" in out.columns:
        out = out.withColumn("symbol", strip_suffix("symbol", suffix))
    return out


def unpivot_wide(df: DataFrame, date_col: str = "Date", sep: str = "_",
                 fields: Sequence[str] = ("Open", "High", "Low", "Close", "Volume")) -> DataFrame:
    """P1 for wide multi-ticker frames (``<Field><sep><TICKER>`` columns): one
    row per (date, ticker) via an array of structs + explode - no shuffle."""
    tickers = sorted({c.split(sep, 1)[1] for c in df.columns
                      if sep in c and c.split(sep, 1)[0] in fields})
    rows = F.array(*[F.struct(F.lit(t).alias("ticker"),
                              *[(F.col(f"`{f}{sep}{t}`") if f"{f}{sep}{t}" in df.columns
                                 else F.lit(None).cast("double")).alias(f) for f in fields])
                     for t in tickers])
    return df.select(F.col(date_col), F.explode(rows).alias("r")).select(date_col, "r.*")


def keep_last_per_date(df: DataFrame, keys: Sequence[str] = ("symbol", "date"),
                       seq: str = "load_seq") -> DataFrame:
    """The last landed row per duplicate (symbol, date)."""
    return dedupe(df, keys, seq, last=True)


SEGMENT_COLUMNS = ["symbol", "date", "timestamp", "open", "high", "low", "close", "volume",
                   "adjusted_close", "sector", "market_cap_segment", "data_source",
                   "data_quality_score", "created_at"]


def segment_shape(df: DataFrame, table_name: str | Column, data_source: str | Column,
                  loaded_at: Column) -> DataFrame:
    """The 14-column segment table row (constants, segment from table name)."""
    t = table_name if isinstance(table_name, Column) else F.lit(table_name)
    seg = (F.when(t.contains("large_cap"), "large_cap").when(t.contains("mid_cap"), "mid_cap")
            .otherwise("small_cap"))
    src = data_source if isinstance(data_source, Column) else F.lit(data_source)
    return df.select(
        "symbol", F.to_date("date").alias("date"), loaded_at.alias("timestamp"),
        "open", "high", "low", "close", "volume", F.col("close").alias("adjusted_close"),
        F.lit("Unknown").alias("sector"), seg.alias("market_cap_segment"),
        src.alias("data_source"), F.lit(1.0).alias("data_quality_score"),
        loaded_at.alias("created_at"))


def coerce_dropna(df: DataFrame, numeric: Sequence[str] = ("open", "high", "low", "close", "volume"),
                  date_col: str = "date") -> DataFrame:
    """Bad numbers and dates -> NULL (try_cast, never raising), then drop
    rows without a date or close."""
    out = df.withColumns({c: F.col(c).cast("string").try_cast("double")
                          for c in numeric if c in df.columns})
    out = out.withColumn(date_col, F.try_to_date(F.col(date_col).cast("string")))
    return out.dropna(subset=[date_col, "close"])


def flatten_quotes(q: DataFrame) -> DataFrame:
    """P5: quote records with a nested ``ohlc`` struct -> flat row, missing -> 0."""
    z = F.lit(0.0)
    has = "ohlc" in q.columns

    def part(c):
        return F.coalesce(F.col(f"ohlc.{c}"), z) if has else z
    return q.select("symbol", "ts",
                    F.coalesce(F.col("last_price"), z).alias("last_price"),
                    *[part(c).alias(c) for c in ("open", "high", "low", "close")],
                    F.coalesce(F.col("volume"), z).alias("volume"))


def rename_portfolio(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Broker field names -> table names."""
    return df.withColumnsRenamed(mapping)


def strip_suffix(symbol: str | Column = "symbol", suffix: str = TICKER_SUFFIX) -> Column:
    """P7 (anchored at the end, unlike the reference's replace-anywhere)."""
    return F.regexp_replace(F.col(symbol) if isinstance(symbol, str) else symbol, suffix, "")


def add_suffix(symbol: str | Column = "symbol", suffix: str = ".NS") -> Column:
    return F.concat(F.col(symbol) if isinstance(symbol, str) else symbol, F.lit(suffix))


def month_ranges(df: DataFrame, start: str = "start_date", end: str = "end_date",
                 strict_reference: bool = False) -> DataFrame:
    """One row per month of [start, end]; first range partial, last clipped.
    ``strict_reference`` keeps the reference's ``current < end`` loop test, which
    loses an end that falls on the 1st of a month."""
    m = F.explode(F.sequence(F.trunc(start, "MM"), F.trunc(end, "MM"),
                             F.expr("INTERVAL 1 MONTH"))).alias("_m")
    out = df.select("*", m)
    out = out.select(*[c for c in df.columns],
                     F.greatest(F.col("_m"), F.col(start)).alias("range_start"),
                     F.least(F.last_day("_m"), F.col(end)).alias("range_end"))
    keep = (F.col("range_start") < F.col(end)) if strict_reference else \
        (F.col("range_start") <= F.col(end))
    return out.filter(keep)


def date_range(df: DataFrame, start: Column | None = None, end: Column | None = None,
               symbol: str | None = None, col: str = "date", newest_first: bool | None = None) -> DataFrame:
    """Open-ended range select; ``newest_first`` True or False sorts by ``col`` (O1), None
    leaves the order open."""
    out = df
    if symbol is not None:
        out = out.filter(F.col("symbol") == symbol)
    if start is not None:
        out = out.filter(F.col(col) >= start)
    if end is not None:
        out = out.filter(F.col(col) <= end)
    return in_order(out, col, newest_first)


def in_order(df: DataFrame, by: str, newest_first: bool | None = True, then: Sequence[str] = ("symbol",)) -> DataFrame:
    """O1: rows by ``by`` (a sort by ranges, NULLs last), newest or oldest first; rows of one time by ``then``."""
    if newest_first is None:
        return df
    first = F.col(by).desc_nulls_last() if newest_first else F.col(by).asc_nulls_last()
    return df.orderBy(first, *[c for c in then if c in df.columns and c != by])


def recent_rows(df: DataFrame, as_of: Column, hours: int = 24, ts: str = "ts",
                newest_first: bool | None = None) -> DataFrame:
    """Rows of the last ``hours`` before ``as_of``, newest first when asked for."""
    return in_order(df.filter(F.col(ts) >= as_of - F.make_dt_interval(hours=F.lit(hours))), ts, newest_first)


def normalise_source(source: str | Column = "source") -> Column:
    """Vendor source name -> canonical name, else 'unknown'."""
    s = F.lower(F.col(source) if isinstance(source, str) else source)
    out = F.lit("unknown")
    for k, v in SOURCE_ALIASES.items():
        out = F.when(s == k, F.lit(v)).otherwise(out)
    return out


def session_label(ts: str | Column = "ts") -> Column:
    """Weekend first, then regular 09:15-15:30, pre 09:00-09:15,
    post 15:40-16:00 (all inclusive), else closed."""
    t = time_of_day(ts)
    return (F.when(is_weekend(ts), "weekend")
             .when((t >= REGULAR_START) & (t <= REGULAR_END), "regular")
             .when((t >= PRE_MARKET_START) & (t <= REGULAR_START), "pre_market")
             .when((t >= POST_MARKET_START) & (t <= POST_MARKET_END), "post_market")
             .otherwise("closed"))


def market_open(ts: str | Column = "ts") -> Column:
    """P16."""
    return session_label(ts) == "regular"


def trading_decisions(signals: DataFrame, ts: str = "timestamp") -> DataFrame:
    """P20: only each symbol's latest signal; buy if signal > 0.5 and
    confidence > 0.6, sell if signal < -0.5 and confidence > 0.6, else hold."""
    latest = signals.groupBy("symbol").agg(
        F.max_by(F.struct(*[c for c in signals.columns if c != "symbol"]), F.col(ts)).alias("s"))
    s, c = F.col("s.signal"), F.col("s.confidence")
    return latest.select("symbol", "s.*",
                         F.when((s > SIGNAL_THRESHOLD) & (c > MIN_CONFIDENCE), "BUY")
                          .when((s < -SIGNAL_THRESHOLD) & (c > MIN_CONFIDENCE), "SELL")
                          .otherwise("HOLD").alias("decision"))


def position_size(df: DataFrame, cash: Column, price: str = "price",
                  confidence: str = "confidence") -> DataFrame:
    """int(cash * 0.05 * confidence / price); rows with no price or 0 skipped."""
    q = F.floor(safe_div(cash * POSITION_FRACTION * F.col(confidence), F.col(price)))
    return df.withColumn("quantity", q).filter(F.col("quantity") > 0)


def exit_flags(positions: DataFrame, quotes: DataFrame) -> DataFrame:
    """P22 + J10: positions joined to the latest price; stop loss below -5%,
    take profit above +15%."""
    j = positions.join(quotes.select("symbol", "last_price"), "symbol", "inner")
    pnl = safe_div(F.col("last_price") - F.col("entry_price"), F.col("entry_price"))
    return j.withColumn("pnl_pct", pnl).withColumn(
        "exit_reason", F.when(pnl < STOP_LOSS, "stop_loss").when(pnl > TAKE_PROFIT, "take_profit"))
