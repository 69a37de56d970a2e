"""Technical indicators; the SQL twins walk each series row by row (recursive CTEs)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import indicators as I
from ..sources import fixtures as fx
from .registry import query


def _mean(state: str, value: str, span: int) -> str:
    return f"{state} + ({value} - {state}) * 2.0 / ({span} + 1)"


def _seeded(state: str, value: str, period: int, place: str) -> str:
    return (f"CASE WHEN {place} <= {period} THEN {state} + {value} / {period} "
            f"ELSE {state} + ({value} - {state}) / {period} END")


def _rows(source: str, needed: str) -> str:
    """The rows of the series, numbered, with the previous row's values."""
    return f"""
SELECT symbol, date, high, low, close, row_number() OVER w AS p, row_number() OVER w - 1 AS place,
       lag(close) OVER w AS was, lag(high) OVER w AS was_high, lag(low) OVER w AS was_low
FROM {source} WHERE {needed} WINDOW w AS (PARTITION BY symbol ORDER BY date)"""


_MOVES = """
SELECT *, greatest(close - was, 0) AS up, greatest(was - close, 0) AS down,
       greatest(high - low, abs(high - was), abs(low - was)) AS tr,
       CASE WHEN high - was_high > was_low - low AND high > was_high THEN high - was_high ELSE 0.0 END AS dm_up,
       CASE WHEN was_low - low > high - was_high AND low < was_low THEN was_low - low ELSE 0.0 END AS dm_down
FROM numbered"""

_FIRST_SCAN = f"""
SELECT * FROM (WITH RECURSIVE walk AS (
  SELECT symbol, p, close AS e12, close AS e26, close AS e20, close AS e50, close AS e200,
         0.0::DOUBLE AS up14, 0.0::DOUBLE AS down14, 0.0::DOUBLE AS up21, 0.0::DOUBLE AS down21,
         0.0::DOUBLE AS tr14, 0.0::DOUBLE AS plus14, 0.0::DOUBLE AS minus14
  FROM moves WHERE p = 1
  UNION ALL
  SELECT m.symbol, m.p, {_mean('e12', 'close', 12)}, {_mean('e26', 'close', 26)}, {_mean('e20', 'close', 20)},
         {_mean('e50', 'close', 50)}, {_mean('e200', 'close', 200)},
         {_seeded('up14', 'up', 14, 'place')}, {_seeded('down14', 'down', 14, 'place')},
         {_seeded('up21', 'up', 21, 'place')}, {_seeded('down21', 'down', 21, 'place')},
         {_seeded('tr14', 'tr', 14, 'place')}, {_seeded('plus14', 'dm_up', 14, 'place')},
         {_seeded('minus14', 'dm_down', 14, 'place')}
  FROM walk JOIN moves m ON m.symbol = walk.symbol AND m.p = walk.p + 1)
SELECT m.symbol, m.date, m.high, m.low, m.close, m.place, walk.* EXCLUDE (symbol), e12 - e26 AS line,
       CASE WHEN place >= 14 THEN CASE WHEN plus14 + minus14 = 0 THEN 0.0
            ELSE 100 * abs(plus14 - minus14) / (plus14 + minus14) END END AS dx
FROM walk JOIN moves m USING (symbol, p))"""

_SECOND_SCAN = f"""
SELECT * FROM (WITH RECURSIVE walk2 AS (
  SELECT symbol, p, line AS sig, 0.0::DOUBLE AS adx14 FROM scanned WHERE p = 1
  UNION ALL
  SELECT s.symbol, s.p, {_mean('sig', 'line', 9)},
         CASE WHEN place < 14 THEN 0.0 ELSE {_seeded('adx14', 'dx', 14, 'place - 13')} END
  FROM walk2 JOIN scanned s ON s.symbol = walk2.symbol AND s.p = walk2.p + 1)
SELECT scanned.*, sig, adx14 FROM walk2 JOIN scanned USING (symbol, p))"""


def _scans(source: str, needed: str) -> list[tuple[str, str]]:
    return [("numbered", _rows(source, needed)), ("moves", _MOVES), ("scanned", _FIRST_SCAN),
            ("scanned2", _SECOND_SCAN)]


def _rsi(n: int) -> str:
    return (f"CASE WHEN place >= {n} THEN CASE WHEN up{n} + down{n} = 0 THEN 50.0 "
            f"ELSE 100 * up{n} / (up{n} + down{n}) END END")


_FRAMED = """
  SELECT *, count(*) OVER b AS bn, avg(close) OVER b AS mid, stddev_pop(close) OVER b AS dev,
         CASE WHEN count(*) OVER s = 14 THEN CASE WHEN max(high) OVER s = min(low) OVER s THEN 50.0
              ELSE 100 * (close - min(low) OVER s) / (max(high) OVER s - min(low) OVER s) END END AS k
  FROM scanned2
  WINDOW b AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW),
         s AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 13 PRECEDING AND CURRENT ROW)"""

_TABLE = f"""
SELECT symbol, date, {_rsi(14)} AS rsi_14, {_rsi(21)} AS rsi_21, e20 AS ema_20, e50 AS ema_50, e200 AS ema_200,
       line AS macd_line, sig AS macd_signal, line - sig AS macd_histogram,
       CASE WHEN bn = 20 THEN mid + 2 * dev END AS bb_upper, CASE WHEN bn = 20 THEN mid END AS bb_middle,
       CASE WHEN bn = 20 THEN mid - 2 * dev END AS bb_lower, k AS stoch_k,
       CASE WHEN count(k) OVER d = 3 THEN avg(k) OVER d END AS stoch_d,
       CASE WHEN place >= 14 THEN tr14 END AS atr, CASE WHEN place >= 27 THEN adx14 END AS adx
FROM framed WINDOW d AS (PARTITION BY symbol ORDER BY date ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

_ALL = "high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL"
_DOUBLES = " ".join(I.INDICATORS)
_FRAMES = _scans("history", _ALL) + [("framed", _FRAMED)]


@query("indicator_table", _TABLE, ("history",), doubles=_DOUBLES, extra=_FRAMES)
def indicator_table(spark, sf_dir):
    """All columns of the indicator table over the long daily series."""
    return I.indicator_table(fx.history(spark, sf_dir))


@query("indicator_table_split", _TABLE, ("history",), doubles=_DOUBLES, extra=_FRAMES)
def indicator_table_split(spark, sf_dir):
    """The same with weekly buckets, blocks of 3 rows and frames in blocks of 64 rows."""
    return I.indicator_table(fx.history(spark, sf_dir), F.date_trunc("week", "date"), 3, 64)


_MACD = """
SELECT v.symbol, v.date, e20 AS ema_20, e50 AS ema_50, e200 AS ema_200, line AS macd_line, sig AS macd_signal,
       line - sig AS macd_histogram
FROM vendor_a v LEFT JOIN scanned2 USING (symbol, date)"""


@query("ema_macd", _MACD, ("vendor_a",), doubles="ema_20 ema_50 ema_200 macd_line macd_signal macd_histogram",
       extra=_scans("vendor_a", "close IS NOT NULL"))
def ema_macd(spark, sf_dir):
    """EMA 20/50/200 and MACD line, signal, histogram of the faulty vendor's bars (gaps in the close)."""
    bars = fx.vendor_a(spark, sf_dir).select("symbol", "date", "close")
    return I.macd(I.ema(bars)).drop("close")


_RSI = f"""
SELECT symbol, date, rsi_14, rsi_21,
       CASE WHEN rsi_14 > 70 THEN 'SELL' WHEN rsi_14 < 30 THEN 'BUY' WHEN rsi_14 IS NOT NULL THEN 'HOLD' END AS action
FROM (SELECT v.symbol, v.date, {_rsi(14)} AS rsi_14, {_rsi(21)} AS rsi_21
      FROM vendor_a v LEFT JOIN scanned USING (symbol, date))"""


@query("rsi_signals", _RSI, ("vendor_a",), doubles="rsi_14 rsi_21", extra=_scans("vendor_a", "close IS NOT NULL")[:3])
def rsi_signals(spark, sf_dir):
    """RSI 14/21 and the 70/30 rule on the faulty vendor's bars (gaps in the close)."""
    bars = fx.vendor_a(spark, sf_dir).select("symbol", "date", "close")
    return I.rsi_rule(I.rsi(bars)).drop("close")


_ADX = """
SELECT symbol, date, CASE WHEN place >= 14 THEN tr14 END AS atr,
       CASE WHEN place >= 14 THEN CASE WHEN tr14 = 0 THEN 0.0 ELSE 100 * plus14 / tr14 END END AS plus_di,
       CASE WHEN place >= 14 THEN CASE WHEN tr14 = 0 THEN 0.0 ELSE 100 * minus14 / tr14 END END AS minus_di,
       CASE WHEN place >= 27 THEN adx14 END AS adx
FROM scanned2"""


@query("atr_adx", _ADX, ("history",), doubles="atr plus_di minus_di adx", extra=_scans("history", _ALL))
def atr_adx(spark, sf_dir):
    """ATR 14, both directional indicators and ADX 14 over the long daily series."""
    bars = fx.history(spark, sf_dir).select("symbol", "date", "high", "low", "close")
    return I.adx(I.atr(bars)).select("symbol", "date", "atr", "plus_di", "minus_di", "adx")
