"""Technical indicators of the indicator table: exponential means and MACD, Wilder's RSI,
ATR and ADX, Bollinger bands and the stochastic oscillator.

The recurrences are scans of composable maps (``functions.recurrence``), the bounded
frames are halo windows (``functions.series.rolling``), both per (symbol, bucket), so no
task holds a symbol's whole series.  Rows without a close (for the range indicators: a
high, low or close) are no part of the series and get NULL values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recurrence import mean_of, recur, seeded_mean
from ..functions.series import in_blocks, with_place
from ..session import cut

# The columns of the indicator table and the parameters of the strategies.
EMA_SPANS = (20, 50, 200)
RSI_PERIODS = (14, 21)
MACD_FAST, MACD_SLOW, MACD_SIGNAL = 12, 26, 9
RSI_OVERBOUGHT, RSI_OVERSOLD = 70, 30
RANGE_PERIOD = 14
BAND_ROWS, BAND_WIDTH = 20, 2.0
STOCH_ROWS, STOCH_MEAN = 14, 3
# Ours: rows of a halo block of the bounded frames.
FRAME_BLOCK = 1024

INDICATORS = ("rsi_14", "rsi_21", "ema_20", "ema_50", "ema_200", "macd_line", "macd_signal", "macd_histogram",
              "bb_upper", "bb_middle", "bb_lower", "stoch_k", "stoch_d", "atr", "adx")

_KEYS, _ORDER, _MONTH = ["symbol"], ["date"], "_month"


def _monthly(df: DataFrame, bucket: Column | None) -> DataFrame:
    return df.withColumn(_MONTH, F.date_trunc("month", "date") if bucket is None else bucket)


def _scan(df: DataFrame, specs, block: int | None) -> DataFrame:
    return recur(df, _KEYS, _ORDER, specs, F.col(_MONTH), **({} if block is None else {"block": block}))


def _only(bars: DataFrame, needed: tuple[str, ...], build, columns: list[str]) -> DataFrame:
    """``build`` on the rows that hold ``needed``; the other rows with NULL in ``columns``."""
    whole = F.lit(True)
    for c in needed:
        whole = whole & F.col(c).isNotNull()
    rest = bars.filter(~whole).withColumns({c: F.lit(None).cast("double") for c in columns})
    return build(bars.filter(whole)).select(*bars.columns, *columns).unionByName(rest)


def _ema_specs(spans) -> dict:
    return {f"ema_{s}": mean_of(s, F.col("close")) for s in spans}


def ema(bars: DataFrame, spans: tuple[int, ...] = EMA_SPANS, bucket: Column | None = None,
        block: int | None = None) -> DataFrame:
    """``ema_<span>`` of the close: smoothing 2 / (span + 1), from the first close on."""
    def build(b):
        return _scan(_monthly(b, bucket), _ema_specs(spans), block)
    return _only(bars, ("close",), build, [f"ema_{s}" for s in spans])


def macd(bars: DataFrame, fast: int = MACD_FAST, slow: int = MACD_SLOW, signal: int = MACD_SIGNAL,
         bucket: Column | None = None, block: int | None = None) -> DataFrame:
    """Fast minus slow mean, the signal (a mean of that line: a second scan) and their difference."""
    def build(b):
        b = _scan(_monthly(b, bucket), {"_fast": mean_of(fast, F.col("close")), "_slow": mean_of(slow, F.col("close"))}, block)
        b = b.withColumn("macd_line", F.col("_fast") - F.col("_slow"))
        b = _scan(b, {"macd_signal": mean_of(signal, F.col("macd_line"))}, block)
        return b.withColumn("macd_histogram", F.col("macd_line") - F.col("macd_signal"))
    return _only(bars, ("close",), build, ["macd_line", "macd_signal", "macd_histogram"])


def _moves(b: DataFrame, columns: list[str]) -> DataFrame:
    """Previous values, ``_pos`` and ``_place``: the number of the change that leads to the row (0: the first row)."""
    b = with_place(b, _KEYS, _ORDER, columns, F.col(_MONTH), "_pos", "_was_")
    return b.withColumn("_place", F.col("_pos") - 1)


def _rsi_specs(periods) -> dict:
    change = F.col("close") - F.col("_was_close")
    out = {}
    for n in periods:
        out[f"_up_{n}"] = seeded_mean(n, F.greatest(change, F.lit(0.0)), F.col("_place"))
        out[f"_down_{n}"] = seeded_mean(n, F.greatest(-change, F.lit(0.0)), F.col("_place"))
    return out


def _rsi_value(n: int) -> Column:
    up, down = F.col(f"_up_{n}"), F.col(f"_down_{n}")
    value = F.when(up + down == 0, 50.0).otherwise(100 * F.try_divide(up, up + down))
    return F.when(F.col("_place") >= n, value)


def rsi(bars: DataFrame, periods: tuple[int, ...] = RSI_PERIODS, bucket: Column | None = None,
        block: int | None = None) -> DataFrame:
    """``rsi_<n>``: Wilder's mean gain as a share of mean gain plus mean loss, NULL before n
    changes, 50 without any movement."""
    def build(b):
        b = _scan(_moves(_monthly(b, bucket), ["close"]), _rsi_specs(periods), block)
        return b.withColumns({f"rsi_{n}": _rsi_value(n) for n in periods})
    return _only(bars, ("close",), build, [f"rsi_{n}" for n in periods])


def rsi_rule(rated: DataFrame, column: str = "rsi_14", overbought: float = RSI_OVERBOUGHT,
             oversold: float = RSI_OVERSOLD) -> DataFrame:
    """The RSI rule: SELL above ``overbought``, BUY below ``oversold``, else HOLD; NULL without a value."""
    v = F.col(column)
    return rated.withColumn("action", F.when(v > overbought, "SELL").when(v < oversold, "BUY")
                            .when(v.isNotNull(), "HOLD"))


def _true_range() -> Column:
    was = F.col("_was_close")
    return F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - was), F.abs(F.col("low") - was))


def _range_specs(n: int) -> dict:
    up, down = F.col("high") - F.col("_was_high"), F.col("_was_low") - F.col("low")
    zero = F.lit(0.0)
    place = F.col("_place")
    return {"_tr": seeded_mean(n, _true_range(), place),
            "_plus": seeded_mean(n, F.when((up > down) & (up > 0), up).otherwise(zero), place),
            "_minus": seeded_mean(n, F.when((down > up) & (down > 0), down).otherwise(zero), place)}


def _with_adx(b: DataFrame, n: int, block: int | None, more: dict | None = None) -> DataFrame:
    """``adx`` from the three smoothed ranges: the second scan of the chain (with ``more`` recurrences)."""
    plus, minus = F.col("_plus"), F.col("_minus")
    # the common divisor (the smoothed true range) drops out of the ratio
    dx = F.when(plus + minus == 0, 0.0).otherwise(100 * F.try_divide(F.abs(plus - minus), plus + minus))
    b = b.withColumn("_dx", F.when(F.col("_place") >= n, dx))
    b = _scan(b, {"_adx": seeded_mean(n, F.col("_dx"), F.col("_place") - (n - 1)), **(more or {})}, block)
    return b.withColumn("adx", F.when(F.col("_place") >= 2 * n - 1, F.col("_adx")))


def atr(bars: DataFrame, period: int = RANGE_PERIOD, bucket: Column | None = None,
        block: int | None = None) -> DataFrame:
    """``atr``: Wilder's mean of the true range, NULL before ``period`` changes."""
    def build(b):
        b = _moves(_monthly(b, bucket), ["close"])
        b = _scan(b, {"_tr": seeded_mean(period, _true_range(), F.col("_place"))}, block)
        return b.withColumn("atr", F.when(F.col("_place") >= period, F.col("_tr")))
    return _only(bars, ("high", "low", "close"), build, ["atr"])


def adx(bars: DataFrame, period: int = RANGE_PERIOD, bucket: Column | None = None,
        block: int | None = None) -> DataFrame:
    """``plus_di``, ``minus_di`` (from ``period`` changes on) and ``adx`` (from 2 * period - 1 on):
    true range and both directional movements in one scan, their index in a second."""
    def build(b):
        b = cut(_moves(_monthly(b, bucket), ["high", "low", "close"]))
        b = cut(_scan(b, _range_specs(period), block))
        b = _with_adx(b, period, block)
        ready = F.col("_place") >= period
        return b.withColumns({
            "plus_di": F.when(ready, F.when(F.col("_tr") == 0, 0.0).otherwise(100 * F.try_divide("_plus", "_tr"))),
            "minus_di": F.when(ready, F.when(F.col("_tr") == 0, 0.0).otherwise(100 * F.try_divide("_minus", "_tr")))})
    return _only(bars, ("high", "low", "close"), build, ["plus_di", "minus_di", "adx"])


def _bands(b: DataFrame, w, rows: int, width: float) -> DataFrame:
    f = w.rowsBetween(1 - rows, 0)
    ready = F.count("close").over(f) == rows
    middle, spread = F.avg("close").over(f), width * F.stddev_pop("close").over(f)
    return b.withColumns({"bb_upper": F.when(ready, middle + spread), "bb_middle": F.when(ready, middle),
                          "bb_lower": F.when(ready, middle - spread)})


def _stochastic(b: DataFrame, w, rows: int, mean: int) -> DataFrame:
    f, g = w.rowsBetween(1 - rows, 0), w.rowsBetween(1 - mean, 0)
    low, high = F.min("low").over(f), F.max("high").over(f)
    k = F.when(high == low, 50.0).otherwise(100 * F.try_divide(F.col("close") - low, high - low))
    b = b.withColumn("stoch_k", F.when(F.count("close").over(f) == rows, k))
    return b.withColumn("stoch_d", F.when(F.count("stoch_k").over(g) == mean, F.avg("stoch_k").over(g)))


def bands(bars: DataFrame, rows: int = BAND_ROWS, width: float = BAND_WIDTH, bucket: Column | None = None,
          block: int = FRAME_BLOCK) -> DataFrame:
    """Bollinger bands: mean of the last ``rows`` closes and ``width`` population deviations to
    both sides; NULL before ``rows`` closes."""
    def build(b):
        b = with_place(_monthly(b, bucket), _KEYS, _ORDER, ["close"], F.col(_MONTH), "_pos", "_was_")
        return in_blocks(b, _KEYS, "_pos", rows - 1, block, lambda u, w: _bands(u, w, rows, width))
    return _only(bars, ("close",), build, ["bb_upper", "bb_middle", "bb_lower"])


def stochastic(bars: DataFrame, rows: int = STOCH_ROWS, mean: int = STOCH_MEAN, bucket: Column | None = None,
               block: int = FRAME_BLOCK) -> DataFrame:
    """``stoch_k``: where the close stands between the lowest low and the highest high of the last
    ``rows`` rows (50 when they are equal); ``stoch_d``: its mean over ``mean`` rows."""
    def build(b):
        b = with_place(_monthly(b, bucket), _KEYS, _ORDER, ["close"], F.col(_MONTH), "_pos", "_was_")
        return in_blocks(b, _KEYS, "_pos", rows + mean - 2, block, lambda u, w: _stochastic(u, w, rows, mean))
    return _only(bars, ("high", "low", "close"), build, ["stoch_k", "stoch_d"])


def indicator_table(bars: DataFrame, bucket: Column | None = None, block: int | None = None,
                    frame_block: int = FRAME_BLOCK) -> DataFrame:
    """All columns of the indicator table per symbol and date: one pass for places and previous
    values, two scans for all recurrences (each written once, as the next step reads it twice),
    and one pass over halo blocks for the bounded frames.  Rows without a high, low or close
    get NULL in every indicator."""
    def build(b):
        b = cut(_moves(_monthly(b, bucket), ["high", "low", "close"]))
        b = cut(_scan(b, {**_ema_specs(EMA_SPANS), "_fast": mean_of(MACD_FAST, F.col("close")),
                          "_slow": mean_of(MACD_SLOW, F.col("close")), **_rsi_specs(RSI_PERIODS),
                          **_range_specs(RANGE_PERIOD)}, block))
        b = b.withColumn("macd_line", F.col("_fast") - F.col("_slow"))
        b = _with_adx(b, RANGE_PERIOD, block, {"macd_signal": mean_of(MACD_SIGNAL, F.col("macd_line"))})
        b = b.withColumns({"macd_histogram": F.col("macd_line") - F.col("macd_signal"),
                           "atr": F.when(F.col("_place") >= RANGE_PERIOD, F.col("_tr")),
                           **{f"rsi_{n}": _rsi_value(n) for n in RSI_PERIODS}})
        return in_blocks(b, _KEYS, "_pos", max(BAND_ROWS - 1, STOCH_ROWS + STOCH_MEAN - 2), frame_block, lambda u, w:
                         _stochastic(_bands(u, w, BAND_ROWS, BAND_WIDTH), w, STOCH_ROWS, STOCH_MEAN))
    return _only(bars.select("symbol", "date", "high", "low", "close"), ("high", "low", "close"), build,
                 list(INDICATORS)).select("symbol", "date", *INDICATORS)
