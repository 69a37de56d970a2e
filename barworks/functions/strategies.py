"""named strategies that turn a symbol's bars into signals.

Two forms may be registered.  The preferred one is a DataFrame -> DataFrame
function built from native expressions (runs in whole-stage codegen).  A
per-symbol pandas function is also accepted and runs through
``groupBy('symbol').applyInPandas`` (Arrow batches, one symbol per call) -
that form needs a whole symbol in one task, so it suits daily bars, not tick
history.
"""

from __future__ import annotations

from typing import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# The momentum rule of the strategy configuration.
MOMENTUM_LOOKBACK = 10
MOMENTUM_THRESHOLD = 0.02
CONFIDENCE_SCALE = 0.1

_FRAME: dict[str, Callable[[DataFrame], DataFrame]] = {}
_PANDAS: dict[str, tuple[Callable[[pd.DataFrame], pd.DataFrame], str]] = {}

SIGNAL_SCHEMA = "symbol string, date date, close double, momentum double, signal int, confidence double"


def register_strategy(name: str, func: Callable, schema: str | None = None) -> None:
    """Register ``func``: a DataFrame -> DataFrame function, or (with ``schema``)
    a pandas function applied per symbol."""
    if schema is None:
        _FRAME[name] = func
    else:
        _PANDAS[name] = (func, schema)


def apply_strategy(bars: DataFrame, name: str) -> DataFrame:
    if name in _FRAME:
        return _FRAME[name](bars)
    func, schema = _PANDAS[name]
    return bars.groupBy("symbol").applyInPandas(func, schema)


def strategies() -> list[str]:
    return sorted(set(_FRAME) | set(_PANDAS))


def momentum(bars: DataFrame, lookback: int = MOMENTUM_LOOKBACK,
             threshold: float = MOMENTUM_THRESHOLD, bucket=None, block: int | None = None) -> DataFrame:
    """close / close ``lookback`` rows earlier - 1; +1 above the threshold,
    -1 below its negative, else 0; confidence = min(|r| / 0.1, 1)."""
    from .series import rolling

    def build(w):
        return {"momentum": F.try_divide(F.col("close"), F.lag("close", lookback).over(w)) - 1}
    b = rolling(bars.select("symbol", "date", "close"), ["symbol"], ["date"], lookback, build,
                bucket, block)
    m = F.col("momentum")
    return b.select("*", F.when(m > threshold, 1).when(m < -threshold, -1).otherwise(0).alias("signal"),
                    F.when(m.isNotNull(), F.least(F.abs(m) / CONFIDENCE_SCALE, F.lit(1.0)))
                     .alias("confidence"))


def momentum_pandas(pdf: pd.DataFrame) -> pd.DataFrame:
    """The same rule on one symbol's pandas frame."""
    pdf = pdf.sort_values("date")
    prev = pdf["close"].shift(MOMENTUM_LOOKBACK)
    r = (pdf["close"] / prev.where(prev != 0)) - 1
    sig = np.where(r > MOMENTUM_THRESHOLD, 1, np.where(r < -MOMENTUM_THRESHOLD, -1, 0))
    return pd.DataFrame({"symbol": pdf["symbol"], "date": pdf["date"], "close": pdf["close"],
                         "momentum": r, "signal": sig.astype("int32"),
                         "confidence": np.minimum(r.abs() / CONFIDENCE_SCALE, 1.0)})


register_strategy("momentum", momentum)
register_strategy("momentum_split", lambda b: momentum(b, bucket=F.date_trunc("week", "date"), block=16))
register_strategy("momentum_pandas", momentum_pandas, SIGNAL_SCHEMA)
