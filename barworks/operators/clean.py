"""Cleaning, imputation and outlier capping (C1-C31) as DataFrame transforms.

Series steps (fills, interpolation, previous-valid) go through the segmented
windows of ``functions.series``; per-symbol statistics (median, mean, mode,
quantiles) are partial-aggregated ``groupBy`` results joined back on the key,
never a whole-partition window.
"""

from __future__ import annotations

from typing import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.exprs import OHLCV_COLUMNS, PRICE_COLUMNS, dedupe
from ..functions.quantiles import group_percentiles, multi_percentiles
from ..functions.spline import interpolate_spline
from ..functions.series import fill, interpolate_linear, interpolate_local

KEYS = ("symbol",)
ORDER = ("date", "load_seq")

# Defaults of the cleaners.
DEFAULT_VOLUME = 1000.0
IQR_THRESHOLD = 3.0
ZSCORE_THRESHOLD = 3.0
LOW_QUANTILE, HIGH_QUANTILE = 0.01, 0.99
MIN_VALID_PRICE = 0.01
VOLUME_MEDIAN_ROWS = 10


def _present(df: DataFrame, cols: Sequence[str]) -> list[str]:
    return [c for c in cols if c in df.columns]


def value_columns(df: DataFrame, keys, order, numeric: bool = False) -> list[str]:
    """Every column (or every numeric one) that is neither key nor order."""
    own = {*keys, *order, "date"}
    return [f.name for f in df.schema if f.name not in own
            and (not numeric or isinstance(f.dataType, T.NumericType))]


# -- fills (C2, C10, C11, C27) ---------------------------------------------

def fill_forward(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS, order=ORDER,
                 bucket: Column | None = None, then_backward: bool = True) -> DataFrame:
    """C10 (and C2): last non-NULL value; with ``then_backward`` leading gaps take
    the next value.  ffill-then-bfill equals coalesce(ffill(c), bfill(c))."""
    cols = _present(df, cols)
    out = fill(df, keys, order, {"_f_" + c: F.col(c) for c in cols}, "forward", bucket)
    if then_backward:
        out = fill(out, keys, order, {"_b_" + c: F.col(c) for c in cols}, "backward", bucket)
        return out.withColumns({c: F.coalesce("_f_" + c, "_b_" + c) for c in cols}) \
                  .drop(*["_f_" + c for c in cols], *["_b_" + c for c in cols])
    return out.withColumns({c: F.col("_f_" + c) for c in cols}).drop(*["_f_" + c for c in cols])


def fill_backward(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS, order=ORDER,
                  bucket: Column | None = None, then_forward: bool = True) -> DataFrame:
    """C11 (C27 with ``then_forward=False``)."""
    cols = _present(df, cols)
    out = fill(df, keys, order, {"_b_" + c: F.col(c) for c in cols}, "backward", bucket)
    if then_forward:
        out = fill(out, keys, order, {"_f_" + c: F.col(c) for c in cols}, "forward", bucket)
        return out.withColumns({c: F.coalesce("_b_" + c, "_f_" + c) for c in cols}) \
                  .drop(*["_f_" + c for c in cols], *["_b_" + c for c in cols])
    return out.withColumns({c: F.col("_b_" + c) for c in cols}).drop(*["_b_" + c for c in cols])


def fill_linear(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS, order=ORDER,
                bucket: Column | None = None) -> DataFrame:
    """C12 / C28."""
    return interpolate_linear(df, keys, order, _present(df, cols), bucket)


def fill_cubic(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS, order=ORDER,
               bucket: Column | None = None) -> DataFrame:
    """C13 (re-aimed): local cubic through two known points on each side."""
    return interpolate_local(df, keys, order, _present(df, cols), 3, bucket)


def fill_spline(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS, order=ORDER,
                bucket: Column | None = None) -> DataFrame:
    """One cubic spline through all known values of a symbol."""
    return interpolate_spline(df, keys, order, _present(df, cols), bucket)


def fill_quadratic(df: DataFrame, cols: Sequence[str] = OHLCV_COLUMNS, keys=KEYS,
                   order=ORDER, bucket: Column | None = None) -> DataFrame:
    """C29 (re-aimed): local quadratic through the three nearest known points."""
    return interpolate_local(df, keys, order, _present(df, cols), 2, bucket)


def _stat_fill(df: DataFrame, cols, keys, agg: Callable[[str], Column] | None = None,
               stats: DataFrame | None = None) -> DataFrame:
    cols = _present(df, cols)
    if stats is None:
        stats = df.groupBy(*keys).agg(*[agg(c).alias("_s_" + c) for c in cols])
    out = df.join(stats, list(keys), "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_s_" + c)) for c in cols}) \
              .drop(*["_s_" + c for c in cols])


def _medians(df: DataFrame, cols, keys) -> DataFrame:
    """Per-key exact medians of every column, one row per key."""
    return multi_percentiles(df, keys, {c: ([0.5], ["_s_" + c]) for c in cols})


def fill_mean(df, cols=OHLCV_COLUMNS, keys=KEYS):
    """C14: per-symbol column mean."""
    return _stat_fill(df, cols, keys, F.avg)


def fill_median(df, cols=OHLCV_COLUMNS, keys=KEYS):
    """Per-symbol exact median (linear between ranks)."""
    cols = _present(df, cols)
    return _stat_fill(df, cols, keys, stats=_medians(df, cols, keys))


def _modes(df: DataFrame, cols, keys) -> DataFrame:
    """Per-key modes: equal values are counted first, then the most frequent (the
    smallest on ties) is one maximum, so no task holds the values of a key."""
    out = None
    for c in cols:
        counts = df.filter(F.col(c).isNotNull()).groupBy(*keys, c).agg(F.count(F.lit(1)).alias("_n"))
        part = counts.groupBy(*keys).agg(F.min(F.struct(-F.col("_n"), F.col(c).alias("v")))["v"].alias("_s_" + c))
        out = part if out is None else out.join(part, list(keys), "full")
    return out


def fill_mode(df, cols=OHLCV_COLUMNS, keys=KEYS):
    """Per-symbol most frequent value, the smallest on ties."""
    cols = _present(df, cols)
    return _stat_fill(df, cols, keys, stats=_modes(df, cols, keys))


def fill_zero(df, cols=OHLCV_COLUMNS):
    """C17 ZERO; NONE is the identity."""
    return df.fillna(0.0, subset=_present(df, cols))


IMPUTERS: dict[str, Callable[..., DataFrame]] = {
    "forward_fill": fill_forward,
    "backward_fill": fill_backward,
    "linear": fill_linear,
    "polynomial": fill_cubic,
    "spline": fill_spline,
    "mean": fill_mean,
    "median": fill_median,
    "mode": fill_mode,
    "zero": fill_zero,
    "none": lambda df, *a, **k: df,
}


def impute(df: DataFrame, method: str = "forward_fill",
           custom: Callable[[Column], Column] | None = None, **kw) -> DataFrame:
    """C9 dispatcher over every column (``cols`` narrows it; interpolations and
    averages over every numeric one).  ``custom`` (F2) maps each column expression to its
    replacement; without it CUSTOM passes the frame through unchanged."""
    if method == "custom":
        if custom is None:
            return df
        return df.withColumns({c: custom(F.col(c)) for c in value_columns(df, KEYS, ORDER, numeric=True)})
    if method != "none":
        kw.setdefault("cols", value_columns(df, kw.get("keys", KEYS), kw.get("order", ORDER),
                                            numeric=method not in ("forward_fill", "backward_fill", "mode")))
    return IMPUTERS[method](df, **kw)


# -- outliers (C18-C20) ----------------------------------------------------

def _bounds(df, cols, keys, method, threshold):
    if method == "zscore":
        stats = df.groupBy(*keys).agg(*[a for c in cols for a in (
            F.avg(c).alias("_m_" + c), F.stddev_samp(c).alias("_s_" + c))])
        return stats.select(*keys, *[x for c in cols for x in (
            (F.col("_m_" + c) - threshold * F.col("_s_" + c)).alias("_lo_" + c),
            (F.col("_m_" + c) + threshold * F.col("_s_" + c)).alias("_hi_" + c))])
    ps = (0.25, 0.75) if method == "iqr" else (LOW_QUANTILE, HIGH_QUANTILE)
    stats = multi_percentiles(df, keys, {c: (ps, ["_a_" + c, "_b_" + c]) for c in cols})
    sel = list(keys)
    for c in cols:
        a, b = F.col("_a_" + c), F.col("_b_" + c)
        if method == "iqr":
            sel += [(a - threshold * (b - a)).alias("_lo_" + c), (b + threshold * (b - a)).alias("_hi_" + c)]
        else:
            sel += [a.alias("_lo_" + c), b.alias("_hi_" + c)]
    return stats.select(*sel)


def cap_outliers(df: DataFrame, method: str = "iqr", threshold: float | None = None,
                 cols: Sequence[str] | None = None, keys=KEYS, order=ORDER) -> DataFrame:
    """C18 iqr (q1 - t*iqr, q3 + t*iqr), C19 zscore (mean +- t*sample std),
    C20 quantile (1% / 99%) on ``cols``, every numeric column by default;
    unknown method -> unchanged."""
    if method not in ("iqr", "zscore", "quantile"):
        return df
    if threshold is None:
        threshold = IQR_THRESHOLD if method == "iqr" else ZSCORE_THRESHOLD
    cols = value_columns(df, keys, order, numeric=True) if cols is None else _present(df, cols)
    out = df.join(_bounds(df, cols, keys, method, threshold), list(keys), "left")
    capped = {}
    for c in cols:
        lo, hi, v = F.col("_lo_" + c), F.col("_hi_" + c), F.col(c)
        capped[c] = F.when(v < lo, lo).when(v > hi, hi).otherwise(v)
    return out.withColumns(capped).drop(*[p + c for c in cols for p in ("_lo_", "_hi_")])


# -- OHLC repair and negative prices (C3-C5, C21-C25) ----------------------

def ohlc_repair(df: DataFrame, with_counts: bool = False) -> DataFrame:
    """High >= max(open, close), low <= min(open, close) (NULLs skipped).
    ``with_counts`` adds the per-row flags ``high_fixed`` / ``low_fixed``."""
    mx, mn = F.greatest("open", "close"), F.least("open", "close")
    hf, lf = F.col("high") < mx, F.col("low") > mn
    out = df
    if with_counts:
        out = out.withColumns({"high_fixed": F.coalesce(hf, F.lit(False)),
                               "low_fixed": F.coalesce(lf, F.lit(False))})
    return out.withColumns({"high": F.when(hf, mx).otherwise(F.col("high")),
                            "low": F.when(lf, mn).otherwise(F.col("low"))})


def negative_prices(df: DataFrame, method: str = "absolute", keys=KEYS, order=ORDER,
                    min_valid_price: float = MIN_VALID_PRICE,
                    cols: Sequence[str] = PRICE_COLUMNS + ("adj_close",),
                    bucket: Column | None = None) -> DataFrame:
    """C22 absolute (default, also for unknown methods), C23 previous valid
    (leading -> next valid; the whole column is filled, as in the reference),
    C24 minimum valid price, C25 NULL."""
    cols = _present(df, cols)
    if method == "previous":
        masked = df.withColumns({c: F.when(~(F.col(c) < 0), F.col(c)) for c in cols})
        return fill_forward(masked, cols, keys, order, bucket)
    rep = {"minimum": lambda c: F.when(F.col(c) < 0, F.lit(min_valid_price)).otherwise(F.col(c)),
           "nan": lambda c: F.when(~(F.col(c) < 0), F.col(c))}
    f = rep.get(method, lambda c: F.when(F.col(c) < 0, F.abs(c)).otherwise(F.col(c)))
    if method == "nan":
        return df.withColumns({c: F.when(F.col(c).isNull() | (F.col(c) >= 0), F.col(c)) for c in cols})
    return df.withColumns({c: f(c) for c in cols})


def _volume_to_median(df: DataFrame, keys=KEYS) -> DataFrame:
    """NULL or non-positive volume -> median of the positive volumes, 1000 if none."""
    med = group_percentiles(df, keys, "volume", [0.5], ["_med"], where="volume > 0")
    out = df.join(med, list(keys), "left")
    v = F.col("volume")
    return out.withColumn("volume", F.when(v.isNull() | (v <= 0),
                                           F.coalesce("_med", F.lit(DEFAULT_VOLUME)))
                          .otherwise(v)).drop("_med")


def clean_bars(df: DataFrame, keys=KEYS, order=ORDER, bucket: Column | None = None) -> DataFrame:
    """C2 fill -> C3 abs of non-positive prices -> C4 swap -> C5 raise/lower
    -> C6 volume -> C7 keep the first row per (symbol, date)."""
    out = fill_forward(df, value_columns(df, keys, order), keys, order, bucket)
    out = out.withColumns({c: F.when(F.col(c) <= 0, F.abs(c)).otherwise(F.col(c))
                           for c in PRICE_COLUMNS})
    swap = F.col("high") < F.col("low")
    out = out.withColumns({"high": F.when(swap, F.col("low")).otherwise(F.col("high")),
                           "low": F.when(swap, F.col("high")).otherwise(F.col("low"))})
    for ref in ("open", "close"):
        out = out.withColumn("high", F.when(F.col("high") < F.col(ref), F.col(ref))
                             .otherwise(F.col("high")))
    for ref in ("open", "close"):
        out = out.withColumn("low", F.when(F.col("low") > F.col(ref), F.col(ref))
                             .otherwise(F.col("low")))
    if "volume" in out.columns:
        out = _volume_to_median(out, keys)
    return keep_first(out, [*keys, "date"], "load_seq")


def keep_first(df: DataFrame, key: Sequence[str], by: str, last: bool = False) -> DataFrame:
    """One row per key, the first (or last) by ``by``."""
    return dedupe(df, key, by, last)


def clean_pipeline(df: DataFrame, method: str = "forward_fill", outliers: str | None = "iqr",
                   keys=KEYS, order=ORDER) -> DataFrame:
    """Impute -> outlier caps -> OHLC repair."""
    kw = {"keys": keys, "order": order} if method in ("forward_fill", "backward_fill", "linear") \
        else ({"keys": keys} if method in ("mean", "median", "mode") else {})
    out = impute(df, method, **kw)
    if outliers:
        out = cap_outliers(out, outliers, keys=keys)
    return ohlc_repair(out)


# -- tiered imputer (C26-C31) ----------------------------------------------

def volume_rolling_median(df: DataFrame, keys=KEYS, order=ORDER, rows: int = VOLUME_MEDIAN_ROWS,
                          bucket: Column | None = None, block: int | None = None) -> DataFrame:
    """NULL volume -> median of the last ``rows`` rows including the current
    one (NULLs skipped).  The frame is bounded, so per-row work is O(rows);
    ``block`` adds the halo split for hot symbols."""
    from ..functions.series import rolling

    def build(w):
        return {"volume": F.coalesce(F.col("volume"),
                                     F.percentile("volume", 0.5).over(w.rowsBetween(-(rows - 1), 0)))}
    return rolling(df, keys, order, rows - 1, build, bucket, block)


def cross_source_fill(primary: DataFrame, reference: DataFrame,
                      cols: Sequence[str] = PRICE_COLUMNS, keys=KEYS) -> DataFrame:
    """NULL price -> the other vendor's value on the same date (the first one
    by ``load_seq`` if that vendor has the date twice, else the least)."""
    if "load_seq" in reference.columns:
        reference = keep_first(reference, [*keys, "date"], "load_seq")
    else:
        reference = reference.groupBy(*keys, "date").agg(*[F.min(c).alias(c) for c in cols])
    ref = reference.select(*keys, "date", *[F.col(c).alias("_r_" + c) for c in cols])
    out = primary.join(ref, [*keys, "date"], "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_r_" + c)) for c in cols}) \
              .drop(*["_r_" + c for c in cols])


def tiered_impute(df: DataFrame, method: str = "linear", reference: DataFrame | None = None,
                  keys=KEYS, order=ORDER, bucket: Column | None = None) -> DataFrame:
    """Prices by method (one-way fills, linear, cross-source), volume by
    rolling median, then OHLC repair for symbols where something was missing."""
    cols = _present(df, PRICE_COLUMNS)
    if method == "forward_fill":
        out = fill_forward(df, cols, keys, order, bucket, then_backward=False)
    elif method == "backward_fill":
        out = fill_backward(df, cols, keys, order, bucket, then_forward=False)
    elif method == "cross_source" and reference is not None:
        out = cross_source_fill(df, reference, cols, keys)
    elif method == "market_average":
        out = market_average_fill(df, cols)
    elif method == "spline":
        out = fill_quadratic(df, cols, keys, order, bucket)
    else:
        out = fill_linear(df, cols, keys, order, bucket)
    if "volume" in df.columns:
        out = volume_rolling_median(out, keys, order, bucket=bucket)
    tracked = [*cols] + (["volume"] if "volume" in df.columns else [])
    gaps = (df.groupBy(*keys)
              .agg(F.max(F.greatest(*[F.col(c).isNull() for c in tracked])).alias("_any_null")))
    out = out.join(gaps, list(keys), "left")
    mx, mn, g = F.greatest("open", "close"), F.least("open", "close"), F.col("_any_null")
    return out.withColumns({"high": F.when(g & (F.col("high") < mx), mx).otherwise(F.col("high")),
                            "low": F.when(g & (F.col("low") > mn), mn).otherwise(F.col("low"))}) \
              .drop("_any_null")


def market_average_fill(df: DataFrame, cols: Sequence[str] = PRICE_COLUMNS) -> DataFrame:
    """MARKET_AVERAGE (ours; the reference has no branch): NULL price -> the
    same-date average over all symbols."""
    avg = df.groupBy("date").agg(*[F.avg(c).alias("_a_" + c) for c in cols])
    out = df.join(avg, "date", "left")
    return out.withColumns({c: F.coalesce(F.col(c), F.col("_a_" + c)) for c in cols}) \
              .drop(*["_a_" + c for c in cols])
