"""Prices and volumes adjusted for splits and dividends.

Actions and bars of a symbol form one timeline, in which an action stands before the bar
of its ex-date.  Along it, the last close before each action is filled forward (an as-of
lookup: the ex-date need not have a bar), and each bar takes the product of the factors of
all later actions, a running product from the end.  Both scans are cut into time buckets.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.recurrence import running
from ..functions.series import fill
from ..session import cut

SPLIT, DIVIDEND = "split", "dividend"
_KEYS, _ORDER = ["symbol"], ["date", "_bar"]


def _action_days(actions: DataFrame) -> DataFrame:
    """One row per symbol and ex-date: the ratios multiplied, the amounts added up.  Rows
    without a symbol, date or value, of another kind, or with a ratio or amount that is not
    positive are no actions."""
    a = actions.filter(F.col("symbol").isNotNull() & F.col("ex_date").isNotNull() & (F.col("value") > 0)
                       & F.col("kind").isin(SPLIT, DIVIDEND))
    return a.groupBy("symbol", F.col("ex_date").alias("date")).agg(
        F.product(F.when(F.col("kind") == SPLIT, F.col("value"))).alias("_ratio"),
        F.sum(F.when(F.col("kind") == DIVIDEND, F.col("value"))).alias("dividend"))


def _timeline(bars: DataFrame, actions: DataFrame, bucket: Column | None) -> DataFrame:
    """Bars (``_bar`` true) and action days with ``close_before``, the two factors of the action."""
    days = _action_days(actions).select("symbol", "date", F.lit(False).alias("_bar"),
                                        F.coalesce("_ratio", F.lit(1.0)).alias("ratio"), "dividend")
    line = bars.withColumn("_bar", F.lit(True)).unionByName(days, allowMissingColumns=True)
    # written once: each of the two scans reads its input twice
    line = cut(line.withColumn("_month", F.date_trunc("month", "date") if bucket is None else bucket))
    line = fill(line, _KEYS, _ORDER, {"close_before": F.col("close")}, "forward", F.col("_month"))
    # a dividend that no positive close precedes, or that is not below it, changes no price
    share = F.col("dividend") / F.col("close_before")
    paid = F.when((F.col("close_before") > 0) & (F.col("dividend") < F.col("close_before")), 1 - share)
    return line.withColumns({"split_factor": F.when(~F.col("_bar"), 1 / F.col("ratio")),
                             "price_factor": F.when(~F.col("_bar"), F.coalesce(paid, F.lit(1.0)) / F.col("ratio"))})


def adjustment_factors(bars: DataFrame, actions: DataFrame, bucket: Column | None = None) -> DataFrame:
    """symbol, ex_date, ratio, dividend, close_before, price_factor, split_factor per action day.

    ``actions``: symbol, ex_date, kind ('split': value new shares for one old; 'dividend':
    value per share), value.  ``close_before`` is the last known close before the ex-date."""
    line = _timeline(bars.select("symbol", "date", "close"), actions, bucket)
    return line.filter(~F.col("_bar")).select("symbol", F.col("date").alias("ex_date"), "ratio", "dividend",
                                              "close_before", "price_factor", "split_factor")


def adjusted(bars: DataFrame, actions: DataFrame, bucket: Column | None = None) -> DataFrame:
    """``bars`` (symbol, date, open, high, low, close, volume) with prices times ``price_factor`` and
    volume over ``split_factor``: the products of the factors of all actions with a later
    ex-date (1 without any).  Bars without a date have no place in time and stay as they are."""
    line = _timeline(bars.filter("date IS NOT NULL"), actions, bucket)
    line = running(line, _KEYS, _ORDER, products={"_price": F.col("price_factor"), "_split": F.col("split_factor")},
                   backward=True, bucket=F.col("_month")).filter("_bar")
    dateless = bars.filter("date IS NULL").withColumns({"_price": F.lit(1.0), "_split": F.lit(1.0)})
    out = line.select(*bars.columns, "_price", "_split").unionByName(dateless)
    return out.withColumns({**{c: F.col(c) * F.col("_price") for c in ("open", "high", "low", "close")},
                            "volume": F.col("volume") / F.col("_split")}).withColumnsRenamed(
        {"_price": "price_factor", "_split": "split_factor"})
