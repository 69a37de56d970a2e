"""Column-level helpers shared by the operators (all native expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PRICE_COLUMNS = ("open", "high", "low", "close")
OHLCV_COLUMNS = ("open", "high", "low", "close", "volume")

# Issue severities, lowest to highest.
SEVERITIES = ("info", "warning", "error", "critical")


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_div(num, den) -> Column:
    """NULL on a zero or NULL denominator (ANSI mode raises on plain division)."""
    return F.try_divide(col(num), col(den))


def round_scaled(c: Column, digits: int = 6) -> Column:
    """round(x * 10^d) / 10^d on the binary double - the SQL engines' rounding,
    so the output edge rounds identically on both sides of the oracle check."""
    p = float(10 ** digits)
    return F.round(c * p, 0) / p


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double column (see ``round_scaled``); used at the output edge
    of checked queries.  Built as one projection of expression text."""
    p = float(10 ** digits)
    cols = [f"round(`{f.name}` * {p}, 0) / {p} AS `{f.name}`"
            if f.dataType.typeName() in ("double", "float") else f"`{f.name}`"
            for f in df.schema.fields]
    return df.selectExpr(*cols)


def time_of_day(ts: str | Column) -> Column:
    """'HH:mm:ss.SSSSSS' text, so comparisons keep sub-second precision."""
    return F.date_format(col(ts), "HH:mm:ss.SSSSSS")


def is_weekend(ts: str | Column) -> Column:
    return F.weekday(col(ts)) >= 5  # Monday = 0


def dedupe(df: DataFrame, key, by: str, last: bool = False) -> DataFrame:
    """One row per ``key``: the row with the smallest (or largest) ``by``.

    One ``row_number`` window (one exchange on the key, one sort).  A
    ``min_by(struct(row), by)`` aggregate was measured slower: struct buffers
    are not fixed-width, so Spark plans it as a sort aggregate with a sort on
    each side of the exchange."""
    from pyspark.sql.window import Window
    o = F.col(by).desc() if last else F.col(by).asc()
    w = Window.partitionBy(*list(key)).orderBy(o)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
