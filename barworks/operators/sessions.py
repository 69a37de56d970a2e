"""Trading sessions: a calendar without weekends and holidays, and gaps counted in sessions.

The calendar holds one row per session with its number, so the sessions missing between
two bars are a difference of numbers, whatever lies between them.  Its size is that of
the calendar (some 250 rows a year), not of the bars.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import is_weekend, safe_div
from ..functions.series import with_prev


def session_calendar(bounds: DataFrame, holidays: DataFrame) -> DataFrame:
    """date, session (1, 2, ...): the weekdays from the first to the last day of ``bounds``
    (one row: first, last) that are not in ``holidays`` (date; repeated and NULL dates are allowed)."""
    days = bounds.filter("first IS NOT NULL AND last IS NOT NULL").select(
        F.explode(F.sequence(F.to_date("first"), F.to_date("last"))).alias("date"))
    days = days.filter(~is_weekend("date")).join(holidays.select("date").distinct(), "date", "left_anti")
    return days.withColumn("session", F.row_number().over(Window.orderBy("date")))


def bounds_of(bars: DataFrame) -> DataFrame:
    return bars.agg(F.min("date").alias("first"), F.max("date").alias("last"))


def session_gaps(bars: DataFrame, calendar: DataFrame, as_of: Column | None = None, days: int | None = None,
                 most: int = 0, bucket: Column | None = None) -> DataFrame:
    """Per symbol the gaps of more than ``most`` missing sessions between neighbouring bars:
    gap_count, missing_sessions (their sum), longest_gap.  Bars on days without a session
    are not looked at; ``days`` keeps the last days before ``as_of``, as ``date_gaps`` does."""
    if days is not None:
        bars = bars.filter(F.col("date") >= F.date_sub(as_of, days))
    b = bars.select("symbol", "date").distinct().join(calendar, "date")
    month = F.date_trunc("month", "date") if bucket is None else bucket
    b = with_prev(b, ["symbol"], ["date"], ["session"], month)
    missing = F.col("session") - F.col("prev_session") - 1
    return b.withColumn("missing", missing).filter(F.col("missing") > most).groupBy("symbol").agg(
        F.count(F.lit(1)).alias("gap_count"), F.sum("missing").alias("missing_sessions"),
        F.max("missing").cast("long").alias("longest_gap"))


def off_session_rows(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per symbol the rows on days without a session: weekend_rows, holiday_rows, first_date, last_date."""
    off = bars.filter(F.col("date").isNotNull()).join(calendar.select("date"), "date", "left_anti")
    return off.groupBy("symbol").agg(
        F.count_if(is_weekend("date")).alias("weekend_rows"), F.count_if(~is_weekend("date")).alias("holiday_rows"),
        F.min("date").alias("first_date"), F.max("date").alias("last_date"))


def session_coverage(bars: DataFrame, calendar: DataFrame) -> DataFrame:
    """Per symbol: sessions with a bar, the sessions from its first to its last, and their ratio."""
    b = bars.select("symbol", "date").distinct().join(calendar, "date")
    c = b.groupBy("symbol").agg(F.count(F.lit(1)).alias("sessions_present"),
                                (F.max("session") - F.min("session") + 1).cast("long").alias("sessions_expected"))
    return c.withColumn("completeness", safe_div("sessions_present", "sessions_expected"))
