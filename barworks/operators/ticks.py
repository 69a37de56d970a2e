"""Row-level quote validation.

Every check is a condition with a result.  The results of one record form an
array (NULLs filtered), which is exploded for the issue rows (T11); the
per-record summary and verdict (T12-T13) add up the conditions themselves.  No
shuffle beyond the per-symbol average volume used by the spike check.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import is_weekend, time_of_day
from .shape import POST_MARKET_END, POST_MARKET_START, PRE_MARKET_START, REGULAR_END, REGULAR_START

# Circuit-breaker limits by instrument category (default 0.20);
# the reference spells the fund key 'et', we accept both 'et' and 'etf'.
CIRCUIT_LIMITS = {"normal": 0.20, "et": 0.10, "etf": 0.10, "index": 0.05, "illiquid": 0.05}
DEFAULT_LIMIT = 0.20
MAX_PRICE = 100000
MIN_PRICE = 0.01
VOLUME_SPIKE = 5.0
GAP_THRESHOLD = 0.10
FUTURE_SECONDS = 300

LEVELS = ("info", "warning", "error", "critical")
_VERDICT = ("CASE WHEN total_checks > 0 THEN passed * 100.0D / total_checks ELSE 0.0D END AS success_rate",
            "failed = 0 AND critical_count = 0 AS is_valid")


@dataclass(frozen=True)
class TickCheck:
    """One result of the quote checks, declared as Spark SQL expressions."""

    check: str
    level: str
    valid: bool
    field: str
    cond: str
    value: str = "NULL"
    message: str | None = None

    def struct(self) -> str:
        return (f"named_struct('check', '{self.check}', 'level', '{self.level}', 'is_valid', {str(self.valid).lower()}, "
                f"'field', '{self.field}', 'value', CAST({self.value} AS DOUBLE))")


def flatten_ticks(ticks: DataFrame) -> DataFrame:
    """Quote rows with the ``ohlc`` struct lifted to columns."""
    return ticks.selectExpr("*", *[f"ohlc.{c} AS {c}" for c in ("open", "high", "low", "close")])


def _limit_sql(category: str = "category") -> str:
    cases = " ".join(f"WHEN '{k}' THEN {v}D" for k, v in CIRCUIT_LIMITS.items())
    return f"CASE {category} {cases} ELSE {DEFAULT_LIMIT}D END"


def tick_checks() -> list[TickCheck]:
    """T1-T10 in the order of their run, gates applied.  The messages are kept for what a summary lists."""
    full = ("open IS NOT NULL AND high IS NOT NULL AND low IS NOT NULL AND close IS NOT NULL "
            "AND volume IS NOT NULL")                                                    # T3
    pmax, pmin = "greatest(open, high, low, close)", "least(open, high, low, close)"
    chg = "abs(try_divide(close - previous_close, previous_close))"
    gap = "abs(try_divide(open - previous_close, previous_close))"
    tod = "date_format(ts, 'HH:mm:ss.SSSSSS')"
    in_session = (f"(({tod} >= '{REGULAR_START}' AND {tod} <= '{REGULAR_END}') OR "
                  f"({tod} >= '{PRE_MARKET_START}' AND {tod} < '{REGULAR_START}') OR "
                  f"({tod} >= '{POST_MARKET_START}' AND {tod} <= '{POST_MARKET_END}'))")
    c = TickCheck
    return [
        c("required_fields", "error", False, "symbol", "symbol IS NULL",                   # T1
          message="Missing required field: symbol"),
        c("required_fields", "error", False, "timestamp", "ts IS NULL", message="Missing required field: timestamp"),
        c("ohlc", "error", False, "high", f"{full} AND high < greatest(open, close)", "high",  # T4
          "High price below open or close"),
        c("ohlc", "error", False, "low", f"{full} AND low > least(open, close)", "low", "Low price above open or close"),
        *[c("ohlc", "error", False, x, f"{full} AND {x} <= 0", x, f"Non-positive price for {x}")
          for x in ("open", "high", "low", "close")],
        c("price_range", "warning", False, "price_range", f"{full} AND {pmax} > {MAX_PRICE}", pmax),  # T5
        c("price_range", "error", False, "price_range", f"{full} AND {pmin} < {MIN_PRICE}", pmin,
          "Extremely low price"),
        c("volume", "error", False, "volume", "volume < 0", "volume", "Negative volume"),  # T6
        c("volume", "warning", True, "volume", f"avg_volume IS NOT NULL AND volume > avg_volume * {VOLUME_SPIKE}", "volume"),
        c("circuit_breaker", "critical", True, "circuit_breaker",                          # T7
          f"close IS NOT NULL AND previous_close > 0 AND {chg} >= {_limit_sql()}", chg, "Circuit breaker limit reached"),
        c("timestamp", "warning", False, "timestamp", f"ts > _as_of + make_dt_interval(0, 0, 0, {FUTURE_SECONDS})"),  # T8
        c("market_hours", "info", True, "market_hours", "weekday(ts) >= 5"),               # T9
        c("market_hours", "warning", True, "market_hours", f"NOT (weekday(ts) >= 5) AND ts IS NOT NULL AND NOT {in_session}"),
        c("price_gap", "warning", True, "price_gap",                                       # T10
          f"open IS NOT NULL AND previous_close > 0 AND {gap} > {GAP_THRESHOLD}", gap),
    ]


def _prepared(ticks: DataFrame, as_of: Column, volumes: DataFrame | None) -> DataFrame:
    """Flat quotes with ``_as_of`` (a column first, because subqueries may not sit inside
    the array filter) and the symbol's average volume.  ``volumes`` (symbol, volume): where
    the averages come from, when that is cheaper to read than the quotes with all that was
    joined to them."""
    t = flatten_ticks(ticks).withColumn("_as_of", as_of)
    if "avg_volume" not in t.columns:
        avg = (t if volumes is None else volumes).groupBy("symbol").agg(F.avg("volume").alias("avg_volume"))
        t = t.join(avg, "symbol", "left")
    return t


def tick_results(ticks: DataFrame, as_of: Column, volumes: DataFrame | None = None) -> DataFrame:
    """Per record the array ``results`` of all check results (structs)."""
    items = ", ".join(f"CASE WHEN {c.cond} THEN {c.struct()} END" for c in tick_checks())
    return _prepared(ticks, as_of, volumes).selectExpr(
        "event_id", "symbol", "ts", f"filter(array({items}), x -> x IS NOT NULL) AS results")


def tick_issues(results: DataFrame) -> DataFrame:
    """T11 rows: one per (record, check result)."""
    return results.select("event_id", "symbol", "ts", F.explode("results").alias("r")) \
                  .select("event_id", "symbol", "ts", "r.*")


def tick_summary(results: DataFrame) -> DataFrame:
    """The counts and the verdict of ``quote_summary`` from rows of ``tick_results``."""
    def n(pred: str) -> str:
        return f"CAST(size(filter(results, x -> {pred})) AS BIGINT)"
    return results.selectExpr(
        "event_id", "symbol", "CAST(size(results) AS BIGINT) AS total_checks", f"{n('x.is_valid')} AS passed",
        f"{n('NOT x.is_valid')} AS failed", *["{} AS {}_count".format(n(f"x.level = '{lv}'"), lv) for lv in LEVELS]
    ).selectExpr("*", *_VERDICT)


def quote_summary(ticks: DataFrame, as_of: Column, volumes: DataFrame | None = None) -> DataFrame:
    """T12 + T13 per record: totals, passed / failed, counts by level, success rate (0
    when no results), the verdict (no failure, no critical) and the messages of the critical
    results and of the failed errors, in the checks' order.

    The checks' conditions become flags that are added up; no array of results is built."""
    checks = tick_checks()
    t = _prepared(ticks, as_of, volumes).selectExpr(
        "event_id", "symbol", *[f"coalesce({c.cond}, false) AS _f{i}" for i, c in enumerate(checks)])

    def n(keep) -> str:
        flags = [f"CAST(_f{i} AS BIGINT)" for i, c in enumerate(checks) if keep(c)]
        return " + ".join(flags) or "0L"

    def texts(keep) -> str:
        listed = [f"CASE WHEN _f{i} THEN '{c.message}' END" for i, c in enumerate(checks) if keep(c)]
        return f"array_compact(array({', '.join(listed)}))"

    t = t.selectExpr(
        "event_id", "symbol", f"{n(lambda c: True)} AS total_checks", f"{n(lambda c: c.valid)} AS passed",
        f"{n(lambda c: not c.valid)} AS failed", *[f"{n(lambda c, lv=lv: c.level == lv)} AS {lv}_count" for lv in LEVELS],
        f"{texts(lambda c: c.level == 'critical')} AS critical_issues",
        f"{texts(lambda c: c.level == 'error' and not c.valid)} AS errors")
    return t.selectExpr("*", *_VERDICT)


def raw_type_issues(raw: DataFrame, numeric=("last_price", "volume", "previous_close")) -> DataFrame:
    """T2 over landed text fields: a value present that does not parse."""
    checks = [f"CASE WHEN {c} IS NOT NULL AND try_cast({c} AS DOUBLE) IS NULL "
              f"THEN {TickCheck('data_types', 'error', False, c, '').struct()} END" for c in numeric if c in raw.columns]
    if "ts" in raw.columns:
        checks.append("CASE WHEN ts IS NOT NULL AND try_to_timestamp(ts) IS NULL "
                      f"THEN {TickCheck('timestamp', 'error', False, 'timestamp', '').struct()} END")
    res = f"filter(array({', '.join(checks)}), x -> x IS NOT NULL)"
    return raw.selectExpr("symbol", f"explode({res}) AS r").select("symbol", "r.*")
