"""Validation queries (V*, A1) and their SQL twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as V
from ..sources import fixtures as fx
from .registry import query

PRICES = ("open", "high", "low", "close")

# -- SQL twin of checks.validate_bars --------------------------------------

_ENRICH = """
SELECT b.*, lag(close) OVER w AS prev_close, lag(date) OVER w AS prev_date, m.med
FROM {src} b LEFT JOIN (SELECT symbol, source, quantile_cont(volume, 0.5) AS med
                        FROM {src} GROUP BY symbol, source) m USING (symbol, source)
WINDOW w AS (PARTITION BY symbol, source ORDER BY date, load_seq)"""

_CHG = """
SELECT *, CASE WHEN prev_close IS NULL OR close IS NULL THEN NULL
               WHEN prev_close = 0 THEN CASE WHEN close <> 0 THEN CAST('inf' AS DOUBLE) END
               ELSE abs((close - prev_close) / prev_close) END AS chg
FROM enr"""


def _specs():
    """(issue_type, severity_sql, column, count_sql, gate_sql, action, kind)."""
    s = []
    for c in ("open", "high", "low", "close", "volume"):
        s.append(("missing_columns", "'critical'", c, f"count({c})", "", V.ACTIONS["missing_columns"], "struct"))
    s.append(("missing_date", "'error'", "date", "count(date)", "", V.ACTIONS["missing_date"], "struct"))
    s.append(("missing_price_columns", "'critical'", None, "least(count(open), count(high), count(low), count(close))",
              "", None, "price"))
    for c in PRICES:
        s.append(("negative_prices", "'error'", c, f"count_if({c} < 0)", "",
                  V.ACTIONS["negative_prices"].format(col=c), "price"))
        s.append(("extremely_low_prices", "'warning'", c, f"count_if({c} < 0.01)", "", None, "price"))
        s.append(("extremely_high_prices", "'warning'", c, f"count_if({c} > 100000)", "", None, "price"))
    s += [("high_less_than_open", "'error'", None, "count_if(high < open)", "",
           V.ACTIONS["high_less_than_open"], "price"),
          ("high_less_than_close", "'error'", None, "count_if(high < close)", "", None, "price"),
          ("low_greater_than_open", "'error'", None, "count_if(low > open)", "", None, "price"),
          ("low_greater_than_close", "'error'", None, "count_if(low > close)", "", None, "price"),
          ("negative_volume", "'error'", "volume", "count_if(volume < 0)", "", None, "price"),
          ("suspiciously_high_volume", "'warning'", "volume", "count_if(volume > med * 100)",
           "n > 10 AND med > 0", None, "price"),
          ("extreme_daily_change", "'warning'", None, "count_if(chg > 0.2)", "n > 1",
           V.ACTIONS["extreme_daily_change"], "price")]
    for c in PRICES:
        s.append(("missing_price_data", f"CASE WHEN k{{i}} * 100 / n > 10 THEN 'error' ELSE 'warning' END",
                  c, f"count_if({c} IS NULL)", "", V.ACTIONS["missing_price_data"], "missing"))
    s.append(("date_gaps", "'warning'", None, "count_if(date_diff('day', prev_date, date) > 5)",
              "n > 1", V.ACTIONS["date_gaps"], "missing"))
    return s


def _lit(v):
    return "CAST(NULL AS VARCHAR)" if v is None else "'" + v.replace("'", "''") + "'"


def issues_sql(src: str, kinds: tuple[str, ...]) -> tuple[str, list[tuple[str, str]]]:
    specs = [s for s in _specs() if s[6] in kinds]
    aggs = ", ".join(f"{s[3]} AS k{i}" for i, s in enumerate(specs))
    extra = [("enr", _ENRICH.format(src=src)), ("enr2", _CHG),
             ("agg", f"SELECT symbol, source, count(*) AS n, any_value(med) AS med, {aggs} "
                     f"FROM enr2 GROUP BY symbol, source")]
    parts = []
    for i, (it, sev, col, _, gate, act, kind) in enumerate(specs):
        struct = it in ("missing_columns", "missing_date", "missing_price_columns")
        fire = f"k{i} = 0" if struct else f"k{i} > 0"
        if gate:
            fire += f" AND {gate}"
        aff = "CAST(NULL AS BIGINT)" if struct else f"CAST(k{i} AS BIGINT)"
        parts.append(f"SELECT symbol, source, '{it}' AS issue_type, {sev.format(i=i)} AS severity, "
                     f"{_lit(col)} AS \"column\", {aff} AS affected_rows, "
                     f"{_lit(act)} AS suggested_action FROM agg WHERE {fire}")
    # a missing column ends the validation, a missing price column the price checks
    union = "\nUNION ALL\n".join(parts)
    return f"""SELECT * FROM ({union}) WINDOW own AS (PARTITION BY symbol, source)
QUALIFY CASE WHEN bool_or(issue_type = 'missing_columns') OVER own THEN issue_type IN ('missing_columns', 'missing_date')
             WHEN bool_or(issue_type = 'missing_price_columns') OVER own
             THEN issue_type IN ('missing_price_columns', 'missing_date', 'missing_price_data', 'date_gaps')
             ELSE true END""", extra


def _issues_query(kinds, src="bars_dirty"):
    return issues_sql(src, kinds)


_P_BODY, _P_EXTRA = _issues_query(("price",))


@query("issues_price", _P_BODY, ("bars_dirty",), extra=_P_EXTRA)
def issues_price(spark, sf_dir):
    """V6-V15 on the faulty vendor bars."""
    return V.issues_of(V.validate_bars(fx.bars_dirty(spark, sf_dir), V.price_checks()))


_M_BODY, _M_EXTRA = _issues_query(("missing",))


@query("issues_missing", _M_BODY, ("bars_dirty",), extra=_M_EXTRA)
def issues_missing(spark, sf_dir):
    """V16-V17."""
    return V.issues_of(V.validate_bars(fx.bars_dirty(spark, sf_dir), V.missing_checks()))


_A_BODY, _A_EXTRA = _issues_query(("struct", "price", "missing"))

_V5_BODY, _V5_EXTRA = _issues_query(("price", "missing"), "bars_partial")


@query("missing_price_columns", _V5_BODY, ("bars_partial",), extra=_V5_EXTRA)
def missing_price_columns(spark, sf_dir):
    """V5: price and missing-data checks where some symbols come without a column: a missing
    price column is reported and ends the price checks."""
    return V.issues_of(V.validate_bars(fx.bars_partial(spark, sf_dir), V.price_checks() + V.missing_checks()))


_V2_BODY, _V2_EXTRA = _issues_query(("struct", "price", "missing"), "bars_partial")


@query("missing_columns", _V2_BODY, ("bars_partial",), extra=_V2_EXTRA)
def missing_columns(spark, sf_dir):
    """V2, V3: all checks on the same bars: a missing column ends the validation, a missing date does not."""
    return V.issues_of(V.validate_bars(fx.bars_partial(spark, sf_dir)))

_SUMMARY_SQL = """
SELECT a.symbol, a.source, CAST(coalesce(i.total, 0) AS BIGINT) AS total_issues,
       CAST(coalesce(i.crit, 0) AS BIGINT) AS critical_issues,
       CAST(coalesce(i.err, 0) AS BIGINT) AS error_issues,
       CAST(coalesce(i.warn, 0) AS BIGINT) AS warning_issues,
       CAST(coalesce(i.info, 0) AS BIGINT) AS info_issues,
       a.n AS data_rows, coalesce(i.crit, 0) = 0 AS is_valid
FROM agg a LEFT JOIN (
  SELECT symbol, source, count(*) AS total, count_if(severity = 'critical') AS crit,
         count_if(severity = 'error') AS err, count_if(severity = 'warning') AS warn,
         count_if(severity = 'info') AS info
  FROM all_issues GROUP BY symbol, source) i USING (symbol, source)"""

_SUMMARY_EXTRA = _A_EXTRA + [("all_issues", _A_BODY)]


def _summary(spark, sf_dir):
    return V.summarize(V.validate_bars(fx.bars_dirty(spark, sf_dir)))


@query("issue_summary", _SUMMARY_SQL, ("bars_dirty",), extra=_SUMMARY_EXTRA)
def issue_summary(spark, sf_dir):
    """All bar checks, then counts by severity and the verdict."""
    return _summary(spark, sf_dir)


_GRADE_SQL = """
SELECT *, CASE WHEN NOT is_valid OR critical_issues > 0 THEN 'unusable'
               WHEN error_issues > 2 THEN 'poor'
               WHEN error_issues > 0 OR warning_issues > 5 THEN 'fair'
               WHEN warning_issues > 0 THEN 'good' ELSE 'excellent' END AS quality
FROM summary"""


@query("grade", _GRADE_SQL, ("bars_dirty",), extra=_SUMMARY_EXTRA + [("summary", _SUMMARY_SQL)])
def grade_q(spark, sf_dir):
    """A1."""
    return V.grade(_summary(spark, sf_dir))


_HOURS_SQL = """
SELECT symbol, issue_type, severity, affected_rows, suggested_action FROM (
  SELECT symbol, 'outside_market_hours' AS issue_type, 'warning' AS severity,
         outside AS affected_rows, 'Filter data to market hours only' AS suggested_action,
         intr AND outside > 0 AS fire FROM h
  UNION ALL
  SELECT symbol, 'weekend_data', 'info', weekend, CAST(NULL AS VARCHAR), intr AND weekend > 0 FROM h)
WHERE fire"""

_HOURS_EXTRA = [("h", """
SELECT symbol, count(*) > 2 * count(DISTINCT CAST(ts AS DATE)) AS intr,
       count_if(strftime(ts, '%H:%M:%S.%f') < '09:15:00.000000'
                OR strftime(ts, '%H:%M:%S.%f') > '15:30:00.000000') AS outside,
       count_if(isodow(ts) >= 6) AS weekend
FROM intraday_bars GROUP BY symbol""")]


@query("issues_hours", _HOURS_SQL, ("intraday_bars",), extra=_HOURS_EXTRA)
def issues_hours(spark, sf_dir):
    """V18-V20 on events used as intraday bars."""
    return V.market_hours_issues(fx.intraday_bars(spark, sf_dir))


_VERDICT_SQL = """
SELECT symbol, source, 'data_quality' AS issue_type, 'error' AS severity,
       printf('Validation failed with %d issues', total_issues) AS message
FROM summary WHERE NOT is_valid"""


@query("collapsed_verdict", _VERDICT_SQL, ("bars_dirty",),
       extra=_SUMMARY_EXTRA + [("summary", _SUMMARY_SQL)])
def collapsed_verdict(spark, sf_dir):
    """V29."""
    return V.collapsed_verdict(_summary(spark, sf_dir))


_REPORT_SQL = """
SELECT count(*) AS symbols_validated, count_if(is_valid) AS symbols_valid,
       count_if(NOT is_valid) AS symbols_failed,
       CAST(sum(critical_issues) AS BIGINT) AS critical_issues,
       CAST(sum(error_issues) AS BIGINT) AS error_issues,
       CAST(sum(warning_issues) AS BIGINT) AS warning_issues,
       CAST(sum(info_issues) AS BIGINT) AS info_issues
FROM summary"""


@query("validation_report", _REPORT_SQL, ("bars_dirty",),
       extra=_SUMMARY_EXTRA + [("summary", _SUMMARY_SQL)])
def validation_report(spark, sf_dir):
    """V27 totals."""
    return V.validation_report(_summary(spark, sf_dir))


def validation_ctes(src: str, p: str) -> list[tuple[str, str]]:
    """CTEs ``{p}iss`` (issues), ``{p}sum`` (V26 summary) and ``{p}grade`` (A1) of ``src``."""
    body, extra = issues_sql(src, ("struct", "price", "missing"))
    ren = {"enr2": f"{p}enr2", "enr": f"{p}enr", "agg": f"{p}agg"}

    def r(sql: str) -> str:
        for old in ("enr2", "enr", "agg"):
            sql = sql.replace(f"FROM {old}", f"FROM __{old}__")
        for old, new in ren.items():
            sql = sql.replace(f"FROM __{old}__", f"FROM {new}")
        return sql

    out = [(ren[n], r(s)) for n, s in extra]
    out.append((f"{p}iss", r(body)))
    summ = (_SUMMARY_SQL.replace("FROM agg a", f"FROM {p}agg a")
            .replace("FROM all_issues", f"FROM {p}iss"))
    out.append((f"{p}sum", summ))
    out.append((f"{p}grade", _GRADE_SQL.replace("FROM summary", f"FROM {p}sum")))
    return out
