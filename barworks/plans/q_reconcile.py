"""Cross-source and selection queries (J1-J6, A2) and their SQL twins."""

from __future__ import annotations

from ..operators import reconcile as R
from ..sources import fixtures as fx
from .q_checks import validation_ctes
from .q_clean import _linear, _ROLL
from .registry import query


def _cmp(a: str, b: str, p: str) -> list[tuple[str, str]]:
    j = f"""
SELECT symbol, count(*) AS common_dates, count(bp) AS price_count, max(bp) * 100 AS price_max_pct,
       avg(bp) * 100 AS price_avg_pct, count(bv) AS volume_count, max(bv) * 100 AS volume_max_pct
FROM (SELECT symbol, CASE WHEN pd > 0.05 THEN pd END AS bp, CASE WHEN vd > 0.2 THEN vd END AS bv
      FROM (SELECT x.symbol,
                   CASE WHEN x.close = 0 THEN CASE WHEN abs(x.close - y.close) > 0
                        THEN CAST('inf' AS DOUBLE) END
                        ELSE abs(x.close - y.close) / x.close END AS pd,
                   CASE WHEN x.volume + 1 = 0 THEN CASE WHEN abs(x.volume - y.volume) > 0
                        THEN CAST('inf' AS DOUBLE) END
                        ELSE abs(x.volume - y.volume) / (x.volume + 1) END AS vd
            FROM {a} x JOIN {b} y USING (symbol, date)))
GROUP BY symbol"""
    c = f"""
SELECT coalesce(sa.symbol, sb.symbol) AS symbol, sa.symbol IS NOT NULL AS in_a,
       sb.symbol IS NOT NULL AS in_b, coalesce(j.common_dates, 0) AS common_dates,
       coalesce(j.price_count, 0) AS price_count, j.price_max_pct, j.price_avg_pct,
       coalesce(j.volume_count, 0) AS volume_count, j.volume_max_pct
FROM (SELECT DISTINCT symbol FROM {a}) sa FULL JOIN (SELECT DISTINCT symbol FROM {b}) sb
  ON sa.symbol = sb.symbol
LEFT JOIN {p}j j ON j.symbol = coalesce(sa.symbol, sb.symbol)"""
    return [(f"{p}j", j), (f"{p}cmp", c)]


_CV = """
SELECT symbol, 'insufficient_data_for_cross_validation' AS issue_type, 'warning' AS severity,
       CAST(NULL AS BIGINT) AS affected_rows,
       'Ensure both data sources have data for comparison' AS suggested_action,
       CAST(NULL AS DOUBLE) AS avg_diff_pct
FROM cmp WHERE NOT (in_a AND in_b)
UNION ALL
SELECT symbol, 'no_common_dates', 'error', NULL, 'Check date ranges and formatting', NULL FROM cmp WHERE in_a AND in_b AND common_dates = 0
UNION ALL
SELECT symbol, 'price_discrepancy', 'warning', price_count,
       'Investigate price differences between kiteconnect and yahoo_finance', price_avg_pct FROM cmp
WHERE in_a AND in_b AND common_dates > 0 AND price_count > 0
UNION ALL
SELECT symbol, 'volume_discrepancy', 'info', volume_count, NULL, NULL FROM cmp
WHERE in_a AND in_b AND common_dates > 0 AND volume_count > 0"""


@query("cross_validate", _CV, ("vendor_a", "bars_b"), doubles="avg_diff_pct",
       extra=_cmp("vendor_a", "bars_b", ""))
def cross_validate(spark, sf_dir):
    """J1 / V25."""
    return R.cross_validate(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


_REPORT = f"""
SELECT symbol, in_a AND in_b AND (price_count > 0 OR volume_count > 0) AS has_discrepancies,
       CASE WHEN NOT (in_a AND in_b) THEN '{R.REASON_EMPTY}'
            WHEN common_dates = 0 THEN '{R.REASON_NO_OVERLAP}' END AS reason,
       price_count, price_max_pct, price_avg_pct, volume_count, volume_max_pct, common_dates,
       CASE WHEN NOT (in_a AND in_b) THEN '{R.REC_SINGLE}'
            WHEN common_dates = 0 THEN '{R.REC_RECENT}'
            WHEN price_count > 0 OR volume_count > 0 THEN '{R.REC_PRIMARY}'
            ELSE '{R.REC_AGREE}' END AS recommendation
FROM cmp"""


@query("discrepancy_report", _REPORT, ("vendor_a", "bars_b"),
       doubles="price_max_pct price_avg_pct volume_max_pct", extra=_cmp("vendor_a", "bars_b", ""))
def discrepancy_report(spark, sf_dir):
    """J2."""
    return R.discrepancy_report(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


_PAIR = validation_ctes("vendor_a", "a_") + validation_ctes("bars_b", "b_") + [("pair", """
SELECT coalesce(a.symbol, b.symbol) AS symbol, a.source AS src_a, a.quality AS q_a,
       a.is_valid AS ok_a, b.source AS src_b, b.quality AS q_b, b.is_valid AS ok_b
FROM a_grade a FULL JOIN b_grade b ON a.symbol = b.symbol""")]

_RANK = ("CASE {q} WHEN 'excellent' THEN 5 WHEN 'good' THEN 4 WHEN 'fair' THEN 3 "
         "WHEN 'poor' THEN 2 WHEN 'unusable' THEN 1 END")

_PREFERRED = """
SELECT * FROM (
  SELECT symbol, CASE WHEN coalesce(ok_a, false) THEN src_a ELSE src_b END AS source,
         CASE WHEN coalesce(ok_a, false) THEN q_a ELSE q_b END AS quality FROM pair)
WHERE source IS NOT NULL"""


@query("select_preferred", _PREFERRED, ("vendor_a", "bars_b"), extra=_PAIR)
def select_preferred(spark, sf_dir):
    """J3."""
    return R.select_preferred(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


_BEST = f"""
SELECT symbol, CASE WHEN use_a THEN src_a ELSE src_b END AS source,
       CASE WHEN use_a THEN q_a ELSE q_b END AS quality
FROM (SELECT *, src_a IS NOT NULL AND (coalesce({_RANK.format(q='q_a')}, 1)
                 >= coalesce({_RANK.format(q='q_b')}, 1) OR src_b IS NULL) AS use_a FROM pair)"""


@query("select_best", _BEST, ("vendor_a", "bars_b"), extra=_PAIR)
def select_best(spark, sf_dir):
    """J4."""
    return R.select_best(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


@query("select_redundant", "SELECT g.symbol, g.source, g.quality, r.* EXCLUDE (symbol) "
       "FROM a_grade g JOIN rep r USING (symbol)", ("vendor_a", "bars_b"),
       doubles="price_max_pct price_avg_pct volume_max_pct",
       extra=validation_ctes("vendor_a", "a_") + _cmp("vendor_a", "bars_b", "")
       + [("rep", _REPORT)])
def select_redundant(spark, sf_dir):
    """J5."""
    return R.select_redundant(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


_FETCH = _PAIR + [
    ("sel", _PREFERRED),
    ("both_src", "SELECT * FROM vendor_a UNION ALL BY NAME SELECT * FROM bars_b"),
    ("chosen", "SELECT x.*, s.quality FROM both_src x JOIN sel s USING (symbol, source)"),
    ("weak", "SELECT * EXCLUDE (quality) FROM chosen WHERE quality IN ('fair', 'poor')"),
    ("w1", _linear("weak", ("open", "high", "low", "close"))),
    ("w2", _ROLL.format(src="w1")),
    ("wg", "SELECT symbol, bool_or(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL "
           "OR volume IS NULL) AS any_null FROM weak GROUP BY symbol"),
    ("fixd", "SELECT t.* REPLACE (CASE WHEN g.any_null AND t.high < greatest(t.open, t.close) "
             "THEN greatest(t.open, t.close) ELSE t.high END AS high, CASE WHEN g.any_null AND "
             "t.low > least(t.open, t.close) THEN least(t.open, t.close) ELSE t.low END AS low) "
             "FROM w2 t LEFT JOIN wg g USING (symbol)"),
] + validation_ctes("fixd", "f_")


@query("tiered_fetch", """
SELECT *, false AS imputed FROM chosen WHERE quality NOT IN ('fair', 'poor')
UNION ALL BY NAME
SELECT f.*, g.quality, true AS imputed FROM fixd f LEFT JOIN f_grade g USING (symbol, source)""",
       ("vendor_a", "bars_b"), doubles="open high low close volume", extra=_FETCH)
def tiered_fetch(spark, sf_dir):
    """Choose, impute fair/poor, re-validate and re-grade."""
    return R.tiered_fetch(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


@query("fetch_stats", """
SELECT *, coalesce(CASE WHEN requests = 0 THEN NULL ELSE successes * 100.0 / requests END, 0.0)
          AS success_rate,
       coalesce(CASE WHEN requests = 0 THEN NULL ELSE validated * 100.0 / requests END, 0.0)
          AS validation_rate
FROM (SELECT source, count(*) AS requests, count_if(data_rows > 0) AS successes,
             count_if(is_valid) AS validated FROM log GROUP BY source
      UNION ALL
      SELECT 'overall', count(*), count_if(data_rows > 0), count_if(is_valid) FROM log)""",
       ("vendor_a", "bars_b"), doubles="success_rate validation_rate",
       extra=validation_ctes("vendor_a", "a_") + validation_ctes("bars_b", "b_")
       + [("log", "SELECT * FROM a_grade UNION ALL SELECT * FROM b_grade")])
def fetch_stats(spark, sf_dir):
    """A2."""
    return R.fetch_stats(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))
