"""Cross-source checks and source selection.

Two vendors are compared on common (symbol, date) with one equi-join; symbol
coverage of each side comes from a full outer join of the distinct symbol
sets, which is where the empty-side and no-overlap cases are decided.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks as V
from .clean import tiered_impute

# Tolerances and the recommendation texts of the report.
PRICE_TOLERANCE = 0.05
VOLUME_TOLERANCE = 0.20
REC_SINGLE = "Use single available source"
REC_RECENT = "Use most recent source"
REC_PRIMARY = "Prefer KiteConnect data (more accurate for Indian markets)"
REC_AGREE = "Both sources agree - either can be used"
REASON_EMPTY = "Insufficient data for comparison"
REASON_NO_OVERLAP = "No overlapping dates"
# Suggested actions of the cross-source issues.
CROSS_ACTIONS = {
    "insufficient_data_for_cross_validation": "Ensure both data sources have data for comparison",
    "no_common_dates": "Check date ranges and formatting",
    "price_discrepancy": "Investigate price differences between {a} and {b}",
}


def _ratio(num: Column, den: Column) -> Column:
    """num / den with float semantics for a zero denominator (num >= 0 here):
    positive -> +inf, zero -> NULL (NaN never exceeds a tolerance)."""
    return F.when(den == 0, F.when(num > 0, F.lit(float("inf")))).otherwise(num / den)


def compare_sources(a: DataFrame, b: DataFrame, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Per symbol of either side: coverage flags and discrepancy aggregates,
    from ONE full outer join on (symbol, date) and one aggregate (the
    coverage flags are counts of each side's rows, the discrepancies come
    from the rows present on both sides)."""
    ja = a.select("symbol", "date", F.col("close").alias("ca"), F.col("volume").alias("va"),
                  F.lit(True).alias("_a"))
    jb = b.select("symbol", "date", F.col("close").alias("cb"), F.col("volume").alias("vb"),
                  F.lit(True).alias("_b"))
    j = ja.join(jb, ["symbol", "date"], "full")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    pd_ = _ratio(F.abs(F.col("ca") - F.col("cb")), F.col("ca"))
    vd = _ratio(F.abs(F.col("va") - F.col("vb")), F.col("va") + 1)
    big_p = F.when(both & (pd_ > tolerance), pd_)
    big_v = F.when(both & (vd > VOLUME_TOLERANCE), vd)
    return j.groupBy("symbol").agg(
        (F.count("_a") > 0).alias("in_a"), (F.count("_b") > 0).alias("in_b"),
        F.count_if(both).alias("common_dates"),
        F.count(big_p).alias("price_count"),
        (F.max(big_p) * 100).alias("price_max_pct"),
        (F.avg(big_p) * 100).alias("price_avg_pct"),
        F.count(big_v).alias("volume_count"),
        (F.max(big_v) * 100).alias("volume_max_pct"))


def _issue(kind: str, severity: str, rows: Column, diff: Column, names: tuple[str, str]) -> Column:
    action = CROSS_ACTIONS.get(kind)
    return F.struct(F.lit(kind).alias("issue_type"), F.lit(severity).alias("severity"),
                    rows.cast("bigint").alias("affected_rows"),
                    F.lit(action and action.format(a=names[0], b=names[1])).cast("string").alias("suggested_action"),
                    diff.alias("avg_diff_pct"))


def cross_validate(a: DataFrame, b: DataFrame, tolerance: float = PRICE_TOLERANCE,
                   names: tuple[str, str] = ("kiteconnect", "yahoo_finance")) -> DataFrame:
    """Issue rows per symbol (insufficient data, no common dates,
    price discrepancy with the mean excess %, volume discrepancy)."""
    c = compare_sources(a, b, tolerance)
    both = F.col("in_a") & F.col("in_b")
    has = both & (F.col("common_dates") > 0)
    null_d = F.lit(None).cast("double")
    items = F.array(
        F.when(~both, _issue("insufficient_data_for_cross_validation", "warning",
                             F.lit(None), null_d, names)),
        F.when(both & (F.col("common_dates") == 0),
               _issue("no_common_dates", "error", F.lit(None), null_d, names)),
        F.when(has & (F.col("price_count") > 0),
               _issue("price_discrepancy", "warning", F.col("price_count"), F.col("price_avg_pct"), names)),
        F.when(has & (F.col("volume_count") > 0),
               _issue("volume_discrepancy", "info", F.col("volume_count"), null_d, names)))
    return (c.select("symbol", F.explode(F.filter(items, lambda x: x.isNotNull())).alias("i"))
             .select("symbol", "i.*"))


def discrepancy_report(a: DataFrame, b: DataFrame, tolerance: float = PRICE_TOLERANCE) -> DataFrame:
    """Per symbol, discrepancy counts, max/avg %, common dates, recommendation."""
    c = compare_sources(a, b, tolerance)
    both = F.col("in_a") & F.col("in_b")
    disc = both & ((F.col("price_count") > 0) | (F.col("volume_count") > 0))
    return c.select(
        "symbol", disc.alias("has_discrepancies"),
        F.when(~both, REASON_EMPTY).when(F.col("common_dates") == 0, REASON_NO_OVERLAP)
         .alias("reason"),
        "price_count", "price_max_pct", "price_avg_pct", "volume_count", "volume_max_pct",
        "common_dates",
        F.when(~both, REC_SINGLE).when(F.col("common_dates") == 0, REC_RECENT)
         .when(disc, REC_PRIMARY).otherwise(REC_AGREE).alias("recommendation"))


def grades(bars: DataFrame, strict: bool = False,
           keys: tuple[str, ...] = ("symbol", "source")) -> DataFrame:
    """(keys, quality, is_valid, counts) for every (symbol, source)."""
    return V.grade(V.summarize(V.validate_bars(bars, keys=keys), keys=keys, strict=strict))


def _rank(q: Column) -> Column:
    r = F.lit(None).cast("int")
    for name, v in V.GRADES.items():
        r = F.when(q == name, F.lit(v)).otherwise(r)
    return r


def _graded_pair(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Grade both vendors in ONE validation pass (a side tag joins the key so
    equal source names cannot merge), then fold each symbol's two grades into
    one row with a conditional aggregate over the small graded table."""
    both = (primary.withColumn("_side", F.lit(0))
            .unionByName(secondary.withColumn("_side", F.lit(1)), allowMissingColumns=True))
    g = grades(both, keys=("symbol", "source", "_side"))
    pick = lambda side, c: F.max(F.when(F.col("_side") == side, F.col(c)))
    return g.groupBy("symbol").agg(
        pick(0, "source").alias("src_a"), pick(0, "quality").alias("q_a"),
        pick(0, "is_valid").alias("ok_a"), pick(1, "source").alias("src_b"),
        pick(1, "quality").alias("q_b"), pick(1, "is_valid").alias("ok_b"))


def _choice(g: DataFrame, use_a: Column) -> DataFrame:
    """One row per symbol: the chosen side with its source and grade."""
    return g.select("symbol", F.when(use_a, 0).otherwise(1).alias("_side"),
                    F.when(use_a, F.col("src_a")).otherwise(F.col("src_b")).alias("source"),
                    F.when(use_a, F.col("q_a")).otherwise(F.col("q_b")).alias("quality"))


def _choose(primary: DataFrame, secondary: DataFrame, strategy: str) -> DataFrame:
    """symbol, _side, source, quality of the side that a strategy takes.

    preferred: the primary when valid, else the secondary when present; best_quality:
    the better grade, ties to the primary; redundant and primary_only: the primary;
    secondary_only: the secondary."""
    g = _graded_pair(primary, secondary)
    has_a, has_b = F.col("src_a").isNotNull(), F.col("src_b").isNotNull()
    if strategy == "preferred":
        return _choice(g, F.coalesce(F.col("ok_a"), F.lit(False))).filter(F.col("source").isNotNull())
    if strategy == "best_quality":
        ra = F.coalesce(_rank(F.col("q_a")), F.lit(1))
        rb = F.coalesce(_rank(F.col("q_b")), F.lit(1))
        return _choice(g, has_a & ((ra >= rb) | ~has_b))
    if strategy in ("redundant", "primary_only"):
        return _choice(g.filter(has_a), F.lit(True))
    if strategy == "secondary_only":
        return _choice(g.filter(has_b), F.lit(False))
    raise ValueError(f"unknown strategy {strategy}")


def select_preferred(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """The primary when it is valid, else the secondary when present."""
    return _choose(primary, secondary, "preferred").drop("_side")


def select_best(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Higher grade wins (excellent 5 .. unusable 1, missing = unusable),
    ties go to the primary."""
    return _choose(primary, secondary, "best_quality").drop("_side")


def select_redundant(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Primary selection plus the J2 report; no fallback without primary data."""
    ga = grades(primary).select("symbol", "source", "quality")
    rep = discrepancy_report(primary, secondary)
    return ga.join(rep, "symbol", "inner")


def tiered_fetch(primary: DataFrame, secondary: DataFrame, method: str = "linear",
                 strategy: str = "preferred", impute_missing: bool = True) -> DataFrame:
    """Choose a side per symbol by ``strategy`` (J3-J5 or one side only), impute the
    fair/poor choices (C26), re-validate and re-grade them; everything else passes
    through.  Without ``impute_missing`` the choices stay as they are.  The method
    ``cross_source`` fills from the vendor that was not chosen for the symbol.

    The bars of both vendors and the choice (one row per symbol) are written once as reliable
    checkpoints: validation, imputation and the second validation read them from there."""
    from ..session import cut
    both = cut(primary.withColumn("_side", F.lit(0))
               .unionByName(secondary.withColumn("_side", F.lit(1)), allowMissingColumns=True))
    sel = cut(_choose(*(both.filter(F.col("_side") == side).select(*df.columns)
                        for side, df in enumerate((primary, secondary))), strategy))
    # the side tells the vendors apart even when their source names are the same
    chosen = both.join(sel.select("symbol", "_side", "quality"), ["symbol", "_side"], "inner").drop("_side")
    if not impute_missing:
        return chosen.withColumn("imputed", F.lit(False))
    weak = F.col("quality").isin("fair", "poor")
    keep = chosen.filter(~weak).withColumn("imputed", F.lit(False))
    other = None
    if method == "cross_source":
        side = sel.select("symbol", (1 - F.col("_side")).alias("_side"))
        other = both.join(side, ["symbol", "_side"], "left_semi").drop("_side")
    fix = tiered_impute(chosen.filter(weak).drop("quality"), method, other)
    regrade = grades(fix).select("symbol", "source", "quality")
    fixed = fix.join(regrade, ["symbol", "source"], "left").withColumn("imputed", F.lit(True))
    return keep.unionByName(fixed)


def fetch_stats(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """A2: per source (and overall) requests, successes, validated, rates (0-safe)."""
    both = (primary.withColumn("_side", F.lit(0))
            .unionByName(secondary.withColumn("_side", F.lit(1)), allowMissingColumns=True))
    log = grades(both, keys=("symbol", "source", "_side")).select(
        "source", (F.col("data_rows") > 0).alias("ok"), F.col("is_valid"))
    per = log.groupBy("source").agg(F.count(F.lit(1)).alias("requests"),
                                    F.count_if("ok").alias("successes"),
                                    F.count_if("is_valid").alias("validated"))
    overall = log.agg(F.count(F.lit(1)).alias("requests"), F.count_if("ok").alias("successes"),
                      F.count_if("is_valid").alias("validated")).select(
        F.lit("overall").alias("source"), "requests", "successes", "validated")
    out = per.unionByName(overall)
    rate = lambda n: F.coalesce(F.try_divide(F.col(n) * 100.0, F.col("requests")), F.lit(0.0))
    return out.withColumns({"success_rate": rate("successes"), "validation_rate": rate("validated")})
