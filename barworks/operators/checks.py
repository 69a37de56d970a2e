"""Bar validation (V1-V30) as one aggregate pass per (symbol, source).

Pattern: add the few row-level helper columns a check needs (previous close
and date from a segmented ``lag``, the group's median volume from a
partial-aggregated ``percentile`` joined back), then ONE
``groupBy(symbol, source)`` computes every count with ``count_if``.  Issue
rows are an array of structs built on the aggregated row (one row per group,
so tiny) and exploded; the summary reads the same aggregated row, so there
is no second pass and no join between issues and summary.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import PRICE_COLUMNS, time_of_day, is_weekend
from ..functions.quantiles import group_percentiles
from ..functions.series import with_prev

# Thresholds of the bar checks.
MIN_PRICE = 0.01
MAX_PRICE = 100000
MAX_DAILY_CHANGE = 0.20
VOLUME_MEDIAN_MULTIPLE = 100
VOLUME_MEDIAN_MIN_ROWS = 10
MISSING_ERROR_PCT = 10
MAX_DATE_GAP_DAYS = 5
MARKET_OPEN = "09:15:00.000000"
MARKET_CLOSE = "15:30:00.000000"

# Suggested actions attached to issue rows.
ACTIONS = {
    "negative_prices": "Remove or interpolate negative {col} values",
    "high_less_than_open": "Fix OHLC data inconsistencies",
    "extreme_daily_change": "Check for stock splits, bonuses, or data errors",
    "missing_price_data": "Interpolate or fetch missing data",
    "date_gaps": "Check for holidays or data source gaps",
    "outside_market_hours": "Filter data to market hours only",
    "missing_columns": "Ensure data source provides complete OHLCV data",
    "missing_price_columns": None,
    "missing_date": "Ensure data has proper date indexing",
    "invalid_data_type": "Convert {col} to numeric format",
    "empty_dataframe": "Check data source connectivity and symbol validity",
}

# Columns of an issue row (after ``issues_of``).
ISSUE_SCHEMA = ("symbol string, source string, issue_type string, severity string, "
                "column string, affected_rows bigint, suggested_action string")


@dataclass(frozen=True)
class Check:
    """One issue kind, declared as Spark SQL expressions:

    * ``count``    - aggregate over the group's rows (``count_if(...)``)
    * ``severity`` - over the aggregated row (a literal or a CASE)
    * ``gate``     - optional extra condition over the aggregated row

    Declaring checks as expression text keeps the plan identical to the
    Column-API form while building it in one call per expression."""
    issue_type: str
    severity: str
    column: str | None
    count: str
    gate: str | None = None

    def action(self) -> str | None:
        a = ACTIONS.get(self.issue_type)
        return a.format(col=self.column) if a and self.column else a


def _c(name: str) -> Column:
    return F.col(name)


def _q(v: str | None) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + v.replace("'", "\\'") + "'"


def price_checks(has_volume: bool = True) -> list[Check]:
    """V5-V15 in the order the reference emits them."""
    out: list[Check] = [Check("missing_price_columns", "'critical'", None,
                              f"least({', '.join(f'count({c})' for c in PRICE_COLUMNS)})")]
    for c in PRICE_COLUMNS:
        out.append(Check("negative_prices", "'error'", c, f"count_if({c} < 0)"))
        out.append(Check("extremely_low_prices", "'warning'", c, f"count_if({c} < {MIN_PRICE})"))
        out.append(Check("extremely_high_prices", "'warning'", c, f"count_if({c} > {MAX_PRICE})"))
    out += [
        Check("high_less_than_open", "'error'", None, "count_if(high < open)"),
        Check("high_less_than_close", "'error'", None, "count_if(high < close)"),
        Check("low_greater_than_open", "'error'", None, "count_if(low > open)"),
        Check("low_greater_than_close", "'error'", None, "count_if(low > close)"),
    ]
    if has_volume:
        out += [
            Check("negative_volume", "'error'", "volume", "count_if(volume < 0)"),
            Check("suspiciously_high_volume", "'warning'", "volume",
                  f"count_if(volume > _med_volume * {VOLUME_MEDIAN_MULTIPLE})",
                  gate=f"_n > {VOLUME_MEDIAN_MIN_ROWS} AND _med > 0"),
        ]
    out.append(Check("extreme_daily_change", "'warning'", None,
                     f"count_if(_chg > {MAX_DAILY_CHANGE})", gate="_n > 1"))
    return out


def missing_checks() -> list[Check]:
    """V16 per price column (share of rows) and V17 date gaps."""
    out = [Check("missing_price_data",
                 f"CASE WHEN _nulls_{c} * 100 / _n > {MISSING_ERROR_PCT} THEN 'error' ELSE 'warning' END",
                 c, f"count_if({c} IS NULL)") for c in PRICE_COLUMNS]
    out.append(Check("date_gaps", "'warning'", None,
                     f"count_if(datediff(date, _prev_date) > {MAX_DATE_GAP_DAYS})", gate="_n > 1"))
    return out


def structure_checks() -> list[Check]:
    """V2/V3: a column absent from a vendor frame is all NULL after
    ``unionByName(allowMissingColumns=True)``; the count is of present values."""
    out = [Check("missing_columns", "'critical'", c, f"count({c})")
           for c in ("open", "high", "low", "close", "volume")]
    out.append(Check("missing_date", "'error'", "date", "count(date)"))
    return out


def _enrich(bars: DataFrame, keys: Sequence[str], order: Sequence[str],
            bucket: Column | None) -> DataFrame:
    """Row helpers: previous close/date along the series and the group's median volume."""
    b = with_prev(bars, keys, order, ["close", "date"], bucket)
    med = group_percentiles(bars, keys, "volume", [0.5], ["_med_volume"])
    b = b.join(med, list(keys), "left")
    chg = ("CASE WHEN prev_close IS NULL OR close IS NULL THEN CAST(NULL AS DOUBLE) "
           "WHEN prev_close = 0 THEN CASE WHEN close <> 0 THEN double('inf') END "
           "ELSE abs((close - prev_close) / prev_close) END")
    return b.selectExpr("*", f"{chg} AS _chg").withColumnRenamed("prev_date", "_prev_date")


def _assemble(agg: DataFrame, keys: Sequence[str], checks: Sequence[Check],
              counts: Sequence[str]) -> DataFrame:
    items = []
    for name, chk in zip(counts, checks):
        structural = chk.issue_type in STRUCTURAL
        fire = f"{name} = 0" if structural else f"{name} > 0"
        if chk.gate:
            fire += f" AND ({chk.gate})"
        rows = "CAST(NULL AS BIGINT)" if structural else f"CAST({name} AS BIGINT)"
        items.append(
            f"CASE WHEN {fire} THEN named_struct('issue_type', '{chk.issue_type}', "
            f"'severity', {chk.severity}, 'column', {_q(chk.column)}, 'affected_rows', {rows}, "
            f"'suggested_action', {_q(chk.action())}) END")
    arr = f"filter(array({', '.join(items)}), x -> x IS NOT NULL)"
    out = agg.selectExpr(*keys, "_n AS data_rows", f"{arr} AS issues")
    return out.withColumn("issues", F.expr(_STOPPED))


STRUCTURAL = ("missing_columns", "missing_price_columns", "missing_date", "invalid_data_type")
# A missing column (V2) ends the validation after the structure checks; a missing price column
# (V5) ends the price checks.
_AFTER_PRICES = ("missing_price_data", "date_gaps")


def _quoted(names: Sequence[str]) -> str:
    return ", ".join(f"'{n}'" for n in names)


_STOPPED = (
    "CASE WHEN exists(issues, x -> x.issue_type = 'missing_columns') "
    f"THEN filter(issues, x -> x.issue_type IN ({_quoted([t for t in STRUCTURAL if t != 'missing_price_columns'])})) "
    "WHEN exists(issues, x -> x.issue_type = 'missing_price_columns') "
    f"THEN filter(issues, x -> x.issue_type IN ({_quoted(STRUCTURAL + _AFTER_PRICES)})) ELSE issues END")


def validate_bars(bars: DataFrame, checks: Sequence[Check] | None = None,
                  keys: Sequence[str] = ("symbol", "source"),
                  order: Sequence[str] = ("date", "load_seq"),
                  bucket: Column | None = None) -> DataFrame:
    """Per (symbol, source): ``data_rows`` and ``issues`` (array of issue structs)."""
    checks = list(checks if checks is not None
                  else structure_checks() + price_checks() + missing_checks())
    b = _enrich(bars, keys, order, bucket)
    counts = [f"_k{i}" for i in range(len(checks))]
    aggs = [f"{chk.count} AS {n}" for chk, n in zip(checks, counts)]
    aggs += ["count(1) AS _n", "first(_med_volume) AS _med"]
    aggs += [f"count_if({c} IS NULL) AS _nulls_{c}" for c in PRICE_COLUMNS]
    agg = b.groupBy(*keys).agg(*[F.expr(a) for a in aggs])
    return _assemble(agg, keys, checks, counts)


def issues_of(validated: DataFrame, keys: Sequence[str] = ("symbol", "source")) -> DataFrame:
    return validated.select(*keys, F.explode("issues").alias("i")).select(*keys, "i.*")


def summarize(validated: DataFrame, keys: Sequence[str] = ("symbol", "source"),
              strict: bool = False) -> DataFrame:
    """V26 summary: counts by severity, rows, verdict (no critical; strict: no error)."""
    def n(sev):
        return f"CAST(size(filter(issues, x -> x.severity = '{sev}')) AS BIGINT)"
    valid = f"{n('critical')} = 0" + (f" AND {n('error')} = 0" if strict else "")
    return validated.selectExpr(
        *keys, "CAST(size(issues) AS BIGINT) AS total_issues",
        f"{n('critical')} AS critical_issues", f"{n('error')} AS error_issues",
        f"{n('warning')} AS warning_issues", f"{n('info')} AS info_issues",
        "data_rows", f"{valid} AS is_valid")


def with_further_issues(validated: DataFrame, *further: DataFrame) -> DataFrame:
    """The issues of the market-hours check (V24), of the comparison with a reference
    source (V25) and the like, keyed by symbol (and source, when they carry one), joined to a
    validation, so that the summary and the grade count them.  A missing column stops the pass: then only the findings on
    structure count."""
    fields = "issue_type string, severity string, column string, affected_rows bigint, suggested_action string"
    names = [f.split()[0] for f in fields.split(", ")]
    out = validated
    for df in further:
        keys = ["symbol", *(["source"] if "source" in df.columns else [])]
        shaped = df.select(*keys, F.struct(*[
            (F.col(n) if n in df.columns else F.lit(None)).cast("bigint" if n == "affected_rows" else "string").alias(n)
            for n in names]).alias("i"))
        # a handful of kinds per symbol
        more = shaped.groupBy(*keys).agg(F.sort_array(F.collect_list("i")).alias("_more"))
        none = F.array().cast("array<struct<" + ",".join(f.replace(" ", ":") for f in fields.split(", ")) + ">>")
        out = (out.join(more, keys, "left")
               .withColumn("issues", F.concat("issues", F.coalesce("_more", none))).drop("_more"))
    stops = F.exists("issues", lambda x: (x["issue_type"] == "missing_columns") & (x["severity"] == "critical"))
    return out.withColumn("issues", F.when(stops, F.filter("issues", lambda x: x["issue_type"].isin(*STRUCTURAL)))
                          .otherwise(F.col("issues")))


# Quality grades, best to worst, with their rank.
GRADES = {"excellent": 5, "good": 4, "fair": 3, "poor": 2, "unusable": 1}


def grade(summary: DataFrame) -> DataFrame:
    """A1: grade from the issue counts of a V26 summary."""
    e, w = _c("error_issues"), _c("warning_issues")
    q = (F.when(~_c("is_valid") | (_c("critical_issues") > 0), "unusable")
          .when(e > 2, "poor").when((e > 0) | (w > 5), "fair")
          .when(w > 0, "good").otherwise("excellent"))
    return summary.withColumn("quality", q)


def market_hours_issues(intraday: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """Outside 09:15-15:30 (WARNING) and weekend rows (INFO), only for
    groups with more than two rows per distinct day."""
    tod = time_of_day("ts")
    agg = intraday.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"),
        F.count_distinct(F.to_date("ts")).alias("_days"),
        F.count_if((tod < MARKET_OPEN) | (tod > MARKET_CLOSE)).alias("_outside"),
        F.count_if(is_weekend("ts")).alias("_weekend"))
    intr = _c("_n") > _c("_days") * 2
    items = F.array(
        F.when(intr & (_c("_outside") > 0), F.struct(
            F.lit("outside_market_hours").alias("issue_type"), F.lit("warning").alias("severity"),
            _c("_outside").alias("affected_rows"),
            F.lit(ACTIONS["outside_market_hours"]).alias("suggested_action"))),
        F.when(intr & (_c("_weekend") > 0), F.struct(
            F.lit("weekend_data").alias("issue_type"), F.lit("info").alias("severity"),
            _c("_weekend").alias("affected_rows"),
            F.lit(None).cast("string").alias("suggested_action"))))
    return (agg.select(*keys, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("i"))
               .select(*keys, "i.*"))


def empty_symbols(universe: DataFrame, bars: DataFrame) -> DataFrame:
    """V1: universe symbols without any bar -> CRITICAL empty_dataframe."""
    return (universe.select("symbol").distinct().join(bars.select("symbol"), "symbol", "left_anti")
            .select("symbol", F.lit("empty_dataframe").alias("issue_type"),
                    F.lit("critical").alias("severity"),
                    F.lit(ACTIONS["empty_dataframe"]).alias("suggested_action")))


def non_numeric_columns(landed: DataFrame, keys: Sequence[str] = ("symbol",),
                        cols: Sequence[str] = ("open", "high", "low", "close", "volume")) -> DataFrame:
    """V4 on landed text columns: values present that do not parse as numbers."""
    present = [c for c in cols if c in landed.columns]
    agg = landed.groupBy(*keys).agg(*[
        F.count_if(F.col(c).isNotNull() & F.col(c).try_cast("double").isNull()).alias(c)
        for c in present])
    items = F.array(*[F.when(_c(c) > 0, F.struct(
        F.lit("invalid_data_type").alias("issue_type"), F.lit("warning").alias("severity"),
        F.lit(c).alias("column"), _c(c).alias("affected_rows"),
        F.lit(ACTIONS["invalid_data_type"].format(col=c)).alias("suggested_action")))
        for c in present])
    return (agg.select(*keys, F.explode(F.filter(items, lambda x: x.isNotNull())).alias("i"))
               .select(*keys, "i.*"))


def collapsed_verdict(summary: DataFrame, keys: Sequence[str] = ("symbol", "source")) -> DataFrame:
    """One ERROR ``data_quality`` issue per invalid (symbol, source)."""
    return summary.filter(~_c("is_valid")).select(
        *keys, F.lit("data_quality").alias("issue_type"), F.lit("error").alias("severity"),
        F.format_string("Validation failed with %d issues", _c("total_issues")).alias("message"))


def validation_report(summary: DataFrame) -> DataFrame:
    """V27 totals: symbols validated / valid / failed and issues by severity."""
    return summary.agg(
        F.count(F.lit(1)).alias("symbols_validated"),
        F.count_if(_c("is_valid")).alias("symbols_valid"),
        F.count_if(~_c("is_valid")).alias("symbols_failed"),
        F.sum("critical_issues").alias("critical_issues"),
        F.sum("error_issues").alias("error_issues"),
        F.sum("warning_issues").alias("warning_issues"),
        F.sum("info_issues").alias("info_issues"))


# Defaults of the integrity check.
INTEGRITY_MIN_ROWS = 20
INTEGRITY_MAX_MISSING = 0.05
INTEGRITY_JUMP = 0.20
INTEGRITY_COLUMNS = ("open", "high", "low", "close", "volume")


def integrity(bars: DataFrame, keys: Sequence[str] = ("symbol", "source"),
              order: Sequence[str] = ("date", "load_seq"), min_rows: int = INTEGRITY_MIN_ROWS,
              max_missing: float = INTEGRITY_MAX_MISSING, bucket: Column | None = None) -> DataFrame:
    """V30 per (symbol, source): rows (>= min_rows), duplicate rows (2nd and
    later copies of an identical (date, OHLCV) row), missing cells as a share
    of rows x columns, and per price column the jumps > 20% of the padded
    percent change.  Invalid when a column is absent, rows are too few or the
    missing share exceeds ``max_missing``."""
    from ..functions.series import fill
    cols = [c for c in INTEGRITY_COLUMNS if c in bars.columns]
    dups = (bars.groupBy(*keys, "date", *cols).agg(F.count(F.lit(1)).alias("_n"))
                .groupBy(*keys).agg(F.sum(F.col("_n") - 1).alias("duplicate_count")))
    f = fill(bars, keys, order, {"_ff_" + c: _c(c) for c in PRICE_COLUMNS}, "forward", bucket)
    f = with_prev(f, keys, order, ["_ff_" + c for c in PRICE_COLUMNS], bucket)

    def jump(c):
        x, p = _c("_ff_" + c), _c("prev__ff_" + c)
        chg = F.when(p == 0, F.when(x != 0, F.lit(float("inf")))).otherwise(F.abs(x / p - 1))
        return F.count_if(chg > INTEGRITY_JUMP).alias("jumps_" + c)
    nulls = sum((F.col(c).isNull().cast("int") for c in cols), F.lit(0))
    agg = f.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("row_count"),
        F.sum(nulls).cast("bigint").alias("missing_value_count"),
        F.least(*[F.count(c) for c in cols]).alias("_min_present"),
        *[jump(c) for c in PRICE_COLUMNS])
    out = agg.join(dups, list(keys), "left")
    share = out["missing_value_count"] / (out["row_count"] * len(cols))
    return out.select(
        *keys, "row_count", (F.col("row_count") >= min_rows).alias("enough_rows"),
        F.coalesce("duplicate_count", F.lit(0)).cast("bigint").alias("duplicate_count"),
        "missing_value_count", share.alias("missing_share"),
        *[F.col("jumps_" + c) for c in PRICE_COLUMNS],
        ((F.col("_min_present") > 0) & (F.col("row_count") >= min_rows)
         & (share <= max_missing)).alias("is_valid"))
