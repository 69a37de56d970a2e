"""Run reports and log aggregation.

Per-group "first N" lists (failed symbols, example messages) are bounded in
two stages: N per (group, salt bucket) first, then N per group over those
candidates - a hot group never lands whole in one task, and only N values
per group are ever collected.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.exprs import safe_div

# Report limits and verdict texts.
FAILED_LISTED = 10
EXAMPLES_KEPT = 3
TOP_PATTERNS = 10
PATTERN_WORDS = 5
PARTIAL_SUCCESS_PCT = 90
VERDICT_OK = "completed successfully"
VERDICT_MINOR = "completed with minor issues"
VERDICT_MAJOR = "completed with significant issues"


def first_n(df: DataFrame, keys: Sequence[str], order: Sequence[Column], n: int,
            salt_buckets: int = 64, salt_on: Column | None = None) -> DataFrame:
    """Rows ranked 1..n per key by ``order`` (ties broken by the order list)."""
    salt = F.pmod(F.hash(salt_on if salt_on is not None else F.struct(*order)), F.lit(salt_buckets))
    s = df.withColumn("_salt", salt)
    w1 = Window.partitionBy(*keys, "_salt").orderBy(*order)
    cand = s.withColumn("_r", F.row_number().over(w1)).filter(F.col("_r") <= n).drop("_r", "_salt")
    w2 = Window.partitionBy(*keys).orderBy(*order)
    return cand.withColumn("rank", F.row_number().over(w2)).filter(F.col("rank") <= n)


def segment_report(runs: DataFrame) -> DataFrame:
    """A23 + A24 per segment: requested / ok / failed symbols, records, status
    (completed or partial) and the first 10 failed symbols in name order."""
    ok = F.col("status") == "success"
    agg = runs.groupBy("segment").agg(
        F.count_distinct("symbol").alias("symbols_requested"),
        F.count_distinct(F.when(ok, F.col("symbol"))).alias("symbols_successful"),
        F.coalesce(F.sum(F.when(ok, F.col("records"))), F.lit(0)).alias("total_records"))
    agg = agg.withColumn("symbols_failed", F.col("symbols_requested") - F.col("symbols_successful"))
    failed = runs.filter(~ok).select("segment", "symbol").distinct()
    top = first_n(failed, ["segment"], [F.col("symbol")], FAILED_LISTED)
    lists = top.groupBy("segment").agg(
        F.sort_array(F.collect_list("symbol")).alias("failed_symbols"))
    out = agg.join(lists, "segment", "left")
    return out.select(
        "segment", "symbols_requested", "symbols_successful", "symbols_failed", "total_records",
        F.when(F.col("symbols_failed") == 0, "completed").otherwise("partial").alias("status"),
        F.coalesce("failed_symbols", F.array().cast("array<string>")).alias("failed_symbols"))


def pipeline_report(runs: DataFrame) -> DataFrame:
    """A24 totals: symbols processed / ok / failed, success % and the verdict."""
    per = segment_report(runs)
    t = per.agg(F.sum("symbols_requested").alias("total_symbols"),
                F.sum("symbols_successful").alias("total_successful"),
                F.sum("symbols_failed").alias("total_failed"))
    rate = F.coalesce(safe_div(F.col("total_successful") * 100.0, F.col("total_symbols")), F.lit(0.0))
    return t.select("*", rate.alias("success_rate"),
                    F.when(F.col("total_failed") == 0, VERDICT_OK)
                     .when(rate >= PARTIAL_SUCCESS_PCT, VERDICT_MINOR)
                     .otherwise(VERDICT_MAJOR).alias("verdict"))


def pull_counts(runs: DataFrame) -> DataFrame:
    """Daily pull counts by outcome."""
    s = F.col("status")
    return runs.agg(F.count(F.lit(1)).alias("symbols_attempted"),
                    F.count_if(s == "success").alias("successful"),
                    F.count_if(s == "no_data").alias("no_data"),
                    F.count_if(s == "validation_failed").alias("validation_failed"),
                    F.coalesce(F.sum(F.when(s == "success", F.col("records"))), F.lit(0))
                     .alias("records_inserted"))


def weekly_report(universe: DataFrame, coverage: DataFrame, quality: DataFrame) -> DataFrame:
    """One row from three one-row aggregates, combined with scalar subqueries."""
    n = universe.agg(F.count_distinct("symbol")).scalar()
    cols = [n.alias("universe_size")]
    cols += [coverage.select(c).scalar().alias(c) for c in coverage.columns]
    cols += [quality.select(c).scalar().alias(c) for c in ("quality_score",)]
    return coverage.sparkSession.range(1).select(*cols)


def error_pattern(error_type: str | Column, message: str | Column) -> Column:
    """A27 key: type + ':' + the first five whitespace-separated words."""
    msg = F.col(message) if isinstance(message, str) else message
    t = F.col(error_type) if isinstance(error_type, str) else error_type
    # the first five whitespace-separated words, re-joined by single blanks
    # (one anchored regex; no array of every word of a long message)
    head = F.regexp_extract(msg, r"^\s*(\S+(?:\s+\S+){0,%d})" % (PATTERN_WORDS - 1), 1)
    return F.concat(t, F.lit(":"), F.regexp_replace(head, r"\s+", " "))


def error_patterns(log: DataFrame, top: int = TOP_PATTERNS) -> DataFrame:
    """Count, first / last seen and up to three example messages per
    pattern; the ``top`` patterns by count (ties: earliest first seen).

    Those few rows are kept in a checkpoint, as two joins use them and each would
    read all messages again to find them."""
    from ..session import checkpoint_dir
    checkpoint_dir(log.sparkSession)
    keyed = log.withColumn("pattern", error_pattern("error_type", "message"))
    agg = keyed.groupBy("pattern").agg(F.count(F.lit(1)).alias("count"),
                                       F.min("timestamp").alias("first_seen"),
                                       F.max("timestamp").alias("last_seen"))
    best = agg.orderBy(F.col("count").desc(), F.col("first_seen"), F.col("pattern")).limit(top).checkpoint()
    ex = first_n(keyed.join(best.select("pattern"), "pattern", "left_semi"), ["pattern"],
                 [F.col("timestamp"), F.col("message")], EXAMPLES_KEPT)
    examples = ex.groupBy("pattern").agg(F.sort_array(F.collect_list(
        F.struct("timestamp", "message"))).alias("_ex"))
    return best.join(examples, "pattern", "left").select(
        "pattern", "count", "first_seen", "last_seen",
        F.transform("_ex", lambda x: x["message"]).alias("examples"))


def error_totals(log: DataFrame) -> DataFrame:
    """A27 totals: errors and distinct patterns."""
    return log.agg(F.count(F.lit(1)).alias("total_errors"),
                   F.count_distinct(error_pattern("error_type", "message")).alias("unique_patterns"))
