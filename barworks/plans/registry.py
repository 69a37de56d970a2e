"""Registry of the named queries and their DuckDB oracles."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from ..functions.exprs import rounded
from .ctes import with_ctes

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def _bigint_counts(sql: str) -> str:
    """DuckDB's count_if is HUGEINT; Spark's is bigint - cast it in the oracle."""
    out, i, key = [], 0, "count_if("
    while True:
        j = sql.find(key, i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 1, j + len(key)
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[k], 0)
            k += 1
        inner = _bigint_counts(sql[j + len(key):k - 1])
        out.append(sql[i:j] + "CAST(count_if(" + inner + ") AS BIGINT)")
        i = k


def round_sql(body: str, doubles: str) -> str:
    """Round the named double columns to 6 digits, as ``rounded`` does in Spark."""
    cols = doubles.split()
    if not cols:
        return body
    rep = ", ".join(f"round({c}, 6) AS {c}" for c in cols)
    return f"SELECT * REPLACE ({rep}) FROM (\n{body}\n) AS q"


def query(name: str, sql: str | None = None, ctes: tuple[str, ...] = (),
          doubles: str = "", extra: list[tuple[str, str]] | None = None):
    """Register ``fn(spark, sf_dir)``; its output doubles are rounded to 6 digits
    and ``sql`` (if given) is the DuckDB twin with the named fixture CTEs."""
    def deco(fn: QueryFn) -> QueryFn:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return rounded(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = round_sql(_bigint_counts(with_ctes(sql, *ctes, extra=extra)), doubles)
        return fn
    return deco
