"""Exact per-group percentiles without a buffer that grows with a group.

Spark's ``percentile`` is exact, but its final merge holds every distinct value of a group
in one task.  Here a first pass takes a bounded summary of each group (``percentile_approx``,
whose rank error is limited) and from it a bracket around each wanted rank; a second pass
counts the values: those inside a bracket one by one, all others as one number for each gap
between brackets.  The running count over these few rows finds the values at the two ranks
around each percentage, and their interpolation is ``percentile``'s (linear between the
ranks ``floor`` and ``ceil`` of (n - 1) * p).  Groups of fewer than ``SMALL`` rows have one
bracket, their whole range.  A rank outside its bracket would be an error, never a wrong value.

While the plan reads a small input (``scale``), no group's buffer can grow large and
``percentile`` is used as it is.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scale import is_small

#: Accuracy of the summaries: ranks are off by at most n / ACCURACY.
ACCURACY = 10_000
#: Half the width of a bracket as a share of the group, several times the summaries' error.
MARGIN = 8 / ACCURACY
#: Below so many rows a bracket would be narrower than two ranks: the group's range is taken.
SMALL = 2_500


def group_percentiles(df: DataFrame, keys: Sequence[str], col: str, percentages: Sequence[float],
                      names: Sequence[str], where: str | None = None) -> DataFrame:
    """One row per key with one column per percentage (NULL when the key has
    no non-NULL value).  ``where`` restricts the rows (SQL text)."""
    return multi_percentiles(df, keys, {col: (percentages, names)}, where)


def multi_percentiles(df: DataFrame, keys: Sequence[str],
                      specs: dict[str, tuple[Sequence[float], Sequence[str]]],
                      where: str | None = None) -> DataFrame:
    """Percentiles of several columns per key: two passes over ``df`` (one for a small input),
    whatever the number of columns."""
    keys = list(keys)
    src = df.filter(where) if where else df
    if is_small(df):
        aggs = [F.percentile(c, F.array(*[F.lit(p) for p in ps])).alias("_q_" + c) for c, (ps, _) in specs.items()]
        out = src.groupBy(*keys).agg(*aggs)
        return out.select(*keys, *[F.col("_q_" + c)[i].alias(n) for c, (_, ns) in specs.items() for i, n in enumerate(ns)])
    return bracketed_percentiles(src, keys, specs)


def bracketed_percentiles(src: DataFrame, keys: list[str],
                          specs: dict[str, tuple[Sequence[float], Sequence[str]]]) -> DataFrame:
    """``multi_percentiles`` for groups of any size."""
    cols = list(specs)
    src = src.select(*keys, *[F.col(c).cast("double").alias(f"_v{i}") for i, c in enumerate(cols)])
    marks = {i: sorted({q for p in specs[c][0] for q in (max(0.0, p - MARGIN), min(1.0, p + MARGIN))})
             for i, c in enumerate(cols)}
    stats = src.groupBy(*keys).agg(*[x for i in marks for x in (
        F.count(f"_v{i}").alias(f"_n{i}"), F.min(f"_v{i}").alias(f"_lo{i}"), F.max(f"_v{i}").alias(f"_hi{i}"),
        F.percentile_approx(f"_v{i}", marks[i], ACCURACY).alias(f"_q{i}"))])

    def brackets(i: int) -> Column:
        """The brackets of a column, by percentage (they may overlap)."""
        def at(q: float) -> Column:
            return F.col(f"_q{i}")[marks[i].index(q)]
        ps = sorted(set(specs[cols[i]][0]))
        own = F.array(*[F.struct(at(max(0.0, p - MARGIN)).alias("lo"), at(min(1.0, p + MARGIN)).alias("hi")) for p in ps])
        whole = F.array(F.struct(F.col(f"_lo{i}").alias("lo"), F.col(f"_hi{i}").alias("hi")))
        return F.when(F.col(f"_n{i}") < SMALL, whole).otherwise(own)

    stats = stats.select(*keys, *[brackets(i).alias(f"_b{i}") for i in marks], *[f"_n{i}" for i in marks])
    joined = src.join(stats.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)],
                                   *[f"_b{i}" for i in marks]),
                      [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])

    def placed(i: int) -> Column:
        """The value itself inside a bracket; else the gap it lies in, after the bracket below it."""
        v, b = F.col(f"_v{i}"), F.col(f"_b{i}")
        inside = F.exists(b, lambda x: (v >= x["lo"]) & (v <= x["hi"]))
        below = F.aggregate(b, F.lit(float("-inf")), lambda m, x: F.when(x["hi"] < v, F.greatest(m, x["hi"])).otherwise(m))
        return F.struct(F.lit(i).alias("c"), F.when(v.isNull(), v).when(inside, v).otherwise(below).alias("v"),
                        (~inside).alias("gap"))

    rows = joined.select(*keys, F.explode(F.array(*[placed(i) for i in marks])).alias("x"))
    rows = rows.select(*keys, "x.*").filter("v IS NOT NULL").groupBy(*keys, "c", "v", "gap").agg(F.count(F.lit(1)).alias("m"))
    w = Window.partitionBy(*keys, "c").orderBy("v", "gap").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("last", F.sum("m").over(w) - 1).withColumn("first", F.col("last") - F.col("m") + 1)
    picked = []
    for i, c in enumerate(cols):
        for j, p in enumerate(specs[c][0]):
            x = (F.col(f"_n{i}") - 1) * F.lit(float(p))
            for side, rank in (("l", F.floor(x)), ("u", F.ceil(x))):
                here = (F.col("c") == i) & (rank >= F.col("first")) & (rank <= F.col("last"))
                gap = F.raise_error(F.lit("a percentile's rank lies outside its bracket")).cast("double")
                picked.append(F.max(F.when(here, F.when(F.col("gap"), gap).otherwise(F.col("v")))).alias(f"_{side}{i}_{j}"))
    counts = stats.select(*keys, *[f"_n{i}" for i in marks])
    found = rows.join(counts.select(*[F.col(k).alias(f"_k{j}") for j, k in enumerate(keys)], *[f"_n{i}" for i in marks]),
                      [F.col(k).eqNullSafe(F.col(f"_k{j}")) for j, k in enumerate(keys)])
    found = found.groupBy(*keys).agg(*picked, *[F.first(f"_n{i}").alias(f"_n{i}") for i in marks])
    out = []
    for i, c in enumerate(cols):
        for j, (p, name) in enumerate(zip(*specs[c])):
            x = (F.col(f"_n{i}") - 1) * F.lit(float(p))
            lo, hi, vl, vu = F.floor(x), F.ceil(x), F.col(f"_l{i}_{j}"), F.col(f"_u{i}_{j}")
            out.append(F.when(lo == hi, vl).otherwise((hi - x) * vl + (x - lo) * vu).alias(name))
    return found.select(*keys, *out)
