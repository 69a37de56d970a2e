"""Interpolation by one cubic spline through all known values of a series.

The spline's second derivatives at the known points solve a tridiagonal system over the
whole series: a forward elimination and a backward substitution.  What a point far away
adds fades by at least one half per known point (by 3.7 when they are evenly spaced), so a
block of known points with ``HALO`` more on each side gives the system's solution to the
last digits, and no task holds a series.  The ends are not-a-knot (the first two and last
two pieces are one cubic each); three known points give their parabola, two their line.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .series import fill, with_position

#: Known points of a block, and the points on each side that are solved with it.
BLOCK, HALO = 128, 64

# k: the points (j: number, p: place, v: value) of a block with its halo; n: points of the series.
_HM, _HP = "(k[i].p - k[i - 1].p)", "(k[i + 1].p - k[i].p)"
_SLOPES = f"((k[i + 1].v - k[i].v) / {_HP} - (k[i].v - k[i - 1].v) / {_HM})"
_LEFT, _RIGHT = "(i = 1 AND k[0].j = 1)", "(i = size(k) - 2 AND k[size(k) - 1].j = n)"
#: One equation a * m[i - 1] + b * m[i] + c * m[i + 1] = r for each inner point; the end points
#: are eliminated (not-a-knot, or 0 where the halo is cut).
_EQUATIONS = f"""transform(sequence(1, size(k) - 2), i -> named_struct(
  'a', CASE WHEN i = 1 THEN 0D WHEN {_RIGHT} THEN {_HM} - {_HP} * {_HP} / {_HM} ELSE {_HM} END,
  'b', 2 * ({_HM} + {_HP}) + CASE WHEN {_LEFT} THEN {_HM} + {_HM} * {_HM} / {_HP} ELSE 0D END
       + CASE WHEN {_RIGHT} THEN {_HP} + {_HP} * {_HP} / {_HM} ELSE 0D END,
  'c', CASE WHEN i = size(k) - 2 THEN 0D WHEN {_LEFT} THEN {_HP} - {_HM} * {_HM} / {_HP} ELSE {_HP} END,
  'r', 6 * {_SLOPES}))"""
_NONE = "array(named_struct('c', 0D, 'd', 0D))"
_FORWARD = f"""aggregate(equations, {_NONE}, (done, x) -> concat(done, array(named_struct(
  'c', x.c / (x.b - x.a * element_at(done, -1).c),
  'd', (x.r - x.a * element_at(done, -1).d) / (x.b - x.a * element_at(done, -1).c)))))"""
_BACKWARD = """reverse(aggregate(reverse(slice(forward, 2, size(forward) - 1)), array(0D),
  (done, x) -> concat(done, array(x.d - x.c * element_at(done, -1)))))"""
#: inner: the solutions of the inner points and a last 0.
_SOLVED = """CASE WHEN n < 3 THEN transform(k, x -> 0D)
  WHEN n = 3 THEN transform(k, x -> 2 * ((k[2].v - k[1].v) / (k[2].p - k[1].p) - (k[1].v - k[0].v) / (k[1].p - k[0].p))
                                    / (k[2].p - k[0].p))
  ELSE concat(
    array(CASE WHEN k[0].j = 1 THEN inner[0] + (inner[0] - inner[1]) * (k[1].p - k[0].p) / (k[2].p - k[1].p) ELSE 0D END),
    slice(inner, 1, size(k) - 2),
    array(CASE WHEN k[size(k) - 1].j = n THEN inner[size(k) - 3] + (inner[size(k) - 3] - inner[size(k) - 4])
      * (k[size(k) - 1].p - k[size(k) - 2].p) / (k[size(k) - 2].p - k[size(k) - 3].p) ELSE 0D END)) END"""


def second_derivatives(points: DataFrame, keys: Sequence[str], block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """keys, p, m: the spline's second derivative at each of ``points`` (keys, j: 1, 2, ..., p, v)."""
    keys = list(keys)
    sizes = points.groupBy(*keys).agg(F.max("j").cast("long").alias("n"))
    at, blk = (F.col("j") - 1) % block, F.floor((F.col("j") - 1) / block)
    own = F.array(blk)
    # copies for the block before (the first points) and the one after (the last points)
    every = F.concat(own, F.when(at < halo, F.array(blk - 1)).otherwise(F.array().cast("array<bigint>")),
                     F.when(at >= block - halo, F.array(blk + 1)).otherwise(F.array().cast("array<bigint>")))
    dealt = points.select(*keys, F.explode(every).alias("_blk"), F.struct("j", "p", "v").alias("x"))
    groups = dealt.groupBy(*keys, "_blk").agg(F.array_sort(F.collect_list("x")).alias("k")).join(sizes, keys)
    # the copies beside the first and the last block belong to no block
    groups = groups.filter((F.col("_blk") >= 0) & (F.col("_blk") * block < F.col("n")))
    empty = "CAST(array() AS array<struct<a: double, b: double, c: double, r: double>>)"
    solved = groups.withColumn("equations", F.expr(f"CASE WHEN n < 4 THEN {empty} ELSE {_EQUATIONS} END")) \
        .withColumn("forward", F.expr(_FORWARD)).withColumn("inner", F.expr(
            "CASE WHEN n < 4 THEN array(0D) ELSE slice(" + _BACKWARD + ", 1, size(k) - 2) END")) \
        .withColumn("m", F.expr(_SOLVED))
    rows = solved.select(*keys, "_blk", F.explode(F.arrays_zip("k", "m")).alias("z"))
    return rows.filter(F.floor((F.col("z.k.j") - 1) / block) == F.col("_blk")).select(
        *keys, F.col("z.k.p").alias("p"), F.col("z.m").alias("m"))


def interpolate_spline(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
                       bucket: Column | None = None, block: int = BLOCK, halo: int = HALO) -> DataFrame:
    """NULLs between known values take the spline's value at their row position; those before
    the first and after the last known value stay NULL."""
    from ..session import cut
    keys = list(keys)
    if bucket is None:
        bucket = F.date_trunc("month", F.col(order[0]))
    b = cut(with_position(df.withColumn("_month", bucket), keys, order, "_pos", F.col("_month")))
    for c in cols:
        known = b.filter(F.col(c).isNotNull()).select(*keys, "_month", F.col("_pos").cast("double").alias("p"),
                                                      F.col(c).cast("double").alias("v"))
        points = with_position(known, keys, ["p"], "j", F.col("_month"))
        m = second_derivatives(points.select(*keys, "j", "p", "v"), keys, block, halo)
        m = m.select(*keys, F.col("p").cast(b.schema["_pos"].dataType).alias("_pos"), F.col("m").alias(f"_m_{c}"))
        b = b.join(m, [*keys, "_pos"], "left")
    point = {c: F.when(F.col(c).isNotNull(), F.struct(F.col("_pos").cast("double").alias("p"), F.col(c).alias("v"),
                                                     F.col(f"_m_{c}").alias("m"))) for c in cols}
    b = fill(b, keys, order, {f"_a_{c}": x for c, x in point.items()}, "forward", F.col("_month"))
    b = fill(b, keys, order, {f"_z_{c}": x for c, x in point.items()}, "backward", F.col("_month"))
    out = {}
    for c in cols:
        a, z = F.col(f"_a_{c}"), F.col(f"_z_{c}")
        h, s, t = z.p - a.p, z.p - F.col("_pos"), F.col("_pos") - a.p
        value = ((a.m * s * s * s + z.m * t * t * t) / (6 * h)
                 + (a.v / h - a.m * h / 6) * s + (z.v / h - z.m * h / 6) * t)
        out[c] = F.when(F.col(c).isNotNull(), F.col(c)).when(a.isNotNull() & z.isNotNull(), value)
    return b.withColumns(out).select(*df.columns)
