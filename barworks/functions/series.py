"""Ordered-series windows that stay parallel for hot keys.

A plain ``Window.partitionBy('symbol')`` puts a whole symbol into one task.
The helpers here split each series into coarse, order-preserving buckets
(month of the date by default) and run the window per (keys, bucket).  Values
that must cross a bucket boundary (previous row, last non-NULL value, row
position) come from a per-bucket summary - one row per (keys, bucket), so
tiny - scanned per key and joined back on (keys, bucket).  The join key equals
the window partitioning, so the big side is not shuffled again.

This is the classic segmented-scan decomposition: exact results, no row caps.
With ``bucket=None`` a helper decides by the size of what its plan reads (see
below): one window per key for a small input, the split form beyond it.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .scale import is_small

_B = "_bkt"


def month_bucket(order_col: str = "date") -> Column:
    return F.date_trunc("month", F.col(order_col))


# Without an explicit bucket or block, series operators cut their series when the plan reads
# more than a small input (``scale``): into months, and frames into blocks of FRAME_BLOCK rows.
# Two session settings say otherwise:
#   spark.barworks.series.split = none | day | week | month | quarter | year
#   spark.barworks.series.block = <rows per halo block>   (row-bounded frames)
SPLIT_CONF = "spark.barworks.series.split"
BLOCK_CONF = "spark.barworks.series.block"
_UNITS = ("day", "week", "month", "quarter", "year")
FRAME_BLOCK = 100_000


def _resolve(df: DataFrame, order: Sequence[str], bucket: Column | None) -> Column | None:
    """An explicit bucket wins; then the session's split unit over the first (date or
    timestamp) order column; else months, or None (one window per key) for a small input."""
    if bucket is not None:
        return bucket
    unit = (df.sparkSession.conf.get(SPLIT_CONF, "") or "").lower()
    first = order[0]
    kind = df.schema[first].dataType.typeName() if first in df.columns else ""
    if unit == "none" or kind not in ("date", "timestamp", "timestamp_ntz"):
        return None
    if unit not in _UNITS:
        if is_small(df):
            return None
        unit = "month"
    return F.date_trunc(unit, F.col(first))


def _resolve_block(df: DataFrame, block: int | None) -> int | None:
    if block is not None:
        return block
    v = df.sparkSession.conf.get(BLOCK_CONF, None)
    if v:
        return int(v)
    split = (df.sparkSession.conf.get(SPLIT_CONF, "") or "").lower()
    return None if split or is_small(df) else FRAME_BLOCK


def _w(keys, order, bucketed: bool):
    parts = list(keys) + ([_B] if bucketed else [])
    return Window.partitionBy(*parts).orderBy(*[F.col(o) for o in order])


def with_prev(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              cols: Sequence[str], bucket: Column | None = None,
              prefix: str = "prev_") -> DataFrame:
    """Add ``prefix+c`` = value of ``c`` on the previous row of the key's series."""
    bucket = _resolve(df, order, bucket)
    if bucket is None:
        w = _w(keys, order, False)
        return df.withColumns({prefix + c: F.lag(c).over(w) for c in cols})
    b = df.withColumn(_B, bucket)
    w = _w(keys, order, True)
    b = b.withColumn("_first", F.lag(F.lit(1)).over(w).isNull())
    b = b.withColumns({"_lag_" + c: F.lag(c).over(w) for c in cols})
    tails = (b.groupBy(*keys, _B)
              .agg(F.max_by(F.struct(*cols), F.struct(*order)).alias("_tail")))
    tails = tails.withColumn(
        "_prev_tail", F.lag("_tail").over(Window.partitionBy(*keys).orderBy(_B))).drop("_tail")
    b = b.join(tails, [*keys, _B], "left")
    out = b.withColumns({prefix + c: F.when(F.col("_first"), F.col("_prev_tail." + c))
                         .otherwise(F.col("_lag_" + c)) for c in cols})
    return out.drop(_B, "_first", "_prev_tail", *["_lag_" + c for c in cols])


def with_next(df: DataFrame, keys: Sequence[str], order: Sequence[str],
              cols: Sequence[str], bucket: Column | None = None,
              prefix: str = "next_") -> DataFrame:
    """Add ``prefix+c`` = value of ``c`` on the next row of the key's series."""
    bucket = _resolve(df, order, bucket)
    if bucket is None:
        w = _w(keys, order, False)
        return df.withColumns({prefix + c: F.lead(c).over(w) for c in cols})
    b = df.withColumn(_B, bucket)
    w = _w(keys, order, True)
    # the bucket's last row has no successor; same window spec, no second sort
    b = b.withColumn("_last", F.lead(F.lit(1)).over(w).isNull())
    b = b.withColumns({"_lead_" + c: F.lead(c).over(w) for c in cols})
    heads = (b.groupBy(*keys, _B)
              .agg(F.min_by(F.struct(*cols), F.struct(*order)).alias("_head")))
    heads = heads.withColumn(
        "_next_head", F.lead("_head").over(Window.partitionBy(*keys).orderBy(_B))).drop("_head")
    b = b.join(heads, [*keys, _B], "left")
    out = b.withColumns({prefix + c: F.when(F.col("_last"), F.col("_next_head." + c))
                         .otherwise(F.col("_lead_" + c)) for c in cols})
    return out.drop(_B, "_last", "_next_head", *["_lead_" + c for c in cols])


def _running(keys, order, bucketed: bool, forward: bool, extra=()):
    """A running frame (unbounded preceding .. current row).  Backward scans
    use the reversed order: Spark evaluates a frame that ends at UNBOUNDED
    FOLLOWING by re-aggregating the rest of the partition for every row
    (quadratic), while a running frame is one pass."""
    parts = list(keys) + ([_B] if bucketed else []) + list(extra)
    o = [F.col(c).asc() if forward else F.col(c).desc() for c in order]
    return Window.partitionBy(*parts).orderBy(*o).rowsBetween(Window.unboundedPreceding, 0)


def fill(df: DataFrame, keys: Sequence[str], order: Sequence[str],
         exprs: dict[str, Column], direction: str = "forward",
         bucket: Column | None = None) -> DataFrame:
    """Add each ``name -> expr`` as the last (forward) or next (backward)
    non-NULL value of ``expr`` along the series, current row included.
    Both directions are running ``last(ignorenulls)`` scans (backward over
    the reversed order), so each is linear in the series length."""
    fwd = direction == "forward"
    bucket = _resolve(df, order, bucket)
    tmp = {"_v_" + n: e for n, e in exprs.items()}
    b = df.withColumns(tmp)
    if bucket is None:
        frame = _running(keys, order, False, fwd)
        out = b.withColumns({n: F.last("_v_" + n, ignorenulls=True).over(frame) for n in exprs})
        return out.drop(*tmp)
    b = b.withColumn(_B, bucket)
    frame = _running(keys, order, True, fwd)
    b = b.withColumns({"_in_" + n: F.last("_v_" + n, ignorenulls=True).over(frame) for n in exprs})
    pick = F.max_by if fwd else F.min_by
    ordkey = F.struct(*order)
    edges = b.groupBy(*keys, _B).agg(*[
        pick(F.col("_v_" + n), F.when(F.col("_v_" + n).isNotNull(), ordkey)).alias("_e_" + n)
        for n in exprs])
    # carry across buckets: the nearest earlier (forward) / later (backward)
    # bucket edge, a running scan over the small per-bucket table
    wk = Window.partitionBy(*keys).orderBy(F.col(_B).asc() if fwd else F.col(_B).desc()) \
        .rowsBetween(Window.unboundedPreceding, -1)
    edges = edges.select(*keys, _B, *[F.last("_e_" + n, ignorenulls=True).over(wk).alias("_c_" + n)
                                      for n in exprs])
    b = b.join(edges, [*keys, _B], "left")
    out = b.withColumns({n: F.coalesce(F.col("_in_" + n), F.col("_c_" + n)) for n in exprs})
    return out.drop(_B, *tmp, *["_in_" + n for n in exprs], *["_c_" + n for n in exprs])


def with_position(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                  name: str = "pos", bucket: Column | None = None) -> DataFrame:
    """1-based row position along the series (row_number, split-safe)."""
    bucket = _resolve(df, order, bucket)
    if bucket is None:
        return df.withColumn(name, F.row_number().over(_w(keys, order, False)))
    b = df.withColumn(_B, bucket)
    b = b.withColumn("_rn", F.row_number().over(_w(keys, order, True)))
    sizes = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"))
    wk = Window.partitionBy(*keys).orderBy(_B).rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*keys, _B, F.coalesce(F.sum("_n").over(wk), F.lit(0)).alias("_off"))
    b = b.join(sizes, [*keys, _B], "left")
    return b.withColumn(name, F.col("_rn") + F.col("_off")).drop(_B, "_rn", "_off")


def with_place(df: DataFrame, keys: Sequence[str], order: Sequence[str], cols: Sequence[str],
               bucket: Column, name: str = "pos", prefix: str = "prev_") -> DataFrame:
    """``with_position`` and ``with_prev`` in one: the 1-based row position and the previous
    row's ``cols``, from one window per (keys, bucket), one summary and one join."""
    b = df.withColumn(_B, bucket)
    w = _w(keys, order, True)
    b = b.withColumns({"_rn": F.row_number().over(w), **{"_lag_" + c: F.lag(c).over(w) for c in cols}})
    ends = b.groupBy(*keys, _B).agg(F.count(F.lit(1)).alias("_n"),
                                    F.max(F.struct(*order, F.struct(*cols).alias("_tail"))).alias("_last"))
    wk = Window.partitionBy(*keys).orderBy(_B)
    ends = ends.select(*keys, _B, F.lag("_last._tail").over(wk).alias("_before"),
                       F.coalesce(F.sum("_n").over(wk.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_off"))
    b = b.join(ends, [*keys, _B])
    return b.withColumns({name: F.col("_rn") + F.col("_off"),
                          **{prefix + c: F.when(F.col("_rn") == 1, F.col("_before." + c)).otherwise(F.col("_lag_" + c))
                             for c in cols}}).select(*df.columns, name, *[prefix + c for c in cols])


def in_blocks(df: DataFrame, keys: Sequence[str], pos: str, lookback: int, block: int, then) -> DataFrame:
    """``then(df, w)`` over halo blocks: blocks of ``block`` rows by position ``pos``, each with copies of
    the ``lookback`` rows before it, which are dropped afterwards.  ``w`` is the window of a block."""
    if block <= lookback:
        raise ValueError("block must exceed the lookback")
    at, blk = F.col(pos) - 1, F.floor((F.col(pos) - 1) / block)
    u = df.withColumn("_blk", F.explode(F.when(at % block >= block - lookback, F.array(blk, blk + 1))
                                        .otherwise(F.array(blk))))
    w = Window.partitionBy(*keys, "_blk").orderBy(pos)
    return then(u, w).filter(F.col("_blk") == blk).drop("_blk")


def interpolate_linear(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                       cols: Sequence[str], bucket: Column | None = None) -> DataFrame:
    """Linear interpolation by row position: leading gaps stay NULL, trailing
    gaps take the last known value, inner gaps lie on the line between the
    known neighbours."""
    b = with_position(df, keys, order, "_pos", bucket)
    known = {}
    for c in cols:
        k = F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_pos").alias("p")))
        known["_p_" + c] = k
    b = fill(b, keys, order, known, "forward", bucket)
    b = fill(b, keys, order, {"_n_" + c: F.when(F.col(c).isNotNull(),
                                                 F.struct(F.col(c).alias("v"),
                                                          F.col("_pos").alias("p")))
                              for c in cols}, "backward", bucket)
    out = {}
    for c in cols:
        p, n = F.col("_p_" + c), F.col("_n_" + c)
        line = p.v + (n.v - p.v) * (F.col("_pos") - p.p) / (n.p - p.p)
        out[c] = (F.when(F.col(c).isNotNull(), F.col(c))
                   .when(p.isNull(), F.lit(None).cast("double"))
                   .when(n.isNull(), p.v)
                   .otherwise(line))
    return b.withColumns(out).drop("_pos", *["_p_" + c for c in cols], *["_n_" + c for c in cols])


def rolling(df: DataFrame, keys: Sequence[str], order: Sequence[str], lookback: int,
            build, bucket: Column | None = None, block: int | None = None) -> DataFrame:
    """Row-bounded windows (``rowsBetween(-lookback, 0)``, ``lag(k <= lookback)``)
    that stay parallel for hot keys.

    ``build(w)`` returns ``{name: Column}`` computed over the window spec
    ``w``.  With ``block`` set, each series is cut into fixed-size blocks of
    row positions and every block is prefixed with the ``lookback`` rows
    before it (a halo, duplicated from the previous block), so a task holds
    at most ``block + lookback`` rows; halo rows are dropped afterwards.
    Exact: every kept row sees the same frame as in one window per key.
    Without ``block`` it is one window per key."""
    block = _resolve_block(df, block)
    if block is not None and block <= lookback:
        block = lookback + 1 + block  # a session-wide block smaller than this frame
    if block is None:
        w = Window.partitionBy(*keys).orderBy(*[F.col(o) for o in order])
        return df.withColumns(build(w))
    b = with_position(df, keys, order, "_rpos", bucket)
    return in_blocks(b, keys, "_rpos", lookback, block, lambda u, w: u.withColumns(build(w))).drop("_rpos")


def _lagrange(points: list[tuple[str, str]], x: str) -> str:
    """Expression text: the polynomial through ``points`` ((v, p) pairs) at ``x``."""
    total = None
    for i, (vi, pi) in enumerate(points):
        term = vi
        for j, (_, pj) in enumerate(points):
            if i != j:
                term = f"(({term}) * ({x} - {pj}) / ({pi} - {pj}))"
        total = term if total is None else f"({total} + {term})"
    return total


def interpolate_local(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                      cols: Sequence[str], degree: int = 3, bucket: Column | None = None) -> DataFrame:
    """C13 (degree 3) / C29 (degree 2): a gap takes the value of the local
    polynomial through the nearest known points by row position - two on each
    side for degree 3 (fewer near the ends), the two neighbours plus the
    nearer second neighbour for degree 2.  Gaps before the first or after the
    last known value stay NULL for degree 3; degree 2 keeps the linear rule
    there (leading NULL, trailing last value), like the tiered imputer.

    Each known row carries its own previous/next known point, so one forward
    and one backward fill deliver the two nearest known points on each side
    without a self-join.  Declared as expression text (one projection per
    step).  On the split plan the same steps run on the segmented helpers."""
    if _resolve(df, order, bucket) is not None:
        return _interpolate_local_split(df, keys, order, cols, degree, bucket)
    w = (f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} "
         f"ORDER BY {', '.join(f'`{o}`' for o in order)}")
    # reversed order: "next known" scans become running frames (linear, not
    # the per-row re-aggregation of an UNBOUNDED FOLLOWING frame)
    wr = (f"PARTITION BY {', '.join(f'`{k}`' for k in keys)} "
          f"ORDER BY {', '.join(f'`{o}` DESC' for o in order)}")
    b = df.selectExpr("*", f"row_number() OVER ({w}) AS _pos")
    b = b.selectExpr("*", *[f"CASE WHEN `{c}` IS NOT NULL THEN named_struct('v', `{c}`, 'p', _pos) END "
                            f"AS _k_{c}" for c in cols])
    b = b.selectExpr("*", *[
        f"last(_k_{c}, true) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _kb_{c}"
        for c in cols], *[
        f"last(_k_{c}, true) OVER ({wr} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS _ka_{c}"
        for c in cols])
    b = b.selectExpr("*", *[
        f"CASE WHEN `{c}` IS NOT NULL THEN named_struct('v', `{c}`, 'p', _pos, 'q', _kb_{c}) END AS _pf_{c}"
        for c in cols], *[
        f"CASE WHEN `{c}` IS NOT NULL THEN named_struct('v', `{c}`, 'p', _pos, 'q', _ka_{c}) END AS _nf_{c}"
        for c in cols])
    b = b.selectExpr("*", *[
        f"last(_pf_{c}, true) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _P1_{c}"
        for c in cols], *[
        f"last(_nf_{c}, true) OVER ({wr} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS _N1_{c}"
        for c in cols])
    keep = [f"`{x}`" if x not in cols else f"{_local_value(x, degree)} AS `{x}`" for x in df.columns]
    return b.selectExpr(*keep)


def _local_value(c: str, degree: int) -> str:
    p1, n1 = (f"_P1_{c}.v", f"_P1_{c}.p"), (f"_N1_{c}.v", f"_N1_{c}.p")
    p2, n2 = (f"_P1_{c}.q.v", f"_P1_{c}.q.p"), (f"_N1_{c}.q.v", f"_N1_{c}.q.p")
    has_p2, has_n2 = f"_P1_{c}.q IS NOT NULL", f"_N1_{c}.q IS NOT NULL"
    lin = _lagrange([p1, n1], "_pos")
    if degree == 3:
        val = (f"CASE WHEN {has_p2} AND {has_n2} THEN {_lagrange([p2, p1, n1, n2], '_pos')} "
               f"WHEN {has_n2} THEN {_lagrange([p1, n1, n2], '_pos')} "
               f"WHEN {has_p2} THEN {_lagrange([p2, p1, n1], '_pos')} ELSE {lin} END")
        trailing = "CAST(NULL AS DOUBLE)"
    else:
        use_p2 = f"{has_p2} AND (NOT {has_n2} OR (_pos - _P1_{c}.q.p) <= (_N1_{c}.q.p - _pos))"
        val = (f"CASE WHEN {use_p2} THEN {_lagrange([p2, p1, n1], '_pos')} "
               f"WHEN {has_n2} THEN {_lagrange([p1, n1, n2], '_pos')} ELSE {lin} END")
        trailing = f"_P1_{c}.v"
    return (f"CASE WHEN `{c}` IS NOT NULL THEN `{c}` WHEN _P1_{c} IS NULL THEN CAST(NULL AS DOUBLE) "
            f"WHEN _N1_{c} IS NULL THEN {trailing} ELSE {val} END")


def _interpolate_local_split(df: DataFrame, keys, order, cols, degree: int,
                             bucket: Column | None) -> DataFrame:
    """The local polynomial on segmented scans: row position, the known point
    strictly before / after each row (inclusive fill, then the previous /
    next row's value) and the forward / backward fill of the packed points."""
    b = with_position(df, keys, order, "_pos", bucket)
    known = {f"_k_{c}": F.when(F.col(c).isNotNull(), F.struct(F.col(c).alias("v"), F.col("_pos").alias("p")))
             for c in cols}
    b = fill(b, keys, order, {f"_fk_{c}": known[f"_k_{c}"] for c in cols}, "forward", bucket)
    b = fill(b, keys, order, {f"_bk_{c}": known[f"_k_{c}"] for c in cols}, "backward", bucket)
    b = with_prev(b, keys, order, [f"_fk_{c}" for c in cols], bucket, "_kb")
    b = with_next(b, keys, order, [f"_bk_{c}" for c in cols], bucket, "_ka")
    pack = lambda c, q: F.when(F.col(c).isNotNull(), F.struct(
        F.col(c).alias("v"), F.col("_pos").alias("p"), F.col(q).alias("q")))
    b = fill(b, keys, order, {f"_P1_{c}": pack(c, f"_kb_fk_{c}") for c in cols}, "forward", bucket)
    b = fill(b, keys, order, {f"_N1_{c}": pack(c, f"_ka_bk_{c}") for c in cols}, "backward", bucket)
    keep = [f"`{x}`" if x not in cols else f"{_local_value(x, degree)} AS `{x}`" for x in df.columns]
    return b.selectExpr(*keep)
