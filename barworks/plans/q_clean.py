"""Cleaning queries (C1-C31) and their SQL twins (on the primary vendor bars)."""

from __future__ import annotations

from ..operators import clean as C
from ..sources import fixtures as fx
from .registry import query

OHLCV = ("open", "high", "low", "close", "volume")
PRICES = ("open", "high", "low", "close")
D = "open high low close volume"
_W = """WINDOW f AS (PARTITION BY symbol ORDER BY date, load_seq
                  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       b AS (PARTITION BY symbol ORDER BY date, load_seq
                  ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""


def _ffbf(src: str, cols=OHLCV, backward_first=False) -> str:
    def one(c):
        fw, bw = (f"last_value({c} IGNORE NULLS) OVER f", f"first_value({c} IGNORE NULLS) OVER b")
        return f"coalesce({bw}, {fw}) AS {c}" if backward_first else f"coalesce({fw}, {bw}) AS {c}"
    return f"SELECT * REPLACE ({', '.join(one(c) for c in cols)}) FROM {src} {_W}"


def _linear(src: str, cols=OHLCV) -> str:
    known = lambda c: f"CASE WHEN {c} IS NOT NULL THEN {{'v': {c}, 'p': pos}} END"
    sel = ", ".join(f"last_value({known(c)} IGNORE NULLS) OVER f AS p_{c}, "
                    f"first_value({known(c)} IGNORE NULLS) OVER b AS n_{c}" for c in cols)
    rep = ", ".join(
        f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN p_{c} IS NULL THEN NULL "
        f"WHEN n_{c} IS NULL THEN p_{c}.v "
        f"ELSE p_{c}.v + (n_{c}.v - p_{c}.v) * (pos - p_{c}.p) / (n_{c}.p - p_{c}.p) END AS {c}"
        for c in cols)
    drop = ", ".join(["pos"] + [f"p_{c}, n_{c}" for c in cols])
    return (f"SELECT * EXCLUDE ({drop}) REPLACE ({rep}) FROM ("
            f"SELECT *, {sel} FROM (SELECT *, row_number() OVER (PARTITION BY symbol "
            f"ORDER BY date, load_seq) AS pos FROM {src}) {_W})")


def _stat(src: str, agg: str, cols=OHLCV) -> str:
    stats = ", ".join(agg.format(c=c) + f" AS s_{c}" for c in cols)
    rep = ", ".join(f"coalesce(t.{c}, s.s_{c}) AS {c}" for c in cols)
    return (f"SELECT t.* REPLACE ({rep}) FROM {src} t LEFT JOIN "
            f"(SELECT symbol, {stats} FROM {src} GROUP BY symbol) s USING (symbol)")


def _mode(src: str, cols=OHLCV) -> str:
    joins, rep = [], []
    for c in cols:
        joins.append(f"LEFT JOIN (SELECT symbol, {c} AS m_{c} FROM (SELECT symbol, {c}, "
                     f"row_number() OVER (PARTITION BY symbol ORDER BY count(*) DESC, {c}) AS rn "
                     f"FROM {src} WHERE {c} IS NOT NULL GROUP BY symbol, {c}) WHERE rn = 1) "
                     f"USING (symbol)")
        rep.append(f"coalesce(t.{c}, m_{c}) AS {c}")
    return (f"SELECT t.* REPLACE ({', '.join(rep)}) FROM {src} t " + " ".join(joins))


def _caps(src: str, method: str, cols=OHLCV) -> str:
    aggs, lohi = [], []
    for c in cols:
        if method == "iqr":
            aggs.append(f"quantile_cont({c}, [0.25, 0.75]) AS q_{c}")
            lohi.append(f"q_{c}[1] - 3.0 * (q_{c}[2] - q_{c}[1]) AS lo_{c}, "
                        f"q_{c}[2] + 3.0 * (q_{c}[2] - q_{c}[1]) AS hi_{c}")
        elif method == "zscore":
            aggs.append(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}")
            lohi.append(f"m_{c} - 3.0 * s_{c} AS lo_{c}, m_{c} + 3.0 * s_{c} AS hi_{c}")
        else:
            aggs.append(f"quantile_cont({c}, [0.01, 0.99]) AS q_{c}")
            lohi.append(f"q_{c}[1] AS lo_{c}, q_{c}[2] AS hi_{c}")
    rep = ", ".join(f"CASE WHEN t.{c} < lo_{c} THEN lo_{c} WHEN t.{c} > hi_{c} THEN hi_{c} "
                    f"ELSE t.{c} END AS {c}" for c in cols)
    return (f"SELECT t.* REPLACE ({rep}) FROM {src} t LEFT JOIN (SELECT symbol, {', '.join(lohi)} "
            f"FROM (SELECT symbol, {', '.join(aggs)} FROM {src} GROUP BY symbol)) s USING (symbol)")


def _repair(src: str) -> str:
    return (f"SELECT * REPLACE (CASE WHEN high < greatest(open, close) THEN greatest(open, close) "
            f"ELSE high END AS high, CASE WHEN low > least(open, close) THEN least(open, close) "
            f"ELSE low END AS low) FROM {src}")


def _fix(src, expr):
    return f"SELECT * REPLACE ({', '.join(expr.format(c=c) + f' AS {c}' for c in PRICES)}) FROM {src}"


@query("fill_forward", _ffbf("vendor_a"), ("vendor_a",), doubles=D)
def fill_forward(spark, sf_dir):
    """Forward then backward fill per symbol."""
    return C.fill_forward(fx.vendor_a(spark, sf_dir))


@query("fill_forward_split", _ffbf("vendor_a"), ("vendor_a",), doubles=D)
def fill_forward_split(spark, sf_dir):
    """C10 with the series split in weekly buckets (hot-symbol plan)."""
    from pyspark.sql import functions as F
    return C.fill_forward(fx.vendor_a(spark, sf_dir), bucket=F.date_trunc("week", "date"))


@query("fill_backward", _ffbf("vendor_a", backward_first=True), ("vendor_a",), doubles=D)
def fill_backward(spark, sf_dir):
    """C11."""
    return C.fill_backward(fx.vendor_a(spark, sf_dir))


@query("fill_linear", _linear("vendor_a"), ("vendor_a",), doubles=D)
def fill_linear(spark, sf_dir):
    """C12."""
    return C.fill_linear(fx.vendor_a(spark, sf_dir))


@query("fill_linear_split", _linear("vendor_a"), ("vendor_a",), doubles=D)
def fill_linear_split(spark, sf_dir):
    """C12 with weekly buckets (positions and neighbours carried across buckets)."""
    from pyspark.sql import functions as F
    return C.fill_linear(fx.vendor_a(spark, sf_dir), bucket=F.date_trunc("week", "date"))


@query("fill_mean", _stat("vendor_a", "avg({c})"), ("vendor_a",), doubles=D)
def fill_mean(spark, sf_dir):
    """C14."""
    return C.fill_mean(fx.vendor_a(spark, sf_dir))


@query("fill_median", _stat("vendor_a", "quantile_cont({c}, 0.5)"), ("vendor_a",), doubles=D)
def fill_median(spark, sf_dir):
    """C15."""
    return C.fill_median(fx.vendor_a(spark, sf_dir))


@query("fill_mode", _mode("vendor_a"), ("vendor_a",), doubles=D)
def fill_mode(spark, sf_dir):
    """C16."""
    return C.fill_mode(fx.vendor_a(spark, sf_dir))


@query("fill_zero", "SELECT * REPLACE (" + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in OHLCV)
       + ") FROM vendor_a", ("vendor_a",), doubles=D)
def fill_zero(spark, sf_dir):
    """C17."""
    return C.fill_zero(fx.vendor_a(spark, sf_dir))


@query("outliers_iqr", _caps("vendor_a", "iqr"), ("vendor_a",), doubles=D)
def outliers_iqr(spark, sf_dir):
    """C18."""
    return C.cap_outliers(fx.vendor_a(spark, sf_dir), "iqr")


@query("outliers_zscore", _caps("vendor_a", "zscore"), ("vendor_a",), doubles=D)
def outliers_zscore(spark, sf_dir):
    """C19."""
    return C.cap_outliers(fx.vendor_a(spark, sf_dir), "zscore")


@query("outliers_quantile", _caps("vendor_a", "quantile"), ("vendor_a",), doubles=D)
def outliers_quantile(spark, sf_dir):
    """C20."""
    return C.cap_outliers(fx.vendor_a(spark, sf_dir), "quantile")


@query("ohlc_repair", _repair("vendor_a"), ("vendor_a",), doubles=D)
def ohlc_repair(spark, sf_dir):
    """C21."""
    return C.ohlc_repair(fx.vendor_a(spark, sf_dir))


@query("negative_absolute", _fix("vendor_a", "CASE WHEN {c} < 0 THEN abs({c}) ELSE {c} END"),
       ("vendor_a",), doubles=D)
def negative_absolute(spark, sf_dir):
    """C22."""
    return C.negative_prices(fx.vendor_a(spark, sf_dir), "absolute")


@query("negative_previous", _ffbf("masked", PRICES), ("vendor_a",), doubles=D,
       extra=[("masked", _fix("vendor_a", "CASE WHEN {c} < 0 THEN NULL ELSE {c} END"))])
def negative_previous(spark, sf_dir):
    """C23."""
    return C.negative_prices(fx.vendor_a(spark, sf_dir), "previous")


@query("negative_minimum", _fix("vendor_a", "CASE WHEN {c} < 0 THEN 0.01 ELSE {c} END"),
       ("vendor_a",), doubles=D)
def negative_minimum(spark, sf_dir):
    """C24."""
    return C.negative_prices(fx.vendor_a(spark, sf_dir), "minimum")


@query("negative_null", _fix("vendor_a", "CASE WHEN {c} IS NULL OR {c} >= 0 THEN {c} END"),
       ("vendor_a",), doubles=D)
def negative_null(spark, sf_dir):
    """C25."""
    return C.negative_prices(fx.vendor_a(spark, sf_dir), "nan")


_ROLL = """SELECT * REPLACE (coalesce(volume, quantile_cont(volume, 0.5) OVER (
  PARTITION BY symbol ORDER BY date, load_seq ROWS BETWEEN 9 PRECEDING AND CURRENT ROW)) AS volume)
FROM {src}"""


@query("volume_rolling_median", _ROLL.format(src="vendor_a"), ("vendor_a",), doubles=D)
def volume_rolling_median(spark, sf_dir):
    """C31."""
    return C.volume_rolling_median(fx.vendor_a(spark, sf_dir))


@query("volume_rolling_median_split", _ROLL.format(src="vendor_a"), ("vendor_a",), doubles=D)
def volume_rolling_median_split(spark, sf_dir):
    """C31 on the halo-block plan: 12-row blocks, each prefixed with the 9
    rows before it, so the fixture crosses block boundaries."""
    from pyspark.sql import functions as F
    return C.volume_rolling_median(fx.vendor_a(spark, sf_dir), bucket=F.date_trunc("week", "date"),
                                   block=12)


@query("cross_source_fill", "SELECT a.* REPLACE (" + ", ".join(
    f"coalesce(a.{c}, b.{c}) AS {c}" for c in PRICES) +
    ") FROM vendor_a a LEFT JOIN bars_b b USING (symbol, date)", ("vendor_a", "bars_b"), doubles=D)
def cross_source_fill(spark, sf_dir):
    """C30."""
    return C.cross_source_fill(fx.vendor_a(spark, sf_dir), fx.bars_b(spark, sf_dir))


_C1 = [
    ("f1", _ffbf("bars_dirty")),
    ("a1", _fix("f1", "CASE WHEN {c} <= 0 THEN abs({c}) ELSE {c} END")),
    ("s1", "SELECT * REPLACE (CASE WHEN high < low THEN low ELSE high END AS high, "
           "CASE WHEN high < low THEN high ELSE low END AS low) FROM a1"),
    ("h1", "SELECT * REPLACE (CASE WHEN high < open THEN open ELSE high END AS high) FROM s1"),
    ("h2", "SELECT * REPLACE (CASE WHEN high < close THEN close ELSE high END AS high) FROM h1"),
    ("l1", "SELECT * REPLACE (CASE WHEN low > open THEN open ELSE low END AS low) FROM h2"),
    ("l2", "SELECT * REPLACE (CASE WHEN low > close THEN close ELSE low END AS low) FROM l1"),
    ("v1", "SELECT t.* REPLACE (CASE WHEN volume IS NULL OR volume <= 0 THEN coalesce(m.med, 1000.0) "
           "ELSE volume END AS volume) FROM l2 t LEFT JOIN (SELECT symbol, "
           "quantile_cont(volume, 0.5) AS med FROM l2 WHERE volume > 0 GROUP BY symbol) m "
           "USING (symbol)")]


@query("clean_bars", "SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, "
       "date ORDER BY load_seq) AS rn FROM v1) WHERE rn = 1", ("bars_dirty",), doubles=D, extra=_C1)
def clean_bars(spark, sf_dir):
    """C1 end to end on the faulty bars (duplicates included)."""
    return C.clean_bars(fx.bars_dirty(spark, sf_dir))


@query("clean_pipeline", _repair("c2"), ("vendor_a",), doubles=D,
       extra=[("c1", _ffbf("vendor_a")), ("c2", _caps("c1", "iqr"))])
def clean_pipeline(spark, sf_dir):
    """Forward fill -> IQR caps -> OHLC repair."""
    return C.clean_pipeline(fx.vendor_a(spark, sf_dir), "forward_fill", "iqr")


_TIERED = [
    ("t1", _linear("vendor_a", PRICES)),
    ("t2", _ROLL.format(src="t1")),
    ("g", "SELECT symbol, bool_or(open IS NULL OR high IS NULL OR low IS NULL OR close IS NULL "
          "OR volume IS NULL) AS any_null FROM vendor_a GROUP BY symbol")]


@query("tiered_impute", "SELECT t.* REPLACE (CASE WHEN g.any_null AND t.high < greatest(t.open, t.close) "
       "THEN greatest(t.open, t.close) ELSE t.high END AS high, CASE WHEN g.any_null AND "
       "t.low > least(t.open, t.close) THEN least(t.open, t.close) ELSE t.low END AS low) "
       "FROM t2 t LEFT JOIN g USING (symbol)", ("vendor_a",), doubles=D, extra=_TIERED)
def tiered_impute(spark, sf_dir):
    """C26 with the default linear method: prices linear, volume rolling
    median, OHLC repair only for symbols that had a gap."""
    return C.tiered_impute(fx.vendor_a(spark, sf_dir), "linear")


def _lag_sql(points: list[tuple[str, str]], x: str) -> str:
    """Lagrange value at x through (v, p) points, in the operator's evaluation order."""
    terms = []
    for i, (vi, pi) in enumerate(points):
        t = vi
        for j, (_, pj) in enumerate(points):
            if i != j:
                t = f"(({t}) * ({x} - {pj}) / ({pi} - {pj}))"
        terms.append(t)
    out = terms[0]
    for t in terms[1:]:
        out = f"({out} + {t})"
    return out


def _local_sql(src: str, degree: int, cols=OHLCV) -> str:
    w = "PARTITION BY symbol ORDER BY date, load_seq"
    k = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN {{'v': {c}, 'p': pos}} END AS k_{c}" for c in cols)
    kb = ", ".join(f"last_value(k_{c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND "
                   f"1 PRECEDING) AS kb_{c}, first_value(k_{c} IGNORE NULLS) OVER ({w} ROWS BETWEEN "
                   f"1 FOLLOWING AND UNBOUNDED FOLLOWING) AS ka_{c}" for c in cols)
    pk = ", ".join(f"CASE WHEN {c} IS NOT NULL THEN {{'v': {c}, 'p': pos, 'q': kb_{c}}} END AS pf_{c}, "
                   f"CASE WHEN {c} IS NOT NULL THEN {{'v': {c}, 'p': pos, 'q': ka_{c}}} END AS nf_{c}"
                   for c in cols)
    ff = ", ".join(f"last_value(pf_{c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND "
                   f"CURRENT ROW) AS P1_{c}, first_value(nf_{c} IGNORE NULLS) OVER ({w} ROWS BETWEEN "
                   f"CURRENT ROW AND UNBOUNDED FOLLOWING) AS N1_{c}" for c in cols)
    rep = []
    for c in cols:
        p1, n1 = (f"P1_{c}.v", f"P1_{c}.p"), (f"N1_{c}.v", f"N1_{c}.p")
        p2, n2 = (f"P1_{c}.q.v", f"P1_{c}.q.p"), (f"N1_{c}.q.v", f"N1_{c}.q.p")
        lin = _lag_sql([p1, n1], "pos")
        if degree == 3:
            val = (f"CASE WHEN P1_{c}.q IS NOT NULL AND N1_{c}.q IS NOT NULL THEN "
                   f"{_lag_sql([p2, p1, n1, n2], 'pos')} WHEN N1_{c}.q IS NOT NULL THEN "
                   f"{_lag_sql([p1, n1, n2], 'pos')} WHEN P1_{c}.q IS NOT NULL THEN "
                   f"{_lag_sql([p2, p1, n1], 'pos')} ELSE {lin} END")
            trailing = "CAST(NULL AS DOUBLE)"
        else:
            use_p2 = (f"P1_{c}.q IS NOT NULL AND (N1_{c}.q IS NULL OR "
                      f"(pos - P1_{c}.q.p) <= (N1_{c}.q.p - pos))")
            val = (f"CASE WHEN {use_p2} THEN {_lag_sql([p2, p1, n1], 'pos')} "
                   f"WHEN N1_{c}.q IS NOT NULL THEN {_lag_sql([p1, n1, n2], 'pos')} ELSE {lin} END")
            trailing = f"P1_{c}.v"
        rep.append(f"CASE WHEN {c} IS NOT NULL THEN {c} WHEN P1_{c} IS NULL THEN CAST(NULL AS DOUBLE) "
                   f"WHEN N1_{c} IS NULL THEN {trailing} ELSE {val} END AS {c}")
    return (f"SELECT symbol, date, {', '.join(rep)}, load_seq, source FROM ("
            f"SELECT *, {ff} FROM (SELECT *, {pk} FROM (SELECT *, {kb} FROM (SELECT *, {k} FROM ("
            f"SELECT *, row_number() OVER ({w}) AS pos FROM {src})))))")


@query("interp_cubic", _local_sql("vendor_a", 3), ("vendor_a",), doubles=D)
def interp_cubic(spark, sf_dir):
    """C13 (re-aimed local cubic through two known points on each side)."""
    return C.fill_cubic(fx.vendor_a(spark, sf_dir))


@query("interp_quadratic", _local_sql("vendor_a", 2), ("vendor_a",), doubles=D)
def interp_quadratic(spark, sf_dir):
    """C29 (re-aimed local quadratic through the three nearest known points)."""
    return C.fill_quadratic(fx.vendor_a(spark, sf_dir))


# the tridiagonal system by a walk forward and a walk back over each symbol's known closes
_KNOTS = """
SELECT *, hp - hp * hp / hm AS c_first, hm - hp * hp / hm AS a_last, 6 * ((v2 - v) / hp - (v - v0) / hm) AS r FROM (
  SELECT *, p - lag(p) OVER w AS hm, lead(p) OVER w - p AS hp, lag(v) OVER w AS v0, lead(v) OVER w AS v2
  FROM (SELECT symbol, p, v, row_number() OVER (PARTITION BY symbol ORDER BY p) AS j, count(*) OVER (PARTITION BY symbol) AS n
        FROM (SELECT symbol, close AS v, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date, load_seq) AS DOUBLE) AS p
              FROM vendor_a) WHERE v IS NOT NULL)
  WINDOW w AS (PARTITION BY symbol ORDER BY p))"""
_ROWS_OF = """
SELECT *, CASE WHEN j = 2 THEN 0 WHEN j = n - 1 THEN hm - hp * hp / hm ELSE hm END AS ea,
       2 * (hm + hp) + CASE WHEN j = 2 THEN hm + hm * hm / hp ELSE 0 END + CASE WHEN j = n - 1 THEN hp + hp * hp / hm ELSE 0 END AS eb,
       CASE WHEN j = n - 1 THEN 0 WHEN j = 2 THEN hp - hm * hm / hp ELSE hp END AS ec
FROM knots WHERE n >= 4 AND j > 1 AND j < n"""
_WALKED = """
SELECT * FROM (WITH RECURSIVE there AS (
  SELECT symbol, j, ec / eb AS c, r / eb AS d FROM equations WHERE j = 2
  UNION ALL
  SELECT e.symbol, e.j, e.ec / (e.eb - e.ea * t.c), (e.r - e.ea * t.d) / (e.eb - e.ea * t.c)
  FROM there t JOIN equations e ON e.symbol = t.symbol AND e.j = t.j + 1),
back AS (
  SELECT t.symbol, t.j, t.d AS m FROM there t JOIN equations e USING (symbol, j) WHERE t.j = e.n - 1
  UNION ALL
  SELECT t.symbol, t.j, t.d - t.c * b.m FROM back b JOIN there t ON t.symbol = b.symbol AND t.j = b.j - 1)
SELECT * FROM back)"""
_BENT = """
SELECT k.symbol, k.p, k.v, CASE
  WHEN k.n < 3 THEN 0
  WHEN k.n = 3 THEN 2 * any_value(CASE WHEN k.j = 2 THEN (k.v2 - k.v) / k.hp - (k.v - k.v0) / k.hm END) OVER (PARTITION BY k.symbol)
                      / any_value(CASE WHEN k.j = 2 THEN k.hm + k.hp END) OVER (PARTITION BY k.symbol)
  WHEN k.j = 1 THEN lead(w.m) OVER s + (lead(w.m) OVER s - lead(w.m, 2) OVER s) * k.hp / lead(k.hp) OVER s
  WHEN k.j = k.n THEN lag(w.m) OVER s + (lag(w.m) OVER s - lag(w.m, 2) OVER s) * k.hm / lag(k.hm) OVER s
  ELSE w.m END AS m
FROM knots k LEFT JOIN walked w USING (symbol, j) WINDOW s AS (PARTITION BY k.symbol ORDER BY k.j)"""
_SPLINE = """
SELECT symbol, date, load_seq, CASE WHEN close IS NOT NULL THEN close WHEN z.p IS NOT NULL AND a.p IS NOT NULL THEN
  (a.m * pow(z.p - p, 3) + z.m * pow(p - a.p, 3)) / (6 * (z.p - a.p)) + (a.v / (z.p - a.p) - a.m * (z.p - a.p) / 6) * (z.p - p)
  + (z.v / (z.p - a.p) - z.m * (z.p - a.p) / 6) * (p - a.p) END AS close
FROM (SELECT x.symbol, x.date, x.load_seq, x.close, x.p,
             last_value(CASE WHEN b.p IS NOT NULL THEN {'p': b.p, 'v': b.v, 'm': b.m} END IGNORE NULLS) OVER (
               PARTITION BY x.symbol ORDER BY x.p) AS a,
             first_value(CASE WHEN b.p IS NOT NULL THEN {'p': b.p, 'v': b.v, 'm': b.m} END IGNORE NULLS) OVER (
               PARTITION BY x.symbol ORDER BY x.p ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS z
      FROM (SELECT *, CAST(row_number() OVER (PARTITION BY symbol ORDER BY date, load_seq) AS DOUBLE) AS p FROM vendor_a) x
      LEFT JOIN bent b USING (symbol, p))"""


@query("interp_spline", _SPLINE, ("vendor_a",), doubles="close",
       extra=[("knots", _KNOTS), ("equations", _ROWS_OF), ("walked", _WALKED), ("bent", _BENT)])
def interp_spline(spark, sf_dir):
    """Gaps in the close from one cubic spline through all of a symbol's closes."""
    bars = fx.vendor_a(spark, sf_dir).select("symbol", "date", "load_seq", "close")
    return C.fill_spline(bars, ("close",), ["symbol"], ["date", "load_seq"])
