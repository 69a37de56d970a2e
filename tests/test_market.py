"""Adjustment, sessions and the ledger against plain loops and hand-made cases."""

import datetime as dt
import random
from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from barworks.functions.recurrence import running
from barworks.operators import adjust as A
from barworks.operators import ledger as L
from barworks.operators import sessions as S

D = dt.date


def day(n):
    return D(2024, 1, 1) + dt.timedelta(days=n)


BARS = "symbol string, date date, open double, high double, low double, close double, volume double"
ACTIONS = "symbol string, ex_date date, kind string, value double"


def test_adjustment_by_hand(spark):
    bars = spark.createDataFrame([("A", day(n), 10.0, 12.0, 8.0, 10.0 + n, 100.0) for n in (0, 1, 4, 5)]
                                 + [("B", day(0), 1.0, 1.0, 1.0, 1.0, 1.0), ("A", None, 1.0, 1.0, 1.0, 1.0, 1.0)], BARS)
    actions = spark.createDataFrame([
        ("A", day(3), "split", 2.0), ("A", day(3), "dividend", 1.1),      # no bar that day; close before: 11
        ("A", day(5), "split", 5.0),                                       # on a bar: it is not adjusted
        ("A", day(9), "dividend", 3.0),                                    # after the last bar: close before 15
        ("A", day(0), "dividend", 1.0),                                    # nothing before it
        ("A", None, "split", 7.0), (None, day(2), "split", 7.0), ("A", day(2), "merger", 7.0),
        ("A", day(2), "split", None), ("A", day(2), "split", 0.0), ("A", day(2), "dividend", -1.0),
        ("Z", day(2), "split", 3.0)], ACTIONS)
    got = {(r["symbol"], r["date"]): r for r in A.adjusted(bars, actions).collect()}
    assert len(got) == 6
    later = 1 - 3.0 / 15
    for n, price, split in ((0, 0.9 / 2 / 5 * later, 0.1), (1, 0.9 / 2 / 5 * later, 0.1), (4, later / 5, 0.2), (5, later, 1.0)):
        r = got["A", day(n)]
        assert r["price_factor"] == pytest.approx(price) and r["split_factor"] == pytest.approx(split)
        assert r["close"] == pytest.approx((10 + n) * price) and r["volume"] == pytest.approx(100 / split)
    for k in (("B", day(0)), ("A", None)):
        assert (got[k]["price_factor"], got[k]["split_factor"], got[k]["close"]) == (1.0, 1.0, 1.0)
    factors = {(r["symbol"], r["ex_date"]): r for r in A.adjustment_factors(bars, actions).collect()}
    assert set(factors) == {("A", day(3)), ("A", day(5)), ("A", day(9)), ("A", day(0)), ("Z", day(2))}
    assert factors["A", day(0)]["price_factor"] == 1.0 and factors["A", day(3)]["close_before"] == 11.0
    none = A.adjusted(bars, actions.limit(0)).collect()
    assert {r["price_factor"] for r in none} == {1.0}


@pytest.mark.parametrize("bucket", [None, "week", "year"])
def test_adjustment_against_loops(spark, bucket):
    rnd = random.Random(2)
    bars = [(s, day(n), 1.0, 1.0, 1.0, None if rnd.random() < 0.1 else rnd.uniform(5, 50), 10.0)
            for s in "ABC" for n in range(200) if rnd.random() < 0.7]
    actions = [(rnd.choice("ABC"), day(rnd.randint(-5, 205)), rnd.choice(["split", "dividend"]), rnd.choice([0.5, 2.0, 1.5]))
               for _ in range(60)]
    want = {}
    for s in "ABC":
        mine = sorted(b for b in bars if b[0] == s)
        factor = defaultdict(lambda: 1.0)
        for d in {a[1] for a in actions if a[0] == s}:
            before = [b[5] for b in mine if b[1] < d and b[5] is not None]
            paid = sum(a[3] for a in actions if a[:3] == (s, d, "dividend"))
            if paid and before and paid < before[-1]:
                factor[d] *= 1 - paid / before[-1]
            for a in actions:
                if a[:3] == (s, d, "split"):
                    factor[d] /= a[3]
        for b in mine:
            p = 1.0
            for d, f in factor.items():
                p *= f if d > b[1] else 1.0
            want[s, b[1]] = p
    got = A.adjusted(spark.createDataFrame(bars, BARS), spark.createDataFrame(actions, ACTIONS),
                     None if bucket is None else F.date_trunc(bucket, "date"))
    got = {(r["symbol"], r["date"]): r["price_factor"] for r in got.collect()}
    assert got == pytest.approx(want)


def test_sessions(spark):
    """Of two absences of the same length in days the one over a holiday is not reported."""
    # 2024-01-01 is a Monday; Friday the 5th and Monday the 8th are holidays
    holidays = spark.createDataFrame([(D(2024, 1, 5),), (D(2024, 1, 8),), (D(2024, 1, 8),), (None,)], "date date")
    rows = [("A", d) for d in (3, 4, 9, 10)] + [("B", d) for d in (9, 10, 15, 16)] + [("C", d) for d in (1, 6, 8, 31, 31)]
    bars = spark.createDataFrame([(s, D(2024, 1, d)) for s, d in rows] + [("D", None)], "symbol string, date date")
    calendar = S.session_calendar(S.bounds_of(bars), holidays)
    assert [r["date"].day for r in calendar.orderBy("session").limit(5).collect()] == [1, 2, 3, 4, 9]
    got = {r["symbol"]: tuple(r)[1:] for r in S.session_gaps(bars, calendar).collect()}
    assert got == {"B": (1, 2, 2), "C": (1, 19, 19)}  # B lacks the 11th and 12th; A lacks nothing
    assert {r["symbol"] for r in S.session_gaps(bars, calendar, most=2).collect()} == {"C"}
    recent = S.session_gaps(bars, calendar, F.lit(D(2024, 1, 20)), 6)
    assert recent.collect() == []
    off = {r["symbol"]: (r["weekend_rows"], r["holiday_rows"]) for r in S.off_session_rows(bars, calendar).collect()}
    assert off == {"C": (1, 1)}
    cover = {r["symbol"]: tuple(r)[1:3] for r in S.session_coverage(bars, calendar).collect()}
    assert cover == {"A": (4, 4), "B": (4, 6), "C": (2, 21)}
    assert S.session_calendar(S.bounds_of(bars.limit(0)), holidays).collect() == []


def test_running_sums_and_products(spark):
    rnd = random.Random(3)
    rows = [(rnd.choice("AB"), n, rnd.choice([None, rnd.uniform(0.5, 1.5)])) for n in range(300)]
    df = spark.createDataFrame(rows, "k string, t long, v double")
    for backward in (False, True):
        got = running(df, ["k"], ["t"], {"s": F.col("v")}, {"p": F.col("v")}, backward, F.floor(F.col("t") / 16))
        got = {r["t"]: (r["s"], r["p"]) for r in got.collect()}
        state = {"A": (0.0, 1.0), "B": (0.0, 1.0)}
        for k, t, v in (reversed(rows) if backward else rows):
            if v is not None:
                state[k] = state[k][0] + v, state[k][1] * v
            assert got[t] == pytest.approx(state[k])


def test_daily_performance_by_hand(spark):
    ts = dt.datetime
    signals = spark.createDataFrame([(1, ts(2024, 1, 1, 9), "BUY"), (2, ts(2024, 1, 1, 23), "SELL"), (3, ts(2024, 1, 2, 9), "HOLD"),
                                     (4, ts(2024, 2, 3, 9), "BUY")], "signal_id long, timestamp timestamp_ntz, action string")
    paper = spark.createDataFrame([(1, 10.0), (1, -4.0), (2, 6.0), (3, -1.0), (9, 5.0), (4, None)], "signal_id long, pnl double")
    manual = spark.createDataFrame([(2, 2.0)], "signal_id long, pnl double")
    got = {r["date"]: r.asDict() for r in L.daily_performance(signals, paper, manual).collect()}
    a, b, c = got[D(2024, 1, 1)], got[D(2024, 1, 2)], got[D(2024, 2, 3)]
    assert (a["total_signals"], a["manual_trades_suggested"], a["paper_trades_executed"], a["manual_trades_executed"]) == (2, 2, 3, 1)
    assert (a["paper_total_pnl"], a["paper_avg_win"], a["paper_avg_loss"], a["paper_profit_factor"]) == (12.0, 8.0, -4.0, 4.0)
    assert a["paper_win_rate"] == pytest.approx(200 / 3) and a["paper_portfolio_value"] == 100012.0
    assert (b["paper_profit_factor"], b["paper_avg_win"], b["manual_win_rate"], b["paper_portfolio_value"]) == (0.0, None, None, 100011.0)
    assert (c["paper_trades_executed"], c["paper_total_pnl"], c["paper_profit_factor"], c["manual_portfolio_value"]) == (
        1, 0.0, None, 100002.0)


@pytest.mark.parametrize("bucket", [None, "week"])
def test_ledger_against_a_loop(spark, bucket):
    rnd = random.Random(4)
    trades = [(rnd.choice([1, 2]), rnd.choice("XYZ"), day(rnd.randint(0, 80)), rnd.choice(["BUY", "SELL", "BUY", "HOLD"]),
               Decimal(rnd.randint(1, 9)), Decimal(rnd.randint(100, 900)) / 100, rnd.choice([None, Decimal("0.25")]))
              for _ in range(120)]
    prices = [(s, day(n), Decimal(rnd.randint(100, 900)) / 100) for s in "XYZW" for n in range(0, 90, 7)]
    got = L.portfolio_snapshots(
        spark.createDataFrame(trades, "portfolio_id long, symbol string, date date, side string, quantity decimal(10,0), "
                                      "price decimal(10,2), fees decimal(10,2)"),
        spark.createDataFrame(prices, "symbol string, date date, price decimal(10,2)"),
        bucket=None if bucket is None else F.date_trunc(bucket, "date")).collect()
    real = [t for t in trades if t[3] != "HOLD"]
    seen = 0
    for pid in (1, 2):
        mine = [t for t in real if t[0] == pid]
        since = {}
        for t in mine:
            since[t[1]] = min(t[2], since.get(t[1], t[2]))
        days = sorted({t[2] for t in mine} | {p[1] for p in prices if p[0] in since and p[1] >= since[p[0]]})
        before = Decimal(L.INITIAL_CAPITAL)
        for d in days:
            past = [t for t in mine if t[2] <= d]
            sign = {"BUY": 1, "SELL": -1}
            cash = L.INITIAL_CAPITAL + sum(-sign[t[3]] * t[4] * t[5] - (t[6] or 0) for t in past)
            value, active = Decimal(0), 0
            for s in {t[1] for t in past}:
                q = sum(sign[t[3]] * t[4] for t in past if t[1] == s)
                marks = [p[2] for p in sorted(prices) if p[0] == s and since[s] <= p[1] <= d]
                last = max(t[2] for t in past if t[1] == s)
                mark = marks[-1] if marks else max(t[5] for t in past if t[1] == s and t[2] == last)
                value += q * mark
                active += q != 0
            row = next(r for r in got if r["portfolio_id"] == pid and r["date"] == d)
            assert (row["cash_value"], row["positions_value"], row["active_positions"]) == (float(cash), float(value), active)
            assert row["total_value"] == float(cash + value) and row["day_pnl"] == float(cash + value - before)
            before = cash + value
            seen += 1
    assert seen == len(got)


def test_ingestion_log_equals_one_pass(spark, tmp_dir):
    """After each run, and after a repeated one, the score is that of all rows so far."""
    import os
    from barworks.operators import ingestion as G
    from barworks.operators import quality as Q
    rnd = random.Random(6)
    rows = [(f"S{rnd.randint(0, 9)}", day(n), *[rnd.choice([None, 1.0, 2.0, 3.0]) for _ in range(4)], rnd.choice([0.0, 5.0, None, 9.0]))
            for n in range(12)]
    df = spark.createDataFrame(rows, "symbol string, date date, open double, high double, low double, close double, volume double")
    path = os.path.join(tmp_dir, "log")
    parts = [df.filter(F.dayofmonth("date") % 3 == k) for k in range(3)] + [df.limit(0)]
    for run, part in enumerate(parts):
        G.log_run(part, path, run, F.lit("2024-01-02 03:04:05"), "x")
    G.log_run(parts[1], path, 1, F.lit("2024-01-02 03:04:05"), "x")
    log = {r["run"]: r for r in G.ingestion_log(spark, path).collect()}
    assert sorted(log) == [0, 1, 2, 3] and log[3]["records_count"] == 0 and log[3]["run_score"] == 0.0
    for run in range(4):
        whole = df.limit(0)
        for p in parts[:run + 1]:
            whole = whole.unionByName(p)
        want = Q.quality_score(whole).first()
        assert log[run]["quality_score"] == pytest.approx(want["quality_score"])
        assert log[run]["total_symbols"] == want["total_symbols"]
    assert sum(r["records_count"] for r in log.values()) == 12


def test_ledger_moves_the_positions_rows_once(spark):
    """Nothing is written to learn a position's row before, and its rows are in one shuffle at most."""
    trades = spark.createDataFrame([(1, "X", day(0), "BUY", Decimal(2), Decimal("5.00"), Decimal("0.25"))],
                                   "portfolio_id long, symbol string, date date, side string, quantity decimal(10,0), "
                                   "price decimal(10,2), fees decimal(10,2)")
    prices = spark.createDataFrame([("X", day(n), Decimal(n)) for n in range(1, 4)],
                                   "symbol string, date date, price decimal(10,2)")
    out = L.portfolio_snapshots(trades, prices)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    after_join = plan.split("Join ")[0]  # the plan's root comes first
    assert after_join.count("RepartitionByExpression") == 1
    assert [(r["day_pnl"], r["active_positions"]) for r in out.orderBy("date").collect()] == [
        (-0.25, 1), (-8.0, 1), (2.0, 1), (2.0, 1)]


def test_ledger_of_unknown_days_and_prices(spark):
    """Shares that moved on an unknown day are held later; a position without any price has no value."""
    trades = spark.createDataFrame(
        [(1, "X", None, "BUY", Decimal(3), Decimal(1), None), (1, "X", day(1), "BUY", Decimal(2), Decimal(5), None),
         (1, "Y", day(1), "BUY", Decimal(1), None, None), (None, "X", day(1), "BUY", Decimal(1), Decimal(1), None)],
        "portfolio_id long, symbol string, date date, side string, quantity decimal(10,0), price decimal(10,2), fees decimal(10,2)")
    prices = spark.createDataFrame([("X", day(0), Decimal(9)), ("X", day(2), None), ("X", day(3), Decimal(6))],
                                   "symbol string, date date, price decimal(10,2)")
    for bucket in (None, F.date_trunc("week", "date")):
        got = L.portfolio_snapshots(trades, prices, bucket=bucket).orderBy("date").collect()
        assert [(r["portfolio_id"], r["date"], r["positions_value"], r["cash_value"], r["active_positions"]) for r in got] == [
            (1, day(1), 25.0, 99990.0, 2), (1, day(2), 25.0, 99990.0, 2), (1, day(3), 30.0, 99990.0, 2)]


def test_ledger_moves_prices_instead_of_the_positions_rows(spark):
    """The rows of 40 portfolios' positions on 50 days are made and added up where they are: no shuffle has them."""
    trades = spark.createDataFrame([(p, "X", day(0), "BUY", Decimal(p), Decimal("5.00"), None) for p in range(1, 41)],
                                   "portfolio_id long, symbol string, date date, side string, quantity decimal(10,0), "
                                   "price decimal(10,2), fees decimal(10,2)")
    prices = spark.createDataFrame([("X", day(n), Decimal(n)) for n in range(1, 51)], "symbol string, date date, price decimal(10,2)")
    out = L.portfolio_snapshots(trades, prices)
    plan = out._jdf.queryExecution().executedPlan().toString()
    above, below = plan.split("Generate explode(sequence(")
    assert "Exchange" not in above and "Exchange" in below
    got = {(r["portfolio_id"], r["date"]): r["positions_value"] for r in out.collect()}
    assert got == {(p, day(n)): float(p * (n or 5)) for p in range(1, 41) for n in range(51)}


@pytest.mark.parametrize("bucket", [None, "week"])
def test_ledger_of_named_portfolios_and_prices_of_any_size(spark, bucket):
    """Ids need not be numbers; prices travel whole, whatever their size and sign."""
    held = [Decimal(x) for x in ("0.0001", "-0.0001", "214748.3647", "214748.3648", "-214748.3649", "98765432109876.5432", "0")]
    trades = spark.createDataFrame(
        [("b", "X", day(2), "BUY", Decimal(1), Decimal(7), None), ("a", "X", day(4), "SELL", Decimal(3), Decimal(7), None),
         ("a", "X", day(0), "BUY", Decimal(2), Decimal(7), None), ("a", "Y", day(1), "BUY", Decimal(1), Decimal(2), None)],
        "portfolio_id string, symbol string, date date, side string, quantity decimal(10,0), price decimal(10,2), fees decimal(10,2)")
    prices = spark.createDataFrame([("X", day(n), x) for n, x in enumerate(held)], "symbol string, date date, price decimal(28,4)")
    got = {(r["portfolio_id"], r["date"]): (r["positions_value"], r["active_positions"]) for r in L.portfolio_snapshots(
        trades, prices, bucket=None if bucket is None else F.date_trunc(bucket, "date")).collect()}
    want = {("a", day(n)): (float((2 if n < 4 else -1) * x + (2 if n else 0)), 1 + (n > 0)) for n, x in enumerate(held)}
    assert got == want | {("b", day(n)): (float(x), 1) for n, x in enumerate(held) if n > 1}


def test_ranges_hold_like_numbers_of_trades(spark, monkeypatch):
    """Ranges lie one after the other; a portfolio with most of the trades is not cut."""
    monkeypatch.setattr(L, "RANGE_TRADES", 10)
    df = spark.createDataFrame([(p,) for p in range(100)] + [(50,)] * 100, "portfolio_id long")
    part, n = L.ranges_of(df)
    found = df.groupBy(part.alias("part")).agg(F.count("*").alias("n"), F.min("portfolio_id").alias("a"),
                                               F.max("portfolio_id").alias("b")).orderBy("part").collect()
    assert [r["part"] for r in found] == list(range(n)) and max(r["n"] for r in found if not r["a"] <= 50 <= r["b"]) <= 12
    assert all(x["b"] < y["a"] for x, y in zip(found, found[1:])) and sum(r["n"] for r in found) == 200
    assert L.ranges_of(df.limit(0))[0] is not None
