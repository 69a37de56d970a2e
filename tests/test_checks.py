"""Validation: the reference's validator frames, ticks and summary properties."""

import datetime as dt

from pyspark.sql import functions as F

from barworks.operators import checks as V
from barworks.operators import ticks as T

D0 = dt.date(2023, 1, 1)


def _bars(spark, rows):
    data = [("AAPL", "yahoo_finance", D0 + dt.timedelta(days=i), *[None if v is None else float(v) for v in r], i)
            for i, r in enumerate(rows)]
    return spark.createDataFrame(data, "symbol string, source string, date date, open double, "
                                       "high double, low double, close double, volume double, "
                                       "load_seq long")


VALID = [(100, 105, 95, 102, 1000), (101, 106, 96, 103, 2000), (102, 107, 97, 104, 3000),
         (103, 108, 98, 105, 4000), (104, 109, 99, 106, 5000)]


def _issue_types(df):
    return sorted(r["issue_type"] for r in V.issues_of(V.validate_bars(df)).collect())


def test_valid_frame(spark):
    s = V.summarize(V.validate_bars(_bars(spark, VALID))).first()
    assert s["is_valid"] and s["total_issues"] == 0 and s["data_rows"] == 5


def test_high_below_low(spark):
    rows = list(VALID)
    rows[2] = (102, 90, 95, 104, 3000)
    t = _issue_types(_bars(spark, rows))
    assert "high_less_than_open" in t and "high_less_than_close" in t
    assert "low_greater_than_open" not in t


def test_missing_close(spark):
    rows = list(VALID)
    rows[3] = (103, 108, 98, None, 4000)
    iss = V.issues_of(V.validate_bars(_bars(spark, rows))).filter("issue_type = 'missing_price_data'")
    r = iss.first()
    assert r["column"] == "close" and r["affected_rows"] == 1 and r["severity"] == "error"  # 20% > 10%


def test_empty_universe_symbol(spark):
    u = spark.createDataFrame([("AAPL",), ("EMPTY",)], "symbol string")
    out = V.empty_symbols(u, _bars(spark, VALID)).collect()
    assert [(r["symbol"], r["severity"]) for r in out] == [("EMPTY", "critical")]


def test_issue_counts_sum_to_summary(spark):
    from barworks.sources import fixtures as fx
    v = V.validate_bars(fx.bars_dirty(spark, "/root/testdata/sf0.001"))
    n_issues = V.issues_of(v).count()
    n_summary = V.summarize(v).agg(F.sum("total_issues")).first()[0]
    assert n_issues == n_summary


def test_daily_change_edge_cases(spark):
    rows = [(1, 1, 1, 0, 1), (1, 1, 1, 0, 1), (1, 1, 1, 5, 1), (1, 1, 1, 5.5, 1)]
    iss = V.issues_of(V.validate_bars(_bars(spark, rows), V.price_checks()))
    r = iss.filter("issue_type = 'extreme_daily_change'").first()
    assert r["affected_rows"] == 1  # 0 -> 0 is NaN (not counted), 0 -> 5 is +inf, 5 -> 5.5 is 10%


def test_tick_checks(spark):
    rows = [
        ("A", dt.datetime(2024, 1, 3, 10, 0), 1, 100.0, (100.0, 99.0, 98.0, 101.0), 10.0, "normal", 100.0),
        ("A", dt.datetime(2024, 1, 6, 10, 0), 2, 100.0, (100.0, 102.0, 98.0, 101.0), 10.0, "index", 90.0),
        ("A", dt.datetime(2024, 1, 3, 20, 0), 3, 100.0, (100.0, 102.0, 98.0, 101.0), -1.0, "normal", None),
    ]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, last_price double, "
                                     "ohlc struct<open:double,high:double,low:double,close:double>, "
                                     "volume double, category string, previous_close double")
    res = T.tick_results(df, F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz"))
    iss = {(r["event_id"], r["check"], r["field"]) for r in T.tick_issues(res).collect()}
    assert (1, "ohlc", "high") in iss                  # high < max(open, close)
    assert (2, "circuit_breaker", "circuit_breaker") in iss and (2, "market_hours", "market_hours") in iss
    assert (3, "volume", "volume") in iss and (3, "market_hours", "market_hours") in iss
    summ = {r["event_id"]: r for r in T.tick_summary(res).collect()}
    assert summ[2]["critical_count"] == 1 and not summ[2]["is_valid"]   # valid result but critical
    assert summ[3]["failed"] == 1 and not summ[3]["is_valid"]


def test_missing_column_stops_the_pass(spark):
    """Later findings don't count once a column is missing; hours and cross-source ones do otherwise."""
    from barworks.operators import checks as V
    import datetime as dt
    rows = [("A", "x", dt.date(2024, 1, d), -1.0, 2.0, 1.0, None, 5.0, d) for d in range(1, 4)]
    rows += [("B", "x", dt.date(2024, 1, d), 1.0, 2.0, 1.0, 1.5, 5.0, d) for d in range(1, 4)]
    bars = spark.createDataFrame(rows, "symbol string, source string, date date, open double, high double, low double, "
                                       "close double, volume double, load_seq long")
    more = spark.createDataFrame([("A", "weekend_data", "info"), ("B", "weekend_data", "info"),
                                  ("B", "no_common_dates", "error")], "symbol string, issue_type string, severity string")
    got = {r["symbol"]: r for r in V.grade(V.summarize(V.with_further_issues(V.validate_bars(bars), more))).collect()}
    assert got["A"]["critical_issues"] == 1 and got["A"]["total_issues"] == 1 and got["A"]["quality"] == "unusable"
    assert got["B"]["info_issues"] == 1 and got["B"]["error_issues"] == 1 and got["B"]["quality"] == "fair"


def test_each_price_that_is_not_positive_is_reported(spark):
    """T4 gives one result per price with its own field; T12 lists the messages in order."""
    rows = [("A", dt.datetime(2024, 1, 3, 10, 0), 1, 1.0, (-1.0, 0.0, -2.0, 5.0), 10.0, "normal", None),
            (None, None, 2, 1.0, (1.0, 2.0, 0.5, 1.5), -5.0, "index", 1.0),
            ("B", dt.datetime(2024, 1, 3, 10, 0), 3, 1.0, (1.0, 2.0, 0.5, 1.5), 10.0, "normal", None)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp_ntz, event_id long, last_price double, "
                                     "ohlc struct<open:double,high:double,low:double,close:double>, "
                                     "volume double, category string, previous_close double")
    as_of = F.lit(dt.datetime(2024, 1, 10)).cast("timestamp_ntz")
    found = [(r["check"], r["field"]) for r in T.tick_issues(T.tick_results(df, as_of)).filter("event_id = 1").collect()]
    assert found == [("ohlc", "high"), ("ohlc", "open"), ("ohlc", "high"), ("ohlc", "low"), ("price_range", "price_range")]
    got = {r["event_id"]: r for r in T.quote_summary(df, as_of).collect()}
    assert got[1]["errors"] == ["High price below open or close", "Non-positive price for open",
                                "Non-positive price for high", "Non-positive price for low", "Extremely low price"]
    assert got[1]["failed"] == 5 and got[1]["critical_issues"] == []
    assert got[2]["errors"] == ["Missing required field: symbol", "Missing required field: timestamp", "Negative volume"]
    assert got[2]["critical_issues"] == ["Circuit breaker limit reached"]
    assert got[3]["total_checks"] == 0 and got[3]["is_valid"] and got[3]["success_rate"] == 0.0
    counts = ["event_id", "total_checks", "passed", "failed", "error_count", "critical_count", "success_rate", "is_valid"]
    old = T.tick_summary(T.tick_results(df, as_of))
    assert sorted(map(tuple, old.select(counts).collect())) == sorted(tuple(r[c] for c in counts) for r in got.values())


def test_missing_price_column_ends_the_price_checks(spark):
    rows = [("A", "x", dt.date(2024, 1, d), None, 1.0, 2.0, -1.0, 5.0, d) for d in range(1, 4)]
    bars = spark.createDataFrame(rows, "symbol string, source string, date date, open double, high double, low double, "
                                       "close double, volume double, load_seq long")
    kinds = [r["issue_type"] for r in V.issues_of(V.validate_bars(bars, V.price_checks())).collect()]
    assert kinds == ["missing_price_columns"]
    kinds = [r["issue_type"] for r in V.issues_of(V.validate_bars(bars)).collect()]
    assert kinds == ["missing_columns"]           # the structure checks end the validation before
    dateless = bars.withColumn("open", F.lit(1.0)).withColumn("date", F.lit(None).cast("date"))
    kinds = {r["issue_type"] for r in V.issues_of(V.validate_bars(dateless)).collect()}
    assert {"missing_date", "negative_prices"} <= kinds and "missing_columns" not in kinds


def test_further_issues_of_one_source_charge_that_source(spark):
    rows = [(s, src, dt.date(2024, 1, d), 1.0, 2.0, 1.0, 1.5, 5.0, d) for s in "A" for src in ("x", "y") for d in range(1, 4)]
    bars = spark.createDataFrame(rows, "symbol string, source string, date date, open double, high double, low double, "
                                       "close double, volume double, load_seq long")
    hours = spark.createDataFrame([("A", "x", "outside_market_hours", "warning")],
                                  "symbol string, source string, issue_type string, severity string")
    got = {r["source"]: r["warning_issues"] for r in V.summarize(V.with_further_issues(V.validate_bars(bars), hours)).collect()}
    assert got == {"x": 1, "y": 0}
