"""Shaping, sinks, upsert / delete on Parquet tables, universe files."""

import datetime as dt
import json
import os
import re

from pyspark.sql import functions as F

from barworks.operators import shape as P
from barworks.sources import io as S


def test_standardize_names_and_suffix(spark):
    df = spark.createDataFrame([("RELIANCE.NS", "2024-01-02", 1.0, 2.0)],
                               "Ticker string, Date string, `Adj Close` double, `('Close', 'X')` double")
    out = P.standardize(df)
    assert out.columns == ["symbol", "date", "adj_close", "close"]
    r = out.first()
    assert r["symbol"] == "RELIANCE" and r["date"] == dt.date(2024, 1, 2)


def test_unpivot_wide(spark):
    df = spark.createDataFrame([("2024-01-02", 1.0, 2.0, 3.0)], "Date string, Open_A double, Open_B double, Close_A double")
    rows = {(r["ticker"], r["Open"], r["Close"]) for r in P.unpivot_wide(df).collect()}
    assert rows == {("A", 1.0, 3.0), ("B", 2.0, None)}


def test_month_ranges_strict_and_inclusive(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 15), dt.date(2024, 3, 1))], "start_date date, end_date date")
    inc = [(r["range_start"], r["range_end"]) for r in P.month_ranges(df).orderBy("range_start").collect()]
    assert inc == [(dt.date(2024, 1, 15), dt.date(2024, 1, 31)), (dt.date(2024, 2, 1), dt.date(2024, 2, 29)),
                   (dt.date(2024, 3, 1), dt.date(2024, 3, 1))]
    strict = P.month_ranges(df, strict_reference=True).count()
    assert strict == 2  # the reference loses an end on the 1st


def test_session_labels(spark):
    ts = [dt.datetime(2024, 1, 3, 9, 15), dt.datetime(2024, 1, 3, 15, 30, 0, 500000),
          dt.datetime(2024, 1, 3, 9, 5), dt.datetime(2024, 1, 3, 15, 45), dt.datetime(2024, 1, 6, 10)]
    df = spark.createDataFrame([(t,) for t in ts], "ts timestamp_ntz")
    got = [r[0] for r in df.select(P.session_label("ts")).collect()]
    assert got == ["regular", "closed", "pre_market", "post_market", "weekend"]


def test_source_names(spark):
    df = spark.createDataFrame([("Yahoo",), ("KITE",), ("nse",), ("other",)], "source string")
    assert [r[0] for r in df.select(P.normalise_source()).collect()] == \
        ["yahoo_finance", "kiteconnect", "nse_official", "unknown"]


def _bars(spark, rows):
    return spark.createDataFrame(rows, "symbol string, date date, close double, load_seq long")


def test_write_upsert_delete_expire(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bars")
    d1, d2, d3 = dt.date(2024, 1, 1), dt.date(2024, 1, 2), dt.date(2024, 1, 3)
    S.write_table(_bars(spark, [("A", d1, 1.0, 1), ("B", d1, 2.0, 2), ("A", d2, 3.0, 3)]), path, "WRITE_APPEND")
    S.upsert(spark, path, _bars(spark, [("A", d2, 30.0, 9), ("A", d3, 4.0, 10)]), ["symbol", "date"])
    got = {(r["symbol"], r["date"]): r["close"] for r in spark.read.parquet(path).collect()}
    assert got == {("A", d1): 1.0, ("B", d1): 2.0, ("A", d2): 30.0, ("A", d3): 4.0}
    S.delete_where(spark, path, (F.col("symbol") == "A") & (F.col("date") == F.lit(d3)))
    S.delete_where(spark, path, F.col("symbol") == "B")
    got = {(r["symbol"], r["date"]) for r in spark.read.parquet(path).collect()}
    assert got == {("A", d1), ("A", d2)}
    assert S.expire_partitions(spark, path, "2024-01-02") == [d1]
    assert {r["date"] for r in spark.read.parquet(path).collect()} == {d2}


def test_write_empty_disposition(spark, tmp_dir):
    path = os.path.join(tmp_dir, "t")
    df = _bars(spark, [("A", dt.date(2024, 1, 1), 1.0, 1)])
    S.write_table(df, path, "WRITE_EMPTY")
    try:
        S.write_table(df, path, "WRITE_EMPTY")
        raise AssertionError("second WRITE_EMPTY must fail")
    except ValueError:
        pass


def test_universe_files(spark, tmp_dir):
    shapes = {
        "sectors.json": {"sectors": {"IT": ["TCS", "INFY"], "BANK": ["HDFC", "TCS"]}},
        "universe.json": {"universe": [{"symbol": "TCS", "name": "x"}, "INFY"]},
        "symbols.json": {"symbols": ["A", "A", "B"]},
        "tickers.json": {"tickers": ["T1"]},
    }
    paths = {}
    for name, body in shapes.items():
        paths[name] = os.path.join(tmp_dir, name)
        with open(paths[name], "w") as f:
            json.dump(body, f, indent=2)
    s = lambda p, how: sorted(r[0] for r in S.universe_symbols(spark, p, how).collect())
    assert s(paths["sectors.json"], "sectors") == ["HDFC", "INFY", "TCS"]
    assert s(paths["universe.json"], "sectors") == ["INFY", "TCS"]
    assert s(paths["symbols.json"], "sectors") == ["A", "B"]
    assert s(paths["symbols.json"], "symbols") == ["A", "A", "B"]
    assert s(paths["sectors.json"], "symbols") == ["HDFC", "INFY", "TCS", "TCS"]
    assert s(paths["tickers.json"], "symbols") == ["T1"]


def test_seed_bars(spark):
    b = S.seed_bars(spark, ["X", "Y", "Z"], hours=10)
    assert b.count() == 30
    r = b.filter("symbol = 'Y'").orderBy("timestamp").first()
    assert (r["open"], r["high"], r["low"], r["close"], r["volume"]) == (110, 115, 105, 112, 1000)


def test_read_range_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bars_pq")
    rows = [("A", dt.date(2024, 1, d), float(d), d) for d in range(1, 11)]
    S.write_table(_bars(spark, rows), path, "overwrite")
    df = S.read_bars(spark, path, start="2024-01-03", end="2024-01-05", symbol="A")
    assert sorted(r["date"].day for r in df.collect()) == [3, 4, 5]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "PushedFilters: [IsNotNull(symbol), EqualTo(symbol,A)]" in plan


def test_appends_stamp_and_ensure(spark, tmp_dir):
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("signal_id", T.LongType()), T.StructField("date", T.DateType()),
                           T.StructField("confidence", T.DoubleType()),
                           T.StructField("created_at", T.TimestampNTZType())])
    path = os.path.join(tmp_dir, "signals")
    S.ensure_table(spark, path, schema)
    S.ensure_table(spark, path, schema)                      # second call is a no-op
    src = spark.createDataFrame([(1, dt.date(2024, 1, 2), "0.5")], "signal_id long, date date, confidence string")
    stamp = F.lit("2024-01-02 10:00:00").cast("timestamp_ntz")
    S.append_table(src, path, schema, stamp)
    r = spark.read.parquet(path).first()
    assert r["confidence"] == 0.5 and r["created_at"] == dt.datetime(2024, 1, 2, 10)


def test_daily_append_and_backup(spark, tmp_dir):
    raw = spark.createDataFrame([("A", "2024-01-02", "1.5", "2", "1", "1.8", "10"),
                                 ("A", "bad", "1", "1", "1", "1", "1"),
                                 ("B", "2024-01-02", "x", "2", "1", None, "3")],
                                "symbol string, date string, open string, high string, low string, "
                                "close string, volume string")
    path = os.path.join(tmp_dir, "daily")
    S.daily_append(raw, path, F.lit("2024-01-03 00:00:00").cast("timestamp_ntz"))
    got = spark.read.parquet(path).collect()
    assert [(r["symbol"], r["close"]) for r in got] == [("A", 1.8)]  # bad date and NULL close dropped
    bak = os.path.join(tmp_dir, "bak")
    S.backup_json(spark.read.parquet(path), bak)
    assert spark.read.json(bak).count() == 1


def test_upsert_backtest_defaults(spark, tmp_dir):
    path = os.path.join(tmp_dir, "bt")
    res = spark.createDataFrame([(7, None, 12.0), (8, 1, None)], "backtest_id long, trades long, win_rate double")
    t0 = F.lit("2024-01-02 10:00:00").cast("timestamp_ntz")
    S.upsert_backtest(spark, path, res, "paper", t0)
    first = {r["backtest_id"]: r for r in spark.read.parquet(path).collect()}
    assert first[7]["trades_count"] == 0 and first[8]["win_rate_pct"] == 0.0 and first[7]["metadata"] == "{}"
    res2 = spark.createDataFrame([(7, 5, 50.0)], "backtest_id long, trades long, win_rate double")
    S.upsert_backtest(spark, path, res2, "paper", F.lit("2024-01-03 11:00:00").cast("timestamp_ntz"))  # another day
    rows = {r["backtest_id"]: r for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 2 and rows[7]["trades_count"] == 5
    assert rows[7]["initial_capital"] == 100000.0 and rows[7]["total_return_pct"] == 0.0
    S.upsert_backtest(spark, path, res, "paper", F.lit("2024-01-04 11:00:00").cast("timestamp_ntz"))
    assert sorted((r["backtest_id"], r["date"].day) for r in spark.read.parquet(path).collect()) == [(7, 4), (8, 4)]


def test_null_partition_is_kept_and_rewritten(spark, tmp_dir):
    path = os.path.join(tmp_dir, "nulls")
    d1 = dt.date(2024, 1, 1)
    S.write_table(_bars(spark, [("A", None, 1.0, 1), ("B", None, 2.0, 2), ("A", d1, 3.0, 3)]), path)
    S.upsert(spark, path, _bars(spark, [("C", None, 4.0, 4), ("B", None, 20.0, 5)]), ["symbol", "date"])
    got = lambda: sorted((r["symbol"], str(r["date"]), r["close"]) for r in spark.read.parquet(path).collect())
    assert got() == [("A", "2024-01-01", 3.0), ("A", "None", 1.0), ("B", "None", 20.0), ("C", "None", 4.0)]
    S.delete_where(spark, path, F.col("symbol") == "A")
    assert got() == [("B", "None", 20.0), ("C", "None", 4.0)]
    S.delete_where(spark, path, F.col("close") > 10)
    S.delete_where(spark, path, F.col("symbol") == "C")
    assert not [n for n in os.listdir(path) if n.startswith("date=")]


def test_unreadable_table_is_not_empty(spark, tmp_dir):
    import pytest
    path = os.path.join(tmp_dir, "broken")
    os.makedirs(path)
    with open(os.path.join(path, "part-0.parquet"), "w") as f:
        f.write("not parquet")
    df = _bars(spark, [("A", dt.date(2024, 1, 1), 1.0, 1)])
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        S.write_table(df, path, "WRITE_EMPTY")
    with pytest.raises(Exception, match="(?i)parquet|footer|file"):
        S.upsert(spark, path, df, ["symbol", "date"])
    assert os.listdir(path) == ["part-0.parquet"]


def test_ensured_table_reads_empty(spark, tmp_dir):
    path = os.path.join(tmp_dir, "empty")
    S.ensure_table(spark, path, S.BARS_SCHEMA)
    assert S.read_table(spark, path, S.BARS_SCHEMA).count() == 0
    assert S.read_bars(spark, path, start="2024-01-01").count() == 0
    S.write_table(_bars(spark, [("A", dt.date(2024, 1, 1), 1.0, 1)]), path, "WRITE_EMPTY")
    assert S.read_table(spark, path, S.BARS_SCHEMA).first()["symbol"] == "A"


def test_checkpoint_dir_is_never_machine_local_on_a_cluster():
    import pytest
    from types import SimpleNamespace
    from barworks.session import checkpoint_dir
    session = SimpleNamespace(conf=SimpleNamespace(get=lambda k, d=None: d), sparkContext=SimpleNamespace(
        master="spark://host:7077", getCheckpointDir=lambda: None))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        checkpoint_dir(session)


def test_trading_universe(spark):
    a = spark.createDataFrame([("X",), ("Y",)], "symbol string")
    b = spark.createDataFrame([("Y",), ("Z",)], "symbol string")
    c = spark.createDataFrame([("Q",)], "symbol string")
    got = sorted(r[0] for r in S.trading_universe({"n50": a, "next50": b}, ["n50", "next50"], c).collect())
    assert got == ["Q", "X", "Y", "Z"]


def test_raw_type_issues(spark):
    from barworks.operators import ticks as T
    raw = spark.createDataFrame([("A", "12.5", "abc", "2024-01-02 10:00:00"), ("B", "x", "5", "not a time")],
                                "symbol string, last_price string, volume string, ts string")
    got = sorted((r["symbol"], r["field"]) for r in T.raw_type_issues(raw).collect())
    assert got == [("A", "volume"), ("B", "last_price"), ("B", "timestamp")]


def test_rename_and_custom_impute(spark):
    from barworks.operators import clean as C
    df = spark.createDataFrame([("A", 1.0, None)], "tradingsymbol string, average_price double, close double")
    r = P.rename_portfolio(df, {"tradingsymbol": "symbol", "average_price": "avg_price"})
    assert r.columns == ["symbol", "avg_price", "close"]
    filled = C.impute(r, "custom", custom=lambda c: F.coalesce(c, F.lit(-1.0)))
    assert filled.first()["close"] == -1.0
    assert C.impute(r, "custom").first()["close"] is None      # no function: unchanged


def test_read_csv_landing(spark, tmp_dir):
    path = os.path.join(tmp_dir, "landing_csv")
    rows = [("A", dt.date(2024, 1, d), 1.0, 2.0, 0.5, 1.5, 100.0, d, "csv") for d in range(1, 6)]
    spark.createDataFrame(rows, S.BARS_SCHEMA).write.option("header", "true").csv(path)
    df = S.read_bars(spark, path, fmt="csv", start="2024-01-02", end="2024-01-03")
    assert df.schema == S.BARS_SCHEMA or [f.name for f in df.schema] == [f.name for f in S.BARS_SCHEMA]
    assert sorted(r["date"].day for r in df.collect()) == [2, 3]


def test_staging_is_cleaned_up(spark, tmp_dir):
    from barworks.session import checkpoint_dir
    path = os.path.join(tmp_dir, "bars_stage")
    d1 = dt.date(2024, 1, 1)
    S.write_table(_bars(spark, [("A", d1, 1.0, 1)]), path)
    ck = checkpoint_dir(spark)
    before = {n for n in os.listdir(ck) if n.startswith("stage-")} if os.path.isdir(ck) else set()
    S.upsert(spark, path, _bars(spark, [("A", d1, 2.0, 5)]), ["symbol", "date"])
    S.delete_where(spark, path, F.col("symbol") == "Z")
    after = {n for n in os.listdir(ck) if n.startswith("stage-")}
    assert after == before


def test_catalogue_tables_take_rows(spark, tmp_dir):
    from barworks.sources import schemas as Sc
    for name in Sc.TABLES:
        path, schema = os.path.join(tmp_dir, name), Sc.schema(name)
        S.ensure_table(spark, path, schema)
        assert S.read_table(spark, path, schema).count() == 0
    path, schema = os.path.join(tmp_dir, "paper_trades"), Sc.schema("paper_trades")
    stamp = F.lit("2024-01-02 10:00:00").cast("timestamp")
    row = spark.createDataFrame([("t1", "s1", "A", "BUY", "3", 10.0)],
                                "trade_id string, signal_id string, symbol string, action string, quantity string, entry_price double")
    S.append_table(row.withColumn("date", F.to_date(stamp)), path, schema, stamp)
    got = S.read_table(spark, path, schema).first()
    assert got["quantity"] == 3 and got["created_at"] is not None and got["date"] == dt.date(2024, 1, 2)


def test_intraday_names_and_times(spark):
    df = spark.createDataFrame([("2024-01-02 09:15:00", 1.0), ("2024-01-02 09:16:00", 2.0), ("bad", 3.0)],
                               "Datetime string, `Close RELIANCE.NS` double")
    out = P.standardize(df, "RELIANCE.NS")
    assert out.columns[1] == "close"
    got = [r["date"] for r in out.orderBy("close").collect()]
    assert got == [dt.datetime(2024, 1, 2, 9, 15), dt.datetime(2024, 1, 2, 9, 16), None]


def test_daily_returns_of_real_symbols(spark):
    from barworks.operators import views as Vw
    rows = [("RELIANCE", dt.date(2024, 1, d), float(d), 1.0) for d in (1, 2, 3)]
    bars = spark.createDataFrame(rows, "symbol string, date date, close double, volume double")
    got = Vw.daily_returns(bars.withColumn("load_seq", F.lit(1)), F.lit("2024-01-03").cast("date")).collect()
    assert len(got) == 3 and all(r["sector"] is None for r in got)


def test_cross_source_fill_keeps_rows(spark):
    from barworks.operators import clean as C
    d = dt.date(2024, 1, 1)
    schema = "symbol string, date date, open double, high double, low double, close double, load_seq long"
    mine = spark.createDataFrame([("A", d, None, 2.0, 1.0, 1.5, 1)], schema)
    other = spark.createDataFrame([("A", d, 7.0, 2.0, 1.0, 1.5, 1), ("A", d, 9.0, 2.0, 1.0, 1.5, 2)], schema)
    got = C.cross_source_fill(mine, other).collect()
    assert len(got) == 1 and got[0]["open"] == 7.0


def test_clean_fills_every_column(spark):
    from barworks.operators import clean as C
    schema = "symbol string, date date, open double, high double, low double, close double, volume double, adj_close double, load_seq long"
    rows = [("A", dt.date(2024, 1, d), 1.0, 2.0, 0.5, 1.5, 10.0, v, d) for d, v in ((1, None), (2, 4.0), (3, None))]
    got = [r["adj_close"] for r in C.clean_bars(spark.createDataFrame(rows, schema)).orderBy("date").collect()]
    assert got == [4.0, 4.0, 4.0]


def test_tiered_fetch_tells_equal_source_names_apart(spark):
    from barworks.operators import reconcile as R
    schema = "symbol string, source string, date date, open double, high double, low double, close double, volume double, load_seq long"
    row = lambda c, q: [("A", "x", dt.date(2024, 1, d), c, c + 1, c - 1, c, 10.0, q + d) for d in range(1, 4)]
    a, b = spark.createDataFrame(row(10.0, 0), schema), spark.createDataFrame(row(20.0, 10), schema)
    for strategy, close in (("preferred", 10.0), ("best_quality", 10.0), ("redundant", 10.0), ("primary_only", 10.0),
                            ("secondary_only", 20.0)):
        got = R.tiered_fetch(a, b, strategy=strategy).collect()
        assert [r["close"] for r in got] == [close] * 3, strategy
    assert not any(r["imputed"] for r in R.tiered_fetch(a, b, impute_missing=False).collect())


def test_upsert_and_delete_on_text_partitions(spark, tmp_dir):
    """"001" stays a text, and a value that its folder escapes is found again."""
    path = os.path.join(tmp_dir, "t")
    schema = "segment string, k long, v string, load_seq long"
    S.write_table(spark.createDataFrame([("001", 1, "a", 1), ("1", 1, "b", 1), ("A:B", 2, "c", 1), ("x=y/%", 3, "d", 1),
                                         (None, 4, "e", 1)], schema), path, partition_by="segment", cluster_by=())
    S.upsert(spark, path, spark.createDataFrame([("001", 1, "a2", 2), ("A:B", 2, "c2", 2), (None, 4, "e2", 2)], schema),
             ["segment", "k"], partition_by="segment")

    def rows():
        return sorted(((r["segment"] or "", r["v"]) for r in S.stored(spark, path, "segment").collect()))
    assert rows() == [("", "e2"), ("001", "a2"), ("1", "b"), ("A:B", "c2"), ("x=y/%", "d")]
    S.delete_where(spark, path, F.col("segment").isin("A:B", "x=y/%"), "segment")
    assert rows() == [("", "e2"), ("001", "a2"), ("1", "b")]
    S.delete_where(spark, path, F.col("segment").isNull() | (F.col("segment") == "1"), "segment")
    assert rows() == [("001", "a2")]
    assert [n for n in os.listdir(path) if "=" in n] == ["segment=001"]


def test_stored_partition_types(spark, tmp_dir):
    from pyspark.sql import types as T
    for name, values, kind in [("d", ["2024-01-02"], T.DateType()), ("n", ["7", "-3"], T.LongType()),
                               ("t", ["7", "007"], T.StringType()), ("z", [None], T.StringType())]:
        path = os.path.join(tmp_dir, name)
        S.write_table(spark.createDataFrame([(v, 1) for v in values], "p string, n long"), path, partition_by="p", cluster_by=())
        assert S.stored(spark, path, "p").schema["p"].dataType == kind
        assert S.stored(spark, path, "p", T.StringType()).schema["p"].dataType == T.StringType()


def test_rewritten_partitions_are_not_met_in_a_task(spark, tmp_dir, monkeypatch):
    """The rows of a partition that is rewritten aren't shuffled by the partition's value."""
    path = os.path.join(tmp_dir, "t")
    rows = spark.range(1000).selectExpr("id AS backtest_id", "id % 2 = 0 AS success", "id / 7 AS total_return_pct")
    day = lambda d: F.lit(f"2024-01-0{d} 10:00:00").cast("timestamp_ntz")
    S.upsert_backtest(spark, path, rows, "paper", day(1))
    seen, rewrite = [], S._rewrite

    def looked_at(spark_, path_, kept, *rest):
        seen.append(kept._jdf.queryExecution().executedPlan().toString())
        rewrite(spark_, path_, kept, *rest)

    monkeypatch.setattr(S, "_rewrite", looked_at)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        S.upsert_backtest(spark, path, rows.filter("success"), "paper", day(2))
        S.delete_where(spark, path, F.col("backtest_id") < 10)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert len(seen) == 2
    assert all("BroadcastHashJoin" in p and not re.search(r"SortMergeJoin \[coalesce\(date", p) for p in seen)
    got = spark.read.parquet(path).groupBy("date").count().orderBy("date").collect()
    assert [(r["date"].day, r["count"]) for r in got] == [(1, 495), (2, 495)]
