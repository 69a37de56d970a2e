"""Streaming equals batch; the driver contract runs."""

from barworks.sources import fixtures as fx
from barworks.operators import views as Vw
from barworks.streaming import keyed
from barworks.streaming import quotes as K
from barworks.streaming.keyed import merge

SF = "/root/testdata/sf0.001"


def test_stream_daily_signals_equals_batch(spark):
    import __spark_entry__ as entry
    got = entry.queries()["stream_daily_signals"](spark, SF)
    s = fx.signals(spark, SF)
    exp = Vw.daily_signals(s, s.agg({"timestamp": "max"}).scalar().cast("date"), days=100000)
    cols = ["date", "ticker", "signal_count", "buy_signals", "sell_signals", "hold_signals"]
    assert got.select(*cols).exceptAll(exp.select(*cols)).count() == 0
    assert got.count() == exp.count()


def test_new_dates_only(spark):
    import datetime as dt
    t = spark.createDataFrame([("A", dt.date(2024, 1, 2))], "symbol string, date date")
    b = spark.createDataFrame([("A", dt.date(2024, 1, 2)), ("A", dt.date(2024, 1, 3)),
                               ("B", dt.date(2024, 1, 1))], "symbol string, date date")
    assert sorted((r[0], r[1].day) for r in K.new_dates_only(b, t).collect()) == [("A", 3), ("B", 1)]


def test_entry_smoke(spark):
    import __spark_entry__ as entry
    df = entry.entry(spark)
    assert df.count() > 0 and "quality" in df.columns
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_batch_merges_are_idempotent(spark, tmp_dir):
    import datetime as dt
    import os
    path = os.path.join(tmp_dir, "counts")
    b0 = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 1), (dt.date(2024, 1, 1), "B", 2)],
                               "date date, ticker string, n long")
    b1 = spark.createDataFrame([(dt.date(2024, 1, 1), "A", 5)], "date date, ticker string, n long")
    merge(b0, path, ["date", "ticker"], 0)
    merge(b1, path, ["date", "ticker"], 1)
    first = sorted((r["ticker"], r["n"]) for r in K.maintained(spark, path).collect())
    merge(b1, path, ["date", "ticker"], 1)          # replay of batch 1
    again = sorted((r["ticker"], r["n"]) for r in K.maintained(spark, path).collect())
    assert first == again == [("A", 5), ("B", 2)]


def test_last_arrival_wins(spark, tmp_dir):
    """A later arrival with an older time replaces the quote; the feed's sequence orders a batch."""
    import os
    q = os.path.join(tmp_dir, "latest")
    schema = "symbol string, seq long, ts long, last_price double"
    merge(spark.createDataFrame([("A", 2, 9, 11.0), ("A", 1, 3, 10.0), ("B", 3, 1, 7.0)], schema), q, ["symbol"], 0, "seq")
    merge(spark.createDataFrame([("A", 4, 5, 12.0)], schema), q, ["symbol"], 1, "seq")
    assert sorted((r[0], r[3]) for r in K.maintained(spark, q).collect()) == [("A", 12.0), ("B", 7.0)]


def _files(path):
    import os
    return {os.path.join(d, f): os.path.getmtime(os.path.join(d, f)) for d, _, names in os.walk(os.path.join(path, "data"))
            for f in names if f.startswith("part-")}


def test_merge_cut_short_has_no_effect(spark, tmp_dir):
    """Data without a manifest, and a manifest that was not written to its end, are no version."""
    import os
    path = os.path.join(tmp_dir, "t")
    schema = "k string, n long"
    merge(spark.createDataFrame([("A", 1)], schema), path, ["k"], 0)
    spark.createDataFrame([("A", 9)], schema).write.parquet(os.path.join(path, "data", "1-cut"))
    with open(os.path.join(path, "versions", "1.json"), "w") as f:
        f.write('{"batch": 1, "files"')
    assert [tuple(r) for r in keyed.table(spark, path).collect()] == [("A", 1)]
    merge(spark.createDataFrame([("B", 2)], schema), path, ["k"], 1)
    assert sorted(map(tuple, keyed.table(spark, path).collect())) == [("A", 1), ("B", 2)]
    assert not os.path.exists(os.path.join(path, "data", "1-cut"))


def test_one_key_rewrites_one_bucket(spark, tmp_dir):
    import os
    path = os.path.join(tmp_dir, "t")
    schema = "k string, n long"
    merge(spark.createDataFrame([(f"K{i}", i) for i in range(200)], schema), path, ["k"], 0, buckets=8)
    first = _files(path)
    merge(spark.createDataFrame([("K7", -7)], schema), path, ["k"], 1)
    (_, before), (_, now) = keyed.versions(spark, path)
    changed = [b for b in now["files"] if now["files"][b] != before["files"].get(b)]
    assert len(before["files"]) == 8 and len(changed) == 1
    kept = {f: t for f, t in _files(path).items() if f in first}
    assert kept == first                                     # the version before is whole
    assert {r["k"]: r["n"] for r in keyed.table(spark, path).collect()} == {f"K{i}": i if i != 7 else -7 for i in range(200)}
    for i in range(2, 5):                                    # older versions go
        merge(spark.createDataFrame([("K7", i)], schema), path, ["k"], i)
    assert len(keyed.versions(spark, path)) == 2 and len(_files(path)) <= len(first) + 2


def test_replay_starts_from_the_version_before(spark, tmp_dir):
    """What an earlier run of the batch replaced is there again when the second run has fewer rows."""
    import os
    path = os.path.join(tmp_dir, "t")
    schema = "k string, n long"
    merge(spark.createDataFrame([("A", 1), ("B", 1), (None, 1)], schema), path, ["k"], 0)
    merge(spark.createDataFrame([("A", 2), ("B", 2), ("C", 2)], schema), path, ["k"], 1)
    merge(spark.createDataFrame([("A", 2), (None, 2)], schema), path, ["k"], 1)
    got = {r["k"]: r["n"] for r in keyed.table(spark, path).collect()}
    assert got == {"A": 2, "B": 1, None: 2}
    merge(spark.createDataFrame([], schema), path, ["k"], 2)
    assert {r["k"]: r["n"] for r in keyed.table(spark, path).collect()} == got


def test_streams_read_a_folder_of_part_files(spark, tmp_dir):
    import os
    import shutil
    import __spark_entry__ as entry
    spark.read.parquet(f"{SF}/events.parquet").repartition(4).write.parquet(os.path.join(tmp_dir, "events.parquet"))
    for name in os.listdir(SF):
        if name != "events.parquet":
            shutil.copy(f"{SF}/{name}", tmp_dir)
    for name in ("stream_latest_quote", "stream_daily_signals", "stream_quote_polling"):
        one, many = (entry.queries()[name](spark, d) for d in (SF, tmp_dir))
        assert one.count() == many.count() > 0 and one.exceptAll(many).isEmpty()


def test_replayed_poll_is_stored_once(spark, tmp_dir):
    """The offsets of a finished batch are lost: it runs again and overwrites its own folder."""
    import os
    import shutil
    raw = K.raw_quotes(K.file_stream(spark, SF, "events"))
    ticks = K.tick_intake(raw, fx.instruments(spark, SF))
    out, bak, ck = (os.path.join(tmp_dir, n) for n in ("out", "bak", "ck"))
    K.quote_polling(ticks, out, bak, ck).awaitTermination()
    n = spark.read.parquet(out).count()
    shutil.rmtree(ck)
    K.quote_polling(ticks, out, bak, ck).awaitTermination()
    assert n > 0 and spark.read.parquet(out).count() == n and spark.read.json(bak).count() == n


def test_portfolio_document(spark, tmp_dir):
    import os
    src = os.path.join(tmp_dir, "in")
    spark.createDataFrame([(1, 100.0), (2, 90.0)], "seq long, value double").coalesce(1).write.parquet(src)
    stream = spark.readStream.schema("seq long, value double").parquet(src)
    out, ck = os.path.join(tmp_dir, "doc"), os.path.join(tmp_dir, "ck")
    K.portfolio_status(stream, out, ck).awaitTermination()
    rows = K.maintained(spark, out).collect()
    assert len(rows) == 1 and rows[0]["document_id"] == "current" and rows[0]["value"] == 90.0


def test_live_signals_stream(spark, tmp_dir):
    import datetime as dt
    import os
    src = os.path.join(tmp_dir, "sig_in")
    rows = [(1, "S1", dt.datetime(2024, 1, 2, 10), 0.5), (1, "S1", dt.datetime(2024, 1, 2, 11), 0.7),
            (2, "S2", dt.datetime(2024, 1, 2, 10), 0.1)]
    spark.createDataFrame(rows, "signal_id long, symbol string, timestamp timestamp_ntz, confidence double") \
         .write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    out, ck = os.path.join(tmp_dir, "live"), os.path.join(tmp_dir, "ck")
    K.live_signals(stream, out, ck).awaitTermination()
    got = {r["signal_id"]: r["confidence"] for r in K.maintained(spark, out).collect()}
    assert got == {1: 0.7, 2: 0.1}


def test_daily_counts_independent_of_session_zone(spark):
    import datetime as dt
    rows = [(1, "S1", dt.datetime(2024, 1, 2, 23, 30), "BUY", 0.5),
            (2, "S1", dt.datetime(2024, 1, 3, 0, 30), "SELL", 0.7)]
    df = spark.createDataFrame(rows, "signal_id long, symbol string, timestamp timestamp_ntz, "
                                     "action string, confidence double")
    prev = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "America/New_York")
        got = sorted((r["date"].day, r["signal_count"]) for r in K.daily_signal_counts(df).collect())
    finally:
        spark.conf.set("spark.sql.session.timeZone", prev)
    assert got == [(2, 1), (3, 1)]


def test_entry_without_the_text_folders(tmp_dir):
    """The entry imports on a copy without the text operators, with and without the pipeline file,
    and when only an empty folder of the package is left."""
    import os
    import shutil
    import subprocess
    import sys
    from barworks.plans import QUERIES
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for k, (pipeline, folder) in enumerate([(False, False), (True, False), (True, True)]):
        copy = os.path.join(tmp_dir, f"repo{k}")
        shutil.copytree(os.path.join(root, "barworks"), os.path.join(copy, "barworks"),
                        ignore=shutil.ignore_patterns("llm", "__pycache__"))
        shutil.copy(os.path.join(root, "__spark_entry__.py"), copy)
        source = os.path.join(root, "corpus_pipeline.py")
        if pipeline and os.path.exists(source):
            shutil.copy(source, copy)
        if folder:
            os.makedirs(os.path.join(copy, "barworks", "llm", "__pycache__"))
        code = "import __spark_entry__ as e; print(len(e.queries()), len(e.oracle_sql()))"
        env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
        got = subprocess.run([sys.executable, "-c", code], cwd=copy, env=env, capture_output=True, text=True, check=True)
        assert got.stdout.split() == [str(len(QUERIES))] * 2
