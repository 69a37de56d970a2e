"""Structured Streaming for quotes and signals (K1-K6).

Sources are file streams (Kafka in production works the same way: only the
``readStream`` format changes).  Stateful results are kept in keyed tables (``keyed``)
by ``foreachBatch`` merges that are idempotent: a replayed batch starts from the version
before it, so running it again yields the same table.  Every query keeps its offsets
in a checkpoint under the cluster's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.shape import flatten_quotes, market_open
from ..session import checkpoint_dir
from ..sources.io import _exists, _is_folder, remove_path, with_symbols
from .keyed import merge, table

QUOTE_FIELDS = ("last_price", "volume")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def file_stream(spark: SparkSession, directory: str, name: str, fmt: str = "parquet",
                max_files: int | None = None) -> DataFrame:
    """A file stream over the table ``<directory>/<name>.<fmt>``, one file or a
    folder of part files; the schema comes from the footers (metadata only)."""
    file = f"{name}.{fmt}"
    path = f"{directory.rstrip('/')}/{file}"
    r = spark.readStream.format(fmt).schema(spark.read.format(fmt).load(path).schema)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    if _is_folder(spark, path):
        return r.load(path)
    # a stream's path has to be a folder; of its files only the one counts
    return r.option("pathGlobFilter", file).load(directory)


def tick_intake(raw: DataFrame, instruments: DataFrame, symbols: DataFrame | None = None) -> DataFrame:
    """K1: token -> symbol by a stream-static left join (an unknown token is
    kept as its text), missing numbers -> 0, optional subscription filter."""
    out = with_symbols(raw, instruments)
    out = out.withColumns({c: F.coalesce(F.col(c), F.lit(0.0)) for c in QUOTE_FIELDS if c in out.columns})
    if symbols is not None:
        out = out.join(symbols.select("symbol"), "symbol", "left_semi")
    return out


def maintained(spark: SparkSession, path: str) -> DataFrame:
    """A table that a stream keeps: a keyed one, or plain Parquet files."""
    return table(spark, path) if _exists(spark, f"{path}/versions") else spark.read.parquet(path)


def taken(spark: SparkSession, path: str, *others: str) -> DataFrame:
    """The rows of a scratch table, kept in a checkpoint (cleaned when unreferenced); its
    folder and ``others`` are removed."""
    checkpoint_dir(spark)
    rows = maintained(spark, path).checkpoint()
    for p in (path, *others):
        remove_path(spark, p)
    return rows


def latest_per(stream: DataFrame, table_path: str, checkpoint: str, keys: list[str], arrival: str | None = None,
               available_now: bool = True, interval: str = "60 seconds"):
    """A keyed table of the last arrival per key, merged batch by batch.  A batch without
    rows (one that only advances a watermark) leaves the table as it is."""
    def batch(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            merge(df, table_path, keys, batch_id, arrival)
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime=interval)).start()


def latest_quotes(stream: DataFrame, table_path: str, checkpoint: str,
                  key: str = "symbol", arrival: str | None = None, available_now: bool = True):
    """Latest quote per symbol, last arrival wins, kept in a table."""
    return latest_per(stream, table_path, checkpoint, [key], arrival, available_now)


def live_signals(stream: DataFrame, table_path: str, checkpoint: str):
    """K4: live signal document per signal_id (latest write wins)."""
    return latest_per(stream, table_path, checkpoint, ["signal_id"], "timestamp")


def portfolio_status(stream: DataFrame, table_path: str, checkpoint: str):
    """K4: the one current portfolio document (a constant key), stamped by the caller."""
    return latest_per(stream.withColumn("document_id", F.lit("current")), table_path, checkpoint, ["document_id"])


def quote_polling(stream: DataFrame, table_path: str, backup_path: str, checkpoint: str,
                  available_now: bool = True):
    """K3: every trigger flatten quotes (P5), keep market hours (P16), back up
    as JSON per day (S17) and append to the table (S7).

    Each batch owns a folder ``batch=<id>`` of the table and of the backup and
    overwrites it, so a replayed batch is stored once."""
    def batch(df: DataFrame, batch_id: int) -> None:
        flat = flatten_quotes(df).filter(market_open("ts")).withColumn("date", F.to_date("ts"))
        flat = flat.hint("rebalance", F.col("date")).persist()
        try:
            flat.write.mode("overwrite").partitionBy("date").json(f"{backup_path}/batch={batch_id}")
            flat.write.mode("overwrite").partitionBy("date").parquet(f"{table_path}/batch={batch_id}")
        finally:
            flat.unpersist()
    w = stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="60 seconds")).start()


def daily_signal_counts(signals: DataFrame, watermark: str = "1 day") -> DataFrame:
    """K5: per day and ticker counts of a signal stream (watermarked window)."""
    a = F.col("action")
    # The event time must be a zoned timestamp.  The naive wall-clock value is
    # read as UTC explicitly (not through the session zone), so the 1-day
    # windows - aligned to the epoch - are the wall-clock days, and the day
    # label is taken from epoch seconds: independent of the session zone.
    wall = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    ev = signals.withColumn("_et", F.to_timestamp(F.concat(wall, F.lit("Z")),
                                                  "yyyy-MM-dd'T'HH:mm:ss.SSSSSSX"))
    day = F.date_from_unix_date(F.floor(F.unix_seconds(F.col("w.start")) / 86400).cast("int"))
    return (ev.withWatermark("_et", watermark)
                   .groupBy(F.window("_et", "1 day").alias("w"), F.col("symbol").alias("ticker"))
                   .agg(F.count(F.lit(1)).alias("signal_count"),
                        F.avg("confidence").alias("avg_confidence"),
                        F.count_if(a == "BUY").alias("buy_signals"),
                        F.count_if(a == "SELL").alias("sell_signals"),
                        F.count_if(a == "HOLD").alias("hold_signals"))
                   .select(day.alias("date"), "ticker", "signal_count",
                           "avg_confidence", "buy_signals", "sell_signals", "hold_signals"))


def run_daily_signal_counts(signals: DataFrame, table_path: str, checkpoint: str,
                            available_now: bool = True):
    """K5 as a running query: update mode merged into a keyed table per batch."""
    agg = daily_signal_counts(signals)

    def batch(df: DataFrame, batch_id: int) -> None:
        if not df.isEmpty():
            merge(df, table_path, ["date", "ticker"], batch_id)

    w = agg.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(batch)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="24 hours")).start()


def new_dates_only(batch: DataFrame, table: DataFrame) -> DataFrame:
    """K6: keep the rows of each symbol newer than the table's latest date (A10)."""
    latest = table.groupBy("symbol").agg(F.max("date").alias("_latest"))
    j = batch.join(latest, "symbol", "left")
    return j.filter(F.col("_latest").isNull() | (F.col("date") > F.col("_latest"))).drop("_latest")


def raw_quotes(events: DataFrame) -> DataFrame:
    """Quote records as a broker feed sends them: token, price, volume, time."""
    k = F.get_json_object("props", "$.k").cast("double")
    return events.select((F.col("user_id") + 1000000).alias("instrument_token"), "ts", "event_id",
                         F.col("value").alias("last_price"), (k * 100).alias("volume"))


def signal_records(events: DataFrame) -> DataFrame:
    """The signal mapping applied to an event stream (same rules as the batch fixture)."""
    et = F.col("event_type")
    return events.select(F.col("event_id").alias("signal_id"),
                         F.concat(F.lit("S"), F.col("user_id")).alias("symbol"),
                         F.col("ts").alias("timestamp"),
                         F.when(et == "purchase", "BUY").when(et == "error", "SELL")
                          .otherwise("HOLD").alias("action"),
                         (F.get_json_object("props", "$.k").cast("double") / 100.0).alias("confidence"))

