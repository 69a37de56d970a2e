"""Ingestion log: records, symbols and quality of each run, and the score of all runs so far.

The counts behind the quality score (A4, one row per symbol) can be added up, so each run
stores its own and the score after a run is that of the sum: no run reads the bars of
another.  A run that is repeated replaces what it stored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .quality import quality_by_symbol, score_of


_STATE = ("symbol string, record_count long, null_ohlc_count long, zero_volume_count long, first_date date, "
          "last_date date")
_LOG = ("start_date date, end_date date, records_count long, symbols_count long, run_score double, "
        "quality_score double, total_symbols long, source string, created_at timestamp_ntz, run long")


def merged_states(states: DataFrame) -> DataFrame:
    """One row per symbol from several: counts added up, first and last date."""
    return states.groupBy("symbol").agg(
        *[F.sum(c).alias(c) for c in ("record_count", "null_ohlc_count", "zero_volume_count")],
        F.min("first_date").alias("first_date"), F.max("last_date").alias("last_date"))


def log_run(bars: DataFrame, path: str, run: int, loaded_at: Column, source: str) -> None:
    """Store the states of ``run`` (symbols of this run's ``bars``) and its log row.

    Runs are numbered; the score so far is that of the runs up to this one.  An empty run
    is logged with no records."""
    spark = bars.sparkSession
    quality_by_symbol(bars).write.mode("overwrite").parquet(f"{path}/states/run={run}")
    own = spark.read.schema(_STATE).parquet(f"{path}/states/run={run}")
    # runs are folders: the states of later ones are not read
    so_far = spark.read.schema(f"{_STATE}, run long").option("basePath", f"{path}/states").parquet(f"{path}/states")
    so_far = merged_states(so_far.filter(F.col("run") <= run))
    count = own.agg(F.min("first_date").alias("start_date"), F.max("last_date").alias("end_date"),
                    F.coalesce(F.sum("record_count"), F.lit(0)).alias("records_count"),
                    F.count(F.lit(1)).alias("symbols_count"))
    row = count.withColumns({"run_score": score_of(own).select("quality_score").scalar(),
                             "quality_score": score_of(so_far).select("quality_score").scalar(),
                             "total_symbols": so_far.agg(F.count(F.lit(1))).scalar()})
    row.select("start_date", "end_date", "records_count", "symbols_count", "run_score", "quality_score", "total_symbols",
               F.lit(source).alias("source"), loaded_at.cast("timestamp_ntz").alias("created_at")) \
       .write.mode("overwrite").parquet(f"{path}/log/run={run}")


def ingestion_log(spark: SparkSession, path: str) -> DataFrame:
    """The log rows of all runs."""
    return spark.read.schema(_LOG).option("basePath", f"{path}/log").parquet(f"{path}/log").select(
        "run", "start_date", "end_date", "records_count", "symbols_count", "run_score", "quality_score", "total_symbols",
        "source", "created_at")
