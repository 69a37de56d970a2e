"""Sources and sinks.

Reads go through ``spark.read`` with an explicit schema and filters placed
directly on the scan (partition pruning on ``date``, Parquet predicate
pushdown on the rest).  Writes are plain DataFrame writes; upserts and
deletes on Parquet tables (which reject MERGE/DELETE) stage the rewritten
partitions under the cluster's shared checkpoint folder and swap them in
with dynamic partition overwrite, so a lost executor only retries tasks.
"""

from __future__ import annotations

import re
import uuid
from typing import Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpoint_dir

BARS_SCHEMA = T.StructType([
    T.StructField("symbol", T.StringType(), False),
    T.StructField("date", T.DateType(), False),
    T.StructField("open", T.DoubleType()),
    T.StructField("high", T.DoubleType()),
    T.StructField("low", T.DoubleType()),
    T.StructField("close", T.DoubleType()),
    T.StructField("volume", T.DoubleType()),
    T.StructField("load_seq", T.LongType()),
    T.StructField("source", T.StringType()),
])

# Stored metrics of a backtest row with their defaults, and the names
# under which a result carries two of them.
BACKTEST_DEFAULTS = {"initial_capital": 100000.0, "final_value": 0.0, "total_return_pct": 0.0,
                     "trades_count": 0, "win_rate_pct": 0.0}
BACKTEST_NAMES = {"trades": "trades_count", "win_rate": "win_rate_pct"}

# Write dispositions of the warehouse loader.
WRITE_MODES = {"WRITE_APPEND": "append", "WRITE_TRUNCATE": "overwrite",
               "WRITE_EMPTY": "write_empty", "append": "append", "overwrite": "overwrite",
               "errorifexists": "errorifexists"}


# -- reads (S1-S3, S5, S6) -------------------------------------------------

def read_bars(spark: SparkSession, path: str, fmt: str = "parquet",
              schema: T.StructType | None = BARS_SCHEMA, start=None, end=None,
              symbol: str | None = None) -> DataFrame:
    """S1 / S6 read side: landed bars of a date range (partition-pruned).

    ``schema`` None: as the files say; an empty table then cannot be read."""
    r = spark.read.format(fmt)
    if schema is not None:
        r = r.schema(schema)
    if fmt == "csv":
        r = r.option("header", "true")
    df = r.load(path)
    if start is not None:
        df = df.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        df = df.filter(F.col("date") <= F.lit(end).cast("date"))
    if symbol is not None:
        df = df.filter(F.col("symbol") == symbol)
    return df


def for_universe(bars: DataFrame, universe: DataFrame) -> DataFrame:
    """One scan restricted to the universe (symbols without data simply
    yield no rows).  A left-semi join; the planner broadcasts the universe
    when its measured size allows, else it shuffles both sides."""
    return bars.join(universe.select("symbol").distinct(), "symbol", "left_semi")


def drop_critical(bars: DataFrame, issues: DataFrame) -> DataFrame:
    """S3: symbols with any CRITICAL issue are left out (left anti join)."""
    bad = issues.filter(F.col("severity") == "critical").select("symbol").distinct()
    return bars.join(bad, "symbol", "left_anti")


def source_fallback(primary: DataFrame, secondary: DataFrame) -> DataFrame:
    """Per symbol the primary source, else the secondary."""
    have = primary.select("symbol").distinct()
    return primary.unionByName(secondary.join(have, "symbol", "left_anti"),
                               allowMissingColumns=True)


def with_tokens(df: DataFrame, instruments: DataFrame, symbol: str = "symbol") -> DataFrame:
    """S5 symbol -> token (unknown symbol -> NULL token)."""
    dim = instruments.select(F.col("tradingsymbol").alias(symbol), "instrument_token")
    return df.join(dim, symbol, "left")


def with_symbols(ticks: DataFrame, instruments: DataFrame, token: str = "instrument_token") -> DataFrame:
    """S5 token -> symbol; K1 keeps an unknown token as its text."""
    dim = instruments.select(F.col("instrument_token").alias(token), F.col("tradingsymbol"))
    j = ticks.join(dim, token, "left")
    return j.withColumn("symbol", F.coalesce(F.col("tradingsymbol"), F.col(token).cast("string"))) \
            .drop("tradingsymbol")


# -- writes (S6-S8, S11-S13, S17) ------------------------------------------

def write_table(df: DataFrame, path: str, mode: str = "append", partition_by: str | None = "date",
                cluster_by: Sequence[str] = ("symbol",), fmt: str = "parquet") -> None:
    """A partitioned, clustered table write.

    Rows are rebalanced on the partition value: adaptive execution splits a
    large date into as many tasks as its bytes ask for and joins small ones,
    so neither a hot date nor many thin ones decide the file sizes.  Within a
    task rows are sorted on the clustering columns for min/max skipping.
    ``mode`` accepts the loader's dispositions; WRITE_EMPTY fails only when
    the table already holds rows.
    """
    mode = WRITE_MODES.get(mode, mode)
    spark = df.sparkSession
    if mode == "write_empty":
        if _has_rows(spark, path, fmt):
            raise ValueError(f"table at {path} is not empty")
        mode = "overwrite"
    w = df.hint("rebalance", F.col(partition_by)) if partition_by else df
    order = [c for c in (partition_by, *cluster_by) if c] if cluster_by else []
    if order:
        w = w.sortWithinPartitions(*order)
    writer = w.write.mode(mode).format(fmt)
    if partition_by:
        writer = writer.partitionBy(partition_by)
    writer.save(path)


def _has_files(spark: SparkSession, path: str) -> bool:
    """Whether the table's folder holds a data file (names with _ or . are markers)."""
    if not _exists(spark, path):
        return False
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(p, True)
    while files.hasNext():
        if files.next().getPath().getName()[0] not in "._":
            return True
    return False


def _has_rows(spark: SparkSession, path: str, fmt: str = "parquet") -> bool:
    """A missing table, or a folder without data files, has no rows; a table that
    cannot be read is an error, never an empty one."""
    return _has_files(spark, path) and not spark.read.format(fmt).load(path).isEmpty()


def ensure_table(spark: SparkSession, path: str, schema: T.StructType,
                 partition_by: str | None = "date") -> None:
    """Make the table's folder when it is missing.  ``read_table`` with the
    table's schema reads it from then on, with or without rows."""
    if _exists(spark, path):
        return
    if partition_by and partition_by not in schema.fieldNames():
        raise ValueError(f"no column {partition_by} to partition by")
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).mkdirs(p)


def read_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A maintained table by its schema; no rows when it holds no file yet."""
    return spark.read.schema(schema).parquet(path)


def stamp(df: DataFrame, schema: T.StructType, loaded_at: Column, col: str = "created_at") -> DataFrame:
    """Select and cast to the table schema, add the load stamp."""
    cols = []
    for f in schema.fields:
        if f.name == col:
            cols.append(loaded_at.cast(f.dataType).alias(col))
        elif f.name in df.columns:
            cols.append(F.col(f.name).try_cast(f.dataType).alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    return df.select(*cols)


def append_table(df: DataFrame, path: str, schema: T.StructType, loaded_at: Column,
                 partition_by: str | None = "date", stamp_col: str = "created_at") -> None:
    """The generic row append (signals, trades, performance, snapshots, bars)."""
    write_table(stamp(df, schema, loaded_at, stamp_col), path, "append", partition_by, ())


def daily_append(df: DataFrame, path: str, loaded_at: Column) -> None:
    """Add ``updated_at``, coerce (P4), append partitioned by date."""
    from ..operators.shape import coerce_dropna
    out = coerce_dropna(df).withColumn("updated_at", loaded_at)
    write_table(out, path, "append")


def backup_json(df: DataFrame, path: str, partition_by: str = "date") -> None:
    """Daily JSON-lines backup, appended per date."""
    df.hint("rebalance", F.col(partition_by)).write.mode("append").partitionBy(partition_by).json(path)


# -- upsert / delete / retention on Parquet (S9, S10, S14-S16) -------------

def latest_per_key(df: DataFrame, keys: Sequence[str], order: str = "load_seq") -> DataFrame:
    """S9 core: last write wins per business key."""
    from ..functions.exprs import dedupe
    return dedupe(df, keys, order, last=True)


def _stage(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` under the shared checkpoint folder and read it back: cuts
    the lineage to the table being rewritten and survives executor loss.
    Returns the staged frame and its path (removed once swapped in)."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/stage-{name}-{uuid.uuid4().hex}"
    df.write.mode("errorifexists").parquet(path)
    return spark.read.parquet(path), path


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder through the Hadoop FileSystem of its URI."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def _swap_partitions(staged: DataFrame, path: str, partition_by: str) -> None:
    spark = staged.sparkSession
    prev = spark.conf.get("spark.sql.sources.partitionOverwriteMode", "static")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
    try:
        staged.write.mode("overwrite").partitionBy(partition_by).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", prev)


def _same(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> Column:
    """Null-safe equality of ``cols``."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & a[c].eqNullSafe(b[c])
    return cond


def _within(df: DataFrame, values: DataFrame, partition_by: str) -> DataFrame:
    """The rows whose partition is one of ``values`` (distinct).  The values go to the rows: a table has
    few partitions, and by a shuffle all rows of one would meet in a task."""
    return df.join(F.broadcast(values), _same(df, values, [partition_by]), "left_semi")


def _folders(spark: SparkSession, path: str, partition_by: str) -> dict[str | None, str]:
    """The table's partition folders by their value: the text as written (unescaped), None for null."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    utils = jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils
    out: dict[str | None, str] = {}
    for f in fs.listStatus(p) if fs.exists(p) else []:
        name = f.getPath().getName()
        if f.isDirectory() and name.startswith(f"{utils.escapePathName(partition_by)}="):
            value = name.split("=", 1)[1]
            value = None if value == "__HIVE_DEFAULT_PARTITION__" else utils.unescapePathName(value)
            out[value] = f.getPath().toString()
    return out


def _lossless(values: list[str], kind: T.DataType) -> bool:
    """Whether the values' texts are those that ``kind`` writes."""
    if isinstance(kind, T.DateType):
        return all(re.fullmatch(r"\d{4}-\d\d-\d\d", v) for v in values)
    if isinstance(kind, T.IntegralType):
        return all(re.fullmatch(r"0|-?[1-9]\d*", v) for v in values)
    return False


def stored(spark: SparkSession, path: str, partition_by: str, kind: T.DataType | None = None) -> DataFrame:
    """The stored table.  The partition column is read as the text of its folders and then
    given its type: ``kind``, or without it a date or whole number when every value is
    written like one, else text ("001" stays "001")."""
    name = "spark.sql.sources.partitionColumnTypeInference.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        df = spark.read.parquet(path)
        df.schema
    finally:
        spark.conf.set(name, before)
    if kind is None:
        values = [v for v in _folders(spark, path, partition_by) if v is not None]
        fits = (k for k in (T.DateType(), T.LongType()) if values and _lossless(values, k))
        kind = next(fits, T.StringType())
    return df.withColumn(partition_by, F.col(partition_by).cast(kind))


def _rewrite(spark: SparkSession, path: str, rows: DataFrame, touched: DataFrame, partition_by: str,
             name: str) -> None:
    """Replace the partitions in ``touched`` by ``rows``: staged first, swapped in
    by dynamic overwrite, and partitions left without rows removed (also the one
    of the null value).  Running it again after a failure gives the same table."""
    kind = rows.schema[partition_by].dataType
    touched, where_t = _stage(touched.select(F.col(partition_by).cast(kind)), name + "-parts")
    staged, where = _stage(rows, name)
    remaining = staged.select(partition_by).distinct()
    gone = touched.join(remaining, _same(touched, remaining, [partition_by]), "left_anti")
    emptied = [r[0] for r in gone.select(F.col(partition_by).cast("string")).collect()]  # partition values only
    _swap_partitions(staged, path, partition_by)
    _drop_partitions(spark, path, partition_by, emptied)
    remove_path(spark, where)
    remove_path(spark, where_t)


def upsert(spark: SparkSession, path: str, incoming: DataFrame, keys: Sequence[str],
           order: str = "load_seq", partition_by: str = "date") -> None:
    """Merge ``incoming`` into the table, last write wins per key.

    Rewritten are the partitions that ``incoming`` names and, when the key does
    not include the partition column, those that hold one of its keys already.
    Null keys and null partition values are values like any other."""
    incoming = latest_per_key(incoming, keys, order)
    if not _has_files(spark, path):
        write_table(incoming, path, "append", partition_by, ())
        return
    current = stored(spark, path, partition_by, incoming.schema[partition_by].dataType)
    incoming = incoming.select(*current.columns)
    touched = incoming.select(partition_by)
    if partition_by not in keys:
        new = incoming.select(*keys).distinct()
        touched = touched.unionByName(current.join(new, _same(current, new, keys), "left_semi").select(partition_by))
    touched = touched.distinct()
    affected = _within(current, touched, partition_by)
    _rewrite(spark, path, latest_per_key(affected.unionByName(incoming), keys, order), touched, partition_by,
             "upsert")


def upsert_backtest(spark: SparkSession, path: str, results: DataFrame, mode: str,
                    loaded_at: Column) -> None:
    """Defaults for missing metrics, metadata as JSON text, mode tag, then S9:
    one row for each backtest_id whatever day it was saved before."""
    out = results.withColumnsRenamed({k: v for k, v in BACKTEST_NAMES.items() if v not in results.columns})
    out = out.withColumns({k: F.coalesce(F.col(k), F.lit(v)) if k in out.columns else F.lit(v)
                           for k, v in BACKTEST_DEFAULTS.items()})
    if "metadata" not in out.columns:
        out = out.withColumn("metadata", F.lit("{}"))
    elif out.schema["metadata"].dataType != T.StringType():
        out = out.withColumn("metadata", F.coalesce(F.to_json("metadata"), F.lit("{}")))
    else:
        out = out.withColumn("metadata", F.coalesce("metadata", F.lit("{}")))
    out = out.withColumns({"mode": F.lit(mode), "created_at": loaded_at,
                           "date": F.to_date(loaded_at), "load_seq": F.unix_micros(
                               loaded_at.cast("timestamp"))})
    upsert(spark, path, out, ["backtest_id"], "load_seq", "date")


def delete_where(spark: SparkSession, path: str, cond: Column, partition_by: str = "date") -> None:
    """Delete rows matching ``cond`` (rows where it is NULL stay).  The partition column has
    the type that ``stored`` reads from its folders.

    Only partitions holding a matching row are rewritten; a partition left
    empty is removed through the Hadoop FileSystem of the table path."""
    current = stored(spark, path, partition_by)
    hit = current.filter(cond).select(partition_by).distinct()
    affected = _within(current, hit, partition_by)
    _rewrite(spark, path, affected.filter(without(cond)), hit, partition_by, "delete")


def without(cond: Column) -> Column:
    """The rows that a delete by ``cond`` leaves."""
    return ~F.coalesce(cond, F.lit(False))


def drop_older(df: DataFrame, as_of: Column, days: int, col: str = "created_at") -> DataFrame:
    """S15 / S16 as a DataFrame rule: keep rows newer than ``as_of - days``."""
    return df.filter(F.col(col) >= F.date_sub(as_of, days))


def expire_partitions(spark: SparkSession, path: str, cutoff, partition_by: str = "date") -> list:
    """Drop whole partitions older than ``cutoff`` (no data rewrite).
    The list of partition values comes from the file index, not the rows."""
    parts = spark.read.parquet(path).select(partition_by).distinct()
    old = [r[0] for r in parts.filter(F.col(partition_by) < F.lit(cutoff).cast("date")).collect()]
    _drop_partitions(spark, path, partition_by, old)  # dates are written as they print
    return old


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def _is_folder(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def _drop_partitions(spark: SparkSession, path: str, partition_by: str, values: Iterable) -> None:
    """Remove the folders of these partition values, found by their unescaped names."""
    folders = _folders(spark, path, partition_by)
    for v in values:
        folder = folders.get(v if v is None else str(v))
        if folder is not None:
            remove_path(spark, folder)


# -- universe files (S18-S20) ----------------------------------------------

def _universe_text(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path, wholetext=True).select(F.col("value").alias("j"))


def universe_symbols(spark: SparkSession, path: str, precedence: str = "sectors") -> DataFrame:
    """S18 (precedence 'sectors': sectors, else universe, else symbols; distinct)
    and S19 (precedence 'symbols': symbols, else sectors, else tickers; duplicates kept)."""
    t = _universe_text(spark, path)
    sectors = F.from_json("j", "sectors map<string, array<string>>")["sectors"]
    uni = F.from_json("j", "universe array<string>")["universe"]
    syms = F.from_json("j", "symbols array<string>")["symbols"]
    tick = F.from_json("j", "tickers array<string>")["tickers"]
    flat_sectors = F.flatten(F.map_values(sectors))
    uni_syms = F.transform(uni, lambda e: F.when(F.startswith(F.ltrim(e), F.lit("{")),
                                                 F.get_json_object(e, "$.symbol")).otherwise(e))
    if precedence == "sectors":
        arr = (F.when(sectors.isNotNull(), flat_sectors).when(uni.isNotNull(), uni_syms)
                .when(syms.isNotNull(), syms))
        out = t.select(F.explode(arr).alias("symbol")).filter(F.col("symbol").isNotNull())
        return out.distinct()
    arr = (F.when(syms.isNotNull(), syms).when(sectors.isNotNull(), flat_sectors)
            .when(tick.isNotNull(), tick))
    return t.select(F.explode(arr).alias("symbol"))


def trading_universe(lists: dict[str, DataFrame], enabled: Sequence[str],
                     custom: DataFrame | None = None) -> DataFrame:
    """Union of the enabled index lists and custom symbols, distinct."""
    out = None
    for name in enabled:
        part = lists[name].select("symbol")
        out = part if out is None else out.unionByName(part)
    if custom is not None:
        out = custom.select("symbol") if out is None else out.unionByName(custom.select("symbol"))
    return out.distinct()


# -- statistics and seed data (S21, S22) -----------------------------------

def table_stats(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count per table plus a total row."""
    out = None
    for name, df in tables.items():
        part = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count")
        out = part if out is None else out.unionByName(part)
    total = out.agg(F.sum("row_count").alias("row_count")).select(
        F.lit("total").alias("table_name"), "row_count")
    return out.unionByName(total)


def seed_bars(spark: SparkSession, symbols: Sequence[str], hours: int = 10,
              start: str = "2024-01-01 09:15:00") -> DataFrame:
    """The deterministic bar fixture - symbol i, hour j: open 100+10i+j,
    high 105+10i+j, low 95+10i+j, close 102+10i+j, volume 1000(j+1)."""
    sym = spark.createDataFrame([(i, s) for i, s in enumerate(symbols)], "i int, symbol string")
    g = sym.select("*", F.explode(F.sequence(F.lit(0), F.lit(hours - 1))).alias("j"))
    base = 10 * F.col("i") + F.col("j")
    return g.select("symbol",
                    (F.lit(start).cast("timestamp_ntz") + F.make_dt_interval(hours=F.col("j")))
                    .alias("timestamp"),
                    (100 + base).cast("double").alias("open"), (105 + base).cast("double").alias("high"),
                    (95 + base).cast("double").alias("low"), (102 + base).cast("double").alias("close"),
                    (1000 * (F.col("j") + 1)).cast("double").alias("volume"))


def seed_daily_bars(spark: SparkSession, n_symbols: int = 250, n_days: int = 4685,
                    start: str = "2010-01-01") -> DataFrame:
    """S22's value rule laid out as daily bars (symbol i, day j): a like-sized
    load (250 x 4,685 = 1,171,250 bars) generated by ``spark.range``."""
    i = F.col("id") % n_symbols
    j = (F.col("id") / n_symbols).cast("long")
    base = (10 * i + j).cast("double")
    return spark.range(n_symbols * n_days).select(
        F.concat(F.lit("Y"), i).alias("symbol"),
        F.date_add(F.lit(start).cast("date"), j.cast("int")).alias("date"),
        (100 + base).alias("open"), (105 + base).alias("high"), (95 + base).alias("low"),
        (102 + base).alias("close"), (1000 * (j % 10 + 1)).cast("double").alias("volume"),
        F.col("id").alias("load_seq"), F.lit("seed").alias("source"))
