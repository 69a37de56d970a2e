"""A keyed table that is merged batch by batch, bucket by bucket.

Rows are dealt into ``buckets`` by a hash of their key.  A merge writes new files for the
buckets its batch touches and leaves the others as they are; then a small manifest
(``versions/<n>.json``) names the files of every bucket, and the newest readable manifest
is the table.  Writing that one file is the commit: a merge that is cut short before has
no effect, and no folder is renamed.

A batch that runs again starts from the version before its first run, so the table is the
same whatever the first run had written.  The files of the newest two versions are kept,
older ones are removed.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.io import remove_path

BUCKETS = 16
#: Columns of a maintained table: the batch that wrote the row, its place among that batch's rows.
ARRIVAL = ("_batch", "_at")
_BUCKET = "_bucket"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _manifests(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the versions, ascending."""
    fs, p = _fs(spark, f"{path}/versions")
    names = [f.getPath().getName() for f in fs.listStatus(p)] if fs.exists(p) else []
    return sorted(int(n[:-5]) for n in names if n.endswith(".json") and n[:-5].isdigit())


def _read(spark: SparkSession, path: str, number: int) -> dict | None:
    """A manifest; None when its writing was cut short."""
    fs, p = _fs(spark, f"{path}/versions/{number}.json")
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    try:
        return json.loads(text)
    except ValueError:
        return None


def _write(spark: SparkSession, path: str, number: int, manifest: dict) -> None:
    """The commit; two writers of one version: the second fails."""
    fs, p = _fs(spark, f"{path}/versions/{number}.json")
    out = fs.create(p, False)
    try:
        out.write(bytearray(json.dumps(manifest).encode()))
    finally:
        out.close()


def versions(spark: SparkSession, path: str) -> list[tuple[int, dict]]:
    """(number, manifest) of the versions that can be read, ascending."""
    found = ((n, _read(spark, path, n)) for n in _manifests(spark, path))
    return [(n, m) for n, m in found if m is not None]


def _rows(spark: SparkSession, path: str, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
    """The rows of some buckets (all without), with the bookkeeping columns."""
    schema = T.StructType.fromJson(manifest["schema"])
    files = [f"{path}/{folder}" for b, folder in manifest["files"].items() if buckets is None or int(b) in buckets]
    return spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)


def _buckets(spark: SparkSession, folder: str) -> list[int]:
    """The buckets that a folder holds."""
    fs, p = _fs(spark, folder)
    names = [f.getPath().getName() for f in fs.listStatus(p)]
    return [int(n.split("=")[1]) for n in names if n.startswith(f"{_BUCKET}=")]


def merge(batch: DataFrame, path: str, keys: list[str], batch_id: int, arrival: str | None = None,
          buckets: int = BUCKETS) -> None:
    """Keep the row of each key that arrived last: the later batch, within a batch the larger
    ``arrival`` (a sequence or time of the feed; without one, the place in the batch).  NULL
    keys are keys.  A table keeps the number of buckets it was made with."""
    spark = batch.sparkSession
    known = versions(spark, path)
    newest = max([n for n, _ in known] + _manifests(spark, path), default=-1)
    # a batch that runs again starts from the version before it
    known = [(n, m) for n, m in known if m["batch"] != batch_id]
    old = known[-1][1] if known else None
    if old:
        buckets = old["buckets"]
    at = F.col(arrival) if arrival else F.monotonically_increasing_id()
    fresh = batch.withColumn("_batch", F.lit(batch_id).cast("long")).withColumn("_at", at)
    columns = [c for c in fresh.columns if c not in keys]

    def last(df: DataFrame, *by: str) -> DataFrame:
        rows = df.groupBy(*by, *keys).agg(F.max_by(F.struct(*columns), F.struct(*ARRIVAL)).alias("r"))
        return rows.select(*by, *keys, "r.*")

    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias(_BUCKET)
    schema = T.StructType([f for f in fresh.select(*keys, *columns).schema])
    files = dict(old["files"]) if old else {}
    folder = f"data/{newest + 1}-{uuid.uuid4().hex[:8]}"
    rows, stage = last(fresh).select(bucket, *keys, *columns), f"{path}/staged/{uuid.uuid4().hex}"
    if files:  # one row per key, written once: its buckets are asked for before they are merged
        rows.write.partitionBy(_BUCKET).parquet(stage)
        touched = _buckets(spark, stage)
        rows = spark.read.schema(T.StructType([*schema.fields, T.StructField(_BUCKET, T.IntegerType())])).parquet(stage)
        rows = rows.select(_BUCKET, *keys, *columns)
        if any(str(b) in files for b in touched):
            before = _rows(spark, path, old, touched).select(bucket, *keys, *columns)
            rows = last(rows.unionByName(before).repartition(_BUCKET), _BUCKET)
    rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{path}/{folder}")
    files |= {str(b): f"{folder}/{_BUCKET}={b}" for b in _buckets(spark, f"{path}/{folder}")}
    _write(spark, path, newest + 1, {"batch": batch_id, "buckets": buckets, "keys": keys, "files": files,
                                     "schema": schema.jsonValue()})
    remove_path(spark, stage)
    _clean(spark, path, {newest + 1} | {n for n, _ in known[-1:]})


def _clean(spark: SparkSession, path: str, keep: set[int]) -> None:
    """Remove the versions not in ``keep``, and the data that no kept one names."""
    held = {f for n, m in versions(spark, path) if n in keep for f in m["files"].values()}
    for n in _manifests(spark, path):
        if n not in keep:
            remove_path(spark, f"{path}/versions/{n}.json")
    fs, p = _fs(spark, f"{path}/data")
    for folder in fs.listStatus(p) if fs.exists(p) else []:
        name = f"data/{folder.getPath().getName()}"
        if not any(f.startswith(name + "/") for f in held):
            remove_path(spark, f"{path}/{name}")
            continue
        for b in fs.listStatus(folder.getPath()):
            child = b.getPath().getName()
            if child.startswith(f"{_BUCKET}=") and f"{name}/{child}" not in held:
                remove_path(spark, f"{path}/{name}/{child}")


def table(spark: SparkSession, path: str) -> DataFrame:
    """The table as of its newest version, without its bookkeeping columns."""
    known = versions(spark, path)
    if not known:
        raise FileNotFoundError(f"no keyed table at {path}")
    return _rows(spark, path, known[-1][1]).drop(*ARRIVAL)
