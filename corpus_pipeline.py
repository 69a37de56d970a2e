"""The corpus pipeline: five of the text operators, one after the other.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes it as
Parquet to the shared checkpoint folder and reads it again as the next stage's docs.
All stages but the last return the columns of ``documents``, and keep whole rows:

1. quality_classifier: documents that the ordinal model rejects go;
2. exact_dedup: of equal texts the row with the smallest id stays;
3. ngram_jaccard_join: of each group of similar texts the smallest id stays;
4. benchmark_decontamination: documents that hold a benchmark passage go;
5. sentencepiece: the pieces of every text are added (n_pieces, ids, round_trip).

Rows with a null id can't be named as a member of a group: stage 3 keeps them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barworks.llm import decontamination, exact_dedup, jaccard_join, pieces, quality_classifier
from barworks.llm.queries import PIECES, vocabulary
from barworks.session import checkpoint_dir

#: The classifier, the similarity join and the retrieval can't be written as SQL.
ORACLE_SQL = None

#: Near copies share this percentage of their shingles of so many words (op6 has its own values).
NEAR_WORDS, NEAR_PERCENT = 5, 80


def _marked(docs: DataFrame) -> DataFrame:
    """doc_id, text and the whole row, so that added columns can't clash with the row's."""
    return docs.select(F.struct(*docs.columns).alias("row"), "doc_id", "text")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality_classifier.graded(_marked(docs), labels).where("kept").select("row.*")


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    gone = exact_dedup.exact_groups(docs).where("not kept").select("doc_id", "text_sha256").distinct()
    gone = gone.select(F.col("doc_id").alias("gone_id"), F.col("text_sha256").alias("gone_text"))
    rows = _marked(docs).withColumn("sha", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    return rows.join(gone, rows["doc_id"].eqNullSafe(gone["gone_id"]) & (rows["sha"] == gone["gone_text"]),
                     "left_anti").select("row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = jaccard_join.similar_components(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = found.where("component_id <> doc_id").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")


def clean(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.leaks(_marked(docs), benchmark).where(F.size("leaks") == 0).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pieces.encoded(docs, vocabulary(PIECES))


STAGES = [
    ("quality_classifier", quality),
    ("exact_dedup", exact),
    ("ngram_jaccard_join", near),
    ("benchmark_decontamination", clean),
    ("sentencepiece", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the stages' tables go when the session ends."""
    folder = f"{checkpoint_dir(spark)}/corpus-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(path)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return docs
