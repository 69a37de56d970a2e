"""Exact duplicates: 128-bit content hash, smallest id kept, bytes compared.

Texts are equal when identical after each run of ASCII white space is one space.
1. Hash every text; per hash, count the rows and take the smallest id (combined
   before the shuffle, so a hot text costs one entry per task).
2. Only rows of hashes that occur twice meet the text of their hash's first row,
   and the bytes are compared.  Texts that differ from it though they share the
   hash are grouped by their bytes.
3. Per (hash, differing text or null): the smallest id and the number of rows.

Joins are on the hash.  Both sides are shuffled for the join alone (the small side
loses its known partitioning first, as a side that is already partitioned by the hash
would keep adaptive skew handling from splitting the other), so a hot text's rows are split.

Defined cases: null text counts as empty; a null id is larger than any other; rows
that share the smallest id of their group are all marked kept; an empty table gives
an empty result; very long texts are hashed and compared as whole values, one at a time;
other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._util import anew, cut

SPACE = r"[\x20\x09-\x0D]+"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def exact_groups(docs: DataFrame, digest=F.md5) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 per row of ``docs`` (doc_id, text).

    ``digest``: the content hash (128 bits by default; tests pass a weak one).
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), normalised(F.col("text")).alias("norm"))
    base = base.withColumn("h", F.unhex(digest(F.col("norm").cast("binary"))))
    # one light row per document; what is said about texts later is joined to it
    rows = cut(base.select("doc_id", "h", F.unhex(F.sha2("norm", 256)).alias("sha")))
    first = rows.groupBy("h").agg(F.min("doc_id").alias("first"), F.count("*").alias("n"))
    again = cut(first.where("n > 1"))
    # the texts of hashes that occur twice, against the text of the first row
    dup = cut(base.join(anew(again.select("h", "first")), "h"))
    model = dup.where("doc_id <=> first").groupBy("h").agg(F.min("norm").alias("model"))
    odd = dup.join(anew(cut(model)), "h").where(F.col("norm") != F.col("model"))
    odd = cut(odd.select("h", "doc_id", F.struct("norm").alias("other")))
    # rows that differ from their hash's first text: groups by bytes
    split = odd.groupBy("h", "other").agg(F.min("doc_id").alias("keep_id"), F.count("*").alias("size"))
    lost = odd.groupBy("h").agg(F.count("*").alias("moved"))
    out = (rows.join(anew(again.join(lost, "h", "left")), "h", "left")
           .select("doc_id", "h", "sha",
                   F.when(F.col("n").isNull(), F.col("doc_id")).otherwise(F.col("first")).alias("keep_id"),
                   (F.coalesce("n", F.lit(1)) - F.coalesce("moved", F.lit(0))).alias("group_size")))
    differs = odd.join(split, ["h", "other"]).select(
        "h", "doc_id", F.unhex(F.sha2("other.norm", 256)).alias("sha"),
        F.col("keep_id").alias("k2"), F.col("size").alias("s2")).distinct()
    out = (out.alias("o").join(differs.alias("d"),
                               F.col("o.h").eqNullSafe(F.col("d.h")) & F.col("o.doc_id").eqNullSafe(F.col("d.doc_id"))
                               & F.col("o.sha").eqNullSafe(F.col("d.sha")), "left")
           .select("o.doc_id", F.when(F.col("s2").isNotNull(), F.col("k2")).otherwise(F.col("keep_id")).alias("keep_id"),
                   F.coalesce("s2", "group_size").alias("group_size"), "o.sha"))
    return out.select(
        "doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))
