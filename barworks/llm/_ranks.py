"""Positions in a total order over all rows, without one task that sees them all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ._util import cut


def positions(df: DataFrame, *order: Column, name: str = "position") -> DataFrame:
    """``df`` with each row's place (long, from 0) in the order of ``order``.

    The rows are dealt by ranges of ``order`` and sorted within each part; the parts are
    written, so that a row keeps its part.  A row's place is its place in its part plus
    the sizes of the parts before: one number for each part is all that is looked at as
    a whole, and that is what is sent to every task.  ``order`` has to end in a column
    that tells equal rows apart, or else equal rows stay in one part.
    """
    parts = cut(df.repartitionByRange(*order).sortWithinPartitions(*order))
    tagged = parts.withColumns({
        "_part": F.spark_partition_id(),
        # the low 33 bits count the rows of a part
        "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = parts.groupBy(F.spark_partition_id().alias("_part")).agg(F.count("*").alias("_size"))
    starts = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    return (tagged.join(F.broadcast(starts), "_part")
            .withColumn(name, F.col("_start") + F.col("_at")).drop("_part", "_at", "_start"))
