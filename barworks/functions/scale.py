"""The size of what a plan reads, for choices between a plain plan and one that scales.

Both plans of such a choice give the same rows.  The plain one may hold one key's rows in
one task, which is right while the largest input is small; beyond that the other one cuts
every key's rows into bounded parts.  The size is that of the files, known before any job.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: Bytes of the largest input up to which one key's rows may meet in one task.
SMALL_INPUT = 64 << 20
SMALL_CONF = "spark.barworks.small.input"


def largest_input(df: DataFrame) -> int:
    """Bytes of the largest leaf of the plan; an input of unknown size counts as very large."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    sizes = [leaves.apply(i).stats().sizeInBytes() for i in range(leaves.size())]
    return max((int(str(s)) for s in sizes), default=0)


def is_small(df: DataFrame) -> bool:
    limit = int(df.sparkSession.conf.get(SMALL_CONF, str(SMALL_INPUT)))
    return limit > 0 and largest_input(df) <= limit
