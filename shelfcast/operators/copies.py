"""Equal rows merged into a count, and a count turned back into rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

BLOCK = 4096


def merge_copies(df: DataFrame) -> DataFrame:
    """Distinct rows with their number of ``copies``, merged before the shuffle as well as after."""
    return df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("copies"))


def repeat_copies(df: DataFrame) -> DataFrame:
    """Each row ``copies`` times (once if NULL), numbered by ``copy`` from 0.

    Works in blocks, so that no array grows with the count.
    """
    copies = F.coalesce("copies", F.lit(1).cast("long"))
    blocks = df.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1, F.lit(BLOCK).cast("long"))))
    last = F.least(copies, F.col("block") + BLOCK) - 1
    return blocks.withColumn("copy", F.explode(F.sequence("block", last))).drop("block", "copies")
