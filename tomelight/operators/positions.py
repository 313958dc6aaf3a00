"""Global positions without sorting a whole table in one task.

A running total over a long key is split by the key's high bits, so that each
window group holds at most 2^20 distinct keys (2^22 at the upper two levels)
whatever the distribution of the keys. Only small totals move between levels.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LEVELS = (20, 42)


def running_start(df: DataFrame, key: str, size: str, out: str = "start") -> DataFrame:
    """Add the sum of ``size`` over all rows with a smaller ``key``.

    ``key`` must be a long column without duplicates.
    """

    def before(window):
        total = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
        return F.coalesce(total, F.lit(0)).cast("long")

    low, high = LEVELS
    rows = df.withColumn("_p1", F.shiftright(key, low)).withColumn("_n", F.col(size).cast("long"))
    mid = (
        rows.groupBy("_p1")
        .agg(F.sum("_n").alias("_n"))
        .withColumn("_p2", F.shiftright("_p1", high - low))
    )
    top = mid.groupBy("_p2").agg(F.sum("_n").alias("_n"))
    top = top.select("_p2", before(Window.orderBy("_p2")).alias("_top"))
    mid = mid.join(top, "_p2").select(
        "_p1", (F.col("_top") + before(Window.partitionBy("_p2").orderBy("_p1"))).alias("_mid")
    )
    return (
        rows.join(mid, "_p1")
        .withColumn(out, F.col("_mid") + before(Window.partitionBy("_p1").orderBy(key)))
        .drop("_p1", "_n", "_mid")
    )


def position_index(df: DataFrame, key: str, out: str = "pos") -> DataFrame:
    """Zero-based position of each row in ascending ``key`` order."""
    return running_start(df.withColumn("_one", F.lit(1)), key, "_one", out).drop("_one")
