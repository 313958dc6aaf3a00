"""Joins that hold when one key has a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def is_small(df: DataFrame, max_rows: int) -> bool:
    """Whether a table has at most ``max_rows`` rows.

    Partitions are read a few at a time and no further than that.
    """
    return len(df.select(F.lit(1)).take(max_rows + 1)) <= max_rows


def lookup(left: DataFrame, right: DataFrame, key: str, max_broadcast_rows: int = 50_000):
    """Join to a short list such as classes; broadcast when its size allows."""
    short = is_small(right, max_broadcast_rows)
    return left.join(F.broadcast(right) if short else right, key)


def salted_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    spread: str,
    salts: int | None = None,
    hot_rows: int = 1_000_000,
    max_broadcast_rows: int = 50_000,
    how: str = "left",
) -> DataFrame:
    """Join on a key that may be very frequent on the left and is unique on the right.

    A right side of checked size is broadcast. Otherwise keys with ``hot_rows``
    or more left rows are split by the left row's ``spread`` column into as many
    parts as keep a part near ``hot_rows`` (or into ``salts`` parts), and only their
    right rows are repeated, once per part. There are at most left rows /
    ``hot_rows`` such keys; their list is broadcast while its checked size allows.
    """
    if is_small(right, max_broadcast_rows):
        return left.join(F.broadcast(right), key, how)
    counted = F.ceil(F.col("_n") / hot_rows) + 1 if salts is None else F.lit(salts)
    hot = (
        left.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter((F.col("_n") >= hot_rows) & F.col(key).isNotNull())
        .select(key, counted.cast("int").alias("_hot"))
    )
    if is_small(hot, max_broadcast_rows):
        hot = F.broadcast(hot)
    salts = F.coalesce("_hot", F.lit(1))
    part = F.pmod(F.xxhash64(spread), salts).cast("int")
    parts = F.sequence(F.lit(0), salts - 1)
    return (
        left.join(hot, key, "left")
        .withColumn("_part", part)
        .drop("_hot")
        .join(
            right.join(hot, key, "left").withColumn("_part", F.explode(parts)).drop("_hot"),
            [key, "_part"],
            how,
        )
        .drop("_part")
    )
