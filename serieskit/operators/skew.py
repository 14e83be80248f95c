"""Routing of oversized groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

# A group counts as hot from this many rows, however many rows there are in all.
HOT_ROWS = 200_000


def split_hot(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame | None]:
    """Split ``df`` into (ordinary, hot) rows by the size of their key group.

    One small job counts rows per 64-bit hash of the keys, so it shuffles two numbers per
    group. Without a hot group ``df`` comes back as it is, with None. A hash collision can
    only send a small group the hot way, which gives the same result.
    """
    hashed = df.withColumn("_group", F.xxhash64(*keys))
    sizes = hashed.groupBy("_group").agg(F.count("*").alias("_rows"))
    if (sizes.agg(F.max("_rows")).first()[0] or 0) <= hot_rows:
        return df, None
    # Hot groups may be many, so they are matched by a shuffled join, which Spark can split where one is large.
    hot = sizes.where(F.col("_rows") > hot_rows).select("_group")
    return hashed.join(hot, "_group", "left_anti").drop("_group"), hashed.join(hot, "_group", "left_semi").drop("_group")
