"""Repeatable samples drawn by hash, exact in size."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from serieskit.functions import scalars as S
from serieskit.operators.ordered import levels_for, ranked
from serieskit.session import materialize



def _slice(order: Column, rows: int) -> Column:
    """Draws fill [0, 2^32) evenly, so equal slices of it are even value ranges, as many as the rows ask for."""
    return F.floor(order / 2 ** (32 - levels_for(rows)))


def hash_sample(df: DataFrame, by: Sequence[str], ident: str, size: Callable[[Column], Column], seed: object = 42) -> DataFrame:
    """Exactly ``size(group size)`` rows per group, without replacement."""
    drawn = materialize(df.withColumn("_draw", S.draw(seed, F.col(ident))))
    picked = ranked(drawn, by, "_draw", [ident], size, _slice(F.col("_draw"), drawn.count()))
    return picked.drop("_draw", "position", "size")


def stratified_sample(df: DataFrame, by: Sequence[str], label: str, ident: str, limit: int, floor: int = 2, seed: int = 42) -> DataFrame:
    """At most ``limit`` rows per group: ``floor`` of every label first, the rest by draw."""
    drawn = materialize(df.withColumn("_draw", S.draw(seed, F.col(ident))))
    place = F.row_number().over(W.partitionBy(*by, label).orderBy("_draw", ident))
    first = drawn.withColumn("_place", place).where(F.col("_place") <= floor).select(*by, ident, F.lit(2**32).alias("_lead"))
    ordered = drawn.join(first, [*by, ident], "left").withColumn("_order", F.col("_draw") - F.coalesce("_lead", F.lit(0)))
    picked = ranked(ordered, by, "_order", [ident], lambda n: F.lit(limit), _slice(F.col("_order"), drawn.count()))
    return picked.select(*df.columns)
