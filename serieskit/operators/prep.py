"""Feature preparation per group: clip, fill, scale. Only the small parameter tables reach the driver."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.config import BASE_FEATURES, SPREAD_FEATURE, SPREAD_MISSING_LIMIT
from serieskit.operators.ordered import exact_quantiles
from serieskit.session import materialize


# A parameter table up to this many rows goes through the driver; a larger one is stored instead.
SETTLED_ROWS = 50_000


def settled(df: DataFrame) -> DataFrame:
    """A parameter table (groups x features rows) computed once: a local relation, or a stored table if it is large.

    A local one is sent to all tasks where rows meet it, since a shuffle by group would give a task all rows of a large group.
    """
    rows = df.limit(SETTLED_ROWS + 1).collect()
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)) if len(rows) <= SETTLED_ROWS else materialize(df)


def long_form(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    cells = ", ".join(f"'{f}', cast(`{f}` as double)" for f in features)
    return df.select(*by, F.expr(f"stack({len(features)}, {cells}) as (feature, value)"))


def _beside(table: DataFrame, by: Sequence[str], features: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Rows (by, feature, values) as one row per group with columns ``_<feature>_<value>``."""
    wide = [F.max(F.when(F.col("feature") == f, F.col(v))).alias(f"_{f}_{v}") for f in features for v in values]
    return table.groupBy(*by).agg(*wide)


def missing_share(df: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(F.col(column).isNull().cast("double")).alias("missing_fraction"))


def clip_bounds(df: DataFrame, features: Sequence[str], q: float, by: Sequence[str]) -> DataFrame:
    return exact_quantiles(long_form(df, features, by), [*by, "feature"], "value", {"lower": q, "upper": 1 - q})


def clip(df: DataFrame, bounds: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Features held inside their bounds, and whether any was outside. Missing stays missing."""
    joined = df.join(_beside(bounds, by, features, ["lower", "upper"]), list(by), "left")
    flag, held = F.lit(False), {}
    for f in features:
        x, low, high = F.col(f), F.col(f"_{f}_lower"), F.col(f"_{f}_upper")
        flag = flag | F.coalesce((x < low) | (x > high), F.lit(False))
        held[f] = F.when(x < low, low).when(x > high, high).otherwise(x)
    out = joined.withColumn("profile_was_clipped", flag).withColumns(held)
    return out.select(*df.columns, "profile_was_clipped")


def impute_median(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    medians = settled(exact_quantiles(long_form(df, features, by), [*by, "feature"], "value", {"median": 0.5}))
    joined = df.join(_beside(medians, by, features, ["median"]), list(by), "left")
    return joined.withColumns({f: F.coalesce(f, f"_{f}_median") for f in features}).select(*df.columns)


def scale_width(value: Column) -> Column:
    """Population deviation to divide by; NULL where the variance is no more than rounding noise."""
    n, mean, variance = F.count(value), F.avg(value), F.var_pop(value)
    eps = float(np.finfo(float).eps)
    noise = n * F.lit(eps) * variance + F.pow(n * mean * F.lit(eps), F.lit(2.0))
    return F.when(variance > noise, F.sqrt(variance))


def scaled_value(x: Column, mean: Column, width: Column) -> Column:
    """Centred and scaled; exactly 0 for a constant feature, so its noise is not blown up later."""
    return F.when(width.isNull(), x * 0.0).otherwise((x - mean) / width)


def moments(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    return long_form(df, features, by).groupBy(*by, "feature").agg(
        F.avg("value").alias("mean"), scale_width(F.col("value")).alias("deviation")
    )


def standardize(df: DataFrame, features: Sequence[str], by: Sequence[str]) -> DataFrame:
    """Mean 0 and population deviation 1 per group; a constant feature is only centred."""
    table = settled(moments(df, features, by))
    joined = df.join(_beside(table, by, features, ["mean", "deviation"]), list(by), "left")
    scaled = {}
    for f in features:
        scaled[f] = scaled_value(F.col(f), F.col(f"_{f}_mean"), F.col(f"_{f}_deviation"))
    return joined.withColumns(scaled).select(*df.columns)


def use_spread(profiles: DataFrame, by: Sequence[str]) -> DataFrame:
    """Per group whether the spread feature is known often enough to be used."""
    shares = settled(missing_share(profiles, SPREAD_FEATURE, by))
    return shares.withColumn("uses_spread", F.col("missing_fraction") <= SPREAD_MISSING_LIMIT)


FEATURES = (*BASE_FEATURES, SPREAD_FEATURE)


def _work_columns(profiles: DataFrame, used: DataFrame, by: Sequence[str]) -> DataFrame:
    """Copies of the features as ``_w_<feature>``; the spread is 0 for groups that do not use it."""
    frame = profiles.join(used.select(*by, "uses_spread"), list(by), "left")
    spread = F.when(F.col("uses_spread"), F.col(SPREAD_FEATURE)).otherwise(F.lit(0.0))
    return frame.withColumns({f"_w_{f}": spread if f == SPREAD_FEATURE else F.col(f) for f in FEATURES}).drop("uses_spread")


def fit_preparation(profiles: DataFrame, by: Sequence[str], q: float) -> DataFrame:
    """Per group and feature: clip bounds, median to fill with, mean and deviation, and whether it is used at all."""
    by, work = list(by), [f"_w_{f}" for f in FEATURES]
    used = use_spread(profiles, by)
    frame = _work_columns(profiles, used, by)
    key = [*by, "feature"]
    limits = None
    if q:
        limits = settled(clip_bounds(frame, work, q, by))
        frame = clip(frame, limits, work, by)
    medians = settled(exact_quantiles(long_form(frame, work, by), key, "value", {"median": 0.5}))
    beside = frame.join(_beside(medians, by, work, ["median"]), by, "left")
    filled = beside.withColumns({w: F.coalesce(w, f"_{w}_median") for w in work})
    table = medians.join(moments(filled, work, by), key, "left")
    none = F.lit(None).cast("double")
    table = table.join(limits, key, "left") if limits is not None else table.withColumns({"lower": none, "upper": none})
    table = table.join(used.select(*by, "uses_spread"), by, "left").withColumn("feature", F.substring("feature", 4, 1000))
    is_used = (F.col("feature") != SPREAD_FEATURE) | F.col("uses_spread")
    return settled(table.select(*key, "lower", "upper", "median", "mean", "deviation", is_used.alias("is_used")))


def apply_preparation(profiles: DataFrame, fitted: DataFrame, by: Sequence[str]) -> DataFrame:
    """Profiles with the scaled features as ``x`` and the clip flag, by parameters fitted here or before."""
    by = list(by)
    beside = fitted.withColumn("is_used", F.col("is_used").cast("int"))
    values = ["lower", "upper", "median", "mean", "deviation", "is_used"]
    joined = profiles.join(_beside(beside, by, FEATURES, values), by, "left")
    flag, x = F.lit(False), []
    for f in FEATURES:
        low, high, median, mean, width, used = (F.col(f"_{f}_{v}") for v in values)
        raw = F.when(used == 1, F.col(f)).otherwise(F.lit(0.0))
        flag = flag | F.coalesce((raw < low) | (raw > high), F.lit(False))
        held = F.coalesce(F.when(raw < low, low).when(raw > high, high).otherwise(raw), median)
        x.append(F.coalesce(scaled_value(held, mean, width), F.lit(0.0)))
    return joined.select(*profiles.columns, flag.alias("profile_was_clipped"), F.array(*x).alias("x"))


def feature_matrix(profiles: DataFrame, by: Sequence[str], q: float, fitted: DataFrame | None = None) -> DataFrame:
    """Profiles with the scaled features as ``x`` and the clip flag.

    Where the spread is missing too often its component is 0 for the whole group, which
    leaves all distances as if it were absent.
    """
    return apply_preparation(profiles, fit_preparation(profiles, by, q) if fitted is None else fitted, by)


def bin_borders(df: DataFrame, features: Sequence[str], bins: int, by: Sequence[str] = ()) -> DataFrame:
    """Inner borders at equal shares of the known values, one array per feature."""
    names = {f"b{i}": i / bins for i in range(1, bins)}
    found = exact_quantiles(long_form(df, features, by), [*by, "feature"], "value", names)
    return found.select(*by, "feature", F.array_sort(F.array_distinct(F.array(*names))).alias("borders"))


def bin_of(value: Column, borders: Sequence[float]) -> Column:
    """Number of borders at or below the value; missing values get the bin after the last."""
    level = F.lit(0)
    for b in borders:
        level = level + (value >= F.lit(float(b))).cast("int")
    return F.when(value.isNull(), F.lit(len(borders) + 1)).otherwise(level)


def bin_among(value: Column, borders: Column) -> Column:
    """The same with the borders in an array column."""
    return F.when(value.isNull(), F.size(borders) + 1).otherwise(F.size(F.filter(borders, lambda b: value >= b)))
