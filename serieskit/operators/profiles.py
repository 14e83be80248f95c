"""Behaviour profile per series.

A series has at most one row per calendar day, so a window over one series is bounded by
the length of the date range, however many rows a commodity holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window as W, functions as F

from serieskit.config import COVERAGE_CUTOFFS, DROP_DEFINITIONS, SERIES_KEYS, PriceConfig
from serieskit.functions import scalars as S

SERIES = ["commodity", *SERIES_KEYS]


def consecutive_returns(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Day gap to the previous observation, and the relative change where the gap is one day."""
    order = W.partitionBy(*keys).orderBy("date")
    before = F.lag("price").over(order)
    return panel.withColumn("day_gap", F.datediff("date", F.lag("date").over(order))).withColumn(
        "daily_return", F.when(F.col("day_gap") == 1, S.ratio(F.col("price"), before) - 1)
    ).withColumn("_same", F.coalesce((F.col("day_gap") == 1) & (F.col("price") == before), F.lit(False)))


def stale_runs(panel: DataFrame, keys: Sequence[str] = SERIES, minimum: int = 3) -> DataFrame:
    """Number the runs of equal prices on consecutive days; a row from ``minimum`` on is stale."""
    order = W.partitionBy(*keys).orderBy("date")
    runs = consecutive_returns(panel, keys).withColumn(
        "run_id", F.sum((~F.col("_same")).cast("bigint")).over(order.rowsBetween(W.unboundedPreceding, 0))
    )
    place = F.row_number().over(W.partitionBy(*keys, "run_id").orderBy("date"))
    return runs.withColumn("run_position", place.cast("bigint")).withColumn("is_stale", F.col("run_position") >= minimum).drop("_same")


def window_days(cfg: PriceConfig):
    return F.datediff(F.lit(cfg.end_date).cast("date"), F.lit(cfg.start_date).cast("date")) + 1


def profile_features(panel: DataFrame, cfg: PriceConfig, keys: Sequence[str] = SERIES) -> DataFrame:
    """All measures of a series from one exchange on the series keys."""
    keys = list(keys)
    month = W.partitionBy(*keys, "_month")
    rows = (
        stale_runs(panel, keys)
        .withColumn("_month", F.trunc("date", "MM"))
        .withColumn("_monthly", F.when(F.row_number().over(month.orderBy("date")) == 1, F.avg("price").over(month)))
    )
    price, ret = F.col("price"), F.col("daily_return")
    years = range(int(cfg.start_date[:4]), int(cfg.end_date[:4]) + 1)
    per_year = [F.sum((F.year("date") == y).cast("bigint")) for y in years]
    return rows.groupBy(*keys).agg(
        F.count("*").alias("observations"),
        (F.count("*").cast("double") / window_days(cfg)).alias("calendar_coverage"),
        F.count("_monthly").alias("months_observed"),
        (F.least(*per_year) if len(per_year) > 1 else per_year[0]).alias("min_year_observations"),
        F.count(ret).alias("valid_daily_returns"),
        F.avg(F.col("is_stale").cast("double")).alias("stale_price_fraction"),
        (F.sum(F.coalesce((F.abs(ret) > 1).cast("double"), F.lit(0.0))) / F.greatest(F.count(ret), F.lit(1))).alias("large_daily_change_fraction"),
        F.bool_or("dominant_variety_switch").alias("dominant_variety_switch"),
        F.avg(price).alias("mean_price"),
        F.log1p(F.avg(price)).alias("log_mean_price"),
        (F.stddev_samp(price) / F.avg(price)).alias("price_cv"),
        F.stddev_samp(ret).alias("return_volatility"),
        F.avg((ret <= F.lit(-float(cfg.drop_fraction))).cast("double")).alias("sharp_drop_fraction"),
        (F.stddev_pop("_monthly") / F.avg("_monthly")).alias("monthly_variation_cv"),
        F.median("relative_spread").alias("median_relative_spread"),
    )


def with_eligibility(profiles: DataFrame, cfg: PriceConfig) -> DataFrame:
    rules = [
        (F.col("observations") < cfg.min_observations, "few observations"),
        (F.col("calendar_coverage") < F.lit(float(cfg.min_calendar_coverage)), "low calendar coverage"),
        (F.col("months_observed") < cfg.min_months, "few represented months"),
        (F.col("min_year_observations") < cfg.min_year_observations, "uneven year coverage"),
        (F.col("valid_daily_returns") < cfg.min_daily_returns, "few consecutive-day changes"),
    ]
    return profiles.withColumn("eligibility_reason", S.reasons(rules))


def make_profiles(panel: DataFrame, cfg: PriceConfig, keys: Sequence[str] = SERIES) -> tuple[DataFrame, DataFrame]:
    """(eligible, excluded) profiles of one schema."""
    judged = with_eligibility(profile_features(panel, cfg, keys), cfg)
    fine = F.col("eligibility_reason") == "eligible"
    return judged.where(fine), judged.where(~fine)


def whatif_daily_drops(panel: DataFrame, eligible: DataFrame, keys: Sequence[str] = SERIES, drops: Sequence[float] = DROP_DEFINITIONS, by: Sequence[str] = ("commodity",)) -> DataFrame:
    """Share of valid daily changes at or below each drop, over eligible series."""
    keys = list(keys)
    changes = consecutive_returns(panel, keys).join(eligible.select(*keys), keys, "left_semi")
    ret = F.col("daily_return")
    shares = [F.avg((ret <= F.lit(-d)).cast("double")).alias(f"s{i}") for i, d in enumerate(drops)]
    wide = changes.groupBy(*by).agg(F.count(ret).alias("valid_daily_changes"), *shares)
    cells = ", ".join(f"'{d:.0%} consecutive-day decline', s{i}" for i, d in enumerate(drops))
    stacked = F.expr(f"stack({len(drops)}, {cells}) as (drop_definition, event_fraction)")
    return wide.select(*by, stacked, "valid_daily_changes").withColumn("groups_refitted", F.lit(False))


def whatif_coverage(eligible: DataFrame, cutoffs: Sequence[float] = COVERAGE_CUTOFFS, by: Sequence[str] = ("commodity",)) -> DataFrame:
    counts = [F.sum((F.col("calendar_coverage") >= F.lit(c)).cast("bigint")).alias(f"c{i}") for i, c in enumerate(cutoffs)]
    cells = ", ".join(f"double({c}), c{i}" for i, c in enumerate(cutoffs))
    stacked = F.expr(f"stack({len(cutoffs)}, {cells}) as (minimum_calendar_coverage, currently_eligible_profiles_retained)")
    return eligible.groupBy(*by).agg(*counts).select(*by, stacked).withColumn("groups_refitted", F.lit(False))


def extreme_profiles(profiles: DataFrame, n: int = 10, keys: Sequence[str] = SERIES) -> DataFrame:
    """The ``n`` most volatile series of each commodity; the top-k is cut before the shuffle."""
    order = W.partitionBy(keys[0]).orderBy(F.col("return_volatility").desc_nulls_last(), *keys[1:])
    known = profiles.where(F.col("return_volatility").isNotNull())
    return known.withColumn("position", F.row_number().over(order)).where(F.col("position") <= n)


def monthly_index(panel: DataFrame, keys: Sequence[str] = SERIES) -> DataFrame:
    """Monthly mean over the mean of all monthly means, per series; empty months stay, without a value."""
    keys = list(keys)
    months = panel.groupBy(*keys, F.trunc("date", "MM").alias("month")).agg(F.avg("price").alias("monthly_mean"))
    ends = months.groupBy(*keys).agg(F.min("month").alias("_a"), F.max("month").alias("_b"))
    every = ends.select(*keys, F.explode(F.sequence("_a", "_b", F.expr("interval 1 month"))).alias("month"))
    full = every.join(months, [*keys, "month"], "left")
    return full.withColumn("monthly_index", S.ratio(F.col("monthly_mean"), F.avg("monthly_mean").over(W.partitionBy(*keys))))
