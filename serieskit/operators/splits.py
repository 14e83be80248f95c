"""Chronological splits, labels and backtest folds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from serieskit.config import DemandConfig
from serieskit.functions import scalars as S
from serieskit.operators.grid import CHUNK
from serieskit.operators.ordered import exact_quantiles, values_at

SPLITS = ("train", "validation", "test")


def split_bounds(frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    """First slot of validation and of test, by row position in time order."""
    return values_at(
        frame, [], "slot",
        {
            "validation_start": lambda n: F.floor(n * F.lit(cfg.train_fraction)),
            "test_start": lambda n: F.floor(n * F.lit(cfg.validation_fraction)),
        },
        range_of=F.floor(F.col("slot") / CHUNK),
    ).drop("_n_total")


def split_label(vstart: Column, tstart: Column, cfg: DemandConfig) -> Column:
    """Split of a row; NULL for the rows whose look-ahead would reach into the next split."""
    step = cfg.step_seconds
    end = F.col("slot") * step + cfg.embargo_seconds
    slot = F.col("slot")
    return (
        F.when(end < vstart * step, F.lit("train"))
        .when((slot >= vstart) & (end < tstart * step), F.lit("validation"))
        .when(slot >= tstart, F.lit("test"))
    )


def time_split(frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Add ``split``. The two border slots are looked up first, so ``frame`` should be stored."""
    v, t = split_bounds(frame, cfg).first() or (None, None)
    return frame.withColumn("split", split_label(F.lit(v).cast("bigint"), F.lit(t).cast("bigint"), cfg))


def train_quantiles(frame: DataFrame, probabilities: dict[str, float], value: str = "demand_now") -> dict[str, float]:
    """Exact quantiles of the train rows as plain numbers."""
    found = exact_quantiles(frame.where(F.col("split") == "train"), [], value, probabilities).first()
    return {name: found[name] if found else None for name in probabilities}


def label_target(frame: DataFrame, cfg: DemandConfig) -> DataFrame:
    """Target: the look-ahead maximum reaches the peak threshold learnt from train rows only."""
    threshold = train_quantiles(frame, {"threshold": cfg.peak_quantile})["threshold"]
    marked = frame.withColumn("threshold", F.lit(threshold).cast("double"))
    return marked.withColumn("target", (F.col("future_hour_max") >= F.col("threshold")).cast("int"))


def split_summary(labelled: DataFrame) -> DataFrame:
    return labelled.where(F.col("split").isNotNull()).groupBy("split").agg(
        F.count("*").alias("rows"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
        F.avg(F.col("target").cast("double")).alias("peak_fraction"),
        F.count_distinct("target").alias("classes"),
    )


def class_weights(labelled: DataFrame) -> DataFrame:
    """Balanced weight per class: rows / (2 * rows of the class)."""
    counts = labelled.groupBy("target").agg(F.count("*").alias("rows"))
    total = counts.agg(F.sum("rows")).scalar()
    return counts.withColumn("weight", total / (F.lit(2.0) * F.col("rows")))


def backtest_parts(train: DataFrame, cfg: DemandConfig, months_back=(12, 6, 0), check_days: int = 90, tune_days: int = 30) -> DataFrame:
    """Rows of each fold with their part: fit, tuning or evaluation. A row appears once per fold at most."""
    last = train.agg(F.max("timestamp").cast("date")).first()[0]
    marked = train.withColumn("_last", F.lit(last).cast("date"))
    ts = F.col("timestamp")
    ready = ts + F.make_dt_interval(secs=F.lit(cfg.embargo_seconds).cast("decimal(18,6)"))
    folds = []
    for fold, months in enumerate(months_back):
        end = F.add_months("_last", -months)
        check = F.date_sub(end, check_days)
        tune = F.date_sub(end, check_days + tune_days)
        begin, middle, stop = (d.cast("timestamp_ntz") for d in (tune, check, end))
        part = (
            F.when(ready < begin, "fit")
            .when((ts >= begin) & (ready < middle), "tuning")
            .when((ts >= middle) & (ready <= stop), "evaluation")
        )
        folds.append(F.struct(F.lit(fold).alias("fold"), part.alias("part"), check.alias("evaluation_start"), end.alias("evaluation_end")))
    return marked.select("*", F.inline(F.array(*folds))).where(F.col("part").isNotNull()).drop("_last")


def backtest_summary(parts: DataFrame) -> DataFrame:
    return parts.groupBy("fold", "part").agg(
        F.count("*").alias("rows"),
        F.min("evaluation_start").alias("evaluation_start"),
        F.min("evaluation_end").alias("evaluation_end"),
        F.min("timestamp").alias("start"),
        F.max("timestamp").alias("end"),
    )


def outlier_fences(labelled: DataFrame) -> tuple[float, float]:
    q = train_quantiles(labelled, {"q1": 0.25, "q3": 0.75})
    width = 1.5 * (q["q3"] - q["q1"])
    return q["q1"] - width, q["q3"] + width


def flag_outliers(changes: DataFrame, fences: tuple[float, float], cfg: DemandConfig) -> DataFrame:
    """Grid rows outside the train fences or with a large one-step change; flagged, not removed."""
    outside = F.coalesce((F.col("demand") < fences[0]) | (F.col("demand") > fences[1]), F.lit(False))
    jump = F.coalesce(F.col("absolute_change_fraction") > F.lit(cfg.jump_fraction), F.lit(False))
    return changes.withColumn("outside_training_IQR_fences", outside).where(F.col("outside_training_IQR_fences") | jump)


def outlier_audit(flags: DataFrame, fences: tuple[float, float]) -> DataFrame:
    return flags.agg(F.count("*").alias("flagged_grid_rows")).select(
        F.lit(fences[0]).alias("training_IQR_lower"), F.lit(fences[1]).alias("training_IQR_upper"), "flagged_grid_rows",
        F.lit("flag only; retain genuine peaks").alias("action"),
    )


def quarters(frame: DataFrame) -> DataFrame:
    return frame.withColumn("period", S.quarter_label(F.col("timestamp")))
