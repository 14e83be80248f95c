"""Evaluation of binary predictions, grouped by any columns, always from counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from serieskit.config import ALERT_CUTOFFS
from serieskit.functions import scalars as S
from serieskit.operators.ordered import running_totals
from serieskit.session import materialize
from serieskit.operators.splits import train_quantiles

COUNTS = ["TN", "FP", "FN", "TP"]
# The cutoff grid.
CUTOFF_LOW, CUTOFF_HIGH, CUTOFF_STEPS = 0.05, 0.95, 90
# End of fixed values.


def _cells(target: Column, prediction: Column) -> list[Column]:
    hit = {"TN": (0, 0), "FP": (0, 1), "FN": (1, 0), "TP": (1, 1)}
    return [
        F.coalesce(F.sum(((target == t) & (prediction == p)).cast("bigint")), F.lit(0)).alias(name)
        for name, (t, p) in hit.items()
    ]


def confusion_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return scored.groupBy(*by).agg(*_cells(F.col("target"), F.col("prediction")))


def rates() -> dict[str, Column]:
    """Rates from the four counts: undefined precision and F1 are 0, other undefined rates NULL."""
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    rows = tn + fp + fn + tp
    sensitivity, specificity = S.ratio(tp, tp + fn), S.ratio(tn, tn + fp)
    return {
        "rows": rows,
        "peak_fraction": S.ratio(tp + fn, rows),
        "accuracy": S.ratio(tp + tn, rows),
        "precision": F.coalesce(S.ratio(tp, tp + fp), F.lit(0.0)),
        "recall_sensitivity": sensitivity,
        "specificity": specificity,
        "f1": F.coalesce(S.ratio(2 * tp, 2 * tp + fp + fn), F.lit(0.0)),
        "balanced_accuracy": (sensitivity + specificity) / 2,
    }


def binary_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return confusion_counts(scored, by).withColumns(rates())


def score_counts(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score with the running sums below each score."""
    positive = F.col("target").cast("bigint")
    per_score = scored.groupBy(*by, "score").agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    return running_totals(per_score, by, "score", ["pos", "neg"])


def ranking_metrics(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """ROC-AUC (ties half) and average precision (ties one step); NULL with a single class."""
    c = score_counts(scored, by)
    pos, neg = F.col("pos"), F.col("neg")
    found = F.col("pos_total") - F.col("pos_before")
    called = found + F.col("neg_total") - F.col("neg_before")
    wins = pos.cast("double") * (F.col("neg_before") + neg / 2)
    steps = pos.cast("double") * found / called
    both = (F.max("pos_total") > 0) & (F.max("neg_total") > 0)
    return c.groupBy(*by).agg(
        F.when(both, F.sum(wins) / F.max("pos_total") / F.max("neg_total")).alias("roc_auc"),
        F.when(both, F.sum(steps) / F.max("pos_total")).alias("average_precision"),
    )


def full_metrics(scored: DataFrame, by: Sequence[str]) -> DataFrame:
    return binary_metrics(scored, by).join(ranking_metrics(scored, by), list(by), "left")


def roc_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    c = score_counts(scored, by)
    return c.select(
        *by, "score",
        S.ratio(F.col("neg_total") - F.col("neg_before"), F.col("neg_total")).alias("false_positive_rate"),
        S.ratio(F.col("pos_total") - F.col("pos_before"), F.col("pos_total")).alias("true_positive_rate"),
    )


def pr_points(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    c = score_counts(scored, by)
    found = F.col("pos_total") - F.col("pos_before")
    called = found + F.col("neg_total") - F.col("neg_before")
    return c.select(
        *by, "score", S.ratio(found, called).alias("precision"), S.ratio(found, F.col("pos_total")).alias("recall"),
        S.ratio(F.col("pos_total"), F.col("pos_total") + F.col("neg_total")).alias("prevalence"),
    )


def cutoff_value(i: Column) -> Column:
    return F.lit(CUTOFF_LOW) + i * F.lit((CUTOFF_HIGH - CUTOFF_LOW) / CUTOFF_STEPS)


def cutoffs_reached(score: Column) -> Column:
    """Number of cutoffs at or below the score; the guess is corrected against the true borders."""
    guess = F.floor((score - CUTOFF_LOW) / F.lit((CUTOFF_HIGH - CUTOFF_LOW) / CUTOFF_STEPS))
    exact = F.when(cutoff_value(guess + 1) <= score, guess + 1).when(cutoff_value(guess) > score, guess - 1).otherwise(guess)
    return F.least(F.greatest(exact + 1, F.lit(0)), F.lit(CUTOFF_STEPS + 1)).cast("bigint")


def cutoff_curve(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Metrics at each cutoff of the grid, from one pass over the scores."""
    by = list(by)
    positive = F.col("target").cast("bigint")
    binned = scored.groupBy(*by, cutoffs_reached(F.col("score")).alias("reached")).agg(F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg"))
    every = binned.select(*by).dropDuplicates() if by else binned.limit(1).select()
    grid = every.select(*by, F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(CUTOFF_STEPS + 1).cast("bigint"))).alias("reached"))
    full = grid.join(binned, [*by, "reached"], "left").fillna(0, ["pos", "neg"])
    above = W.partitionBy(*by).orderBy(F.col("reached").desc()).rowsBetween(W.unboundedPreceding, 0)
    whole = W.partitionBy(*by)
    counts = full.select(
        *by, "reached",
        F.sum("pos").over(above).alias("TP"), F.sum("neg").over(above).alias("FP"),
        F.sum("pos").over(whole).alias("_p"), F.sum("neg").over(whole).alias("_n"),
    ).where(F.col("reached") > 0)
    counts = counts.withColumns({"FN": F.col("_p") - F.col("TP"), "TN": F.col("_n") - F.col("FP"), "cutoff": cutoff_value(F.col("reached") - 1)})
    return counts.drop("_p", "_n", "reached").withColumns(rates())


def fit_cutoff(scored: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Cutoff with the best F1, the lowest one on ties."""
    curve = cutoff_curve(scored, by)
    best = F.max(F.struct("f1", (-F.col("cutoff")).alias("c"))).alias("best")
    return curve.groupBy(*by).agg(best).select(*by, (-F.col("best.c")).alias("cutoff"), F.col("best.f1").alias("f1"))


def whatif_cutoffs(scored: DataFrame, by: Sequence[str] = (), cutoffs: Sequence[float] = ALERT_CUTOFFS) -> DataFrame:
    """Metrics at a few fixed cutoffs; conditional sums, so rows are not repeated per cutoff."""
    wide = []
    for i, cut in enumerate(cutoffs):
        wide += [c.alias(f"{n}{i}") for n, c in zip(COUNTS, _cells(F.col("target"), (F.col("score") >= F.lit(float(cut))).cast("int")))]
    cells = ", ".join(f"double({cut}), TN{i}, FP{i}, FN{i}, TP{i}" for i, cut in enumerate(cutoffs))
    stacked = F.expr(f"stack({len(cutoffs)}, {cells}) as (probability_cutoff, TN, FP, FN, TP)")
    return scored.groupBy(*by).agg(*wide).select(*by, stacked).withColumns(rates())


def practical_error_rates(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    rows = F.col("TN") + F.col("FP") + F.col("FN") + F.col("TP")
    return counts.select(
        *by, rows.alias("rows"), "FP", "FN",
        S.ratio(1000 * F.col("FP"), rows).alias("false_alarms_per_1000_checks"),
        S.ratio(1000 * F.col("FN"), rows).alias("missed_peak_checks_per_1000_checks"),
    )


def example_predictions(scored: DataFrame, n: int = 3) -> DataFrame:
    """First ``n`` rows in time of each outcome; the cut happens before the shuffle."""
    outcome = (
        F.when((F.col("target") == 1) & (F.col("prediction") == 1), "correct warning")
        .when((F.col("target") == 0) & (F.col("prediction") == 0), "correct no warning")
        .when((F.col("target") == 0) & (F.col("prediction") == 1), "false alarm")
        .when((F.col("target") == 1) & (F.col("prediction") == 0), "missed peak")
    )
    place = F.row_number().over(W.partitionBy("outcome").orderBy("timestamp"))
    return scored.withColumn("outcome", outcome).withColumn("position", place).where(F.col("position") <= n)


def numbered_days(days: DataFrame) -> DataFrame:
    """Add ``index``, the place of a day among all, and their number ``n_days``.

    Days are numbered within their year; a year's own number of days is sent to every later year and summed there, so no
    window holds all days.
    """
    dated = days.withColumn("_year", F.year("day"))
    years = dated.groupBy("_year").agg(F.count("*").alias("_n"))
    last = years.agg(F.max("_year")).scalar()
    later = years.select(F.explode(F.sequence(F.col("_year") + 1, last + 1)).alias("_year"), "_n")
    before = later.groupBy("_year").agg(F.sum("_n").alias("_before"))
    place = F.row_number().over(W.partitionBy("_year").orderBy("day")) - 1
    numbered = dated.join(before, "_year", "left").withColumn("index", (F.coalesce("_before", F.lit(0)) + place).cast("int"))
    return numbered.withColumn("n_days", years.agg(F.sum("_n")).scalar()).drop("_year", "_before")


def day_block_bootstrap(scored: DataFrame, repeats: int, minimum_days: int = 8, seed: int = 42) -> DataFrame:
    """Intervals from redrawn calendar days.

    Counts add up over days, so the rows are reduced to one row of counts per day first and
    only those are redrawn.
    """
    days = materialize(confusion_counts(scored.withColumn("day", F.to_date("timestamp")), ["day"]))
    numbered = numbered_days(days).where(F.col("n_days") >= minimum_days)
    every = F.sequence(F.lit(0), F.lit(max(repeats, 1) - 1))
    draws = numbered.where(F.lit(repeats > 0)).select("n_days", F.col("index").alias("slot"), F.explode(every).alias("repeat"))
    picked = F.floor(S.draw(seed, F.col("repeat"), F.col("slot")) * F.col("n_days") / F.lit(4294967296.0)).cast("int")
    sums = (
        draws.select("repeat", picked.alias("index"))
        .join(numbered.select("index", *COUNTS), "index")
        .groupBy("repeat").agg(*[F.sum(c).alias(c) for c in COUNTS])
    )
    tn, fp, fn, tp = (F.col(c) for c in COUNTS)
    per_repeat = sums.select(
        S.ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        S.ratio(tp, tp + fn).alias("recall_sensitivity"),
        S.ratio(tn, tn + fp).alias("specificity"),
    )
    long = per_repeat.select(F.expr("stack(3, 'f1', f1, 'recall_sensitivity', recall_sensitivity, 'specificity', specificity) as (metric, value)"))
    bounds = F.percentile("value", F.array(F.lit(0.025), F.lit(0.975)))
    return long.groupBy("metric").agg(bounds.alias("b")).select(
        "metric", F.col("b")[0].alias("lower_95"), F.col("b")[1].alias("upper_95"), F.lit("calendar day").alias("resampling_unit")
    ).where(F.col("lower_95").isNotNull())


def whatif_peak_definition(labelled: DataFrame, quantiles: Sequence[float]) -> DataFrame:
    """Train quantiles as thresholds, and the share of test rows at or above each."""
    names = {f"q{i}": q for i, q in enumerate(quantiles)}
    found = train_quantiles(labelled, names)
    test = labelled.where(F.col("split") == "test")
    wide = test.agg(*[F.avg((F.col("future_hour_max") >= found[n]).cast("double")).alias(n) for n in names])
    cells = ", ".join(f"double({q}), double({found[n]!r}), {n}" for n, q in names.items())
    return wide.select(F.expr(
        f"stack({len(names)}, {cells}) as (train_quantile, demand_threshold_native_units, test_future_peak_fraction)"
    )).withColumn("model_retrained", F.lit(False))


def baseline_predictions(labelled: DataFrame) -> DataFrame:
    """Three rules without a model, one row per rule and test row; the value itself is the score."""
    rules = {"Persistence": "demand_now", "Same hour yesterday": "yesterday_hour_max", "Same hour last week": "last_week_hour_max"}
    cells = ", ".join(f"'{name}', {source}" for name, source in rules.items())
    scored = labelled.where(F.col("split") == "test").select("*", F.expr(f"stack({len(rules)}, {cells}) as (model, score)"))
    return scored.withColumn("prediction", (F.col("score") >= F.col("threshold")).cast("int"))


def anchor_cases(labelled: DataFrame) -> DataFrame:
    """Test times of lowest, highest and nearest-to-threshold demand; the earliest on ties."""
    test = labelled.where(F.col("split") == "test")
    d, slot = F.col("demand_now"), F.col("slot")
    picks = test.agg(
        F.min(F.struct(d.alias("o"), slot))["slot"].alias("low"),
        F.min(F.struct(F.abs(d - F.col("threshold")).alias("o"), slot))["slot"].alias("near"),
        F.min(F.struct((-d).alias("o"), slot))["slot"].alias("high"),
    )
    return picks.select(F.expr("stack(3, 'low demand', low, 'near peak threshold', near, 'high demand', high) as (case, slot)"))
