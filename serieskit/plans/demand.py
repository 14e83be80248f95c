"""Regular demand series from a file or table to features, classifiers and their evaluation."""

from __future__ import annotations

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit import config as C
from serieskit.operators import classify as L, grid as G, metrics as M, splits
from serieskit.operators.ordered import exact_quantiles
from serieskit.session import materialize
from serieskit.sources import sinks
from serieskit.sources.columns import resolve
from serieskit.sources.discovery import discover
from serieskit.sources.readers import scan_csv_text, scan_parquet

KEPT = ["slot", "timestamp", "split", "target", "threshold", "demand_now", "future_hour_max"]


def read_input(spark: SparkSession, cfg: C.DemandConfig) -> DataFrame:
    file = discover(spark, cfg.input_root, C.DEMAND_ALIASES["demand"], cfg.input_path, single=True)[0]
    return scan_csv_text(spark, [file.path], file.headers) if file.suffix == ".csv" else scan_parquet(spark, [file.path])


def prepare(raw: DataFrame, cfg: C.DemandConfig, holidays: DataFrame) -> dict[str, DataFrame]:
    """Raw readings -> stored grid and features with the quality row; off-grid readings are refused."""
    typed = G.read_demand(resolve(raw, C.DEMAND_ALIASES, C.DEMAND_OPTIONAL), cfg)
    counted = materialize(G.readings_summary(typed, cfg))
    if counted.first()["off_grid_timestamp_rows"]:
        raise ValueError("off-grid readings need explicit alignment first")
    grid = materialize(G.regular_grid(typed.where(~G.is_invalid()), cfg))
    frame = materialize(G.demand_features(grid, cfg, holidays))
    one = F.lit(1).alias("_k")
    shape = G.grid_summary(grid, frame, cfg)
    return {"grid": grid, "frame": frame, "quality": counted.select("*", one).join(shape.select("*", one), "_k").drop("_k")}


def split_and_label(frame: DataFrame, cfg: C.DemandConfig) -> DataFrame:
    """Stored labelled rows; too few examples or a one-class split is an error."""
    rows = frame.count()
    if rows < cfg.min_examples:
        raise ValueError(f"{rows} complete examples, {cfg.min_examples} needed")
    labelled = materialize(splits.label_target(splits.time_split(frame, cfg), cfg))
    for r in splits.split_summary(labelled).collect():
        if r["split"] != "test" and r["classes"] < 2:
            raise ValueError(f"{r['split']} has only one class; change peak_quantile or give a longer history")
    return labelled


def fit_models(labelled: DataFrame, cfg: C.DemandConfig, names=None) -> dict[str, tuple[L.Fitted, float]]:
    """The four classifiers with their fit seconds."""
    base = G.base_features(cfg)
    features = base + G.weather_features(labelled.columns)
    train = labelled.where(F.col("split") == "train")
    makers = {
        L.ADDITIVE: lambda n: L.fit_additive(train, features, cfg, n),
        L.TREE: lambda n: L.fit_tree(train, features, cfg, n),
    }
    logistic = {n: (train, f) for n, f in ((L.LOGISTIC_BASE, base), (L.LOGISTIC_WEATHER, features)) if not names or n in names}
    out = {}
    if logistic:
        # Both take their steps together, so each is charged half of the time.
        began = time.perf_counter()
        made = L.fit_logistics(logistic, cfg)
        seconds = (time.perf_counter() - began) / len(made)
        out |= {n: (fitted, seconds) for n, fitted in made.items()}
    for name in names or makers:
        if name in makers:
            began = time.perf_counter()
            out[name] = (makers[name](name), time.perf_counter() - began)
    order = [L.ADDITIVE, L.LOGISTIC_BASE, L.LOGISTIC_WEATHER, L.TREE]
    return {n: out[n] for n in order if n in out}


def predictions(labelled: DataFrame, fitted: dict[str, tuple[L.Fitted, float]]) -> tuple[DataFrame, dict[str, float]]:
    """Stored long frame of validation and test scores with the cutoff learnt on validation."""
    held = labelled.where(F.col("split").isin("validation", "test"))
    scored = [model.score(held).select(*KEPT, "model", "score") for model, _ in fitted.values()]
    stored = materialize(reduce(DataFrame.unionByName, scored))
    found = M.fit_cutoff(stored.where(F.col("split") == "validation"), ["model"]).collect()
    cutoffs = {r["model"]: r["cutoff"] for r in found}
    table = labelled.sparkSession.createDataFrame(list(cutoffs.items()), "model string, cutoff double")
    marked = stored.join(F.broadcast(table), "model").withColumn("prediction", (F.col("score") >= F.col("cutoff")).cast("int"))
    return marked, cutoffs


def all_test_rows(labelled: DataFrame, marked: DataFrame) -> DataFrame:
    """Test rows of the fitted models and of the three rules without a model."""
    columns = [*KEPT, "model", "score", "prediction"]
    return marked.where(F.col("split") == "test").select(*columns).unionByName(M.baseline_predictions(labelled).select(*columns))


def rolling_backtests(labelled: DataFrame, cfg: C.DemandConfig) -> DataFrame:
    """Refit on an expanding window inside the train rows and evaluate on the quarter after it."""
    spark = labelled.sparkSession
    train = labelled.where(F.col("split") == "train").drop("target", "threshold")
    parts = materialize(splits.backtest_parts(train, cfg))
    features = G.base_features(cfg) + G.weather_features(labelled.columns)
    rows = {(r["fold"], r["part"]): r for r in splits.backtest_summary(parts).collect()}
    done = []
    for fold in sorted({f for f, _ in rows}):
        sizes = [rows[(fold, p)]["rows"] if (fold, p) in rows else 0 for p in ("fit", "tuning", "evaluation")]
        if min(sizes) < cfg.min_backtest_rows:
            continue
        own = parts.where(F.col("fold") == fold)
        peak = exact_quantiles(own.where(F.col("part") == "fit"), [], "demand_now", {"p": cfg.peak_quantile}).first()["p"]
        own = own.withColumn("target", (F.col("future_hour_max") >= peak).cast("int"))
        start, end = rows[(fold, "fit")]["evaluation_start"], rows[(fold, "fit")]["evaluation_end"]
        classes = {r["part"]: r["n"] for r in own.groupBy("part").agg(F.count_distinct("target").alias("n")).collect()}
        head = spark.createDataFrame([(fold, str(start), str(end), peak, sizes[0])], "fold int, evaluation_start string, evaluation_end string, threshold_native_units double, training_rows bigint")
        if min(classes["fit"], classes["tuning"]) < 2:
            done.append(head.select("fold", "evaluation_start", "evaluation_end", F.lit("skipped: one-class fit/tuning period").alias("status")))
            continue
        model = L.fit_additive(own.where(F.col("part") == "fit"), features, cfg)
        scored = materialize(model.score(own.where(F.col("part") != "fit")).select("fold", "part", "target", "score"))
        cutoff = M.fit_cutoff(scored.where(F.col("part") == "tuning")).first()["cutoff"]
        check = scored.where(F.col("part") == "evaluation").withColumn("prediction", (F.col("score") >= cutoff).cast("int"))
        result = M.full_metrics(check, ["fold"])
        done.append(head.join(result, "fold").withColumns({"status": F.lit("evaluated"), "probability_cutoff": F.lit(cutoff)}))
    if not done:
        return spark.createDataFrame([], "fold int, evaluation_start string, evaluation_end string, status string")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), done)


def evaluate(labelled: DataFrame, grid: DataFrame, cfg: C.DemandConfig) -> dict:
    """All result tables of the classification run."""
    spark = labelled.sparkSession
    fitted = fit_models(labelled, cfg)
    marked, cutoffs = predictions(labelled, fitted)
    test = materialize(all_test_rows(labelled, marked))
    seconds = spark.createDataFrame([(n, s) for n, (_, s) in fitted.items()], "model string, fit_seconds double")
    comparison = materialize(M.full_metrics(test, ["model"]).join(seconds, "model", "left").fillna(0.0, ["fit_seconds"]))
    limits = spark.createDataFrame(list(cutoffs.items()), "model string, probability_cutoff double")
    main = fitted[L.ADDITIVE][0]
    mine = test.where(F.col("model") == L.ADDITIVE)
    train = labelled.where(F.col("split") == "train")
    fences = splits.outlier_fences(labelled)
    flags = splits.flag_outliers(G.relative_change(grid, cfg), fences, cfg)
    ranks = M.ranking_metrics(mine, ["model"])
    tables = {
        "split_summary": splits.split_summary(labelled).drop("classes"),
        "demand_outlier_audit": splits.outlier_audit(flags, fences),
        "unusual_demand_for_review": flags.withColumn("timestamp", G.time_of(F.col("slot"), cfg.step_seconds)),
        "model_comparison_test": comparison,
        "model_comparison_validation": M.full_metrics(marked.where(F.col("split") == "validation"), ["model"]).join(limits, "model"),
        "advance_warning_only": M.full_metrics(test.where(F.col("demand_now") < F.col("threshold")), ["model"]),
        "quarterly_test_performance": M.full_metrics(splits.quarters(test), ["period", "model"]),
        "what_if_alert_cutoffs": M.whatif_cutoffs(mine, ["model"], sorted({*C.ALERT_CUTOFFS, cutoffs[L.ADDITIVE]})).join(ranks, "model"),
        "day_block_confidence_intervals": M.day_block_bootstrap(mine, cfg.bootstrap_repeats, cfg.min_bootstrap_days),
        "lr_baseline_coefficients": L.coefficient_table(fitted[L.LOGISTIC_WEATHER][0], spark),
        "term_importance": L.term_importance(main, train),
        "term_effects": L.effect_table(main, train, ["demand_now", f"change_{cfg.change_minutes}min", "temperature", "humidity"]),
        "what_if_peak_definition": M.whatif_peak_definition(labelled, C.POLICY_QUANTILES),
        "what_if_temperature": L.whatif_temperature(main, labelled, M.anchor_cases(labelled)),
        "test_predictions": mine.select("timestamp", "demand_now", "future_hour_max", "target", F.col("score").alias("alert_score"), "prediction"),
        "example_predictions": M.example_predictions(mine).select("timestamp", "demand_now", "future_hour_max", "target", F.col("score").alias("alert_score"), "prediction", "outcome"),
        "practical_error_rates": M.practical_error_rates(comparison, ["model"]),
        "demand_history": G.daily_max(grid, cfg),
        "roc_points": M.roc_points(mine, ["model"]),
        "precision_recall_points": M.pr_points(mine, ["model"]),
    }
    if cfg.rolling_backtests:
        tables["historical_rolling_backtests"] = rolling_backtests(labelled, cfg)
    return {"tables": tables, "fitted": fitted, "cutoffs": cutoffs}


def run_demand(spark: SparkSession, cfg: C.DemandConfig | dict, holidays: DataFrame | None = None) -> dict:
    """Read, build features, fit, evaluate and write all result tables.

    ``holidays`` is a table with a ``date`` column; without it the optional holiday package
    must be installed.
    """
    cfg = C.DemandConfig.from_dict(cfg) if isinstance(cfg, dict) else cfg
    raw = read_input(spark, cfg)
    if holidays is None:
        typed = G.read_demand(resolve(raw, C.DEMAND_ALIASES, C.DEMAND_OPTIONAL), cfg)
        ends = typed.agg(F.year(F.min("timestamp")), F.year(F.max("timestamp"))).first()
        holidays = G.holiday_table(spark, list(range(ends[0], ends[1] + 1)))
    built = prepare(raw, cfg, holidays)
    labelled = split_and_label(built["frame"], cfg)
    result = evaluate(labelled, built["grid"], cfg)
    result["tables"]["data_quality"] = sinks.key_values(built["quality"])
    for name, table in result["tables"].items():
        sinks.write_csv(table, f"{cfg.output_dir}/{name}")
    sinks.write_json(built["quality"], f"{cfg.output_dir}/metrics")
    threshold = labelled.first()["threshold"]
    main = result["fitted"][L.ADDITIVE][0]
    sinks.write_model(
        spark, {"classifier": main.model, "bins": main.bins.encoder},
        {"config": cfg, "feature_columns": main.features, "alert_cutoff": result["cutoffs"][L.ADDITIVE], "peak_threshold": threshold,
         "borders": {f"{f}/{k}": v for (f, k), v in main.bins.borders.items()}},
        f"{cfg.output_dir}/model",
    )
    return {**result, "labelled": labelled, "grid": built["grid"]}
