"""Price records from files or a table to daily panel, profiles and behaviour groups."""

from __future__ import annotations

from math import ceil

import numpy as np
from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit import config as C
from serieskit.operators import clean, cluster as K, cluster_metrics as Q, panel, prep, profiles as P
from serieskit.operators.sampling import hash_sample
from serieskit.session import materialize
from serieskit.sources import sinks
from serieskit.sources.columns import resolve
from serieskit.sources.discovery import discover
from serieskit.sources.readers import read_aliased

BY = ["commodity"]
SERIES = P.SERIES
IDENT = "series_id"
CLIP_CHECK, PRICE_CHECK = "clip", "price level"
RESTART, SUBSAMPLE = "different initialization", "80% profile subsample; fixed preprocessing"


def panel_from(raw: DataFrame, cfg: C.PriceConfig, source: str | None = None) -> dict[str, DataFrame]:
    """Resolved raw records -> stored days, daily panel, its audit and, with ``source``, the manifest. The raw data are scanned once."""
    keep = [source] if source else []
    stored = clean.store_judged(clean.judge(clean.standardize(raw, cfg, keep), cfg), keep)
    records = clean.sound_records(stored)
    days = panel.stored_days(records)
    out = {"audit": panel.panel_audit(records, days), "days": days, "panel": panel.with_dominance(days)}
    if source:
        out["manifest"] = materialize(clean.manifest(stored, source))
    return out


def panel_from_files(spark: SparkSession, cfg: C.PriceConfig) -> dict[str, DataFrame]:
    years = int(cfg.start_date[:4]), int(cfg.end_date[:4])
    files = discover(spark, cfg.input_root, C.PRICE_ALIASES["price"], cfg.input_path, prefer_parquet=True, years=years)
    raw = read_aliased(spark, files, C.PRICE_ALIASES, C.PRICE_OPTIONAL)
    out = panel_from(raw, cfg, "source_file")
    listed = spark.createDataFrame([(f.path, f.size) for f in files], "source_file string, bytes bigint")
    local = F.regexp_replace(F.col("source_file"), "^file:/+", "/")
    # Rows carry their file as a URI, the listing as a plain path.
    decoded = F.url_decode(F.regexp_replace(F.col("source_file"), r"\+", "%2B"))
    counted = out["manifest"].withColumn("source_file", decoded).withColumn("source_file", local)
    listed = listed.withColumn("source_file", local)
    stray = counted.join(listed, "source_file", "left_anti").select("source_file").take(1)
    if stray:
        raise ValueError(f"records of {stray[0][0]}, which is no listed input file")
    out["manifest"] = listed.join(counted, "source_file", "left").fillna(0)
    return out


def panel_from_table(raw: DataFrame, cfg: C.PriceConfig) -> dict[str, DataFrame]:
    return panel_from(resolve(raw, C.PRICE_ALIASES, C.PRICE_OPTIONAL), cfg)


def eligible_profiles(daily: DataFrame, cfg: C.PriceConfig) -> tuple[DataFrame, DataFrame, dict[str, int]]:
    """Stored eligible profiles, excluded ones, and the eligible count per commodity, checked."""
    judged = materialize(P.with_eligibility(P.profile_features(daily, cfg), cfg))
    fine = F.col("eligibility_reason") == "eligible"
    counts = {r["commodity"]: (r["a"], r["e"]) for r in judged.groupBy(*BY).agg(F.count("*").alias("a"), F.count(F.when(fine, 1)).alias("e")).collect()}
    for name in cfg.commodities:
        if name not in counts:
            raise ValueError(f"no records for {name}")
        if counts[name][1] < cfg.min_profiles:
            raise ValueError(f"only {counts[name][1]} eligible profiles for {name}; the rules are not relaxed")
    ident = F.concat_ws("|", *SERIES)
    return judged.where(fine).withColumn(IDENT, ident), judged.where(~fine), {n: e for n, (_, e) in counts.items()}


def _runs(group: str, k: int, starts: int, seed: int, bit: int = -1) -> list[K.Run]:
    return [K.Run(group, k, (seed, s), bit) for s in range(starts)]


def _centers(spark, best: dict, by: str) -> DataFrame:
    rows = [(*key, j, [float(v) for v in c]) for key, run in best.items() for j, c in enumerate(run.centers)]
    return K.centers_frame(spark, rows, by)


def select_clusters(matrix: DataFrame, cfg: C.PriceConfig) -> dict:
    """Fit every cluster count for every commodity together and choose one per commodity."""
    spark = matrix.sparkSession
    shape = matrix.groupBy(*BY).agg(F.count("*").alias("n"), F.count_distinct("x").alias("u")).collect()
    runs = []
    for row in shape:
        for k in range(2, min(cfg.max_clusters, row["n"] - 1, row["u"]) + 1):
            runs += _runs(row["commodity"], k, cfg.kmeans_starts, 42)
    points = materialize(K.points_frame(matrix, F.col("commodity"), F.col(IDENT)))
    K.fit(points, runs, cfg.kmeans_iterations)
    best = K.best_runs(runs, lambda r: (r.group, r.k))
    centers = _centers(spark, best, "commodity string, clusters int")
    spread = matrix.select(*BY, IDENT, "x").join(centers.select("commodity", "clusters").dropDuplicates(), BY)
    labelled = materialize(K.assign(spread, centers, ["commodity", "clusters"]))
    key = ["commodity", "clusters"]
    silhouette = Q.silhouette_mean(labelled, key, IDENT)
    dims = len(C.BASE_FEATURES) + 1
    smallest = {r["commodity"]: max(3, ceil(r["n"] * cfg.min_cluster_fraction)) for r in shape}
    facts = spark.createDataFrame(
        [(g, k, r.inertia, r.iterations, r.iterations >= cfg.kmeans_iterations, int(r.sizes.min()), int(r.sizes.min()) >= smallest[g]) for (g, k), r in best.items()],
        "commodity string, clusters int, inertia double, iterations int, iteration_limit_reached boolean, smallest_cluster bigint, meets_minimum_cluster_size boolean",
    )
    selection = facts.join(silhouette, key, "left").join(Q.davies_bouldin(labelled, key, dims), key, "left").join(Q.calinski_harabasz(labelled, key, dims), key, "left")
    selection = prep.settled(selection)
    chosen = {}
    for r in sorted(selection.collect(), key=lambda r: r["clusters"]):
        if r["iteration_limit_reached"] or not r["meets_minimum_cluster_size"] or r["silhouette"] is None:
            continue
        if r["commodity"] not in chosen or r["silhouette"] > chosen[r["commodity"]][1]:
            chosen[r["commodity"]] = (r["clusters"], r["silhouette"])
    for row in shape:
        if row["commodity"] not in chosen:
            raise ValueError(f"no feasible cluster count for {row['commodity']}")
    winners = {g: k for g, (k, _) in chosen.items()}
    models = {g: best[(g, k)] for g, k in winners.items()}
    return {"selection": selection, "winners": winners, "models": models, "points": points, "sizes": {r["commodity"]: r["n"] for r in shape}}


def label_profiles(matrix: DataFrame, models: dict) -> DataFrame:
    """Profiles with cluster, distance to its centre, silhouette and the group's name."""
    centers = _centers(matrix.sparkSession, {(g,): r for g, r in models.items()}, "commodity string")
    assigned = materialize(K.assign(matrix, centers, BY))
    scored = Q.silhouette_samples(assigned, BY, [IDENT]).select(*BY, IDENT, "silhouette", "weak_separation")
    names = Q.rank_groups(assigned, BY, "return_volatility").select(*BY, "cluster", "group_description")
    return assigned.join(scored, [*BY, IDENT], "left").join(names, [*BY, "cluster"], "left")


def _resample_mask(matrix: DataFrame, sizes: dict, winners: dict, repeats: int) -> DataFrame:
    """One bit per repeat on each profile, in words of 62: drawn into that repeat's sample or not."""
    spread = matrix.select(*BY, IDENT, F.explode(F.sequence(F.lit(0), F.lit(repeats - 1))).alias("repeat"))
    least = F.create_map(*[F.lit(v) for g, k in winners.items() for v in (g, k + 1)])
    keyed = spread.withColumn("_key", F.concat_ws(":", "repeat", IDENT)).withColumn("_min", least[F.col("commodity")])

    def wanted(n):
        return F.greatest(F.floor(n * F.lit(0.8)), F.col("_min"))

    drawn = hash_sample(keyed, [*BY, "repeat", "_min"], "_key", wanted, "subsample")
    bit = F.expr(f"shiftleft(1L, cast(repeat % {K.WORD_BITS} as int))")
    words = [F.coalesce(F.bit_or(F.when(F.floor(F.col("repeat") / K.WORD_BITS) == w, bit)), F.lit(0).cast("bigint")) for w in range(K.words_for(repeats))]
    return drawn.groupBy(*BY, IDENT).agg(F.array(*words).alias("mask"))


def stability(matrix: DataFrame, picked: dict, labelled: DataFrame, cfg: C.PriceConfig) -> DataFrame:
    """Agreement with the main groups after other starts and after refits on 80 % samples."""
    none = F.array_repeat(F.lit(0).cast("bigint"), K.words_for(cfg.stability_repeats))
    masked = matrix.select(*BY, IDENT, "x")
    if cfg.stability_repeats:
        mask = _resample_mask(matrix, picked["sizes"], picked["winners"], cfg.stability_repeats)
        masked = masked.join(mask, [*BY, IDENT], "left").withColumn("mask", F.coalesce("mask", none))
    else:
        masked = masked.withColumn("mask", none)
    points = materialize(K.points_frame(masked, F.col("commodity"), F.col(IDENT), mask=F.col("mask")))
    runs, checks = [], {}
    for g, k in picked["winners"].items():
        for seed in C.RESTART_SEEDS:
            runs += _runs(g, k, cfg.kmeans_starts, seed)
        for repeat in range(cfg.stability_repeats):
            runs += _runs(g, k, cfg.kmeans_starts, repeat, bit=repeat)
    K.fit(points, runs, cfg.kmeans_iterations)
    best = K.best_runs(runs, lambda r: (r.group, RESTART if r.bit < 0 else SUBSAMPLE, r.start[0]))
    return agreement(labelled, best, cfg)


def agreement(labelled: DataFrame, best: dict, cfg: C.PriceConfig, frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """ARI of each refit against the main labels. Keys of ``best``: (commodity, check, seed)."""
    spark = labelled.sparkSession
    key = ["commodity", "check", "seed"]
    centers = _centers(spark, best, "commodity string, check string, seed int")
    facts = spark.createDataFrame(
        [(*k, r.iterations >= cfg.kmeans_iterations, int(r.sizes.min())) for k, r in best.items()],
        "commodity string, check string, seed int, iteration_limit_reached boolean, smallest_cluster bigint",
    )
    main = labelled.select(*BY, IDENT, F.col("cluster").alias("main"), "x").join(facts.select(*key), BY)
    again = K.assign(main, centers, key)
    return facts.join(Q.adjusted_rand(again, "main", "cluster", key).withColumnRenamed("ARI", "ARI_vs_main"), key)


def _refit(matrix: DataFrame, variant: str, picked: dict, labelled: DataFrame, cfg: C.PriceConfig) -> tuple[DataFrame, DataFrame]:
    points = materialize(K.points_frame(matrix, F.col("commodity"), F.col(IDENT)))
    runs = [r for g, k in picked["winners"].items() for r in _runs(g, k, cfg.kmeans_starts, 42)]
    K.fit(points, runs, cfg.kmeans_iterations)
    best = {(g, variant, 42): r for g, r in K.best_runs(runs, lambda r: r.group).items()}
    main = labelled.select(*BY, IDENT, F.col("cluster").alias("main"))
    swapped = matrix.select(*BY, IDENT, "x").join(main, [*BY, IDENT]).withColumnRenamed("main", "cluster")
    table = agreement(swapped, best, cfg)
    centers = _centers(matrix.sparkSession, {(g,): r for (g, _, _), r in best.items()}, "commodity string")
    relabelled = K.assign(matrix.select(*BY, IDENT, "x"), centers, BY)
    return table, Q.silhouette_mean(relabelled, BY, IDENT)


def clip_sensitivity(profiles: DataFrame, picked: dict, labelled: DataFrame, cfg: C.PriceConfig, clips=C.SENSITIVITY_CLIPS) -> DataFrame:
    """Refit the chosen count after clipping at other quantiles."""
    parts = []
    for q in clips:
        changed = materialize(prep.feature_matrix(profiles, BY, q))
        table, silhouette = _refit(changed, CLIP_CHECK, picked, labelled, cfg)
        parts.append(table.join(silhouette, BY, "left").withColumn("clip_quantile_each_tail", F.lit(float(q))))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.drop("check", "seed")


def price_level_sensitivity(matrix: DataFrame, picked: dict, labelled: DataFrame, cfg: C.PriceConfig) -> DataFrame:
    """Refit with the scaled log mean price as one more component."""
    level = prep.standardize(matrix.withColumn("_level", F.col("log_mean_price")), ["_level"], BY)
    wider = materialize(level.withColumn("x", F.concat("x", F.array("_level"))).drop("_level"))
    table, _ = _refit(wider, PRICE_CHECK, picked, labelled, cfg)
    return table.select("commodity", F.lit("include log mean price").alias("check"), "iteration_limit_reached", "ARI_vs_main")


def projection(matrix: DataFrame) -> DataFrame:
    """Two display coordinates of every profile and the share of its commodity's variance they explain.

    Covariances come from one grouped aggregation; the driver turns one small square matrix per commodity.
    """
    dims = range(len(prep.FEATURES))
    x = F.col("x")
    sums = matrix.groupBy(*BY).agg(*[F.covar_pop(x[i], x[j]).alias(f"c{i}_{j}") for i in dims for j in dims if i <= j]).collect()
    rows = []
    for r in sums:
        values, vectors = np.linalg.eigh(np.array([[r[f"c{min(i, j)}_{max(i, j)}"] or 0.0 for j in dims] for i in dims]))
        main = vectors[:, ::-1][:, :2]
        main = main * np.where(main[np.abs(main).argmax(axis=0), [0, 1]] >= 0, 1.0, -1.0)
        rows.append((r["commodity"], main[:, 0].tolist(), main[:, 1].tolist(), float(values[-2:].sum() / values.sum()) if values.sum() > 0 else None))
    loadings = matrix.sparkSession.createDataFrame(rows, "commodity string, _first array<double>, _second array<double>, explained_share double")

    def along(axis: str):
        return F.aggregate(F.zip_with("x", axis, lambda a, b: a * b), F.lit(0.0), lambda t, v: t + v)

    # One row per commodity.
    return matrix.join(F.broadcast(loadings), BY).select(*BY, IDENT, along("_first").alias("PC1"), along("_second").alias("PC2"), "explained_share")


def label_new(profiles: DataFrame, model: dict[str, DataFrame]) -> DataFrame:
    """Groups of profiles by a saved model (see ``load_model``): nearest centre after the model's own preparation."""
    matrix = prep.apply_preparation(profiles, model["preparation"], BY)
    return K.assign(matrix, model["centers"], BY).join(F.broadcast(model["groups"]), [*BY, "cluster"], "left")


def load_model(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """Preparation, centres and group names that ``run_price`` has saved under ``path``."""
    return {name: spark.read.parquet(f"{path}/{name}") for name in ("preparation", "centers", "groups")}


def representative_history(daily: DataFrame, members: DataFrame) -> DataFrame:
    """Monthly index of the profile nearest to each centre."""
    first = members.where(F.col("position") == 1).select(*SERIES, "cluster")
    return P.monthly_index(daily.join(first.select(*SERIES), SERIES, "left_semi")).join(first, SERIES)


def analyze(daily: DataFrame, cfg: C.PriceConfig) -> dict[str, DataFrame]:
    """All group tables of the requested commodities; works on any daily panel."""
    eligible, excluded, counts = eligible_profiles(daily.where(F.col("commodity").isin(*cfg.commodities)), cfg)
    profiles = eligible.where(F.col("commodity").isin(*cfg.commodities))
    fitted = prep.fit_preparation(profiles, BY, cfg.clip_quantile)
    used = F.broadcast(fitted.where("is_used").select(*BY, "feature"))
    matrix = materialize(prep.apply_preparation(profiles, fitted, BY))
    picked = select_clusters(matrix, cfg)
    labelled = materialize(label_profiles(matrix, picked["models"]))
    stable = prep.settled(stability(matrix, picked, labelled, cfg))
    price = prep.settled(price_level_sensitivity(matrix, picked, labelled, cfg))
    members = Q.nearest_members(labelled, BY, SERIES[1:])
    out = {
        "excluded_profiles": excluded,
        "market_profiles": labelled.drop("x"),
        "cluster_selection": picked["selection"],
        "profile_clipping_bounds": fitted.where("is_used").select(*BY, "feature", "lower", "upper"),
        "group_summary": Q.group_summary(labelled, BY).join(labelled.select(*BY, "cluster", "group_description").dropDuplicates(), [*BY, "cluster"]),
        "group_stability": stable,
        "clipping_sensitivity": clip_sensitivity(profiles, picked, labelled, cfg),
        "price_level_sensitivity": price,
        "representative_markets": members.select(*SERIES, "cluster", "group_description", "silhouette", "price_cv", "return_volatility", "sharp_drop_fraction", "position"),
        "least_separated_profiles": Q.least_separated(labelled, BY, SERIES[1:]).select(*SERIES, "cluster", "silhouette", "weak_separation", "position"),
        "extreme_profiles_for_review": P.extreme_profiles(labelled).select(*SERIES, "return_volatility", "large_daily_change_fraction", "profile_was_clipped", "position"),
        "what_if_daily_drops": P.whatif_daily_drops(daily, profiles),
        "what_if_profile_separation": Q.whatif_separation(labelled, BY),
        "what_if_reporting_coverage": P.whatif_coverage(profiles),
        "representative_price_histories": representative_history(daily, members),
        "profile_separation": Q.silhouette_histogram(labelled, by=BY),
        "cluster_feature_heatmap": Q.center_table(labelled, BY, len(prep.FEATURES), prep.FEATURES).join(used, [*BY, "feature"], "left_semi"),
        "profile_projection": projection(matrix),
    }
    out["commodity_overview"] = overview(daily, labelled, excluded, picked, stable, price, matrix)
    out["models"] = picked["models"]
    out["preparation"] = fitted
    return out


def overview(daily, labelled, excluded, picked, stable, price, matrix) -> DataFrame:
    """One row of metrics per commodity."""
    spark = labelled.sparkSession
    chosen = spark.createDataFrame(list(picked["winners"].items()), "commodity string, clusters int")
    best = picked["selection"].join(chosen, ["commodity", "clusters"]).select("commodity", F.col("clusters").alias("groups"), "silhouette", "davies_bouldin", "calinski_harabasz")
    rows = daily.groupBy(*BY).agg(F.count("*").alias("retained_daily_records"))
    members = labelled.groupBy(*BY).agg(
        F.count("*").alias("eligible_profiles"),
        F.avg(F.col("weak_separation").cast("double")).alias("weak_separation_fraction"),
        F.count("silhouette").alias("profile_silhouettes_evaluated"),
        F.avg(F.col("profile_was_clipped").cast("double")).alias("clipped_profile_fraction"),
        F.avg(F.col(C.SPREAD_FEATURE).isNull().cast("double")).alias("spread_missing_fraction"),
    )
    out_of = excluded.groupBy(*BY).agg(F.count("*").alias("excluded_profiles"))
    usable = (F.col("check") == SUBSAMPLE) & ~F.col("iteration_limit_reached")
    ari = stable.where(usable).groupBy(*BY).agg(F.avg("ARI_vs_main").alias("mean_subsampling_ARI"))
    level = price.select("commodity", F.col("ARI_vs_main").alias("price_feature_ARI"))
    joined = best.join(rows, BY).join(members, BY)
    for t in (out_of, ari, level):
        joined = joined.join(t, BY, "left")
    return joined.fillna(0, ["excluded_profiles"])


def quality(built: dict[str, DataFrame], profiles: DataFrame, cfg: C.PriceConfig) -> DataFrame:
    """Totals of the run as (check, value) rows."""
    one = F.lit(1).alias("_k")
    totals = built["manifest"].agg(
        F.sum("raw_rows_scanned").alias("raw_rows_scanned_once"), F.sum("bytes").alias("raw_bytes_scanned_once"),
        F.sum("inconsistent_price_rows").alias("inconsistent_price_rows_removed"),
    )
    row = built["audit"].select("*", one).join(totals.select("*", one), "_k").drop("_k")
    row = row.withColumns({
        "commodities": F.lit(", ".join(cfg.commodities)),
        "eligible_profiles_total": profiles.agg(F.count("*")).scalar(),
        "common_window_start": F.lit(cfg.start_date), "common_window_end": F.lit(cfg.end_date),
    })
    return sinks.key_values(row)


def run_price(spark: SparkSession, cfg: C.PriceConfig | dict) -> dict:
    """Scan the input once, analyse every requested commodity, write all result tables."""
    cfg = C.PriceConfig.from_dict(cfg) if isinstance(cfg, dict) else cfg
    built = panel_from_files(spark, cfg)
    sinks.write_parquet(built["panel"], f"{cfg.output_dir}/clean_daily_prices")
    daily = spark.read.parquet(f"{cfg.output_dir}/clean_daily_prices")
    if daily.isEmpty():
        raise ValueError("no valid records in the date window")
    tables = analyze(daily, cfg)
    models, fitted = tables.pop("models"), tables.pop("preparation")
    tables["file_manifest"] = built["manifest"]
    tables["data_quality"] = quality(built, tables["market_profiles"], cfg)
    for name, table in tables.items():
        sinks.write_csv(table, f"{cfg.output_dir}/{name}")
    sinks.write_json(tables["commodity_overview"], f"{cfg.output_dir}/metrics_by_commodity")
    sinks.write_json(tables["data_quality"], f"{cfg.output_dir}/metrics")
    centers = _centers(spark, {(g,): r for g, r in models.items()}, "commodity string")
    groups = tables["market_profiles"].select(*BY, "cluster", "group_description").dropDuplicates()
    for name, table in (("centers", centers), ("preparation", fitted), ("groups", groups)):
        sinks.write_parquet(table, f"{cfg.output_dir}/model/{name}")
    sinks.write_model(spark, {}, {"config": cfg, "features": prep.FEATURES}, f"{cfg.output_dir}/model")
    return {**tables, "panel": daily, "models": models}


__all__ = ["analyze", "label_new", "load_model", "panel_from_files", "panel_from_table", "run_price"]
