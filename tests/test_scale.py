"""The devices for skew and for long series give what the plain form gives."""

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Window as W, functions as F

from serieskit.config import DemandConfig
from serieskit.functions import scalars as S
from serieskit.operators import cluster as K, cluster_metrics as Q, grid as G, metrics as M, ordered, panel, prep, profiles as P, sampling
from serieskit.operators.skew import split_hot
from serieskit.session import materialize


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one day of one series, with copies."""
    rng = np.random.default_rng(1)
    n = 3000
    hot = rng.random(n) < 0.4
    pdf = pd.DataFrame({
        "commodity": "Onion", "state": "a", "district": "d", "market": np.where(hot, "m0", [f"m{i % 7}" for i in range(n)]),
        "variety": "v", "grade": "g", "day": np.where(hot, 0, rng.integers(0, 30, n)), "price": np.round(rng.gamma(3, 50, n) + 1, 1),
        "relative_spread": np.where(rng.random(n) < 0.2, np.nan, np.round(rng.random(n), 2)),
    })
    df = spark.createDataFrame(pdf).withColumn("date", F.date_add(F.lit("2022-01-01").cast("date"), F.col("day").cast("int"))).drop("day")
    df = df.withColumn("relative_spread", S.finite(F.col("relative_spread")))
    return df.unionByName(df.where(F.col("market") == "m0")).cache()


def rows(df):
    return sorted(map(str, df.select(*sorted(df.columns)).collect()))


def test_hot_days_equal_ordinary_days(skewed):
    assert split_hot(skewed, panel.DAY, 10**6)[1] is None
    ordinary, hot = split_hot(skewed, panel.DAY, 200)
    assert hot.count() + ordinary.count() == skewed.count()
    assert hot.select(*panel.DAY).distinct().count() == 1
    assert rows(panel.daily_medians(skewed, 200)) == rows(panel.daily_medians(skewed))


def test_daily_medians_against_pandas(skewed):
    pdf = skewed.toPandas().drop_duplicates()
    wanted = pdf.groupby(["market", "date"]).agg(price=("price", "median"), n=("price", "size"), d=("price", "nunique"))
    for r in panel.daily_medians(skewed).collect():
        w = wanted.loc[(r["market"], r["date"])]
        assert (r["price"], r["daily_reports"], r["distinct_reported_prices"]) == (pytest.approx(w.price), w.n, w.d)


def test_exact_quantiles_on_a_hot_value(spark):
    rng = np.random.default_rng(2)
    values = np.where(rng.random(5000) < 0.35, 7.0, rng.normal(0, 20, 5000))
    pdf = pd.DataFrame({"g": rng.integers(0, 3, 5000), "v": values})
    found = ordered.exact_quantiles(spark.createDataFrame(pdf), ["g"], "v", {"a": 0.013, "b": 0.5, "c": 0.9}).collect()
    for r in found:
        wanted = pdf[pdf.g == r["g"]].v.quantile([0.013, 0.5, 0.9]).tolist()
        assert [r["a"], r["b"], r["c"]] == pytest.approx(wanted, abs=1e-12)


def test_running_totals_equal_one_window(spark):
    df = spark.range(4000).select(((F.col("id") * 7919) % 4001).cast("double").alias("o"), (F.col("id") % 5).alias("g"), (F.col("id") % 3).alias("n"))
    window = W.partitionBy("g").orderBy("o").rowsBetween(W.unboundedPreceding, -1)
    plain = df.withColumn("n_before", F.coalesce(F.sum("n").over(window), F.lit(0))).withColumn("n_total", F.sum("n").over(W.partitionBy("g")))
    assert rows(ordered.running_totals(df, ["g"], "o", ["n"], range_rows=50)) == rows(plain)


def test_ranges_follow_each_groups_own_band(spark):
    """A group in a millionth of the span, and one that is nearly all one value, are cut as finely as the others."""
    rng = np.random.default_rng(7)
    wide, band, peak = rng.normal(0, 1e6, 4000), 5 + rng.random(9000) * 1e-6, np.where(rng.random(5000) < 0.995, 9.0, rng.random(5000))
    pdf = pd.DataFrame({"g": ["wide"] * 4000 + ["band"] * 9000 + ["peak"] * 5000 + [None] * 10, "v": np.concatenate([wide, band, peak, np.arange(10.0)])})
    df = spark.createDataFrame(pdf)
    ranged = ordered.with_range(df, ["g"], "v", 200)
    sizes = ranged.groupBy("g", "_range").agg(F.count("*").alias("n"), F.count_distinct("v").alias("d"), F.min("v").alias("a"), F.max("v").alias("b")).toPandas()
    assert sizes[(sizes.n > 200) & (sizes.d > 1)].empty and sizes[sizes.g == "band"].n.max() <= 200 and len(sizes[sizes.g == "band"]) > 45
    for _, part in sizes.groupby("g"):
        part = part.sort_values("_range")
        assert (part.b.to_numpy()[:-1] < part.a.to_numpy()[1:]).all()
    found = ordered.exact_quantiles(df, ["g"], "v", {"p": 0.37}, 200).where("g is not null").collect()
    for r in found:
        assert r["p"] == pytest.approx(pdf[pdf.g == r["g"]].v.quantile(0.37), abs=1e-12)


def test_chunked_windows_equal_one_window(spark):
    cfg = DemandConfig(step_seconds=900, lag_minutes=(15, 60, 1440), rolling_minutes=(90, 180), change_minutes=90, day_minutes=1440, week_minutes=2880)
    grid = spark.range(1000, 3000).select(
        F.col("id").alias("slot"), F.when(F.col("id") % 97 != 0, F.sin(F.col("id")) * 10).alias("demand"))
    build = [G.add_lags, G.add_rolling, G.add_lookahead]

    def plain(frame):
        for step in build:
            frame = step(frame, W.partitionBy(F.lit(1)).orderBy("slot"), cfg)
        return frame

    named = grid.withColumnRenamed("demand", "demand_now")
    wanted = plain(named)
    for size in (64, 500, 4096):
        found = G.demand_windows(grid, cfg, size)
        names = sorted(wanted.columns)
        digits = [F.round(c, 9).alias(c) if c != "slot" else F.col(c) for c in names]
        assert rows(found.select(*digits)) == rows(wanted.select(*digits))


def test_chunks_of_many_series_equal_one_window_each(spark):
    """A long series that is cut, short ones that are not, one of a missing key, and gaps."""
    cfg = DemandConfig(step_seconds=900, lag_minutes=(15, 60, 1440), rolling_minutes=(90, 180), change_minutes=90, day_minutes=1440, week_minutes=2880)
    named = spark.range(0, 2300).select(
        F.when(F.col("id") < 1500, "long").when(F.col("id") < 1700, "short").when(F.col("id") < 1710, "tiny").alias("k"),
        (F.col("id") * 3 % 2300).alias("x"), (F.col("id") + F.when(F.col("id") < 1500, 0).otherwise(977)).alias("slot"))
    readings = named.where("x % 41 > 0").select("k", "slot", F.sin("x").alias("demand")).unionByName(named.where("x % 57 = 0").select("k", "slot", F.lit(5.0).alias("demand")))
    grid = materialize(G.regular_grid(readings, cfg, by=["k"]).where("slot is not null"))
    known = grid.where("demand is not null").groupBy("k").count().collect()
    assert {r["k"] for r in known} == {"long", "short", "tiny", None}

    def plain(frame):
        for step in (G.add_lags, G.add_rolling, G.add_lookahead):
            frame = step(frame, W.partitionBy("k").orderBy("slot"), cfg)
        return frame

    wanted = plain(grid.withColumnRenamed("demand", "demand_now"))
    names = sorted(wanted.columns)
    digits = [F.round(c, 9).alias(c) if c not in ("slot", "k") else F.col(c) for c in names]
    for size in (64, 500, 4096):
        assert rows(G.demand_windows(grid, cfg, size, ["k"]).select(*digits)) == rows(wanted.select(*digits))


def test_relative_change_at_chunk_borders(spark):
    grid = spark.range(0, 9000).select(F.col("id").alias("slot"), (F.col("id") + 1.0).alias("demand"))
    out = G.relative_change(grid, DemandConfig())
    assert out.count() == 9000
    assert out.where(F.col("absolute_change_fraction").isNull()).count() == 1


def test_regular_grid_spans_many_chunks(spark):
    some = spark.createDataFrame([(5, 1.0), (5, 3.0), (20005, 4.0)], "slot bigint, demand double")
    grid = G.regular_grid(some, DemandConfig())
    assert grid.count() == 20001
    assert grid.where("slot = 5").first()["demand"] == 2.0
    assert grid.where("demand is null").count() == 19999


def test_profile_stale_share_and_gaps(spark):
    days = [("x", "2022-01-01", 5.0), ("x", "2022-01-02", 5.0), ("x", "2022-01-03", 5.0), ("x", "2022-01-04", 5.0), ("x", "2022-01-06", 5.0), ("x", "2022-01-07", 4.0)]
    df = spark.createDataFrame(days, "k string, d string, price double").select("k", F.col("d").cast("date").alias("date"), "price")
    out = P.stale_runs(df, ["k"]).orderBy("date").collect()
    assert [r["run_position"] for r in out] == [1, 2, 3, 4, 1, 1]
    assert [r["is_stale"] for r in out] == [False, False, True, True, False, False]
    assert [r["daily_return"] for r in out] == [None, 0.0, 0.0, 0.0, None, pytest.approx(-0.2)]


def test_ranking_against_pairs(spark):
    rng = np.random.default_rng(3)
    y, s = rng.integers(0, 2, 400), np.round(rng.random(400), 2)
    scored = spark.createDataFrame(pd.DataFrame({"target": y, "score": s}))
    found = M.ranking_metrics(scored).first()
    pos, neg = s[y == 1], s[y == 0]
    auc = ((pos[:, None] > neg).sum() + 0.5 * (pos[:, None] == neg).sum()) / len(pos) / len(neg)
    assert found["roc_auc"] == pytest.approx(auc)
    ap, before = 0.0, 0
    for c in sorted(set(s), reverse=True):
        tp, called = (y[s >= c] == 1).sum(), (s >= c).sum()
        ap += (tp - before) / y.sum() * tp / called
        before = tp
    assert found["average_precision"] == pytest.approx(ap)


def test_cutoff_curve_against_direct_counts(spark):
    rng = np.random.default_rng(4)
    grid = 0.05 + np.arange(91) * ((0.95 - 0.05) / 90)
    s = np.concatenate([rng.random(300), grid[::9]])
    y = (rng.random(len(s)) < s).astype(int)
    curve = M.cutoff_curve(spark.createDataFrame(pd.DataFrame({"target": y, "score": s}))).orderBy("cutoff").collect()
    assert len(curve) == 91
    for c, r in zip(grid, curve):
        assert (r["TP"], r["FP"]) == (((s >= c) & (y == 1)).sum(), ((s >= c) & (y == 0)).sum())


def test_samples_have_their_exact_size(spark):
    df = spark.range(5000).select((F.col("id") % 2).alias("g"), F.col("id").alias("key"), F.when(F.col("id") < 3, 1).otherwise(0).alias("label"))
    assert sampling.hash_sample(df, ["g"], "key", lambda n: F.floor(n * 0.8)).groupBy("g").count().orderBy("g").collect() == [(0, 2000), (1, 2000)]
    picked = sampling.stratified_sample(df.withColumn("a", F.lit(1)), ["a"], "label", "key", 50)
    assert picked.count() == 50
    assert picked.where("label = 1").count() >= 2


def blobs():
    rng = np.random.default_rng(5)
    return np.vstack([rng.normal(c, 0.5, (80, 3)) for c in (-4, 0, 4)])


def test_batched_kmeans_reaches_spark_ml(spark):
    x = blobs()
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "id": range(len(x)), "x": list(x)})).cache()
    runs = [K.Run("a", 3, (42, s)) for s in range(4)] + [K.Run("a", 2, (42, s)) for s in range(4)]
    K.fit(K.points_frame(df, F.col("g"), F.col("id")), runs)
    best = K.best_runs(runs, lambda r: r.k)
    for k in (2, 3):
        theirs = KMeans(k=k, seed=1, maxIter=100, tol=1e-6).fit(df.withColumn("features", array_to_vector("x")))
        assert best[k].inertia <= theirs.summary.trainingCost * 1.001
        assert best[k].sizes.sum() == len(x)


def test_silhouettes_against_numpy(spark):
    x, label = blobs(), np.repeat([0, 1, 2], 80)
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "id": range(len(x)), "cluster": label, "x": list(x)}))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    wanted = {}
    for i in range(len(x)):
        mean = [d[i, label == c].sum() / ((label == c).sum() - (c == label[i])) for c in range(3)]
        a, b = mean[label[i]], min(m for c, m in enumerate(mean) if c != label[i])
        wanted[i] = (b - a) / max(a, b)
    found = {r["id"]: r["silhouette"] for r in Q.silhouette_samples(df, ["g"], ["id"]).collect()}
    assert found == pytest.approx(wanted)
    blocks = {r["id"]: r["silhouette"] for r in Q.silhouette_samples(df, ["g"], ["id"], block_rows=50).collect()}
    assert blocks == pytest.approx(wanted)
    assert Q.silhouette_mean(df, ["g"], "id").first()["silhouette"] == pytest.approx(np.mean(list(wanted.values())))


def test_silhouettes_of_large_groups_are_whole(spark):
    df = spark.range(6000).select(F.lit("a").alias("g"), "id", (F.col("id") % 2).cast("int").alias("cluster"), F.array((F.col("id") % 2) * 9 + F.rand(3)).alias("x"))
    scored = Q.silhouette_samples(df, ["g"], ["id"])
    assert scored.count() == 6000 and scored.where("silhouette is null or silhouette < 0.5").count() == 0


def test_silhouettes_send_a_row_to_few_blocks(spark):
    rows = "rows bigint, width int, clusters bigint"
    sizes = spark.createDataFrame([(600, 64, 10), (100_000, 64, 10), (600_000, 64, 10), (600_000, 64, 600_000)], rows).toDF("_rows", "_width", "_clusters")
    found = {(r["_rows"], r["_clusters"]): r["b"] for r in sizes.withColumn("b", Q._blocks(None)).collect()}
    # Copies of a row are what is sent, and as many rows of sums come back; before, it was a block for each 1,024 rows.
    assert found == {(600, 10): 1, (100_000, 10): 12, (600_000, 10): 19, (600_000, 600_000): 586}
    df = spark.createDataFrame([("a", i, i % 3, [float(i * i)]) for i in range(40)], "g string, id int, cluster int, x array<double>")
    plan = Q.silhouette_samples(df, ["g"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan


def test_silhouettes_of_close_points_keep_their_digits(spark):
    rng = np.random.default_rng(11)
    # Far from zero, clusters far apart, their points close and some of them copies.
    label = rng.integers(0, 4, 300)
    x = 1e6 + 100.0 * label[:, None] + np.round(rng.normal(0, 1e-3, (300, 5)), 6)
    x[::7] = x[label == label[0]][0]
    df = spark.createDataFrame(pd.DataFrame({"g": "a", "id": range(300), "cluster": label, "x": list(x)}))
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(2))
    mean = np.stack([d[:, label == c].sum(1) / ((label == c).sum() - (label == c)) for c in range(4)], 1)
    a, b = mean[np.arange(300), label], np.where(np.arange(4) == label[:, None], np.inf, mean).min(1)
    wanted = (b - a) / np.maximum(a, b)
    for rows in (None, 70):
        found = {r["id"]: r["silhouette"] for r in Q.silhouette_samples(df, ["g"], ["id"], block_rows=rows).collect()}
        assert [found[i] for i in range(300)] == pytest.approx(wanted, abs=1e-9)


def test_silhouettes_take_rows_without_a_cluster(spark):
    rows = [("a", 1, 0, [0.0]), ("a", 2, 0, [1.0]), ("a", 3, 1, [9.0]), ("a", 4, 1, [9.5]), ("a", 5, None, [4.0])]
    df = spark.createDataFrame(rows, "g string, id int, cluster int, x array<double>")
    found = {r["id"]: r["silhouette"] for r in Q.silhouette_samples(df, ["g"], ["id"]).collect()}
    assert found[5] == 0.0 and found[1] == pytest.approx((9.25 - 1.0) / 9.25)


def test_settled_parameters_meet_rows_without_a_shuffle(spark):
    df = spark.range(3000).select(F.when(F.col("id") % 9 != 0, "a").alias("g"), "id", (F.col("id") % 700).cast("double").alias("v"))
    bounds = prep.settled(prep.clip_bounds(df, ["v"], 0.01, ["g"]))
    for out in (prep.clip(df, bounds, ["v"], ["g"]), prep.impute_median(df, ["v"], ["g"]), prep.standardize(df, ["v"], ["g"])):
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "rightHint=(strategy=broadcast)" in plan
        assert out.count() == 3000


def test_tasks_of_daily_medians_follow_the_rows(spark, monkeypatch):
    monkeypatch.setattr(panel, "TASK_ROWS", 20, raising=False)
    rows = spark.range(600).select(
        F.lit("a").alias("commodity"), *[F.lit("s").alias(k) for k in panel.SERIES_KEYS],
        F.date_add(F.lit("2001-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("date"),
        (F.col("id") % 100 + 1).cast("double").alias("price"), F.when(F.col("id") % 2 == 0, 0.5).alias("relative_spread"),
    )
    days = panel.daily_medians(rows)
    # Six copies of each of two prices a day; Spark may not join these parts again.
    assert "repartitionbyexpression" in days._jdf.queryExecution().optimizedPlan().toString().lower()
    assert ", 30" in [line for line in days._jdf.queryExecution().optimizedPlan().toString().splitlines() if "RepartitionByExpression" in line][0]
    found = {(r["date"].timetuple().tm_yday, r["price"], r["relative_spread"], r["daily_reports"]) for r in days.collect()}
    assert found == {(d + 1, d + 26.0, 0.5 if d % 2 == 0 else None, 2) for d in range(50)}


def test_single_member_cluster_scores_zero(spark):
    df = spark.createDataFrame([("a", 1, 0, [0.0]), ("a", 2, 0, [1.0]), ("a", 3, 1, [9.0])], "g string, id int, cluster int, x array<double>")
    assert {r["id"]: r["silhouette"] for r in Q.silhouette_samples(df, ["g"], ["id"]).collect()}[3] == 0.0


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.,eE+-dfxna ", max_size=8), min_size=20, max_size=40))
def test_numbers_parse_like_pandas(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r["v"] for r in df.select("i", S.parse_number(F.col("t")).alias("v")).orderBy("i").collect()]
    wanted = pd.to_numeric(pd.Series(texts).str.replace(",", ""), errors="coerce").replace([np.inf, -np.inf], np.nan)
    for f, w, t in zip(found, wanted, texts):
        assert (f is None) == bool(np.isnan(w)), t
        assert f is None or f == pytest.approx(w), t


def test_dates(spark):
    texts = ["2022-01-02", "02/01/2022", "2-1-2022", "12/25/2022", "3 Feb 2022", "2022/03/04", "31/02/2022", "soon", "", None, "2022-01-02 10:00:00"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    found = [r["v"] for r in df.select("i", S.parse_date(F.col("t")).cast("string").alias("v")).orderBy("i").collect()]
    assert found == ["2022-01-02", "2022-01-02", "2022-01-02", "2022-12-25", "2022-02-03", "2022-03-04", None, None, None, None, "2022-01-02"]


def test_keys_and_spelling(spark):
    df = spark.createDataFrame([("  ONION\t",), ("potato",), ("",), (None,)], "c string")
    out = df.select(S.clean_or_default(F.col("c")).alias("k"), S.spelling(F.col("c"), ("Onion",)).alias("s")).collect()
    assert [tuple(r) for r in out] == [("onion", "Onion"), ("potato", None), ("unspecified", None), ("unspecified", None)]


def test_runs_dealt_to_tasks_equal_points_dealt_to_tasks(spark, monkeypatch):
    """Both ways of fitting give the same starts, rounds and clusters, also on resamples and with more centres than points."""
    rng = np.random.default_rng(11)
    pdf = pd.DataFrame({"g": ["a"] * 300 + ["b"] * 4, "id": range(304), "x": [list(v) for v in rng.normal(0, 1, (304, 3))], "mask": [[int(m)] for m in rng.integers(0, 4, 304)]})
    frame = spark.createDataFrame(pdf, "g string, id long, x array<double>, mask array<long>")
    points = materialize(K.points_frame(frame, F.col("g"), F.col("id"), mask=F.col("mask")))

    def fitted():
        runs = [K.Run("a", k, (42, s), bit) for k in (2, 5) for s in range(2) for bit in (-1, 0, 1)] + [K.Run("b", 6, (1, 0))]
        K.fit(points, runs)
        return runs

    one = fitted()
    monkeypatch.setattr(K, "SENT_BYTES", 0)
    for r, s in zip(one, fitted()):
        assert r.sizes.tolist() == s.sizes.tolist() and r.iterations == s.iterations and r.converged == s.converged
        assert r.centers == pytest.approx(s.centers) and r.inertia == pytest.approx(s.inertia)
