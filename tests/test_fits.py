"""Newton fits and exact trees against Spark ML and plain searches."""

import numpy as np
import pandas as pd
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from serieskit.operators import exact_tree, metrics as M, newton
from serieskit.session import materialize


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(4)
    parts = []
    for key, n, p in (("one", 600, 5), ("two", 300, 3), ("far", 80, 2)):
        x = rng.normal(0, 1, (n, p))
        y = (x[:, 0] * (50 if key == "far" else 1.5) + 0.3 * rng.normal(0, 1, n) > 0).astype(float)
        parts.append(pd.DataFrame({"key": key, "x": list(x), "y": y, "w": rng.choice([0.5, 2.0], n)}))
    return materialize(spark.createDataFrame(pd.concat(parts), "key string, x array<double>, y double, w double").repartition(5))


def test_newton_solves_all_keys_together(rows):
    found = newton.fit(rows)
    assert all(s.converged and s.steps < 30 for s in found.values())
    for key, solution in found.items():
        own = rows.where(F.col("key") == key).withColumn("features", array_to_vector("x"))
        total = own.agg(F.sum("w")).first()[0]
        plain = LogisticRegression(labelCol="y", weightCol="w", regParam=1 / total, elasticNetParam=0.0, standardization=False, maxIter=3000, tol=1e-14).fit(own)
        assert solution.coefficients == pytest.approx(plain.coefficients.toArray(), abs=2e-6) and solution.intercept == pytest.approx(plain.intercept, abs=2e-6)


def plain_tree(x, y, w, depth, least):
    splits = {}

    def gini(s):
        a, b = (w[s] * y[s]).sum(), (w[s] * (1 - y[s])).sum()
        return 2 * a * b / (a + b) if a + b else 0.0

    def cut(node, s, level):
        if level == depth or len(set(y[s])) < 2:
            return
        best = None
        for i in range(x.shape[1]):
            values = np.unique(x[s, i])
            for a, b in zip(values[:-1], values[1:]):
                left, right = s[x[s, i] <= a], s[x[s, i] > a]
                gain = round((gini(s) - gini(left) - gini(right)) / w[s].sum(), 12)
                if min(len(left), len(right)) >= least and gain > 0 and (best is None or gain > best[0]):
                    best = gain, i, (a + b) / 2, left, right
        if best:
            splits[node] = best[1:3]
            cut(2 * node, best[3], level + 1)
            cut(2 * node + 1, best[4], level + 1)

    cut(1, np.arange(len(y)), 0)
    return splits


@pytest.mark.parametrize("least", [1, 12])
def test_exact_tree_against_plain_search(spark, least):
    rng = np.random.default_rng(9)
    x = np.column_stack([np.round(rng.normal(0, 1, 160), 1), rng.integers(0, 5, 160), rng.normal(0, 1, 160)])
    y = ((x[:, 0] > 0.2) ^ (x[:, 1] > 2)).astype(float)
    w = np.where(y == 1, 1.25, 0.75)
    frame = materialize(spark.createDataFrame(pd.DataFrame({"x": list(x), "y": y, "w": w}), "x array<double>, y double, w double"))
    tree = exact_tree.fit(frame, 3, least)
    assert {n: (i, pytest.approx(t)) for n, (i, t) in tree.splits.items()} == plain_tree(x, y, w, 3, least)
    scored = tree.transform(frame.withColumn("features", array_to_vector("x")))
    assert scored.count() == 160 and "probability" in scored.columns


def test_a_tree_of_one_class_is_a_leaf(spark):
    frame = spark.createDataFrame([([1.0], 1.0, 1.0), ([2.0], 1.0, 1.0)], "x array<double>, y double, w double")
    tree = exact_tree.fit(frame, 3)
    assert tree.splits == {} and tree.shares == {1: 1.0}


def test_no_repeats_give_no_intervals(spark):
    days = pd.date_range("2021-12-28", periods=20, freq="D")
    frame = spark.createDataFrame(pd.DataFrame({"timestamp": days, "target": [0, 1] * 10, "prediction": [0, 1, 1, 1] * 5}))
    assert M.day_block_bootstrap(frame, 0).count() == 0 and M.day_block_bootstrap(frame, 5).count() == 3
    numbered = M.numbered_days(frame.select(F.to_date("timestamp").alias("day"))).orderBy("day").collect()
    assert [r["index"] for r in numbered] == list(range(20)) and {r["n_days"] for r in numbered} == {20}
