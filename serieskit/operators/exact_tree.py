"""A shallow classification tree whose splits are searched at every distinct value.

One level of the tree is one pass: rows are summed per (node, feature, value), running sums over the ordered values give both sides
of every possible split, and the best one of each node is a grouped maximum. Values are ordered by ``running_totals``,
so no task orders a whole feature. The driver holds the splits alone, at most 2 ** depth of them.

Gains are compared at twelve digits; of equal ones the earlier feature and then the lower value wins. A node stays a leaf if its rows
are of one class, if no split leaves ``least_rows`` rows on both sides, or if none gains.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.operators.ordered import running_totals
from serieskit.session import materialize

GAIN_DIGITS = 12


@dataclass
class ExactTree:
    """Splits (feature number, threshold) and positive shares by node; node n has the children 2n and 2n + 1."""

    splits: dict[int, tuple[int, float]] = field(default_factory=dict)
    shares: dict[int, float] = field(default_factory=dict)

    def leaf(self, x: Column, node: int = 1) -> Column:
        if node not in self.splits:
            return F.lit(node)
        i, threshold = self.splits[node]
        return F.when(x[i] <= F.lit(threshold), self.leaf(x, 2 * node)).otherwise(self.leaf(x, 2 * node + 1))

    def transform(self, df: DataFrame) -> DataFrame:
        """``df`` (with a vector column features) and the probability of both classes."""
        share = F.create_map(*[F.lit(v) for n, s in sorted(self.shares.items()) if n not in self.splits for v in (n, float(s))])
        held = df.withColumn("_x", vector_to_array("features"))
        held = held.withColumn("_share", share[self.leaf(F.col("_x"))])
        return held.withColumn("probability", array_to_vector(F.array(1 - F.col("_share"), F.col("_share")))).drop("_x", "_share")


def _impurity(a: Column, b: Column) -> Column:
    """Gini impurity of class weights times their sum."""
    return F.when(a + b > 0, 2 * a * b / (a + b)).otherwise(F.lit(0.0))


def best_splits(rows: DataFrame, least_rows: int) -> DataFrame:
    """node, feature, value (the largest on the left side), after (the next larger one) and gain of each node's best split.

    ``rows`` has node, x, y (0 or 1) and w.
    """
    long = rows.select("node", F.posexplode("x").alias("feature", "value"), (F.col("w") * F.col("y")).alias("pos"), (F.col("w") * (1 - F.col("y"))).alias("neg"))
    sums = long.groupBy("node", "feature", "value").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg"), F.count("*").alias("n"))
    by = ["node", "feature"]
    totals = running_totals(sums, by, "value", ["n", "pos", "neg"])
    left = {c: F.col(f"{c}_before") + F.col(c) for c in ("n", "pos", "neg")}
    right = {c: F.col(f"{c}_total") - left[c] for c in left}
    whole = _impurity(F.col("pos_total"), F.col("neg_total"))
    gain = (whole - _impurity(left["pos"], left["neg"]) - _impurity(right["pos"], right["neg"])) / (F.col("pos_total") + F.col("neg_total"))
    fit = totals.select(*by, "value", F.round(gain, GAIN_DIGITS).alias("gain"), left["n"].alias("left_n"), right["n"].alias("right_n"))
    fit = fit.where((F.col("left_n") >= least_rows) & (F.col("right_n") >= least_rows) & (F.col("gain") > 0))
    best = fit.groupBy("node").agg(F.min(F.struct((-F.col("gain")).alias("g"), "feature", "value")).alias("b"))
    best = best.select("node", "b.feature", "b.value", (-F.col("b.g")).alias("gain"))
    above = sums.join(F.broadcast(best.select("node", "feature", F.col("value").alias("_at"))), by).where(F.col("value") > F.col("_at"))
    return best.join(above.groupBy("node").agg(F.min("value").alias("after")), "node")


def fit(rows: DataFrame, depth: int = 5, least_rows: int = 1) -> ExactTree:
    """A tree over ``rows`` (x array<double> without missing values, y 0 or 1, w weight), a stored table."""
    tree = ExactTree()
    x = F.col("x")
    for level in range(depth + 1):
        placed = rows.withColumn("node", tree.leaf(x))
        facts = placed.groupBy("node").agg((F.sum(F.col("w") * F.col("y")) / F.sum("w")).alias("share")).collect()
        tree.shares |= {r["node"]: r["share"] for r in facts}
        # Nodes of this level whose rows are of both classes may be cut.
        open_ = [r["node"] for r in facts if r["node"] >= 1 << level and 0 < r["share"] < 1]
        if level == depth or not open_:
            return tree
        found = best_splits(placed.where(F.col("node").isin(open_)), least_rows).collect()
        if not found:
            return tree
        for r in found:
            tree.splits[r["node"]] = (r["feature"], (r["value"] + r["after"]) / 2)
    return tree


def split_table(tree: ExactTree, features: Sequence[str], spark) -> DataFrame:
    """Every node with its split, or its positive share where it is a leaf."""
    rows = [
        (n, features[tree.splits[n][0]] if n in tree.splits else None, tree.splits[n][1] if n in tree.splits else None, float(share))
        for n, share in sorted(tree.shares.items())
    ]
    return spark.createDataFrame(rows, "node int, feature string, threshold double, positive_share double")
