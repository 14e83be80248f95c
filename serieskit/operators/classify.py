"""Classifiers fitted by Spark ML on train rows; preparation learns only a few numbers per feature."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import Bucketizer, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.config import TEMPERATURE_SHIFTS, DemandConfig
from serieskit.operators import exact_tree, newton
from serieskit.operators.ordered import exact_quantiles
from serieskit.operators.prep import long_form, scale_width, scaled_value
from serieskit.operators.splits import class_weights
from serieskit.session import materialize

ADDITIVE = "Additive model"
LOGISTIC_BASE = "Logistic Regression: demand/calendar"
LOGISTIC_WEATHER = "Logistic Regression: weather enhanced"
TREE = "Shallow Decision Tree"
TREE_DEPTH = 5


def weighted(train: DataFrame) -> DataFrame:
    """Train rows with the balanced class weight; both classes must be there."""
    rows = {r["target"]: r["weight"] for r in class_weights(train).collect()}
    if set(rows) != {0, 1}:
        raise ValueError("the training rows hold only one class")
    return train.withColumn("weight", F.when(F.col("target") == 1, F.lit(rows[1])).otherwise(F.lit(rows[0])))


def fill_values(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Train medians of the features that have gaps; a feature never seen is filled with 0."""
    gaps = train.agg(*[F.count(F.when(F.col(f).isNull(), 1)).alias(f) for f in features]).first().asDict()
    holed = [f for f in features if gaps[f]]
    if not holed:
        return {}
    rows = exact_quantiles(long_form(train, holed, []), ["feature"], "value", {"median": 0.5}).collect()
    known = {r["feature"]: r["median"] for r in rows}
    return {f: known.get(f, 0.0) for f in holed}


def scale_values(train: DataFrame, features: Sequence[str], fill: dict[str, float]) -> dict[str, tuple[float, float]]:
    stats = train.agg(*[
        c for f in features
        for c in (F.avg(_filled(f, fill)).alias(f"m_{f}"), scale_width(_filled(f, fill)).alias(f"d_{f}"))
    ]).first()
    return {f: (stats[f"m_{f}"], stats[f"d_{f}"]) for f in features}


def _filled(f: str, fill: dict[str, float]) -> Column:
    c = F.col(f).cast("double")
    return F.coalesce(c, F.lit(float(fill[f]))) if f in fill else c


@dataclass
class Fitted:
    """A fitted classifier with everything needed to score new rows."""

    name: str
    features: list[str]
    model: object
    fill: dict = field(default_factory=dict)
    scale: dict = field(default_factory=dict)
    bins: object = None

    def vector(self, df: DataFrame) -> DataFrame:
        if self.bins is not None:
            return self.bins.transform(df)
        parts = []
        for f in self.features:
            c = _filled(f, self.fill)
            parts.append(scaled_value(c, *(F.lit(v).cast("double") for v in self.scale[f])) if f in self.scale else c)
        return df.withColumn("features", array_to_vector(F.array(*parts)))

    def score(self, df: DataFrame) -> DataFrame:
        kept = df.columns
        out = self.model.transform(self.vector(df)).withColumn("score", vector_to_array("probability")[1])
        return out.select(*kept, "score").withColumn("model", F.lit(self.name))


def fit_logistic(train: DataFrame, features: list[str], cfg: DemandConfig, name: str) -> Fitted:
    return fit_logistics({name: (train, features)}, cfg)[name]


def fit_logistics(wanted: dict[str, tuple[DataFrame, list[str]]], cfg: DemandConfig) -> dict[str, Fitted]:
    """L2 logistic regressions on filled, scaled features with balanced weights, one for each name; all take their Newton steps together.

    The penalty is half the squared norm of the coefficients, without the intercept.
    """
    made, parts = {}, []
    for name, (train, features) in wanted.items():
        fill = fill_values(train, features)
        made[name] = Fitted(name, features, None, fill, scale_values(train, features, fill))
        x = vector_to_array("features").alias("x")
        parts.append(made[name].vector(weighted(train)).select(F.lit(name).alias("key"), x, F.col("target").cast("double").alias("y"), F.col("weight").cast("double").alias("w")))
    rows = materialize(reduce(DataFrame.unionByName, parts))
    for name, found in newton.fit(rows, most_steps=cfg.logistic_iterations).items():
        made[name].model = _logistic_model(rows.sparkSession, found)
    return made


def _logistic_model(spark, found: newton.Solution) -> LogisticRegressionModel:
    """The solution as a model of Spark ML, so that it scores, is saved and read as one."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    values = gateway.new_array(gateway.jvm.double, len(found.coefficients))
    for i, v in enumerate(found.coefficients):
        values[i] = float(v)
    vector = jvm.org.apache.spark.ml.linalg.Vectors.dense(values)
    name = jvm.org.apache.spark.ml.util.Identifiable.randomUID("logreg")
    return LogisticRegressionModel(jvm.org.apache.spark.ml.classification.LogisticRegressionModel(name, vector, found.intercept))


def fit_tree(train: DataFrame, features: list[str], cfg: DemandConfig, name: str = TREE) -> Fitted:
    """A tree of five levels with exact splits and balanced weights; a leaf holds at least 50 rows and a thousandth of all."""
    fitted = Fitted(name, features, None, fill_values(train, features))
    rows = fitted.vector(weighted(train)).select(vector_to_array("features").alias("x"), F.col("target").cast("double").alias("y"), F.col("weight").cast("double").alias("w"))
    fitted.model = exact_tree.fit(materialize(rows), TREE_DEPTH, max(50, train.count() // 1000))
    return fitted


@dataclass
class Bins:
    """Binned columns of an additive model and their place in the one-hot vector."""

    borders: dict
    ends: dict
    pairs: list
    encoder: object = None
    terms: list = field(default_factory=list)
    sizes: list = field(default_factory=list)

    def indices(self, df: DataFrame) -> DataFrame:
        names = list(self.borders)
        df = df.withColumns({f"_v_{n}": F.coalesce(F.col(n[0]).cast("double"), F.lit(float("nan"))) for n in names})
        splits = [[float("-inf"), *self.borders[n], float("inf")] for n in names]
        cut = Bucketizer(splitsArray=splits, inputCols=[f"_v_{n}" for n in names], outputCols=[f"_i_{n}" for n in names], handleInvalid="keep")
        df = cut.transform(df)
        for a, b in self.pairs:
            width = len(self.borders[(b, "pair")]) + 2
            first, second = F.col(f"`_i_{(a, 'pair')}`"), F.col(f"`_i_{(b, 'pair')}`")
            df = df.withColumn(f"_i_{a} & {b}", first * F.lit(float(width)) + second)
        return df

    def inputs(self) -> list[str]:
        mains = [f"_i_{n}" for n in self.borders if n[1] == "main"]
        return mains + [f"_i_{a} & {b}" for a, b in self.pairs]

    def transform(self, df: DataFrame) -> DataFrame:
        indexed = self.indices(df)
        encoded = self.encoder.transform(indexed)
        outs = self.encoder.getOutputCols()
        return VectorAssembler(inputCols=outs, outputCol="features").transform(encoded)


def learn_bins(train: DataFrame, features: list[str], pairs: list[tuple[str, str]], cfg: DemandConfig) -> Bins:
    """Equal-share borders of every feature from one pass of quantile sketches."""
    wanted = {(f, "main"): cfg.max_bins for f in features}
    wanted |= {(f, "pair"): cfg.max_interaction_bins for p in pairs for f in p}
    sketches = []
    for i, ((f, _), bins) in enumerate(wanted.items()):
        shares = F.array(*[F.lit(j / bins) for j in range(1, bins)])
        sketches.append(F.percentile_approx(F.col(f).cast("double"), shares, F.lit(10_000)).alias(f"b{i}"))
    ends = [c for i, f in enumerate(features) for c in (F.min(f).cast("double").alias(f"lo{i}"), F.max(f).cast("double").alias(f"hi{i}"))]
    row = train.agg(*sketches, *ends).first()
    borders = {}
    for i, name in enumerate(wanted):
        distinct = sorted(set(row[f"b{i}"] or [0.0]))
        borders[name] = distinct
    edges = {f: (row[f"lo{i}"], row[f"hi{i}"]) for i, f in enumerate(features)}
    bins = Bins(borders, edges, pairs)
    inputs = bins.inputs()
    encoder = OneHotEncoder(inputCols=inputs, outputCols=[f"_o_{i}" for i in range(len(inputs))], handleInvalid="keep", dropLast=False)
    bins.encoder = encoder.fit(bins.indices(train))
    bins.terms = features + [f"{a} & {b}" for a, b in pairs]
    bins.sizes = [int(n) + 1 for n in bins.encoder.categorySizes]
    return bins


def interaction_pairs(features: Sequence[str], cfg: DemandConfig) -> list[tuple[str, str]]:
    wanted = [("demand_now", f"change_{cfg.change_minutes}min"), ("temperature", "humidity")]
    return [p for p in wanted if set(p) <= set(features)]


def fit_additive(train: DataFrame, features: list[str], cfg: DemandConfig, name: str = ADDITIVE) -> Fitted:
    """Additive model on binned features and two binned interactions; a missing value is its own bin."""
    bins = learn_bins(train, features, interaction_pairs(features, cfg), cfg)
    fitted = Fitted(name, features, None, bins=bins)
    learner = LogisticRegression(
        featuresCol="features", labelCol="target", weightCol="weight", regParam=1.0 / train.count(), elasticNetParam=0.0,
        standardization=False, maxIter=cfg.additive_iterations, tol=1e-6,
    )
    fitted.model = learner.fit(fitted.vector(weighted(train)).select("features", "target", "weight"))
    return fitted


def _bin_weights(fitted: Fitted, train: DataFrame) -> DataFrame:
    """Per term and bin: train rows and contribution, centred over the train rows."""
    bins, spark = fitted.bins, train.sparkSession
    coefficients = fitted.model.coefficients.toArray()
    rows, at = [], 0
    for term, size in zip(bins.terms, bins.sizes):
        rows += [(term, b, float(coefficients[at + b])) for b in range(size)]
        at += size
    effects = spark.createDataFrame(rows, "term string, bin int, raw double")
    cells = ", ".join(f"'{t}', cast(`{c}` as int)" for t, c in zip(bins.terms, bins.inputs()))
    counts = bins.indices(train).select(F.expr(f"stack({len(bins.terms)}, {cells}) as (term, bin)")).groupBy("term", "bin").agg(F.count("*").alias("rows"))
    joined = effects.join(counts, ["term", "bin"], "left").fillna(0, ["rows"])
    centre = joined.groupBy("term").agg((F.sum(F.col("raw") * F.col("rows")) / F.sum("rows")).alias("_centre"))
    return joined.join(centre, "term").withColumn("contribution", F.col("raw") - F.col("_centre")).drop("_centre", "raw")


def term_importance(fitted: Fitted, train: DataFrame) -> DataFrame:
    weights = _bin_weights(fitted, train)
    value = F.sum(F.abs("contribution") * F.col("rows")) / F.sum("rows")
    return weights.groupBy("term").agg(value.alias("mean_absolute_score_contribution"))


def effect_table(fitted: Fitted, train: DataFrame, features: Sequence[str]) -> DataFrame:
    """Middle of each bin and its contribution."""
    rows = []
    for f in features:
        low, high = fitted.bins.ends[f]
        inner = fitted.bins.borders[(f, "main")]
        if low is None:
            continue
        edges = [min(low, inner[0]), *inner, max(high, inner[-1])]
        rows += [(f, b, (edges[b] + edges[b + 1]) / 2) for b in range(len(edges) - 1)]
    middles = train.sparkSession.createDataFrame(rows, "term string, bin int, feature_value double")
    out = middles.join(_bin_weights(fitted, train), ["term", "bin"])
    return out.select(F.col("term").alias("feature"), "bin", "feature_value", F.col("contribution").alias("score_contribution"))


def coefficient_table(fitted: Fitted, spark) -> DataFrame:
    pairs = list(zip(fitted.features, (float(c) for c in fitted.model.coefficients)))
    return spark.createDataFrame(pairs, "feature string, standardized_coefficient double")


def whatif_temperature(fitted: Fitted, labelled: DataFrame, anchors: DataFrame, shifts: Sequence[int] = TEMPERATURE_SHIFTS) -> DataFrame:
    """Scores of three anchor rows with the temperature moved; the product feature follows."""
    rows = labelled.join(F.broadcast(anchors), "slot").withColumn("temperature_change_C", F.explode(F.array(*[F.lit(s) for s in shifts])))
    moved = {c: F.col(c) + F.col("temperature_change_C") for c in ("temperature", "dew_point") if c in labelled.columns}
    shifted = rows.withColumns(moved).withColumn("temperature_x_humidity", F.col("temperature") * F.col("humidity") / 100)
    return fitted.score(shifted).select("case", F.col("timestamp").cast("string").alias("timestamp"), "temperature_change_C", F.col("score").alias("model_alert_score"))
