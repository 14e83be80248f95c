"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

Features are densities of insults (a short fixed lexicon, and words and word stems learned from labelled rows), how
near insults stand to a second person, and rates of capitals, punctuation and obfuscated
spelling. Labelled rows are dealt to folds by a hash of their id: the first teach the lexicon, the next the trees and the last the
calibration, all seen through that one lexicon. So no stage is judged on rows it
has learned from. Ids, language and source are never features.

At most ``LABEL_ROWS`` labelled rows are used, those with the smallest hashes of their id; scoring covers every whole
text and moves no rows.

Defined cases: a null or empty text has all features zero and gets the score of that; a doc_id
with several labels counts as toxic if one says so, labels without id or value are left out; a doc_id with several texts teaches all of them;
without rows of both classes to learn from, every score is the share of toxic labels; without rows of both classes
to calibrate on, the trees' probability is the score.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression, IsotonicRegressionModel
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.llm.common import discard, small_batches, stored, texts

LABEL_ROWS = 24_000
LEXICON_TERMS = 500
THRESHOLD = 0.7
STEMS = (4, 5, 6)

# Plain insults, and words that speak to a second person.
INSULTS = frozenset(
    "idiot idiots moron morons stupid dumb loser losers pathetic worthless disgusting scum trash garbage clown fool imbecile cretin bastard bitch jerk "
    "vermin filth hate kill dumm idioten trottel abschaum widerlich imbécile stupide ordure crétin idiota estúpido basura imbécil asqueroso".split()
)
SECOND_PERSON = frozenset("you your yours yourself u ur du dich dir dein deine euch tu te toi ton ta vous votre usted tú ti vosotros".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": "", ".": "", "-": "", "_": ""})

_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"[^\W\d_][0-9@$*_.\-!]+[^\W\d_][0-9@$*_.\-!\w]*|(?<!\w)(?:[^\W\d_] ){3,}[^\W\d_](?!\w)")

FEATURES = [
    "insult_density", "insults", "learned_density", "learned", "learned_kinds", "hidden_insults", "obfuscation_rate",
    "second_person_rate", "proximity", "capital_rate", "shout_rate", "punctuation_rate", "exclamation_rate", "words",
]


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]

    def holds(self, word: str) -> bool:
        return word in self.words or any(word[:n] in self.stems for n in STEMS if len(word) > n)


def features(text: str, lexicon: Lexicon) -> list[float]:
    """The dense features of one whole text, in the order of ``FEATURES``."""
    lower = text.lower()
    words = _WORD.findall(lower)
    if not words:
        return [0.0] * len(FEATURES)
    n, counts = len(words), Counter(words)
    insults = {w: c for w, c in counts.items() if w in INSULTS}
    known, stems = lexicon.words, lexicon.stems
    learned = {w: c for w, c in counts.items() if w in known or w[:4] in stems and len(w) > 4 or w[:5] in stems and len(w) > 5 or w[:6] in stems and len(w) > 6}
    mixed = _MIXED.findall(lower)
    plain = [m.replace(" ", "").translate(LEET) for m in mixed]
    hidden = sum(p in INSULTS or lexicon.holds(p) for p in plain)
    second = sum(c for w, c in counts.items() if w in SECOND_PERSON)
    near = 0.0
    if second and (insults or learned):
        spoken = np.array([i for i, w in enumerate(words) if w in SECOND_PERSON])
        hits = np.array([i for i, w in enumerate(words) if w in insults or w in learned])
        at = np.searchsorted(spoken, hits)
        gap = np.minimum(np.abs(hits - spoken[np.maximum(at - 1, 0)]), np.abs(spoken[np.minimum(at, len(spoken) - 1)] - hits))
        near = float((1 / gap.clip(1)).sum()) / n
    raw = np.frombuffer(text.encode(errors="replace"), np.uint8)
    letters = max(1, sum(map(len, words)))
    capitals = int(((raw >= 65) & (raw <= 90)).sum())
    marks = int((((raw >= 33) & (raw <= 47)) | ((raw >= 58) & (raw <= 64))).sum())
    a, b = sum(insults.values()), sum(learned.values())
    return [
        a / n, math.log1p(a), b / n, math.log1p(b), math.log1p(len(learned)), math.log1p(hidden), len(mixed) / n,
        second / n, near, capitals / letters, float(capitals > letters / 2), marks / len(raw), text.count("!") / len(raw), math.log1p(n),
    ]


def _featured(lexicon: Lexicon, keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = np.array([features(t, lexicon) for t in batch.column("text").to_pylist()], float).reshape(-1, len(FEATURES))
            columns = [batch.column(name) for name in keep] + [pa.array(np.ascontiguousarray(rows[:, i])) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *FEATURES])

    return run


def featured(docs: DataFrame, lexicon: Lexicon, keep: dict[str, str]) -> DataFrame:
    schema = ", ".join([f"{n} {t}" for n, t in keep.items()] + [f"{n} double" for n in FEATURES])
    return docs.select(*keep, "text").mapInArrow(_featured(lexicon, list(keep)), schema)


def _terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of either class that hold a word, or a word that begins with a stem, summed over a batch."""
    for batch in batches:
        sums: dict[tuple[str, int], list[int]] = {}
        for text, toxic in zip(batch["text"], batch["toxic"]):
            words = set(_WORD.findall(text.lower()))
            terms = {(w, 0) for w in words}
            for n in STEMS:
                terms.update((w[:n], 1) for w in words if len(w) > n)
            for term in terms:
                sums.setdefault(term, [0, 0])[toxic] += 1
        yield pd.DataFrame([(t, s, n, p) for (t, s), (n, p) in sums.items()], columns=["term", "stem", "neg", "pos"])


def learn_lexicon(rows: DataFrame, terms: int = LEXICON_TERMS) -> Lexicon:
    """The words and stems that most surely mark toxic rows: at most ``terms``, by log-odds over their deviation."""
    sums = rows.mapInPandas(_terms, "term string, stem int, neg long, pos long").groupBy("term", "stem").agg(F.sum("neg").alias("neg"), F.sum("pos").alias("pos"))
    p, n = (rows.agg(F.sum("toxic"), F.sum(1 - F.col("toxic"))).first()) or (0, 0)
    p, n = p or 0, n or 0
    odds = F.log((F.col("pos") + 0.5) / (p + 1) / ((F.col("neg") + 0.5) / (n + 1)))
    sure = odds / F.sqrt(1 / (F.col("pos") + 0.5) + 1 / (F.col("neg") + 0.5))
    best = sums.where("pos >= 3").withColumn("odds", odds).withColumn("sure", sure).where("odds > 3 and sure > 2.5").orderBy(F.desc("sure"), "term", "stem").limit(terms).collect()
    return Lexicon(frozenset(r.term for r in best if not r.stem), frozenset(r.term for r in best if r.stem))


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


@dataclass
class Model:
    lexicon: Lexicon
    trees: GBTClassificationModel | None
    steps: IsotonicRegressionModel | None
    share: float

    def score(self, docs: DataFrame, keep: dict[str, str]) -> DataFrame:
        """``keep`` and score (0 to 1) of every row of ``docs``; ``docs`` has a text column without nulls."""
        small_batches(docs.sparkSession)
        if self.trees is None:
            return docs.select(*keep, F.lit(float(self.share)).alias("score"))
        scored = _probability(self.trees, featured(docs, self.lexicon, keep))
        if self.steps is None:
            return scored.select(*keep, F.col("probability_toxic").alias("score"))
        # Steps tie many rows; a thousandth of the trees' own probability keeps their order.
        both = self.steps.transform(scored)
        return both.select(*keep, F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("calibrated") + 0.001 * F.col("probability_toxic"))).alias("score"))


def _probability(trees: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    ready = VectorAssembler(inputCols=FEATURES, outputCol="dense").transform(rows)
    return trees.transform(ready).withColumn("probability_toxic", vector_to_array("probability")[1])


def _both(rows: DataFrame) -> bool:
    return len(rows.select("toxic").distinct().collect()) == 2


def fit(docs: DataFrame, labels: DataFrame, label_rows: int = LABEL_ROWS) -> Model:
    """Learn from at most ``label_rows`` labelled rows whose crc32 rule leaves them for training."""
    small_batches(docs.sparkSession)
    usable = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    usable = usable.where(~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    drawn = usable.orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(label_rows)
    # Bounded by label_rows, so it may be sent to every executor.
    rows = stored(texts(docs).join(F.broadcast(drawn), "doc_id").withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(10)).cast("int")), "toxic-rows")
    share = rows.agg(F.avg("toxic")).first()[0] or 0.0
    lexicon = learn_lexicon(rows.where("fold < 4"))
    ready = stored(featured(rows.where("fold >= 4"), lexicon, {"toxic": "int", "fold": "int"}), "toxic-features")
    trees = steps = None
    learn, check = ready.where("fold < 8"), ready.where("fold >= 8")
    if _both(learn):
        dense = VectorAssembler(inputCols=FEATURES, outputCol="dense").transform(learn).select("dense", F.col("toxic").cast("double").alias("label"))
        trees = GBTClassifier(featuresCol="dense", labelCol="label", maxIter=20, maxDepth=4, stepSize=0.3, minInstancesPerNode=3, seed=7).fit(dense)
        if _both(check):
            judged = _probability(trees, check).select("probability_toxic", F.col("toxic").cast("double").alias("label"))
            steps = IsotonicRegression(featuresCol="probability_toxic", labelCol="label", predictionCol="calibrated").fit(judged)
    discard(rows, ready)
    return Model(lexicon, trees, steps, share)


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels)
    scored = model.score(texts(docs), {"doc_id": "long"})
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_civil(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows whose score reaches the threshold; columns and their order stay."""
    names = docs.columns
    model = fit(docs, labels)
    kinds = dict(docs.dtypes)
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], F.coalesce(F.col("text"), F.lit("")).alias("text"))
    keep = {f"c{i}": kinds[c] for i, c in enumerate(names)}
    scored = model.score(carried, keep).where(F.col("score") < THRESHOLD)
    return scored.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
