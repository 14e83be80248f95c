"""Language of pages by Bayesian fusion of evidence.

Per language l the log posterior adds up, by Bayes' rule,

* the prior of the page's host: counts of the host, smoothed towards its domain, that towards its suffix, that towards all pages;
* the likelihood of the text under byte trigrams, tempered, since neighbouring trigrams repeat each other;
* the likelihood of the language declared in the markup, given l;
* the likelihood of the address suffix, given l.

The trigrams are counted over all texts with a known language, so every language that has a text with letters can be given. Everything else is counted
over all pages by grouped aggregation, weighed by the posterior of the text alone; a page's own weight is left out of its own
host's and domain's counts.

Defined cases: a null or empty html has no text evidence; a null or unreadable url belongs to the empty
host and suffix; no declared language is a value of its own; without any text of known language the result has
no rows; ties go to the language first in the alphabet; other columns are ignored; repeated rows count as often as they come.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.llm.common import small_batches, stored
from serieskit.llm.html_text import main_text

BUCKET_BITS = 15
SMOOTH = 0.5
# A text counts like at most this many independent trigrams, and half of that at as many trigrams.
TEMPER = 120.0
# Pages that a wider group counts as for a narrower one.
HOST_WEIGHT = 5.0

_DECLARED = re.compile(r"<html\b[^>]*?\blang\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", re.I)
_META = re.compile(r"<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?\s*([a-zA-Z]{2,3})", re.I)


def trigrams(text: str) -> np.ndarray:
    """Bucket of every byte trigram of the letters of a text."""
    data = np.frombuffer((" " + " ".join(re.findall(r"[^\W\d_]+", text.lower())) + " ").encode(), np.uint8).astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.uint32)
    code = (data[:-2] << np.uint32(16)) | (data[1:-1] << np.uint32(8)) | data[2:]
    return (code * np.uint32(2654435761)) >> np.uint32(32 - BUCKET_BITS)


@dataclass(frozen=True)
class TextModel:
    languages: tuple[str, ...]
    logs: np.ndarray

    def scores(self, text: str) -> np.ndarray:
        """Tempered log likelihood of a text under every language, from 0 for the best down."""
        found = trigrams(text)
        if not len(found):
            return np.zeros(len(self.languages))
        mean = self.logs[:, found].mean(axis=1)
        out = mean * (TEMPER * len(found) / (TEMPER + len(found)))
        return out - out.max()


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, rows in batch.groupby("lang"):
            own = sums.setdefault(lang, np.zeros(1 << BUCKET_BITS, np.int64))
            for text in rows["text"]:
                own += np.bincount(trigrams(text), minlength=1 << BUCKET_BITS)
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        yield pd.DataFrame({"lang": lang, "bucket": at, "n": own[at]})


def fit_text(docs: DataFrame) -> TextModel:
    """Trigram model of the languages in ``docs`` (text, lang), from all its rows.

    A task gives one number for each of its languages and buckets at most, and the driver gets languages times buckets
    numbers, however many rows there are.
    """
    small_batches(docs.sparkSession)
    known = docs.select("text", F.lower("lang").alias("lang")).where("text is not null and lang is not null and lang <> ''")
    sums = known.mapInPandas(_counts, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(sums["lang"].unique()))
    table = np.zeros((len(languages), 1 << BUCKET_BITS))
    for i, lang in enumerate(languages):
        own = sums[sums["lang"] == lang]
        table[i, own["bucket"].to_numpy(np.int64)] = own["n"]
    table += SMOOTH
    return TextModel(languages, np.log(table / table.sum(axis=1, keepdims=True)) if len(languages) else table)


def _evidence(held):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = held.value
        for batch in batches:
            pages = batch.column("html").to_pylist()
            declared = [(_DECLARED.search(h) or _META.search(h)) for h in pages]
            scores = np.array([model.scores(main_text(h)) for h in pages]).reshape(len(pages), len(model.languages))
            weights = np.exp(scores)
            weights /= weights.sum(axis=1, keepdims=True)
            columns = {n: batch.column(n) for n in batch.schema.names if n != "html"}
            columns["declared"] = pa.array([d[1].lower() if d else "" for d in declared], pa.string())
            for i in range(len(model.languages)):
                columns[f"t{i}"], columns[f"q{i}"] = (pa.array(np.ascontiguousarray(x[:, i])) for x in (scores, weights))
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _host(url: Column) -> Column:
    return F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/@]*@)?([^/:?#]*)", 1))


def identify(pages: DataFrame, docs: DataFrame) -> DataFrame:
    """page_id, url, lang, probability, text_lang and declared of every page."""
    spark = pages.sparkSession
    model = fit_text(docs)
    n = len(model.languages)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", F.coalesce("html", F.lit("")).alias("html"))
    rows = rows.withColumn("host", _host(F.col("url")))
    rows = rows.withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    numbers = ", ".join(f"t{i} double, q{i} double" for i in range(n))
    if not n:
        return rows.limit(0).select("page_id", "url", F.lit("").alias("lang"), F.lit(0.0).alias("probability"), F.lit("").alias("text_lang"), F.lit("").alias("declared"))
    held = spark.sparkContext.broadcast(model)
    seen = stored(rows.mapInArrow(_evidence(held), f"page_id long, url string, host string, domain string, suffix string, declared string, {numbers}"), "language-evidence")

    def sums(key: str, name: str) -> DataFrame:
        return seen.groupBy(key).agg(*[F.sum(f"q{i}").alias(f"{name}{i}") for i in range(n)])

    total = seen.agg(*[F.sum(f"q{i}") for i in range(n)]).first()
    whole = np.array([x or 0.0 for x in total]) + 1.0
    share = whole / whole.sum()
    # Values of a declaration and of a suffix: all that occur, and one more for what did not.
    kinds = {k: seen.agg(F.count_distinct(k)).first()[0] + 1 for k in ("declared", "suffix")}
    out = seen
    for key, name in (("host", "h"), ("domain", "d"), ("suffix", "s"), ("declared", "m")):
        out = out.join(sums(key, name), key)

    def smoothed(name: str, wider: list[Column]) -> list[Column]:
        own = [F.col(f"{name}{i}") - F.col(f"q{i}") for i in range(n)]
        size = sum(own[1:], own[0])
        return [(own[i] + HOST_WEIGHT * wider[i]) / (size + HOST_WEIGHT) for i in range(n)]

    prior = smoothed("h", smoothed("d", [F.lit(float(x)) for x in share]))
    logs = []
    for i in range(n):
        given = [F.log((F.col(f"{name}{i}") - F.col(f"q{i}") + 1.0) / (float(whole[i]) - F.col(f"q{i}") + float(kinds[kind]))) for name, kind in (("s", "suffix"), ("m", "declared"))]
        logs.append(F.log(F.greatest(prior[i], F.lit(1e-12))) + F.col(f"t{i}") + given[0] + given[1])
    out = out.select("page_id", "url", "declared", F.array(*logs).alias("logs"), F.array(*[F.col(f"t{i}") for i in range(n)]).alias("texts"))
    names = F.array(*[F.lit(x) for x in model.languages])
    best = F.array_max("logs")
    mass = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - best))
    return out.select(
        "page_id", "url", F.get(names, F.array_position("logs", best).cast("int") - 1).alias("lang"), (1.0 / mass).alias("probability"),
        F.get(names, F.array_position("texts", F.array_max("texts")).cast("int") - 1).alias("text_lang"), "declared",
    )
