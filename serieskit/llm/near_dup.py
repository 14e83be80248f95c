"""MinHash near-duplicates with tensored banding.

Two small collections of half keys are made per document, each half key from ``HALF_ROWS`` minima; a table's
key is one half key of either collection, so HALVES * HALVES tables cost 2 * HALVES * HALF_ROWS minima. Two sets of
similarity s meet in some table with probability (1 - (1 - s**HALF_ROWS)**HALVES)**2: 0.9993 at 0.8, 0.99995 at 0.85.

Texts with equal sets are one class from the start. Documents that share a key are one list: exact sketches rule out most pairs, the rest are
confirmed on their full sets, the nearest of each member first and only while they are in different groups (module ``links``). So a key with many
copies costs a few comparisons each, and no link between members of a key is lost. Groups are the smallest id reachable.

Defined cases: a null or empty text, or one of white space, has an empty set, is linked with
nothing and stays; with fewer words than a shingle has, the whole sequence is one shingle; rows that share a doc_id
are one document and all returned; a row with a null doc_id takes no part, has a null group and stays; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from serieskit.llm.common import discard, small_batches, stored, texts
from serieskit.llm.hashing import chunks, mixed, multipliers, shingles
from serieskit.llm.links import Levels, components_of_rows, distinct_sets, list_parts, odd_sketch, set_name, settled_groups

HALVES = 11
HALF_ROWS = 3

SIGNED = "doc_id long, n_shingles long, class_a long, class_b long, halves array<long>, sketch binary"


def half_keys(grams: np.ndarray, factors: np.ndarray, rows: int) -> np.ndarray:
    """The half keys of a set, from ``rows`` minima each."""
    least = np.array([(grams * f).min() for f in factors], np.uint64).reshape(-1, rows)
    keys = np.arange(len(least), dtype=np.uint64)
    for row in range(rows):
        keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, row])
    return keys


def _sign(words: int, levels: Levels, halves: int, rows: int):
    factors = multipliers(2 * halves * rows, 17)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [t.encode() for t in batch.column("text").to_pylist()]
            for first, part in chunks(whole):
                hashed, borders, _, _ = shingles(part, words)
                out: list[tuple] = []
                for a, b in zip(borders[:-1], borders[1:]):
                    grams = np.unique(mixed(hashed[a:b]))
                    if not len(grams):
                        out.append((0, None, None, None, None))
                        continue
                    sketch = odd_sketch(grams, levels.bits(int(levels.of(len(grams))))).tobytes()
                    out.append((len(grams), *set_name(grams), half_keys(grams, factors, rows).view(np.int64), sketch))
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(part)), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.list_(pa.int64())), pa.array(columns[4], pa.binary())],
                    ["doc_id", "n_shingles", "class_a", "class_b", "halves", "sketch"],
                )

    return run


def table_keys(classes: DataFrame, halves: int) -> DataFrame:
    """One row (key, node) for every table: each pair of half keys of the two collections."""
    n = F.lit(halves)
    pairs = F.transform(
        F.sequence(F.lit(0), n * n - 1),
        lambda t: F.xxhash64(t, F.get("halves", F.floor(t / n).cast("int")), F.get("halves", (n + t % n).cast("int"))),
    )
    return classes.select("node", F.explode(pairs).alias("key"))


def shared_ids(signed: DataFrame, classes: DataFrame) -> DataFrame | None:
    """Links (a, b) between the sets of a doc_id that has several; None if none has."""
    own = signed.where("n_shingles > 0 and doc_id is not null").groupBy("doc_id").agg(F.min(F.struct("class_a", "class_b")).alias("least"), F.max(F.struct("class_a", "class_b")).alias("most"))
    several = stored(own.where("least != most").select("doc_id"), "ids-of-several-sets")
    if not several.limit(1).count():
        return None
    names = classes.select("class_a", "class_b", "node")
    nodes = signed.select("doc_id", "class_a", "class_b").join(several, "doc_id", "left_semi").join(names, ["class_a", "class_b"]).select("doc_id", "node").distinct()
    first = nodes.groupBy("doc_id").agg(F.min("node").alias("a"))
    return stored(nodes.join(first, "doc_id").where("a < node").select("a", F.col("node").alias("b")).distinct(), "links")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80, halves: int = HALVES, rows: int = HALF_ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row of ``docs``."""
    small_batches(docs.sparkSession)
    signed = stored(texts(docs).mapInArrow(_sign(words, Levels(percent), halves, rows), SIGNED), "signatures")
    classes = stored(distinct_sets(signed, ["halves", "sketch"]), "sets")
    keys = table_keys(classes, halves)
    counts = stored(keys.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "shared-keys")
    parts = stored(list_parts(keys, counts), "parts")
    discard(counts)
    out = components_of_rows(signed, classes, settled_groups(docs, classes, parts, words, percent, shared_ids(signed, classes)))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group, one of its smallest doc_id. Columns and their order stay.

    A row is known by its doc_id and text: texts that share an id are documents of their own, repeated rows are one, and rows
    without an id take part too, except those without words. Such rows, and further texts of an id, get a
    hash of 62 bits above all usual ids as their name.
    """
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc_id, text = F.col(f"c{names.index('doc_id')}").cast("long"), F.coalesce(F.col(f"c{names.index('text')}"), F.lit(""))
    rows = carried.withColumn("_doc", doc_id).withColumn("_text", F.xxhash64(text))
    several = rows.where("_doc is not null").groupBy(F.col("_doc").alias("_several")).agg(F.min("_text").alias("_least"), F.max("_text").alias("_most")).where("_least < _most")
    rows = rows.join(stored(several, "ids-of-several-texts"), F.col("_doc") == F.col("_several"), "left")
    made = F.shiftrightunsigned(F.xxhash64("_doc", text), 2) + F.lit(1 << 62)
    rows = rows.withColumn("_node", F.when(F.col("_doc").isNull() | (F.col("_text") > F.col("_least")), made).otherwise(F.col("_doc")))
    rows = rows.withColumn("_wordless", F.col("_doc").isNull() & ~text.rlike(r"[^\x20\x09-\x0d]"))
    rows = rows.drop("_doc", "_text", "_several", "_least", "_most")
    found = near_duplicates(rows.select(F.col("_node").alias("doc_id"), text.alias("text")), words, percent)
    gone = found.where("not kept").select(F.col("doc_id").alias("_gone")).distinct()
    left = rows.join(gone, F.col("_node") == F.col("_gone"), "left_anti")
    many = rows.where("not _wordless").groupBy(F.col("_node").alias("_many")).count().where("count > 1").select("_many")
    once = left.join(many, F.col("_node") == F.col("_many"), "left_anti")
    first = left.join(many, F.col("_node") == F.col("_many"), "left_semi").dropDuplicates(["_node"])
    return once.unionByName(first).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
