"""Size-aware heavy-light join: documents whose shingle sets have a Jaccard similarity of at least ``percent``.

Texts with equal sets are one class. Classes are dealt to levels of growing size; at every level two linked sets differ in at
most a known number of shingles.

* Small sets, below a boundary level: every subset of the fixed sizes that two linked sets must share is enumerated, and
  sets that share one meet.
* Large sets: one inverted list per level and block of shingles. The shingles of a level are dealt to one block more
  than linked sets can differ in, so some block is equal in both; a list holds the sets whose block has the same content. (Lists
  of single shingles would hold every document with a common line.) Lists are scanned in blocks of a bounded number of members.

The boundary is the level at which the counted rows of subsets below, and the counted rows and meetings of lists from there on, cost least.

Members of a list carry an odd sketch, the parity of the shingles that fall on each bit. Sketches differ in no more bits than the sets differ in
shingles, so pairs whose sketches differ too much are no links for certain. Of the rest, each member
offers its nearest partners of other components for confirmation on the full sets, then more of them, until all pairs are
confirmed, refused or within one component. So a group of near copies costs a few pairs a member, and no link is lost.

Defined cases: a null or empty text, or one of white space, has an empty set and is linked with nothing; with fewer words than a
shingle has, the whole sequence is one shingle; every row is a document of its own, rows that share a doc_id included; a row with a
null doc_id takes no part and has a null component; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from serieskit.llm.common import small_batches, stored, texts
from serieskit.llm.hashing import chunks, mixed, shingles
from serieskit.llm.links import LEVEL_BITS, Levels, components_of_rows, distinct_sets, list_parts, odd_sketch, set_name, settled_groups

# Largest set whose subsets may be enumerated; from there on a single set has more of them than a long text has words.
MOST_LISTED = 40
# What the look at one pair of a list costs, in rows.
MEETING = 0.05

SIGNED = "doc_id long, n_shingles long, class_a long, class_b long, keys array<long>, sketch binary, grams binary"


def block_keys(grams: np.ndarray, level: int, levels: Levels) -> np.ndarray:
    """One key for every block of shingles of a set at ``level``; an empty block is a content too."""
    blocks = levels.most(level) + 1
    spread = mixed(grams + np.uint64(2 * level + 1))
    at = ((spread >> np.uint64(32)) * np.uint64(blocks) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(blocks, np.uint64)
    np.add.at(sums, at, mixed(spread ^ grams))
    keys = mixed(mixed(sums + np.uint64(level + 1)) + np.arange(blocks, dtype=np.uint64))
    return (keys >> np.uint64(LEVEL_BITS) << np.uint64(LEVEL_BITS)) | np.uint64(level)


def _sign(words: int, levels: Levels):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole = [t.encode() for t in batch.column("text").to_pylist()]
            for first, part in chunks(whole):
                hashed, borders, _, _ = shingles(part, words)
                out: list[tuple] = []
                for a, b in zip(borders[:-1], borders[1:]):
                    grams = np.unique(mixed(hashed[a:b]))
                    if not len(grams):
                        out.append((0, None, None, [], None, None))
                        continue
                    own, last = int(levels.of(len(grams))), levels.up_to(len(grams))
                    # Where linked sets cannot differ, equal classes are all there is.
                    some = [block_keys(grams, at, levels) for at in range(own, last + 1) if levels.most(at)]
                    keys = np.concatenate(some).view(np.int64) if some else []
                    small = grams.tobytes() if len(grams) < MOST_LISTED else None
                    out.append((len(grams), *set_name(grams), keys, odd_sketch(grams, levels.bits(last)).tobytes(), small))
                columns = list(zip(*out))
                lengths = np.cumsum([0, *map(len, columns[3])], dtype=np.int32)
                flat = np.concatenate([np.asarray(k, np.int64) for k in columns[3]])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, len(part)), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.ListArray.from_arrays(pa.array(lengths), pa.array(flat)), *(pa.array(c, pa.binary()) for c in columns[4:])],
                    ["doc_id", "n_shingles", "class_a", "class_b", "keys", "sketch", "grams"],
                )

    return run


def subset_sizes(size: int, percent: int) -> list[int]:
    """Sizes of the subsets that a set must list to meet every linked set: what it shares with larger ones, and with smaller ones."""
    return sorted({-(-percent * m // 100) for m in range(size, size * 100 // percent + 1)})


def subsets(size: int, percent: int) -> int:
    return 0 if lonely(size, percent) else sum(comb(size, c) for c in subset_sizes(size, percent))


def lonely(size: int, percent: int) -> bool:
    """Whether a set of ``size`` can only be linked with an equal one."""
    return subset_sizes(size, percent) == [size] and size * 100 // percent == size


def _enumerate(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, raw in zip(batch.column("node").to_pylist(), batch.column("grams").to_pylist()):
                grams = mixed(np.frombuffer(raw, np.uint64) + np.uint64(7))
                total, keys = grams.sum(dtype=np.uint64), []
                for chosen in subset_sizes(len(grams), percent):
                    left_out = len(grams) - chosen
                    gone = np.array(list(combinations(range(len(grams)), left_out)), np.int64).reshape(comb(len(grams), left_out), left_out)
                    keys.append(mixed(total - grams[gone].sum(axis=1, dtype=np.uint64) + np.uint64(chosen << 1)))
                keys = np.concatenate(keys) >> np.uint64(LEVEL_BITS) << np.uint64(LEVEL_BITS) | np.uint64((1 << LEVEL_BITS) - 1)
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(np.full(len(keys), node, np.int64))], ["key", "node"])

    return run


def boundary(sizes: dict[int, int], meetings: dict[int, int], levels: Levels) -> int:
    """The level from which on lists are scanned; below, subsets are enumerated.

    ``sizes`` counts the classes of each size that may be enumerated, ``meetings`` the pairs of members of every level's lists.
    Levels above have lists either way and do not bear on the choice.
    """
    best, least, spent, saved = 0, 0.0, 0.0, 0.0
    for level in range(int(levels.of(MOST_LISTED))):
        a, b = (int(x) for x in levels.starts[level : level + 2])
        spent += sum(sizes.get(n, 0) * subsets(n, levels.percent) for n in range(a, b))
        rows = sum(many for n, many in sizes.items() if levels.of(n) <= level <= levels.up_to(n)) * (levels.most(level) + 1)
        saved += rows + MEETING * meetings.get(level, 0) if levels.most(level) else 0
        if spent - saved < least:
            best, least = level + 1, spent - saved
    return best


def level_of(key: str = "key") -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << LEVEL_BITS) - 1).cast("long"))


def join(docs: DataFrame, words: int = 3, percent: int = 90) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs``."""
    small_batches(docs.sparkSession)
    levels = Levels(percent)
    signed = stored(texts(docs).mapInArrow(_sign(words, levels), SIGNED), "signed")
    classes = stored(distinct_sets(signed, ["keys", "sketch", "grams"]), "sets")
    lists = classes.select("node", F.explode("keys").alias("key"))
    counts = stored(lists.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"), "lists")
    few = classes.where(F.col("n_shingles") < MOST_LISTED).groupBy("n_shingles").count()
    meets = counts.groupBy(level_of().alias("level")).agg(F.sum(F.expr("members * (members - 1) / 2")).alias("meets"))
    start = boundary({r[0]: r[1] for r in few.collect()}, {r.level: int(r.meets) for r in meets.collect()}, levels)
    parts = list_parts(lists, counts.where(level_of() >= start))
    if start:
        enumerated = [n for n in range(1, int(levels.starts[start])) if not lonely(n, percent)]
        listed = classes.where(F.col("n_shingles").isin(enumerated)).select("node", "grams").mapInArrow(_enumerate(percent), "key long, node long")
        listed = stored(listed, "subsets")
        parts = parts.union(list_parts(listed, listed.groupBy("key").agg(F.count("*").alias("members")).where("members > 1")))
    parts = stored(parts, "parts")
    return components_of_rows(signed, classes, settled_groups(docs, classes, parts, words, percent))
