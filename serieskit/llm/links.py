"""Links between documents by their shingle sets: lists of members in, confirmed groups out. Shared by the operators on pairs.

Members of a list carry an odd sketch, the parity of the shingles that fall on each bit. Sketches differ in no more bits than the sets differ in
shingles, so pairs whose sketches differ too much are no links for certain. Of the rest, each member
offers its nearest partners of other components for confirmation on the full sets, then more of them, until all pairs are
confirmed, refused or within one component. So a group of near copies costs a few pairs a member, and no link between members of a list is lost.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import cached_property
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from serieskit.llm.common import discard, stored, texts
from serieskit.llm.hashing import chunks, mixed, shingles

# A level ends where its sets are so many times as large as its smallest.
GROWTH = 1.4
# Keys may end in the number of their level.
LEVEL_BITS = 6
# Members of a list that are compared in one block.
BLOCK_ROWS = 1024
# Partners that a member offers in the first round, and how many times more in each next one.
OFFERS, MORE = 2, 16
SKETCH_LEAST = 64


@dataclass(frozen=True)
class Levels:
    """Size levels at one similarity. Level i holds the sizes from starts[i] up to, not with, starts[i + 1]."""

    percent: int

    @cached_property
    def starts(self) -> np.ndarray:
        out = [1]
        # The last number of a level is that of the keys of subsets.
        while len(out) < 1 << LEVEL_BITS:
            out.append(max(out[-1] + 1, int(out[-1] * GROWTH)))
        return np.array(out, np.int64)

    def of(self, size) -> np.ndarray:
        return np.searchsorted(self.starts, size, side="right") - 1

    def differ(self, both: int) -> int:
        """Most shingles in which two linked sets of ``both`` shingles together differ."""
        return both * (100 - self.percent) // (100 + self.percent)

    def most(self, level: int) -> int:
        """Most shingles in which linked sets differ whose larger one is of ``level``."""
        return self.differ(2 * (int(self.starts[level + 1]) - 1))

    def up_to(self, size: int) -> int:
        """Last level of sets that a set of ``size`` can be linked with."""
        return int(self.of(size * 100 // self.percent))

    def bits(self, level: int) -> int:
        """Bits of a sketch: a power of two, several times what linked sets differ in."""
        return max(SKETCH_LEAST, 1 << (8 * self.most(level) - 1).bit_length())


def odd_sketch(grams: np.ndarray, bits: int) -> np.ndarray:
    """Parity of the shingles that fall on every bit."""
    at = (mixed(grams ^ np.uint64(0x5851F42D4C957F2D)) >> np.uint64(32)).astype(np.int64) & (bits - 1)
    odd = np.bincount(at, minlength=bits).astype(np.uint8) & 1
    return np.packbits(odd, bitorder="little").view(np.uint64)


def folded(sketch: np.ndarray, bits: int) -> np.ndarray:
    """The same sketch at fewer bits, both powers of two."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, bits // 64), axis=0)


def set_name(grams: np.ndarray) -> tuple[int, int]:
    """128 bits of hash of a sorted set, as two numbers."""
    return tuple(int(v) for v in np.frombuffer(blake2b(grams.tobytes(), digest_size=16).digest(), np.int64))


def list_parts(keys: DataFrame, counts: DataFrame) -> DataFrame:
    """(key, part, own, node) of every list in ``counts``: whole if it is short, else dealt to all pairs of its blocks.

    Part (i, j) holds the members of blocks i and j; ``own`` is a member's block.
    """
    dealt = keys.join(counts.withColumn("pieces", F.ceil(F.col("members") / BLOCK_ROWS).cast("int")), "key")
    dealt = dealt.withColumn("own", F.pmod(F.xxhash64("node", F.lit(3)), F.col("pieces")).cast("int"))
    parts = F.transform(F.sequence(F.lit(0), F.col("pieces") - 1), lambda j: F.least("own", j) * F.col("pieces") + F.greatest("own", j))
    return dealt.select("key", F.explode(parts).alias("part"), "own", "node")


def _nearest(pairs: np.ndarray, offers: int) -> np.ndarray:
    """Which of the pairs (member, member, distance) are among the ``offers`` nearest of either member."""
    x, y, apart = pairs
    ends, others, far = np.concatenate([x, y]), np.concatenate([y, x]), np.concatenate([apart, apart])
    order = np.lexsort((others, far, ends))
    first = np.concatenate([[True], ends[order][1:] != ends[order][:-1]])
    place = np.arange(len(order))
    rank = np.empty(len(order), np.int64)
    rank[order] = place - np.maximum.accumulate(np.where(first, place, 0))
    near = rank < offers
    return near[: len(x)] | near[len(x) :]


def _judge(rows: pa.Table, percent: int, offers: int) -> pa.RecordBatch:
    key, part, own, node, size, group = (rows.column(c).to_numpy() for c in ("key", "part", "own", "node", "size", "component"))
    sketches = rows.column("sketch").to_pylist()
    unit = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (part[1:] != part[:-1])]))
    starts = np.flatnonzero(np.concatenate([[True], unit[1:] != unit[:-1]]))
    # In a part of two blocks only members of different blocks are compared.
    whole = (np.minimum.reduceat(own, starts) == np.maximum.reduceat(own, starts))[unit]
    # Members of a list are compared at the bits of its smallest sketch.
    length = np.array([8 * len(s) for s in sketches])
    bits, found = np.minimum.reduceat(length, starts)[unit], []
    for many in np.unique(bits):
        here = np.flatnonzero(bits == many)
        odd = np.stack([folded(np.frombuffer(sketches[r], np.uint64), many) for r in here])
        i = np.arange(len(here))
        for step in range(1, len(here)):
            # Members of a part follow each other, so parts that are shorter than the step drop out.
            i = i[i + step < len(here)]
            i = i[unit[here[i]] == unit[here[i + step]]]
            if not len(i):
                break
            x, y = here[i], here[i + step]
            fits = (group[x] != group[y]) & (100 * np.minimum(size[x], size[y]) >= percent * np.maximum(size[x], size[y])) & (whole[x] | (own[x] != own[y]))
            apart = np.bitwise_count(odd[i[fits]] ^ odd[i[fits] + step]).sum(axis=1, dtype=np.int64)
            x, y = x[fits], y[fits]
            near = apart <= (size[x] + size[y]) * (100 - percent) // (100 + percent)
            found.append(np.stack([x[near], y[near], apart[near]]))
    pairs = np.concatenate(found, axis=1) if found else np.zeros((3, 0), np.int64)
    kept = _nearest(pairs, offers) if pairs.shape[1] else np.zeros(0, bool)
    open_ = np.zeros(len(starts), bool)
    open_[unit[pairs[0][~kept]]] = True
    x, y = pairs[0][kept], pairs[1][kept]
    # Members of parts that hold more pairs follow, without a partner.
    again = np.flatnonzero(open_[unit])
    first = np.concatenate([np.minimum(node[x], node[y]), node[again]])
    second = np.concatenate([np.maximum(node[x], node[y]), np.zeros(len(again), np.int64)])
    alone = np.arange(len(first)) >= len(x)
    columns = [pa.array(first), pa.array(second, mask=alone), *(pa.array(np.concatenate([c[x], c[again]])) for c in (key, part, own))]
    return pa.RecordBatch.from_arrays(columns, ["a", "b", "key", "part", "own"])


def _offer(percent: int, offers: int):
    """Pairs (a, b) that may be linked, the nearest of each member, and the members (a alone) of parts that hold others."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            if sum(b.num_rows for b in held) < 4 * BLOCK_ROWS:
                continue
            rows = pa.Table.from_batches(held).combine_chunks()
            key, part = rows.column("key").to_numpy(), rows.column("part").to_numpy()
            # The last part may go on in the next batch.
            cut = int(np.argmax((key == key[-1]) & (part == part[-1])))
            held = rows.slice(cut).to_batches()
            if cut:
                yield _judge(rows.slice(0, cut), percent, offers)
        if held:
            yield _judge(pa.Table.from_batches(held).combine_chunks(), percent, offers)

    return run


def _sets(words: int):
    """node and shingles of the rows that are of the wanted class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, wanted = batch.column("node").to_pylist(), list(zip(batch.column("class_a").to_pylist(), batch.column("class_b").to_pylist()))
            whole = [t.encode() for t in batch.column("text").to_pylist()]
            for first, part in chunks(whole):
                hashed, borders, _, _ = shingles(part, words)
                out = []
                for i, (a, b) in enumerate(zip(borders[:-1], borders[1:]), first):
                    grams = np.unique(mixed(hashed[a:b]))
                    if set_name(grams) == wanted[i]:
                        out.append((nodes[i], grams.tobytes()))
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.binary())], ["node", "grams"])

    return run


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= percent * (len(x) + len(y) - both))
            keep = pa.array(linked, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])

    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are links by their full sets."""
    both = pairs.join(sets.select(F.col("node").alias("a"), F.col("grams").alias("grams_a")), "a")
    both = both.join(sets.select(F.col("node").alias("b"), F.col("grams").alias("grams_b")), "b")
    return both.select("a", "b", "grams_a", "grams_b").mapInArrow(_confirm(percent), "a long, b long")


def distinct_sets(signed: DataFrame, carried: Sequence[str]) -> DataFrame:
    """One row of every distinct set: its node (the smallest doc_id, or a made name where texts share an id), and what belongs to the set."""
    some = signed.where("n_shingles > 0 and doc_id is not null").groupBy("class_a", "class_b")
    classes = stored(some.agg(F.min("doc_id").alias("doc_id"), *[F.first(c).alias(c) for c in ("n_shingles", *carried)]), "classes")
    several = classes.groupBy("doc_id").agg(F.count("*").alias("sets"), F.min(F.struct("class_a", "class_b")).alias("least")).where("sets > 1").select(F.col("doc_id").alias("several"), "least")
    made = F.shiftrightunsigned(F.xxhash64("doc_id", "class_a", "class_b"), 2) + F.lit(1 << 62)
    other = F.col("several").isNotNull() & (F.struct("class_a", "class_b") != F.col("least"))
    return classes.join(several, F.col("doc_id") == F.col("several"), "left").withColumn("node", F.when(other, made).otherwise(F.col("doc_id"))).drop("several", "least")


def components(links: DataFrame, most_rounds: int = 60) -> DataFrame:
    """node and component (smallest node reachable) of every node of ``links`` (a, b).

    Every round takes the least label among the neighbours and then the label of that label, so labels reach along paths of doubling length.
    """
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy("a").agg(F.min("b").alias("b")).select(F.col("a").alias("node"), F.least("a", "b").alias("component")), "labels")
    for _ in range(most_rounds):
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("near"))
        met = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("component"))
        far = labels.select(F.col("node").alias("component"), F.col("component").alias("far"))
        after = stored(met.join(far, "component").select("node", "was", F.least("component", "far").alias("component")), "labels")
        moved = after.where("component < was").limit(1).count()
        discard(labels)
        labels = after
        if not moved:
            discard(both)
            return labels.select("node", "component")
    raise RuntimeError("components did not settle")


def settled_groups(docs: DataFrame, classes: DataFrame, parts: DataFrame, words: int, percent: int, links: DataFrame | None = None) -> DataFrame | None:
    """node and component of all linked nodes; None if there is no link.

    ``classes`` has node, doc_id, class_a, class_b, n_shingles and sketch; ``parts`` is made by ``list_parts`` and stored; ``links`` hold in any case.
    """
    facts = classes.select("node", F.col("n_shingles").alias("size"), "sketch")
    groups, sets, tested, offers = None, None, None, OFFERS
    if links is not None:
        groups = components(links)
    while True:
        rows = parts.join(facts, "node")
        rows = rows.withColumn("component", F.col("node")) if groups is None else rows.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
        rows = rows.repartition("key", "part").sortWithinPartitions("key", "part", "node")
        offered = stored(rows.mapInArrow(_offer(percent, offers), "a long, b long, key long, part int, own int"), "offers")
        fresh = offered.where("b is not null").select("a", "b").distinct()
        fresh = stored(fresh if tested is None else fresh.join(tested, ["a", "b"], "left_anti"), "pairs")
        discard(parts)
        parts, spent = offered.where("b is null").select("key", "part", "own", F.col("a").alias("node")), offered
        if sets is None:
            # All that this and later rounds look at: partners of the first round and members of parts that hold more.
            nodes = fresh.select(F.col("a").alias("node")).union(fresh.select("b")).union(parts.select("node")).distinct()
            wanted = classes.select("doc_id", "node", "class_a", "class_b").join(nodes, "node", "left_semi")
            sets = texts(docs).join(wanted, "doc_id").mapInArrow(_sets(words), "node long, grams binary")
            sets = stored(sets.groupBy("node").agg(F.first("grams").alias("grams")), "full-sets")
        met = stored(confirmed(fresh, sets, percent), "links")
        if met.limit(1).count():
            links = met if links is None else stored(links.union(met), "links")
            groups = components(links)
        if not parts.limit(1).count():
            discard(spent, sets)
            return groups
        tested = fresh if tested is None else stored(tested.union(fresh), "tested")
        offers *= MORE


def components_of_rows(signed: DataFrame, classes: DataFrame, groups: DataFrame | None) -> DataFrame:
    """doc_id, n_shingles and component_id, the smallest doc_id of its component, of every row of ``signed``."""
    heads = classes.select("class_a", "class_b", "node", "doc_id")
    heads = heads.withColumn("component", F.col("node")) if groups is None else heads.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = heads.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    heads = heads.drop("node", "doc_id").join(least, "component").drop("component")
    out = signed.select("doc_id", "n_shingles", "class_a", "class_b").join(heads, ["class_a", "class_b"], "left")
    alone = (F.col("n_shingles") == 0) | F.col("doc_id").isNull()
    return out.select("doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))
