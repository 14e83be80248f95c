"""Hard negatives from labelled integer vectors by Kronecker-packed products.

Components are biased to be non-negative, and one component of several candidates is written into separated fields of one
wide integer. One product of that integer with the anchor's component multiplies all of them at once; the fields are wide
enough for the sum over a run of dimensions, so they never run into each other and unpack into exact scores. Integers of up to
53 bits are held in doubles, where their products and sums are exact, so a task multiplies many of them at once; components too large
for that are packed into Python's integers, which have no limit.

Rows are packed into shards once, in the tasks that read them and without a shuffle. Anchors are taken in blocks of a fixed number
past all shards: a first pass finds each anchor's positives, a second its negatives within the asked share of each positive's
score. A task keeps the best rows of every anchor over all its shards, so what is shuffled follows tasks times anchors. All
anchors times all rows is what an exact answer needs; no bound is put on it.

Defined cases: rows with a null id, a null label, a null or empty vector, or a null or non-finite component take no part; shorter
vectors are filled up with zeros; rows that repeat an id are candidates each, but never positives of an anchor of their own id, and an anchor is made of
every distinct label and vector of an id; ties go to the smaller id; an anchor without another row of its label, and a pair without a negative in its
range, give no rows; a score beyond 64 bits is an error; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from serieskit.llm.common import discard, scratch, stored

# Rows of one shard, and anchors that pass all shards at once.
SHARD_ROWS = 8192
ANCHORS = 8192
# Rows of a shard whose scores are unpacked at once.
STRIP = 1024
# Bits of an integer that a double holds exactly.
WIDE = 53
# A run of fewer dimensions is not worth one more field.
LEAST_RUN = 16

SHARD = "ids binary, labels binary, terms binary, width int"


def labelled(vectors: DataFrame, factor: int, label: Column) -> DataFrame:
    """vec_id, label and terms, floor(factor * x) of every component x, of the rows that take part."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    whole = whole.where("vec_id is not null and label is not null and size(e) > 0")
    sound = whole.where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return sound.select("vec_id", "label", F.transform("e", lambda x: F.floor(F.lit(factor) * x).cast("long")).alias("terms"))


def _matrix(lists: pa.ListArray, width: int) -> np.ndarray:
    lengths = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = lists.flatten().to_numpy()
    return out


def _shards(shard_rows: int):
    def pack(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches).combine_chunks()
        terms = rows.column("terms").combine_chunks()
        terms = terms.chunk(0) if isinstance(terms, pa.ChunkedArray) else terms
        width = int(np.diff(terms.offsets.to_numpy()).max())
        parts = [rows.column("vec_id").to_numpy().tobytes(), rows.column("label").to_numpy().tobytes(), _matrix(terms, width).tobytes()]
        return pa.RecordBatch.from_arrays([*(pa.array([p], pa.binary()) for p in parts), pa.array([width], pa.int32())], ["ids", "labels", "terms", "width"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = shard_rows - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == shard_rows:
                    yield pack(held)
                    held = []
        if held:
            yield pack(held)

    return run


@dataclass
class Block:
    """Anchors, by their place in the block."""

    ids: np.ndarray
    labels: np.ndarray
    terms: np.ndarray


def fields(most: int, width: int) -> tuple[int, int, int]:
    """(fields of an integer, bits of a field, dimensions summed in one) for products of up to ``most``; no fields if not even one fits."""
    best = (0, 0, 0)
    for many in (1, 2, 3, 4):
        bits = WIDE // many
        run = min(width, ((1 << bits) - 1) // max(1, most))
        if run and (many == 1 or run >= min(width, LEAST_RUN)):
            best = (many, bits, run)
    return best


def packed_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products of all anchors with all rows, both integer matrices of one width."""
    low_a, low_r = int(anchors.min(initial=0)), int(rows.min(initial=0))
    high_a, high_r = int(anchors.max(initial=0)) - low_a, int(rows.max(initial=0)) - low_r
    width = rows.shape[1]
    if max(abs(low_a), high_a + low_a) * max(abs(low_r), high_r + low_r) * width >= 1 << 62:
        raise OverflowError("a score is beyond 64 bits")
    many, bits, run = fields(high_a * high_r, width)
    if not many:
        return _wide_scores(anchors, rows)
    a = (anchors - low_a).astype(np.float64)
    per = -(-len(rows) // many)
    wide = np.zeros((per, width), np.int64)
    for field in range(many):
        some = rows[field * per : (field + 1) * per]
        wide[: len(some)] += (some - low_r) << (field * bits)
    wide = wide.astype(np.float64)
    sums = np.zeros((len(anchors), many * per), np.int64)
    for at in range(0, width, run):
        product = (a[:, at : at + run] @ wide[:, at : at + run].T).astype(np.int64)
        for field in range(many):
            sums[:, field * per : (field + 1) * per] += (product >> (field * bits)) & ((1 << bits) - 1)
    # (a - low_a)(r - low_r) summed is what was multiplied.
    return sums[:, : len(rows)] + low_r * anchors.sum(axis=1)[:, None] + low_a * rows.sum(axis=1)[None, :] - width * low_a * low_r


def _wide_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The same with integers without a limit: the fields of all rows in one of them."""
    low = int(rows.min())
    reach = max(abs(int(anchors.min())), abs(int(anchors.max()))) * (int(rows.max()) - low) * rows.shape[1]
    size = (reach.bit_length() + 9) // 8
    mid = int.from_bytes((1 << (8 * size - 1)).to_bytes(size, "little") * len(rows), "little")
    wide = [int.from_bytes(b"".join((int(c) - low).to_bytes(size, "little") for c in rows[:, d]), "little") for d in range(rows.shape[1])]
    out = np.empty((len(anchors), len(rows)), np.int64)
    for i, anchor in enumerate(anchors):
        # The middle of every field keeps sums below zero within it.
        raw = (mid + sum(int(x) * w for x, w in zip(anchor, wide))).to_bytes(size * len(rows) + 1, "little")
        back = low * sum(map(int, anchor)) - (1 << (8 * size - 1))
        out[i] = [int.from_bytes(raw[j * size : (j + 1) * size], "little") + back for j in range(len(rows))]
    return out


class Best:
    """The best rows of every slot met so far, at most ``k``, by score and then by id."""

    def __init__(self, slots: int, k: int):
        self.k = k
        self.bar = np.full(slots, np.iinfo(np.int64).min)
        self.slot = self.ids = self.scores = np.zeros(0, np.int64)

    def add(self, slot: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(slot):
            return
        slot, ids, scores = (np.concatenate(x) for x in ((self.slot, slot), (self.ids, ids), (self.scores, scores)))
        order = np.lexsort((ids, -scores, slot))
        slot, ids, scores = slot[order], ids[order], scores[order]
        place = np.arange(len(slot))
        rank = place - np.maximum.accumulate(np.where(np.concatenate([[True], slot[1:] != slot[:-1]]), place, 0))
        keep = rank < self.k
        self.slot, self.ids, self.scores = slot[keep], ids[keep], scores[keep]
        full = rank == self.k - 1
        self.bar[slot[full]] = scores[full]


def _shard_rows(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    for ids, labels, terms, own in zip(*(batch.column(c).to_pylist() for c in ("ids", "labels", "terms", "width"))):
        ids, labels = np.frombuffer(ids, np.int64), np.frombuffer(labels, np.int64)
        rows = np.frombuffer(terms, np.int64).reshape(-1, own)
        yield ids, labels, np.pad(rows, ((0, 0), (0, width - own))) if own < width else rows


def _positives(block, width: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Block = block.value
        best = Best(len(anchors.ids), k)
        for batch in batches:
            for ids, labels, rows in _shard_rows(batch, width):
                for label in np.intersect1d(labels, anchors.labels):
                    here, mine = np.flatnonzero(labels == label), np.flatnonzero(anchors.labels == label)
                    for at in range(0, len(here), STRIP):
                        some = here[at : at + STRIP]
                        scores = packed_scores(anchors.terms[mine], rows[some])
                        i, j = np.nonzero((scores >= best.bar[mine][:, None]) & (anchors.ids[mine][:, None] != ids[some][None, :]))
                        best.add(mine[i], ids[some][j], scores[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.ids), pa.array(best.scores)], ["slot", "vec_id", "score"])

    return run


def _negatives(block, pairs, width: int, k: int):
    """``pairs`` holds place of the anchor, least and most score of every pair of anchor and positive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: Block = block.value
        owner, least, most = pairs.value
        used = np.unique(owner)
        best = Best(len(owner), k)
        # Pairs of the same place among those of their anchor are judged together.
        place = np.arange(len(owner)) - np.searchsorted(owner, owner)
        for batch in batches:
            for ids, labels, rows in _shard_rows(batch, width):
                for at in range(0, len(ids), STRIP):
                    some = slice(at, at + STRIP)
                    scores = packed_scores(anchors.terms[used], rows[some])
                    other = anchors.labels[used][:, None] != labels[some][None, :]
                    for turn in range(int(place.max(initial=-1)) + 1):
                        slots = np.flatnonzero(place == turn)
                        line = np.searchsorted(used, owner[slots])
                        here = scores if len(line) == len(used) else scores[line]
                        i, j = np.nonzero((here >= np.maximum(least, best.bar)[slots][:, None]) & (here <= most[slots][:, None]) & (other if len(line) == len(used) else other[line]))
                        best.add(slots[i], ids[some][j], here[i, j])
        yield pa.RecordBatch.from_arrays([pa.array(best.slot), pa.array(best.ids), pa.array(best.scores)], ["slot", "vec_id", "score"])

    return run


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("slot").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``rows`` is made by ``labelled``; ``anchors`` says which of them are anchors. Negatives score between ``low`` and ``high`` hundredths of the positive.
    """
    spark = rows.sparkSession
    context = spark.sparkContext
    shards = stored(rows.mapInArrow(_shards(SHARD_ROWS), SHARD), "shards")
    # Anchors are dealt by hash, so a group holds about half a block; a larger one is cut.
    chosen = stored(rows.where(anchors).distinct().withColumn("hash", F.xxhash64("vec_id", "label", "terms")), "anchors")
    many, width = chosen.agg(F.count("*"), F.max(F.size("terms"))).first()
    width = max(width or 0, shards.agg(F.max("width")).first()[0] or 0)
    groups = -(-2 * many // ANCHORS)
    path = scratch(spark, "negatives")
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    for group in range(groups):
        taken = chosen.where(F.pmod("hash", F.lit(groups)) == group).toArrow().combine_chunks()
        for at in range(0, taken.num_rows, ANCHORS):
            part = taken.slice(at, ANCHORS).to_batches()[0]
            block = Block(part.column("vec_id").to_numpy(), part.column("label").to_numpy(), _matrix(pa.concat_arrays([part.column("terms")]), width))
            sent = context.broadcast(block)
            near = _first(shards.mapInArrow(_positives(sent, width, positives), "slot long, vec_id long, score long"), positives).toPandas()
            near = near.sort_values(["slot", "rank"])
            owner, score = near["slot"].to_numpy(np.int64), near["score"].to_numpy(np.int64)
            # Integer bounds of low * p <= 100 * n <= high * p, whatever the sign.
            bounds = [-(-low * int(p) // 100) for p in score], [high * int(p) // 100 for p in score]
            ranges = context.broadcast((owner, *(np.array(b, np.int64) for b in bounds)))
            found = _first(shards.mapInArrow(_negatives(sent, ranges, width, negatives), "slot long, vec_id long, score long"), negatives)
            names = spark.createDataFrame(
                pa.table({"slot": np.arange(len(owner)), "anchor_id": block.ids[owner], "positive_id": near["vec_id"].to_numpy(np.int64), "positive_score": score})
            )
            out = found.join(F.broadcast(names), "slot")
            out.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")).write.mode("append").parquet(path)
            sent.unpersist()
            ranges.unpersist()
    discard(shards, chosen)
    return spark.read.schema(schema).parquet(path) if many else spark.createDataFrame([], schema)
