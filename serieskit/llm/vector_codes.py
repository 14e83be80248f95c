"""Compression of vectors to codes, with codebooks fitted by dual-tree Lloyd rounds.

Vectors are cut into equal parts and every position of a part has a codebook. Blocks of vectors are packed once, in the tasks that read them
and without a shuffle: for each part a tree over the block's points, halved at the widest dimension, with the box and the sum of every
node. A round builds a tree over the entries as well and walks both together: the distance bounds of two boxes drop entries that
are farther than another one for certain; a node of points that is left with one entry is assigned as a whole by
its cached sum, and leaves that stay uncertain compare their points with the entries left in integers. Tasks send one sum and count per entry.
The driver holds the codebooks, whose size is set by parts, entries and width.

Integers are held in doubles as long as all squared distances stay exact there; components too large for that are compared
in Python's integers, without trees.

Defined cases: rows with a null or empty vector, or with a null or non-finite component, are dropped; shorter vectors are filled up with zeros,
and so is a width that is no multiple of the parts; a null id is kept and comes after all others; rows that repeat an id are kept
each and ordered by their components; with fewer rows than entries the codebook has one entry for each row; null labels are one label; a distance or sum beyond
64 bits is an error; no rows give no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from serieskit.llm.common import discard, stored

BLOCK_ROWS = 8192
# Points of a leaf, and entries of one.
LEAF, ENTRY_LEAF = 16, 1
# Squared distances below are exact in doubles.
EXACT = 2**52
# Labels whose sums are broadcast, at most; more are met by a shuffle in which a label is dealt to SALTS places.
FEW_LABELS, SALTS = 100_000, 16

BLOCK = "ids array<long>, labels array<long>, points binary, orders binary, low binary, high binary, total binary"


def integer_vectors(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """vec_id, label and terms, floor(factor * x) of every component x, of the rows that are kept."""
    whole = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), F.col("embedding").cast("array<double>").alias("e"))
    sound = whole.where("size(e) > 0").where(~F.exists("e", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return sound.select("vec_id", "label", F.transform("e", lambda x: F.floor(F.lit(factor) * x).cast("long")).alias("terms"))


def borders(n: int, depth: int) -> np.ndarray:
    """Where the 2 ** depth nodes of a level begin among ``n`` points, and their end."""
    return np.arange((1 << depth) + 1) * n >> depth


def depth_of(n: int, leaf: int) -> int:
    """Levels below the root until a node holds at most about ``leaf`` points, and at least one."""
    return min(((n - 1) // leaf).bit_length(), n.bit_length() - 1)


@dataclass
class Tree:
    """Points in the order of a halved tree; low, high and total hold its nodes level by level, the root first."""

    order: np.ndarray
    points: np.ndarray
    low: np.ndarray
    high: np.ndarray
    total: np.ndarray
    depth: int

    @classmethod
    def over(cls, points: np.ndarray, leaf: int) -> Tree:
        n = len(points)
        depth = depth_of(n, leaf)
        order = np.arange(n)
        for level in range(depth):
            edges, middles = borders(n, level), borders(n, level + 1)[1::2]
            for a, b, middle in zip(edges[:-1], edges[1:], middles):
                some = points[order[a:b]]
                widest = int(np.argmax(some.max(axis=0) - some.min(axis=0)))
                order[a:b] = order[a:b][np.argpartition(some[:, widest], middle - a)]
        ordered = points[order]
        nodes: list[tuple] = []
        for level in range(depth, -1, -1):
            if not nodes:
                at = borders(n, level)[:-1]
                nodes.append(tuple(f.reduceat(ordered, at, axis=0) for f in (np.minimum, np.maximum, np.add)))
            else:
                nodes.append(tuple(f(x[0::2], x[1::2]) for f, x in zip((np.minimum, np.maximum, np.add), nodes[-1])))
        return cls(order, ordered, *(np.concatenate(level) for level in zip(*reversed(nodes))), depth)

    def nodes(self, level: int) -> slice:
        return slice((1 << level) - 1, (1 << level + 1) - 1)


def _box_bounds(points: Tree, entries: Tree, level: int, entry_level: int, p: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and most squared distance between the boxes of node pairs."""
    at, over = points.nodes(level), entries.nodes(entry_level)
    above, below = entries.low[over][e] - points.high[at][p], points.low[at][p] - entries.high[over][e]
    least = np.maximum(np.maximum(above, below), 0.0)
    most = np.maximum(-above, -below)
    return np.einsum("ij,ij->i", least, least), np.einsum("ij,ij->i", most, most)


def assign(points: Tree, entries: Tree) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """Entry of every point in tree order, sums and counts by entry, and how many points went as whole nodes.

    All numbers are integers in doubles; ties go to the entry of the lower index.
    """
    n, k = len(points.points), len(entries.points)
    chosen = np.empty(n, np.int64)
    sums, counts, whole = np.zeros((k, points.points.shape[1])), np.zeros(k, np.int64), 0
    level = entry_level = 0
    p, e = np.zeros(1, np.int64), np.zeros(1, np.int64)
    while True:
        least, most = _box_bounds(points, entries, level, entry_level, p, e)
        first = np.flatnonzero(np.concatenate([[True], p[1:] != p[:-1]]))
        nearest = np.minimum.reduceat(most, first)
        keep = least <= np.repeat(nearest, np.diff(np.append(first, len(p))))
        p, e = p[keep], e[keep]
        single = entry_level == entries.depth
        if single:
            left = np.bincount(p, minlength=1 << level)
            alone = left[p] == 1
            edges = borders(n, level)
            for node, entry in zip(p[alone], entries.order[e[alone]]):
                chosen[edges[node] : edges[node + 1]] = entry
            names, nodes = entries.order[e[alone]], p[alone]
            np.add.at(sums, names, points.total[points.nodes(level)][nodes])
            np.add.at(counts, names, np.diff(edges)[nodes])
            whole += int(np.diff(edges)[nodes].sum())
            p, e = p[~alone], e[~alone]
            if not len(p) or level == points.depth:
                break
        if level < points.depth:
            level += 1
            p, e = np.repeat(2 * p, 2) + np.tile([0, 1], len(p)), np.repeat(e, 2)
        if entry_level < entries.depth:
            entry_level += 1
            p, e = np.repeat(p, 2), np.repeat(2 * e, 2) + np.tile([0, 1], len(e))
        order = np.lexsort((e, p))
        p, e = p[order], e[order]
    edges = borders(n, level)
    squares = np.einsum("ij,ij->i", entries.points, entries.points)
    for node, some in zip(np.unique(p), np.split(e, np.flatnonzero(p[1:] != p[:-1]) + 1) if len(p) else []):
        a, b = edges[node], edges[node + 1]
        # In the order of their indices, so that the first of equal ones is the lower.
        some = some[np.argsort(entries.order[some])]
        distance = squares[some] - 2 * (points.points[a:b] @ entries.points[some].T)
        names = entries.order[some][np.argmin(distance, axis=1)]
        chosen[a:b] = names
        np.add.at(sums, names, points.points[a:b])
        np.add.at(counts, names, 1)
    return chosen, sums, counts, whole


def entry_tree(book: np.ndarray) -> Tree:
    """A tree with one entry in each leaf. It is filled up with copies of the last entry, which lose every tie to it."""
    more = (1 << (len(book) - 1).bit_length()) - len(book)
    return Tree.over(np.concatenate([book, np.repeat(book[-1:], more, axis=0)]).astype(np.float64), ENTRY_LEAF)


def _plain(points: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of every point in integers without a limit."""
    rows, entries = points.astype(object), book.astype(object)
    chosen, apart = np.empty(len(rows), np.int64), np.empty(len(rows), object)
    for i, row in enumerate(rows):
        distance = ((entries - row) ** 2).sum(axis=1)
        chosen[i] = min(range(len(distance)), key=lambda j: (distance[j], j))
        apart[i] = distance[chosen[i]]
    return chosen, apart


def _pack(width: int, parts: int):
    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(batches)
        terms = pa.concat_arrays(rows.column("terms").chunks)
        lengths = np.diff(terms.offsets.to_numpy())
        matrix = np.zeros((len(lengths), width), np.int64)
        matrix[np.repeat(np.arange(len(lengths)), lengths), np.arange(lengths.sum()) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = terms.flatten().to_numpy()
        step = width // parts
        fit = exact(int(matrix.min()), int(matrix.max()), step)
        trees = [Tree.over(matrix[:, i * step : (i + 1) * step], LEAF) for i in range(parts)] if fit else []
        packed = [
            matrix if not fit else np.stack([t.points for t in trees]),
            np.stack([t.order for t in trees]) if fit else np.zeros(0, np.int64),
            *(np.stack([getattr(t, name) for t in trees]) if fit else np.zeros(0, np.int64) for name in ("low", "high", "total")),
        ]
        lists = (pa.array([rows.column(c).to_pylist()], pa.list_(pa.int64())) for c in ("vec_id", "label"))
        return pa.RecordBatch.from_arrays([*lists, *(pa.array([x.astype(np.int64).tobytes()], pa.binary()) for x in packed)], ["ids", "labels", "points", "orders", "low", "high", "total"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = BLOCK_ROWS - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(min(room, batch.num_rows))
                if sum(b.num_rows for b in held) == BLOCK_ROWS:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    return run


def exact(low: int, high: int, width: int) -> bool:
    """Whether all squared distances of such components, and sums over a block, are exact in doubles."""
    return width * (2 * max(abs(low), abs(high), 1)) ** 2 < EXACT and max(abs(low), abs(high)) * BLOCK_ROWS < EXACT


def _assigned(batch: pa.RecordBatch, book: np.ndarray):
    """For every block: ids, labels and, by part, (entries and distances in the block's order, sums, counts)."""
    parts, _, step = book.shape
    small = exact(int(book.min()), int(book.max()), step)
    trees = [entry_tree(part) for part in book] if small else []
    columns = [batch.column(c).to_pylist() for c in ("ids", "labels", "points", "orders", "low", "high", "total")]
    for ids, labels, points, orders, *nodes in zip(*columns):
        n, out = len(ids), []
        points = np.frombuffer(points, np.int64)
        if small and orders:
            points, orders = points.reshape(parts, n, step), np.frombuffer(orders, np.int64).reshape(parts, n)
            low, high, total = (np.frombuffer(x, np.int64).reshape(parts, -1, step).astype(np.float64) for x in nodes)
            for i in range(parts):
                tree = Tree(orders[i], points[i].astype(np.float64), low[i], high[i], total[i], len(low[i]).bit_length() - 1)
                chosen, sums, counts, _ = assign(tree, trees[i])
                apart = ((points[i] - book[i][chosen]) ** 2).sum(axis=1)
                back = np.argsort(orders[i])
                out.append((chosen[back], apart[back], sums[: book.shape[1]].astype(np.int64), counts[: book.shape[1]]))
        else:
            if orders:
                order = np.frombuffer(orders, np.int64).reshape(parts, n)
                whole = np.concatenate([p[np.argsort(o)] for p, o in zip(points.reshape(parts, n, step), order)], axis=1)
            else:
                whole = points.reshape(n, parts * step)
            for i in range(parts):
                mine = whole[:, i * step : (i + 1) * step]
                chosen, apart = _plain(mine, book[i])
                sums = np.zeros(book.shape[1:], object)
                for name, row in zip(chosen, mine.astype(object)):
                    sums[name] += row
                out.append((chosen, apart, sums, np.bincount(chosen, minlength=book.shape[1])))
        yield ids, labels, out


def _round(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book: np.ndarray = sent.value
        sums, counts = np.zeros(book.shape, object), np.zeros(book.shape[:2], np.int64)
        for batch in batches:
            for _, _, found in _assigned(batch, book):
                for i, (_, _, some, many) in enumerate(found):
                    sums[i] += some
                    counts[i] += many
        part, entry = np.nonzero(counts)
        place = np.tile(np.arange(book.shape[2]), len(part))
        out = np.repeat(part, book.shape[2]), np.repeat(entry, book.shape[2]), place, np.repeat(counts[part, entry], book.shape[2])
        yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int32()) for x in out[:3]), pa.array(out[3]), pa.array(sums[part, entry].ravel().tolist(), pa.int64())], ["part", "entry", "place", "n", "total"])

    return run


def _codes(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        digits = np.array([f"{i:02x}" for i in range(max(256, sent.value.shape[1]))], object)
        for batch in batches:
            for ids, labels, found in _assigned(batch, sent.value):
                code, error = digits[found[0][0]], found[0][1].astype(object)
                for chosen, apart, _, _ in found[1:]:
                    code, error = code + digits[chosen], error + apart
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(code, pa.string()), pa.array(error.tolist(), pa.int64())], ["vec_id", "label", "code", "error"])

    return run


def compress(rows: DataFrame, parts: int = 4, entries: int = 256, rounds: int = 4) -> tuple[DataFrame, np.ndarray]:
    """vec_id, label, code and error of every row of ``rows`` (made by ``integer_vectors``), and the codebooks (part, entry, place)."""
    spark = rows.sparkSession
    width = rows.agg(F.max(F.size("terms"))).first()[0] or parts
    width = -(-width // parts) * parts
    starts = rows.orderBy(F.asc_nulls_last("vec_id"), "terms").limit(entries).select("terms").collect()
    book = np.zeros((len(starts), width), np.int64)
    for i, (terms,) in enumerate(starts):
        book[i, : len(terms)] = terms
    book = np.ascontiguousarray(book.reshape(len(starts), parts, width // parts).transpose(1, 0, 2))
    if not len(starts):
        return spark.createDataFrame([], "vec_id long, label long, code string, error long"), book
    blocks = stored(rows.mapInArrow(_pack(width, parts), BLOCK), "blocks")
    for _ in range(rounds):
        sent = spark.sparkContext.broadcast(book)
        found = blocks.mapInArrow(_round(sent), "part int, entry int, place int, n long, total long")
        book = book.copy()
        for part, entry, place, many, total in found.groupBy("part", "entry", "place").agg(F.sum("n"), F.sum("total")).collect():
            book[part, entry, place] = total // many
        sent.unpersist()
    out = stored(blocks.mapInArrow(_codes(spark.sparkContext.broadcast(book)), "vec_id long, label long, code string, error long"), "codes")
    discard(blocks)
    return out, book


def book_hash(book: np.ndarray) -> str:
    return sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_errors(codes: DataFrame) -> DataFrame:
    """``codes`` with label_error, the sum of the errors of its label. A hot label is dealt to many tasks."""
    sums = stored(codes.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of"), "label-errors")
    if sums.count() <= FEW_LABELS:
        return codes.join(F.broadcast(sums), F.col("label").eqNullSafe(F.col("of")), "left").drop("of")
    dealt = sums.withColumn("place", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = codes.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code", "error"), F.lit(SALTS)).cast("int"))
    return salted.join(dealt, F.col("label").eqNullSafe(F.col("of")) & (F.col("salt") == F.col("place")), "left").drop("of", "salt", "place")
