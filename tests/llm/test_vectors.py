"""Vector codes and hard negatives against plain loops over small vectors."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from serieskit.llm import hard_negatives, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label int, slot string, part int, node long, score string, terms string"


def vectors(seed: int, n: int, width: int, scale: float = 0.4):
    """Clustered vectors with ties, repeated rows, nulls, short ones and others that take no part."""
    rng = random.Random(seed)
    middles = [[rng.gauss(0, scale) for _ in range(width)] for _ in range(6)]
    rows = []
    for i in range(n):
        x = [m + rng.gauss(0, 0.1) for m in rng.choice(middles)]
        rows.append((i, [round(v * 32) / 32 for v in x] if i % 3 else x, rng.randrange(4)))
    rows += [(n, None, 1), (n + 1, [0.5] * (width - 1) + [float("nan")], 1), (n + 2, [None] + [0.5] * (width - 1), 2), (n + 3, [float("inf")] * width, 2), (n + 4, [], 2)]
    rows += [(n + 5, [0.25, -0.25], 1), (n + 6, [0.0] * width, None), (n + 7, [0.0] * width, 3), (100, rows[100 % n][1], 1), rows[3], rows[3], (None, [0.1] * width, 2), (None, [0.2] * width, None)]
    return rows


def frame(spark, rows, parts: int = 3):
    extra = ("own", 7, 9, "own", "own")
    return spark.createDataFrame([(*r, *extra) for r in rows], SCHEMA).repartition(parts)


def sound(rows, factor, width):
    out = []
    for vec_id, x, label in rows:
        if x and all(v is not None and math.isfinite(v) for v in x):
            whole = [math.floor(factor * float(np.float32(v))) for v in x]
            out.append((vec_id, label, whole + [0] * (width - len(whole))))
    return out


def codes_by_hand(rows, width, parts, entries, rounds):
    kept = sound(rows, 1024, width)
    step = width // parts
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[:entries]
    books = [[r[2][p * step : (p + 1) * step] for r in first] for p in range(parts)]

    def nearest(part, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), i) for i, c in enumerate(books[part]))

    for _ in range(rounds):
        after = []
        for p in range(parts):
            held: dict = {}
            for _, _, x in kept:
                cut = x[p * step : (p + 1) * step]
                held.setdefault(nearest(p, cut)[1], []).append(cut)
            after.append([[sum(c) // len(held[i]) for c in zip(*held[i])] if i in held else book for i, book in enumerate(books[p])])
        books = after
    out = []
    for vec_id, label, x in kept:
        found = [nearest(p, x[p * step : (p + 1) * step]) for p in range(parts)]
        out.append((vec_id, label, "".join(f"{i:02x}" for _, i in found), sum(d for d, _ in found)))
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    text = ",".join(str(v) for book in books for entry in book for v in entry)
    return sorted(str((*r, total[r[1]])) for r in out), hashlib.sha256(text.encode()).hexdigest()


@pytest.mark.parametrize("scale, entries", [(0.4, 256), (0.4, 20), (1e6, 20)])
def test_codes(spark, monkeypatch, scale, entries):
    """Also with fewer entries, and with components beyond doubles' exact range."""
    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 90)
    rows = vectors(1, 200 if entries < 256 else 300, 8, scale)
    codes, book = vector_codes.compress(vector_codes.integer_vectors(frame(spark, rows)), entries=entries)
    got = vector_codes.with_label_errors(codes).select("vec_id", "label", "code", "error", "label_error").collect()
    wanted, digest = codes_by_hand(rows, 8, 4, entries, 4)
    assert sorted(str(tuple(r)) for r in got) == wanted and vector_codes.book_hash(book) == digest


def test_label_errors_of_many_labels(spark, monkeypatch):
    rows = vectors(2, 60, 4)
    codes, _ = vector_codes.compress(vector_codes.integer_vectors(frame(spark, rows)), entries=8)
    wide = sorted(map(str, vector_codes.with_label_errors(codes).collect()))
    monkeypatch.setattr(vector_codes, "FEW_LABELS", 1)
    assert sorted(map(str, vector_codes.with_label_errors(codes).collect())) == wide


def test_codes_of_nothing(spark):
    codes, book = vector_codes.compress(vector_codes.integer_vectors(frame(spark, [(1, None, 1), (2, [], 2)])))
    assert codes.count() == 0 and book.shape[1] == 0 and vector_codes.with_label_errors(codes).count() == 0


def test_trees_prune_and_stay_exact():
    """Nodes go as a whole where clusters are apart, and every choice is the plain one."""
    rng = np.random.default_rng(5)
    middles = rng.integers(-400, 400, (12, 6))
    points = (middles[rng.integers(0, 12, 4000)] + rng.integers(-6, 7, (4000, 6))).astype(np.float64)
    book = np.concatenate([middles, middles[:3], rng.integers(-400, 400, (30, 6))]).astype(np.float64)
    tree = vector_codes.Tree.over(points, vector_codes.LEAF)
    chosen, sums, counts, whole = vector_codes.assign(tree, vector_codes.entry_tree(book))
    assert (counts[len(book) :] == 0).all()
    sums, counts = sums[: len(book)], counts[: len(book)]
    plain = ((tree.points[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)
    assert (chosen == plain).all() and (counts == np.bincount(plain, minlength=len(book))).all() and counts[12:15].sum() == 0
    assert all((sums[i] == tree.points[plain == i].sum(axis=0)).all() for i in range(len(book))) and whole > 2000
    for n in (1, 2, 15, 16, 17, 33, 100):
        some = vector_codes.Tree.over(points[:n], vector_codes.LEAF)
        assert sorted(some.order) == list(range(n)) and (some.total[0] == points[:n].sum(axis=0)).all()


def negatives_by_hand(rows, width, every, positives=5, negatives=10, low=30, high=90):
    kept = [r for r in sound(rows, 256, width) if r[0] is not None and r[1] is not None]
    out = []
    for vec_id, label, x in {(a, b, tuple(c)) for a, b, c in kept if a % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), other, own) for other, own, y in kept)
        for p, (score, positive, _) in enumerate([s for s in scored if s[2] == label and s[1] != vec_id][:positives]):
            fit = [(s, other) for s, other, own in scored if own != label and low * -score <= 100 * -s <= high * -score][:negatives]
            out += [(vec_id, positive, rank, other, -score, -s) for rank, (s, other) in enumerate(fit, 1)]
    return sorted(map(str, out))


@pytest.mark.parametrize("scale", [0.4, 3000.0, 3e5])
def test_negatives(spark, monkeypatch, scale):
    """Several shards, blocks of anchors, and fields of every width."""
    monkeypatch.setattr(hard_negatives, "SHARD_ROWS", 70)
    monkeypatch.setattr(hard_negatives, "STRIP", 32)
    monkeypatch.setattr(hard_negatives, "ANCHORS", 16)
    rows = vectors(3, 260, 24, scale)
    made = hard_negatives.labelled(frame(spark, rows), 256, F.col("label"))
    got = hard_negatives.mine(made, F.col("vec_id") % 10 == 0).collect()
    assert len(got) > 200 and sorted(str(tuple(r)) for r in got) == negatives_by_hand(rows, 24, 10)


def test_negatives_of_nothing(spark):
    for rows in ([], [(100, None, 1)], [(100, [0.5, 0.5], 1), (200, [0.5, 0.5], 2)]):
        assert hard_negatives.mine(hard_negatives.labelled(frame(spark, rows), 256, F.col("label")), F.col("vec_id") % 100 == 0).count() == 0


def test_packed_scores():
    rng = np.random.default_rng(1)
    for reach, width in ((3, 200), (300, 64), (5000, 64), (2**20, 30), (2**25, 9), (2**28, 17)):
        a, r = rng.integers(-reach, reach, (7, width)), rng.integers(-reach, reach // 2 + 1, (23, width))
        assert (hard_negatives.packed_scores(a, r) == a @ r.T).all()
    assert hard_negatives.fields(500 * 500, 64)[0] == 2 and hard_negatives.fields(1 << 60, 4) == (0, 0, 0)
    with pytest.raises(OverflowError):
        hard_negatives.packed_scores(np.full((1, 4), 1 << 40), np.full((1, 4), 1 << 40))
