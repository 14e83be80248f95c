"""The n-gram Jaccard join against brute force on small documents."""

import random

import numpy as np
import pytest

from serieskit.llm import jaccard_join, links
from tests.llm.data import documents, frame, prose
from tests.llm.test_pairs import words_of

ROWS = documents()


def joined_by_hand(rows, k, percent):
    sets = []
    for doc_id, text in rows:
        w = words_of(text)
        sets.append((doc_id, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    head = list(range(len(rows)))

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, (a, x) in enumerate(sets):
        for j, (b, y) in enumerate(sets[:i]):
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                p, q = top(i), top(j)
                head[max(p, q)] = min(p, q)
    least = {}
    for i, (doc_id, _) in enumerate(sets):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    return sorted(str((doc_id, len(x), None if doc_id is None else least[top(i)])) for i, (doc_id, x) in enumerate(sets))


def joined(spark, rows, k, percent):
    return sorted(str(tuple(r)) for r in jaccard_join.join(frame(spark, rows), k, percent).collect())


@pytest.mark.parametrize("k, percent", [(3, 90), (1, 80), (2, 60)])
def test_join(spark, k, percent):
    assert joined(spark, ROWS, k, percent) == joined_by_hand(ROWS, k, percent)


def near_group(seed: int, copies: int, words: int, edits: int) -> list[tuple[int, str]]:
    """Copies of one text that differ in up to ``edits`` places each: some pairs are linked, most are not."""
    rng = random.Random(seed)
    base, rows = prose(rng, words).split(), []
    for i in range(copies):
        own = list(base)
        for _ in range(rng.randrange(edits + 1)):
            own[rng.randrange(words)] = f"edit{rng.randrange(4 * copies)}"
        rows.append((i, " ".join(own)))
    return rows


def test_long_lists_and_many_rounds(spark, monkeypatch):
    """Lists cut into blocks of few members, and one partner a round."""
    rows = near_group(3, 120, 100, 6)
    wanted = joined_by_hand(rows, 3, 90)
    assert 5 < len({r.rsplit(",", 1)[1] for r in wanted}) < 115
    monkeypatch.setattr(links, "BLOCK_ROWS", 7)
    monkeypatch.setattr(links, "OFFERS", 1)
    monkeypatch.setattr(links, "MORE", 4)
    assert joined(spark, rows, 3, 90) == wanted


@pytest.mark.parametrize("meeting", [0.0, 1000.0])
def test_both_sides_of_the_boundary(spark, monkeypatch, meeting):
    """Short texts by subsets or by lists, and pairs across the boundary."""
    seen = []
    chosen = jaccard_join.boundary
    monkeypatch.setattr(jaccard_join, "boundary", lambda *given: seen.append(chosen(*given)) or seen[-1])
    monkeypatch.setattr(jaccard_join, "MEETING", meeting)
    rows = near_group(5, 60, 22, 1) + [(1000 + i, t) for i, t in near_group(6, 40, 45, 2)] + [(2000 + i, t) for i, t in near_group(6, 20, 33, 1)]
    rows += [(3000 + i, " ".join(rows[0][1].split()[: 22 - i % 3])) for i in range(9)]
    assert joined(spark, rows, 2, 90) == joined_by_hand(rows, 2, 90)
    assert (seen[0] > 0) == (meeting > 0)


def test_join_of_nothing(spark):
    assert jaccard_join.join(frame(spark, []), 3, 90).count() == 0
    assert joined(spark, [(1, None), (2, ""), (2, " "), (None, "a b c d")], 3, 90) == sorted(map(str, [(1, 0, 1), (2, 0, 2), (2, 0, 2), (None, 2, None)]))


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for _ in range(200):
        x = rng.integers(1, 1 << 62, rng.integers(1, 400)).astype(np.uint64)
        y = np.concatenate([x[rng.random(len(x)) < 0.9], rng.integers(1, 1 << 62, 20).astype(np.uint64)])
        for bits in (64, 256):
            a, b = (links.folded(links.odd_sketch(np.unique(s), 1024), bits) for s in (x, y))
            assert (a == links.odd_sketch(np.unique(x), bits)).all()
            assert np.bitwise_count(a ^ b).sum() <= len(np.setxor1d(x, y))
