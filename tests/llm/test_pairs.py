"""Near duplicates, suffix dedup and decontamination against brute force on small documents."""

import hashlib
import random
import re

import numpy as np
import pytest

from serieskit.llm import decontaminate, links, near_dup, suffix_dedup
from serieskit.llm.hashing import NOT_WORD, word_hashes
from tests.llm.data import documents, frame, prose

ROWS = documents()


def words_of(text):
    return re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())


def near_by_hand(rows, k):
    sets = []
    for doc_id, text in rows:
        w = words_of(text)
        sets.append((doc_id, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} if w else set()))
    head = {d: d for d, _ in sets if d is not None}

    def top(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 80 * len(x | y):
                p, q = top(a), top(b)
                head[max(p, q)] = min(p, q)
    out = []
    for doc_id, x in sets:
        group = None if doc_id is None else top(doc_id) if x else doc_id
        out.append((doc_id, len(x), group, doc_id is None or group == doc_id))
    return sorted(map(str, out))


@pytest.mark.parametrize("k", [2, 5])
def test_near_duplicates(spark, k):
    got = near_dup.near_duplicates(frame(spark, ROWS), words=k).collect()
    assert sorted(str(tuple(r)) for r in got) == near_by_hand(ROWS, k)


def test_near_duplicates_settle_by_rounds(spark, monkeypatch):
    """The same groups when keys are cut into small blocks and members offer one partner a round."""
    monkeypatch.setattr(links, "BLOCK_ROWS", 5)
    monkeypatch.setattr(links, "OFFERS", 1)
    monkeypatch.setattr(links, "MORE", 3)
    rng, rows = random.Random(4), []
    words = prose(rng, 60).split()
    for i in range(30):
        words = list(words)
        words[rng.randrange(60)] = f"w{i}"
        rows.append((i, " ".join(words)))
    got = near_dup.near_duplicates(frame(spark, rows), words=2).collect()
    assert sorted(str(tuple(r)) for r in got) == near_by_hand(rows, 2)


def test_near_duplicates_of_ids_with_several_texts(spark):
    """An id joins all its texts, also where another id holds the same text."""
    rng = random.Random(8)
    a, b, c = (prose(rng, 30) for _ in range(3))
    rows = [(3, a), (5, a), (5, b), (9, b + " more"), (7, c)]
    got = near_dup.near_duplicates(frame(spark, rows), words=2).collect()
    assert sorted(str(tuple(r)) for r in got) == near_by_hand(rows, 2)
    assert {r.component_id for r in got} == {3, 7}


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(frame(spark, [])).count() == 0
    docs = frame(spark, ROWS[:3] + [(900, None), (901, ROWS[1][1])])
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [0, 1, 2, 900]


def removals_by_hand(rows, width=200):
    whole = [(t or "").encode() for _, t in rows]
    seen = {}
    for b in whole:
        for i in range(len(b) - width + 1):
            seen[b[i : i + width]] = seen.get(b[i : i + width], 0) + 1
    out = []
    for (doc_id, _), b in zip(rows, whole):
        gone = bytearray(len(b))
        for i in range(len(b) - width + 1):
            if seen[b[i : i + width]] > 1:
                gone[i : i + width] = b"x" * width
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out.append((doc_id, len(b), len(b) - len(kept), len(re.findall(b"x+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("split", [4096, 2])
def test_suffix_dedup(spark, monkeypatch, split):
    """Also with every gram of more than two segments split down to single windows."""
    monkeypatch.setattr(suffix_dedup, "SPLIT", split)
    got = suffix_dedup.removals(frame(spark, ROWS)).collect()
    assert sorted(str(tuple(r)) for r in got) == removals_by_hand(ROWS)


def test_suffix_dedup_of_long_texts_and_nothing(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BLOCK", 700)
    rows = ROWS[-12:] + ROWS[85:95]
    got = suffix_dedup.removals(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == removals_by_hand(rows)
    assert suffix_dedup.removals(frame(spark, [])).count() == 0


def test_suffix_stage_keeps_rows(spark):
    docs = frame(spark, ROWS)
    left = suffix_dedup.drop_repeats(docs)
    assert left.columns == docs.columns
    rows = {(r.doc_id, len(r.text or "")): r for r in left.collect()}
    assert left.count() == len(ROWS) and rows[400, 0].text == "" and rows[401, 0].text is None
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in rows.values())


def test_spans_of_repeated_rows_come_once(spark):
    text = prose(random.Random(9), 400)
    rows = [(1, text)] * 40 + [(None, text)] * 40 + ROWS[:5]
    _, found = suffix_dedup._with_spans(frame(spark, rows))
    lists = [[tuple(w) for w in r.found] for r in found.collect()]
    assert len(lists) == 2 and all(len(own) == len(set(own)) for own in lists)
    got = suffix_dedup.removals(frame(spark, rows)).collect()
    assert sorted(str(tuple(r)) for r in got) == removals_by_hand(rows)


@pytest.mark.parametrize("shards", [1, 2, 5])
def test_merged_transforms(shards):
    rng = random.Random(shards)
    source = bytes(rng.choice(b"abc") for _ in range(400))
    bodies = sorted({source[a : a + rng.randrange(30, 80)] + bytes([rng.choice(b"xyz")]) for a in (rng.randrange(330) for _ in range(60))})
    seen = {}
    for i, b in enumerate(bodies):
        for p in range(len(b) - 19):
            seen.setdefault(b[p : p + 20], []).append((i, p))
    want = [sorted(p for v in seen.values() if len(v) > 1 for j, p in v if j == i) for i in range(len(bodies))]
    assert [g.tolist() for g in suffix_dedup.repeated_windows(bodies, 20, shards)] == want


def test_passages(spark):
    """Passages at the largest distance are found, whatever else is in the texts; clean texts stay."""
    rng = random.Random(8)
    items = [(i, prose(rng, n)) for i, n in enumerate([3, 6, 9, 14, 25, 40, 60])] + [(90, ""), (91, None), (92, "  ")]
    rows, want = [], set()
    for trial in range(60):
        item, text = items[trial % 7]
        words = text.split()
        for _ in range(decontaminate.most_edits(len(words))):
            place, kind = rng.randrange(len(words)), rng.randrange(3)
            words[place : place + (kind > 0)] = [] if kind == 1 else [f"q{rng.random()}"[:7].replace(".", "")]
        rows.append((trial, f"{prose(rng, 30)}. {' '.join(words).upper()}! {prose(rng, 20)}"))
        want.add((trial, item))
    rows += [(1000 + i, prose(rng, 100)) for i in range(40)] + [(2000, None), (2001, ""), (None, items[5][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontaminate.find_passages(frame(spark, rows), benchmark, block_items=3).collect()}
    assert got == want | {(None, 5)}
    left = decontaminate.drop_contaminated(frame(spark, rows), benchmark)
    assert sorted(str(r.doc_id) for r in left.collect()) == sorted(str(d) for d, _ in rows[60:])
    assert decontaminate.find_passages(frame(spark, []), benchmark).count() == 0
    assert decontaminate.find_passages(frame(spark, rows), benchmark.limit(0)).count() == 0


def test_least_distance():
    def by_hand(a, b):
        row = [0] * (len(b) + 1)
        for x in a:
            new = [row[0] + 1]
            for j, y in enumerate(b):
                new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
            row = new
        return min(row)

    rng = np.random.default_rng(2)
    for _ in range(60):
        a, b = rng.integers(0, 4, rng.integers(1, 9)), rng.integers(0, 4, rng.integers(0, 14))
        assert decontaminate.least_distance(a, b)[0] == by_hand(a.tolist(), b.tolist())


def test_tables_reach_recall():
    rng = random.Random(5)
    found = 0
    for trial in range(150):
        words = prose(rng, 40).split()
        item = decontaminate.Items([(0, " ".join(words))]).items[0]
        for _ in range(8):
            words[rng.randrange(40)] = f"z{rng.random()}"[2:9]
        window, _ = word_hashes([" ".join(words).encode()], NOT_WORD)
        found += bool(decontaminate.candidates(window[None, :40], [item])[0])
    assert found >= 145


def test_tables_reject_what_is_unrelated():
    """Random windows hardly ever are candidates, at any length; exact copies always are."""
    rng = random.Random(6)
    for n in (5, 8, 12, 20, 40, 100):
        items = [decontaminate.Item(i, word_hashes([prose(rng, n).encode()], NOT_WORD)[0]) for i in range(20)]
        other = np.stack([word_hashes([prose(rng, n).encode()], NOT_WORD)[0] for _ in range(2000)])
        assert decontaminate.candidates(other, [items[i % 20] for i in range(2000)]).mean() < 0.01
        assert decontaminate.candidates(np.stack([i.words for i in items]), items).all()


def test_recall_out_of_reach_is_an_error(monkeypatch):
    monkeypatch.setattr(decontaminate, "MOST_TABLES", 2)
    with pytest.raises(ValueError, match="recall"):
        decontaminate.tables_for.__wrapped__(50)


def test_passages_equal_all_windows(spark, monkeypatch):
    """Every (text, item) with a passage in reach, counted over all windows of all texts, also in many small blocks."""
    rng = random.Random(21)
    few = [a + b for a in ("ka", "lo") for b in ("ra", "ne", "li")]
    items = [(i, prose(rng, rng.choice((1, 2, 5, 7, 8, 11, 16, 30)))) for i in range(40)]
    items += [(40 + i, " ".join(rng.choice(few) for _ in range(rng.choice((5, 8, 10, 15))))) for i in range(20)]
    rows = [(i, " ".join(rng.choice(few) for _ in range(rng.randrange(300)))) for i in range(20)]
    for i in range(60):
        words = rng.choice(items)[1].split()
        for _ in range(rng.randrange(0, int(0.4 * len(words)) + 1)):
            place, kind = rng.randrange(len(words)), rng.randrange(3)
            words[place : place + (kind > 0)] = [] if kind == 1 and len(words) > 1 else [rng.choice(few)]
        rows.append((100 + i, " ".join([prose(rng, rng.randrange(4)), *words, prose(rng, rng.randrange(4))])))
    want = set()
    for d, text in rows:
        whole = word_hashes([text.encode()], NOT_WORD)[0]
        for k, item in items:
            own = word_hashes([item.encode()], NOT_WORD)[0]
            distance = decontaminate.least_distance(own, whole)[0]
            if distance <= decontaminate.most_edits(len(own)):
                want.add((d, k, distance))
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id, r.edits) for r in decontaminate.find_passages(frame(spark, rows), benchmark).collect()}
    assert got == want and len(want) > 40
    small = decontaminate.Items(items)
    monkeypatch.setattr(decontaminate, "HELD_ROWS", 3)
    monkeypatch.setattr(decontaminate, "HELD_WORDS", 50)
    again = small.search([t.encode() for _, t in rows])
    assert {(rows[t][0], k, e) for t, k, _, e in again} == want


def test_repeated_phrase_costs_its_text_only():
    """A text of one phrase against thousands of items that hold it: no row for each occurrence and item."""
    import time

    rng = random.Random(9)
    phrase = "kara lone mimu"
    items = decontaminate.Items([(i, f"{prose(rng, 9)} {phrase} {prose(rng, 8)}") for i in range(3000)] + [(9999, " ".join([phrase] * 7))])
    begun = time.process_time()
    assert [r[1] for r in items.search([" ".join([phrase] * 100_000).encode()])] == [9999]
    assert time.process_time() - begun < 60


def test_stages_go_by_rows(spark):
    """Rows without an id and rows that share one are kept or dropped each for itself."""
    rng = random.Random(12)
    a, b, c, item = (prose(rng, 40) for _ in range(4))
    rows = [(1, a), (1, a), (1, b), (2, a), (None, a), (None, c), (None, c), (None, ""), (None, ""), (3, None)]
    docs = frame(spark, rows)
    left = near_dup.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    want = [(1, a), (1, b), (None, c), (None, ""), (None, ""), (3, None)]
    assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(map(str, want))
    held = f"{b} {item} {c}"
    rows = [(1, a), (1, held), (None, held), (None, a), (2, held), (3, None)]
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    for unnamed in (False, True):
        left = decontaminate.drop_contaminated(frame(spark, rows), benchmark, unnamed)
        want = [(1, a), (None, a), (3, None)] + [] if unnamed else [(1, a), (None, a), (3, None), (None, held)]
        assert sorted(str((r.doc_id, r.text)) for r in left.collect()) == sorted(map(str, want))
        assert left.columns == docs.columns


def test_words_of_equal_polynomials_stay_apart(spark):
    """Two words, and two word sequences, that every polynomial modulo 2**64 takes for equal."""
    parity = [bin(i).count("1") & 1 for i in range(2048)]
    rows = [(1, "".join("ab"[p] for p in parity[:1024])), (2, "".join("ba"[p] for p in parity[:1024]))]
    rows += [(3, " ".join(("cat", "dog")[p] for p in parity)), (4, " ".join(("dog", "cat")[p] for p in parity) + " end")]
    got = near_dup.near_duplicates(frame(spark, rows), words=3).collect()
    assert sorted(str(tuple(r)) for r in got) == near_by_hand(rows, 3)
    assert {r.doc_id: r.component_id for r in got if r.doc_id < 3} == {1: 1, 2: 2}
