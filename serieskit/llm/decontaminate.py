"""Benchmark decontamination: passages of documents within a small edit distance of a benchmark item.

Words are the symbols. An item of n words is found where some passage can be turned into it by at most
floor(0.2 * n) insertions, deletions or replacements of words. The steps:

1. Runs of q words that a document shares with an item. By the q-gram lemma a passage within the distance shares the runs at a
   known number of the item's places, on near diagonals, so nothing is lost by asking for that many; item-sized windows are
   cut only there. Places are counted before any occurrence is listed, so a phrase that a text repeats costs no more than the text.
2. The CGK embedding: a random walk reads a window and an item with the same coins, one step or none per written symbol, so
   that edit distance becomes Hamming distance between what is written.
3. Bit-sampling LSH on the embeddings: a window is a candidate if it agrees with the item on all sampled places of some table. Places
   are shares of what the item's walk writes before it ends, denser at its start, where edits have moved the walks less; what fills up
   behind the end is never sampled and agrees with nothing. So an exact copy is always a candidate, and other texts hardly ever are. Walks
   and tables are repeated until the chance of missing a passage at the largest distance is below 1 - ``RECALL``, counted
   from the agreement of random items with copies edited at random to that distance.
4. Exact edit verification: the least distance of the item to any part of the text around the window.

Items are taken in blocks of bounded size, each sent to all executors; documents are read once per block.

Defined cases: null or empty texts and items match nothing; words are runs of letters and digits, A-Z in lower case; items that
repeat are found each; a row with a null doc_id is searched too; other columns are ignored.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from serieskit.llm.common import small_batches, texts
from serieskit.llm.hashing import NOT_WORD, chunks, multipliers, runs, word_hashes

SHARE = 0.2
RECALL = 0.99
MOST_TABLES = 1024
# Places of a table; fewer where so many do not reach the recall, as on very long items.
SAMPLED = (3, 2, 1)
WALKS = 16
BLOCK_ITEMS = 20_000
_FILTER_BITS = 22
SEARCH_BYTES = 4 << 20
# Rows of shared runs, and words of windows, that are held at once.
HELD_ROWS = 1 << 22
HELD_WORDS = 1 << 21


def most_edits(words: int) -> int:
    return int(SHARE * words + 1e-9)


def gram_length(words: int) -> int:
    return 3 if words >= 8 else max(1, min(2, words))


def shared_grams(words: int) -> int:
    """Grams that a passage within the largest distance shares with an item at least."""
    q = gram_length(words)
    return max(1, words - q + 1 - most_edits(words) * q)


def embed(rows: np.ndarray, walk: int, length: int) -> np.ndarray:
    """CGK embedding of equally long rows of symbols (0 fills up): row after row, ``length`` written symbols.

    The coin of a step depends on the walk, the step and the symbol read, so equal suffixes read at the same
    step are written alike.
    """
    count, width = rows.shape
    padded = np.concatenate([rows, np.zeros((count, 1), np.uint64)], axis=1)
    at = np.zeros(count, np.int64)
    out = np.empty((count, length), np.uint64)
    every = np.arange(count)
    steps = multipliers(length, 1000 + walk)
    for step in range(length):
        symbol = padded[every, at]
        out[:, step] = symbol
        coin = (symbol * steps[step]) >> np.uint64(63)
        at = np.minimum(at + coin.astype(np.int64), width)
    return out


def written(rows: np.ndarray) -> np.ndarray:
    """Symbols that each walk writes before it ends, for rows of embeddings."""
    return (rows != 0).sum(axis=-1)


def walks(rows: np.ndarray) -> list[np.ndarray]:
    return [embed(rows, walk, 3 * rows.shape[1]) for walk in range(WALKS)]


@functools.cache
def tables_for(n: int) -> list[tuple[int, np.ndarray]]:
    """(walk, sampled shares of what a walk writes) of tables that together reach ``RECALL`` for items of ``n`` words.

    Counted on random items and random passages at the largest distance, each cut or filled to n words as a window is. As
    many tables again are added, since the count comes from a bounded number of passages.
    """
    rng = np.random.default_rng(n)
    trials, length = 300, 3 * n
    items = rng.integers(1, 1 << 62, size=(trials, n)).astype(np.uint64)
    edited = np.empty_like(items)
    for item, row in zip(items.tolist(), edited):
        for _ in range(most_edits(n)):
            place, kind, fresh = int(rng.integers(len(item))), int(rng.integers(3)), int(rng.integers(1, 1 << 62))
            item[place : place + (kind > 0)] = [] if kind == 1 and len(item) > 1 else [fresh]
        row[:] = (item + [int(x) for x in rng.integers(1, 1 << 62, size=n)])[:n]
    agree, ends = [], []
    for walk in range(WALKS):
        own = embed(items, walk, length)
        agree.append(embed(edited, walk, length) == own)
        ends.append(written(own))
    every = np.arange(trials)[:, None]
    for sampled in SAMPLED:
        missed, tables = np.ones(trials, bool), []
        while len(tables) < MOST_TABLES and missed.mean() > 1 - RECALL:
            walk, shares = len(tables) % WALKS, rng.random(sampled) ** 2
            missed &= ~agree[walk][every, (shares * ends[walk][:, None]).astype(np.int64)].all(axis=1)
            tables.append((walk, shares))
        if missed.mean() <= 1 - RECALL:
            return tables + [(w % WALKS, rng.random(sampled) ** 2) for w in range(len(tables), 2 * len(tables))]
    raise ValueError(f"{MOST_TABLES} tables do not reach a recall of {RECALL} for items of {n} words")


class Item:
    """One benchmark item with its embeddings and, for every walk, the places of its tables (a row each)."""

    def __init__(self, item_id: int, words: np.ndarray, number: int = 0, walked: list[np.ndarray] | None = None):
        self.item_id, self.words, self.number = item_id, words, number
        n = len(words)
        self.edits, self.q = most_edits(n), gram_length(n)
        self.tables: list[np.ndarray] = []
        self.symbols: list[np.ndarray] = []
        for walk, own in enumerate(walked or [rows[0] for rows in walks(words[None, :])]):
            shares = [s for w, s in tables_for(n) if w == walk]
            places = (np.stack(shares) * written(own)).astype(np.int64) if shares else np.zeros((0, 1), np.int64)
            self.tables.append(places)
            self.symbols.append(own[places])


def candidates(windows: np.ndarray, items: list[Item]) -> np.ndarray:
    """Which windows (rows, filled up with 0 behind their item's size) agree with their item on all sampled places of some table."""
    hit = np.zeros(len(windows), bool)
    of: dict[int, list[int]] = {}
    for row, item in enumerate(items):
        of.setdefault(id(item), []).append(row)
    groups = [(items[rows[0]], np.array(rows)) for rows in of.values()]
    for walk in range(WALKS):
        length = max(int(item.tables[walk].max(initial=-1)) for item, _ in groups) + 1
        if not length:
            continue
        walked = embed(windows, walk, length)
        for item, rows in groups:
            hit[rows] |= (walked[rows][:, item.tables[walk]] == item.symbols[walk]).all(axis=2).any(axis=1)
    return hit


def least_distance(item: np.ndarray, text: np.ndarray) -> tuple[int, int]:
    """Least edit distance of ``item`` to any part of ``text``, and where the first best part ends."""
    step = np.arange(len(text) + 1)
    row = np.zeros(len(text) + 1, np.int64)
    for i, word in enumerate(item, 1):
        change = row[:-1] + (text != word)
        new = np.concatenate([[i], np.minimum(change, row[1:] + 1)])
        row = np.minimum.accumulate(new - step) + step
    end = int(row.argmin())
    return int(row[end]), end


class Items:
    """A bounded block of items and the table of their word runs."""

    def __init__(self, rows: list[tuple[int, str]]):
        self.items: list[Item] = []
        if rows:
            words, borders = word_hashes([(t or "").encode() for _, t in rows], NOT_WORD)
            sizes = np.diff(borders)
            # Items of one length walk together.
            for n in np.unique(sizes[sizes > 0]).tolist():
                same = np.flatnonzero(sizes == n)
                for part in np.array_split(same, -(-len(same) * n // HELD_WORDS)):
                    walked = walks(words[borders[part][:, None] + np.arange(n)])
                    for k, i in enumerate(part.tolist()):
                        self.items.append(Item(rows[i][0], words[borders[i] : borders[i] + n], len(self.items), [w[k] for w in walked]))
        self.tables = {}
        for q in {i.q for i in self.items}:
            grams = [(runs(i.words, q)[: len(i.words) - q + 1], k) for k, i in enumerate(self.items) if i.q == q]
            hashes = np.concatenate([g for g, _ in grams])
            owner = np.concatenate([np.full(len(g), k) for g, k in grams])
            place = np.concatenate([np.arange(len(g)) for g, _ in grams])
            order = np.argsort(hashes, kind="stable")
            sieve = np.zeros(1 << _FILTER_BITS, bool)
            sieve[hashes >> np.uint64(64 - _FILTER_BITS)] = True
            self.tables[q] = hashes[order], owner[order], place[order], sieve

    def shared(self, words: np.ndarray, borders: np.ndarray) -> Iterator[tuple[int, Item, np.ndarray, np.ndarray]]:
        """(text, item, diagonals, shared runs on each) of pairs that share runs at enough of the item's places."""
        need = np.array([shared_grams(len(i.words)) for i in self.items])
        doc_of = np.repeat(np.arange(len(borders) - 1), np.diff(borders))
        for q, (hashes, owner, place, sieve) in self.tables.items():
            grams = runs(words, q)
            at = np.flatnonzero(sieve[grams >> np.uint64(64 - _FILTER_BITS)])
            at = at[at + q <= borders[1:][doc_of[at]]]
            low = np.searchsorted(hashes, grams[at])
            known = low < len(hashes)
            known[known] = hashes[low[known]] == grams[at[known]]
            at, low = at[known], low[known]
            if not len(at):
                continue
            # Occurrences of one run in one text lie together; only their number counts until a pair has enough places.
            order = np.lexsort((at, low, doc_of[at]))
            at, low, doc = at[order], low[order], doc_of[at[order]]
            first = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (low[1:] != low[:-1])]))
            last, low, doc = np.append(first[1:], len(at)), low[first], doc[first]
            times = np.searchsorted(hashes, hashes[low], "right") - low
            # Whole texts are taken together up to about the bound; a single one has at most as many rows as the table.
            ends = np.append(np.flatnonzero(doc[1:] != doc[:-1]) + 1, len(doc))
            rows = np.cumsum(times)[ends - 1]
            block = np.append(0, rows[:-1]) // HELD_ROWS
            stops = ends[np.append(np.flatnonzero(np.diff(block)), len(ends) - 1)]
            for begin, end in zip(np.append(0, stops[:-1]).tolist(), stops.tolist()):
                some = np.arange(begin, end)
                run = np.repeat(some, times[some])
                entry = np.repeat(low[some] - (np.cumsum(times[some]) - times[some]), times[some]) + np.arange(len(run))
                pair = doc[run] * len(self.items) + owner[entry]
                by_pair = np.argsort(pair, kind="stable")
                pair, run, spot = pair[by_pair], run[by_pair], place[entry[by_pair]]
                a = np.flatnonzero(np.concatenate([[True], pair[1:] != pair[:-1]]))
                b = np.append(a[1:], len(pair))
                for i in np.flatnonzero(b - a >= need[pair[a] % len(self.items)]).tolist():
                    text, item = divmod(int(pair[a[i]]), len(self.items))
                    own = slice(a[i], b[i])
                    yield text, self.items[item], *_diagonals(at, first[run[own]], last[run[own]], spot[own], int(borders[text]), int(borders[text + 1]))

    def search(self, part: list[bytes]) -> list[tuple[int, int, int, int]]:
        """(text, item_id, first word, distance) of every item that a text of the chunk holds; the best place of each."""
        words, borders = word_hashes(part, NOT_WORD)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        waiting: list[tuple[int, Item, np.ndarray]] = []
        count = widest = 0
        for text, item, lines, counts in self.shared(words, borders):
            # Runs of one passage lie within as many diagonals as there may be edits, to either side.
            sums = np.append(0, np.cumsum(counts))
            near = sums[np.searchsorted(lines, lines + item.edits, "right")] - sums[np.searchsorted(lines, lines - item.edits)]
            lines = lines[near >= shared_grams(len(item.words))]
            rows = max(1, HELD_WORDS // len(item.words))
            for starts in _starts(lines, item.edits, int(borders[text]), int(borders[text + 1]), rows):
                count, widest = count + len(starts), max(widest, len(item.words))
                if waiting and count * widest > HELD_WORDS:
                    _verify(waiting, words, borders, best)
                    waiting, count, widest = [], len(starts), len(item.words)
                waiting.append((text, item, starts))
        _verify(waiting, words, borders, best)
        return [(text, self.items[number].item_id, first, distance) for (text, number), (distance, first) in sorted(best.items())]


def _verify(waiting: list[tuple[int, Item, np.ndarray]], words: np.ndarray, borders: np.ndarray, best: dict[tuple[int, int], tuple[int, int]]) -> None:
    """Put the least (distance, first word) of each text and item into ``best``, looking where windows are candidates."""
    if not waiting:
        return
    windows = np.zeros((sum(len(starts) for _, _, starts in waiting), max(len(item.words) for _, item, _ in waiting)), np.uint64)
    row, owners = 0, []
    for text, item, starts in waiting:
        index, hi = starts[:, None] + np.arange(len(item.words)), borders[text + 1]
        windows[row : row + len(starts), : len(item.words)] = np.where(index < hi, words[np.minimum(index, hi - 1)], np.uint64(0))
        owners += [item] * len(starts)
        row += len(starts)
    hit, row = candidates(windows, owners), 0
    for text, item, starts in waiting:
        passed = starts[hit[row : row + len(starts)]]
        row += len(starts)
        lo, hi = int(borders[text]), int(borders[text + 1])
        # Windows that begin close to each other are verified as one part of the text.
        for group in np.split(passed, np.flatnonzero(np.diff(passed) > 2 * item.edits + 1) + 1) if len(passed) else []:
            begin, end = max(lo, int(group[0]) - item.edits), min(hi, int(group[-1]) + len(item.words) + item.edits)
            distance, stop = least_distance(item.words, words[begin:end])
            if distance <= item.edits:
                found = distance, max(begin, begin + stop - len(item.words)) - lo
                best[text, item.number] = min(found, best.get((text, item.number), found))


def _diagonals(at: np.ndarray, first: np.ndarray, last: np.ndarray, spot: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
    """Diagonals (place in the text less place in the item) of shared runs, and how many lie on each."""
    times = last - first
    if times.sum() <= hi - lo:
        pos = at[np.repeat(first - (np.cumsum(times) - times), times) + np.arange(times.sum())]
        return np.unique(pos - np.repeat(spot, times), return_counts=True)
    # More rows than words: counted in place.
    shift = lo - int(spot.max())
    counts = np.zeros(hi - shift, np.int64)
    for a, b, p in zip(first.tolist(), last.tolist(), spot.tolist()):
        counts[at[a:b] - p - shift] += 1
    lines = np.flatnonzero(counts)
    return lines + shift, counts[lines]


def _starts(lines: np.ndarray, edits: int, lo: int, hi: int, rows: int) -> Iterator[np.ndarray]:
    """First words of windows within ``edits`` of a diagonal, inside the text, each once and ascending, ``rows`` at most at once."""
    if not len(lines):
        return
    breaks = np.flatnonzero(np.diff(lines) > 2 * edits + 1)
    begins = np.maximum(lines[np.append(0, breaks + 1)] - edits, lo)
    ends = np.minimum(lines[np.append(breaks, len(lines) - 1)] + edits, hi - 1) + 1
    sizes = np.maximum(ends - begins, 0)
    before = np.append(0, np.cumsum(sizes))
    for a in range(0, int(before[-1]), rows):
        number = np.arange(a, min(a + rows, int(before[-1])))
        span = np.searchsorted(before, number, "right") - 1
        yield begins[span] + number - before[span]


def _search(held, names: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = held.value
        for batch in batches:
            whole = [t.encode() for t in batch.column("text").to_pylist()]
            rows = [(first + i, *rest) for first, part in chunks(whole, SEARCH_BYTES) for i, *rest in items.search(part)]
            columns = list(zip(*rows)) if rows else [[]] * 4
            at = pa.array(columns[0], pa.int64())
            yield pa.RecordBatch.from_arrays([*(batch.column(n).take(at) for n in names), *(pa.array(c, pa.int64()) for c in columns[1:])], [*names, "item_id", "first_word", "edits"])

    return run


def find_passages(docs: DataFrame, benchmark: DataFrame, block_items: int = BLOCK_ITEMS) -> DataFrame:
    """doc_id, item_id, first_word and edits of every benchmark item that a document holds (the best place of each).

    At most about ``block_items`` items are sent to the executors at once.
    """
    return _passages(texts(docs), benchmark, block_items, ("doc_id",))


def _passages(rows: DataFrame, benchmark: DataFrame, block_items: int, names: tuple[str, ...]) -> DataFrame:
    spark: SparkSession = rows.sparkSession
    small_batches(spark)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("item_id is not null and text is not null")
    parts = max(1, -(-items.count() // block_items))
    found, kinds = None, ", ".join(f"{n} long" for n in names)
    for part in range(parts):
        block = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).orderBy("item_id", "text").collect()
        held = spark.sparkContext.broadcast(Items([(r.item_id, r.text) for r in block]))
        more = rows.mapInArrow(_search(held, names), f"{kinds}, item_id long, first_word long, edits long")
        found = more if found is None else found.unionByName(more)
    return found


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, unnamed: bool = False) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; columns and their order stay.

    A row is known by its doc_id and a hash of its text, so other rows of the same id stay. Rows with a null doc_id
    go only with ``unnamed``.
    """
    rows = texts(docs).withColumn("row_id", F.xxhash64("doc_id", "text"))
    gone = _passages(rows, benchmark, BLOCK_ITEMS, ("doc_id", "row_id")).select(F.col("doc_id").alias("_doc"), F.col("row_id").alias("_row")).distinct()
    if not unnamed:
        gone = gone.where("_doc is not null")
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    key = F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")))
    left = carried.join(gone, doc_id.cast("long").eqNullSafe(F.col("_doc")) & (key == F.col("_row")), "left_anti")
    return left.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(names)])
