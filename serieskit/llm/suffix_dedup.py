"""Removal of long repeated byte strings by merging Burrows-Wheeler transforms of shards.

A byte goes if some 200-byte string that covers it starts anywhere else in the corpus. Two equal strings have to meet
in one task for that, so they are routed first:

1. Every 200-byte window is named after the gram inside it with the least hash. Following windows
   with the same gram form a segment; equal windows lie in segments of the same gram. Grams of one segment only are unique text and done.
2. A segment that occurs twice as a whole is repeated as a whole. What is left are grams with several different segments.
3. Their segments are dealt to tasks by gram and cut into shards. Each shard has its own Burrows-Wheeler
   transform; the transforms are merged by refining their interleave: sorting the interleave by the transforms' symbols makes it
   right for as many bytes more as a symbol holds, and the intervals of equal prefixes are kept beside it. After 200 bytes the
   intervals are the repeated strings. No suffixes of different shards are compared.
4. A gram with very many different segments is split: into runs of fewer windows that are routed by the bytes all windows of the run
   share, and, where that is not enough, into single windows. Equal windows still meet.

Spans of windows then go back to their documents, whose remaining bytes are put together.

Defined cases: a null text is empty; texts shorter than a window lose nothing; rows that repeat another row's text
are copies of each other, whatever their doc_id; a null doc_id is kept as it is; other columns are ignored. Segments are told apart by 64-bit
hashes of their bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from serieskit.llm.common import discard, small_batches, stored, texts
from serieskit.llm.hashing import POWERS, chunks, mixed

WINDOW = 200
GRAM = 40
BLOCK = 8 << 20
_PLACE_BITS = 24
_PLACES = np.uint64((1 << _PLACE_BITS) - 1)
SHARDS = 4
MERGE_BYTES = 2 << 20
TASK_BYTES = 8 << 20
# A gram (or core) with more different segments than this is split.
SPLIT = 4096
GRANULES = (16, 1)

SEGMENT = "key long, body_hash long, doc_id long, row_id long, start long, windows long, at long"


def prefix_sums(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums from which the hash of any part of ``data`` follows, and the inverse powers that go with them."""
    power, back = POWERS(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * power[: len(data)], out=sums[1:])
    return sums, back


def sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of every ``width`` following values."""
    n = len(values)
    padded = np.concatenate([values, np.full(-n % width + width, np.iinfo(np.uint64).max, np.uint64)]).reshape(-1, width)
    ahead = np.minimum.accumulate(padded, axis=1).ravel()
    behind = np.minimum.accumulate(padded[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(parts: list[bytes], window: int = WINDOW, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(key, body_hash, part, start, windows, place of the gram) of the segments of byte strings that together are at most 16 MB."""
    data = np.frombuffer(b"".join(parts), np.uint8)
    n = len(data)
    if n < window:
        return tuple(np.zeros(0, np.int64) for _ in range(6))
    sums, back = prefix_sums(data)
    grams = (sums[gram:] - sums[:-gram]) * back[: n - gram + 1]
    ordered = (mixed(grams) & ~_PLACES) | np.arange(len(grams), dtype=np.uint64)
    least = sliding_least(ordered, window - gram + 1) & _PLACES
    ends = np.cumsum([len(p) for p in parts])
    begins = ends - [len(p) for p in parts]
    long = ends - begins >= window
    level = np.zeros(n + 1, np.int8)
    level[begins[long]] += 1
    level[ends[long] - window + 1] -= 1
    inside = np.cumsum(level[: len(least)], dtype=np.int8) > 0
    new = np.empty(len(least), bool)
    new[0] = True
    new[1:] = least[1:] != least[:-1]
    new[begins[long]] = True
    first = np.flatnonzero(new & inside)
    edges = np.append(np.flatnonzero(new | ~inside), len(least))
    stop = edges[np.searchsorted(edges, first, "right")]
    count = stop - first
    end = first + count - 1 + window
    body = mixed((sums[end] - sums[first]) * back[first] + count.astype(np.uint64))
    key = mixed(grams[least[first].astype(np.int64)])
    part = np.searchsorted(ends, first, "right")
    return key.view(np.int64), body.view(np.int64), part, first - begins[part], count, least[first].astype(np.int64) - first


def _pieces(whole: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, list[bytes]]]:
    """(text numbers, offsets, parts): texts in groups of bounded size; a longer text in overlapping parts."""
    short = []
    for i, text in enumerate(whole):
        if len(text) > BLOCK:
            for at in range(0, len(text), BLOCK):
                yield np.array([i]), np.array([at]), [text[at : at + BLOCK + WINDOW - 1]]
        else:
            short.append(i)
    for first, part in chunks([whole[i] for i in short]):
        yield np.array(short[first : first + len(part)]), np.zeros(len(part), np.int64), part


def _segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        whole = [t.encode() for t in batch.column("text").to_pylist()]
        for numbers, offsets, parts in _pieces(whole):
            key, body, part, start, count, at = segments(parts)
            rows = pa.array(numbers[part])
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(body), batch.column("doc_id").take(rows), batch.column("row_id").take(rows), pa.array(start + offsets[part]), pa.array(count), pa.array(at)],
                ["key", "body_hash", "doc_id", "row_id", "start", "windows", "at"],
            )


def _rotations(symbols: np.ndarray, base: np.ndarray, local: np.ndarray, size: np.ndarray, lo: int, hi: int) -> np.ndarray:
    """Places lo..hi in the order of their texts' rotations, by doubling the compared length."""
    n = hi - lo
    b, at, m = base[lo:hi], local[lo:hi], size[lo:hi]
    key = np.zeros(n, np.int64)
    for step in range(7):
        key = (key << 9) | symbols[b + (at + step) % m]
    # A place's rank is the first position of the places that equal it so far; only places that share a rank are sorted on.
    rank, open_ = np.zeros(n, np.int64), np.arange(n)
    reach, most = 7, 2 * int(m.max())
    while True:
        order = np.argsort(key)
        open_, key = open_[order], key[order]
        new = np.append(True, key[1:] != key[:-1])
        spot = np.arange(len(key))
        first = np.maximum.accumulate(np.where(new, spot, 0))
        was = rank[open_]
        shared = np.maximum.accumulate(np.where(np.append(True, was[1:] != was[:-1]), spot, 0))
        rank[open_] = was + first - shared
        open_ = open_[~(new & np.append(new[1:], True))]
        if not len(open_) or reach > most:
            return np.argsort(rank, kind="stable") + lo
        key = rank[open_] * n + rank[b[open_] - lo + (at[open_] + reach) % m[open_]]
        reach *= 2


def repeated_windows(bodies: list[bytes], window: int = WINDOW, shards: int = SHARDS) -> list[np.ndarray]:
    """For each of different byte strings the places where a ``window`` starts that also starts elsewhere in them."""
    sizes = np.array([len(b) + 1 for b in bodies], np.int64)
    firsts = np.cumsum(sizes) - sizes
    total = int(sizes.sum())
    symbols = np.zeros(total, np.int64)
    inside = np.ones(total, bool)
    inside[firsts + sizes - 1] = False
    symbols[inside] = np.frombuffer(b"".join(bodies), np.uint8).astype(np.int64) + 1
    base, size = np.repeat(firsts, sizes), np.repeat(sizes, sizes)
    local = np.arange(total) - base
    # A symbol of the transforms is the last few bytes before a place, as many as fit a 64-bit number.
    letters = np.flatnonzero(np.bincount(symbols, minlength=257))
    dense = np.searchsorted(letters, symbols)
    take = max(k for k in (1, 2, 4, 5, 8, 10, 20) if window % k == 0 and len(letters) ** k < 1 << 62)
    before = np.zeros(total, np.int64)
    for step in range(take, 0, -1):
        before = before * len(letters) + dense[base + (local - step) % size]
    before, values = pd.factorize(before, sort=True)
    cuts = np.unique(np.searchsorted(firsts, np.arange(1, shards) * total / shards))
    bounds = np.unique(np.concatenate([[0], firsts[cuts[cuts < len(firsts)]], [total]])).astype(np.int64)
    # The shards' transforms one behind the other, and where each row of a shard goes when its symbol is put before it.
    suffixes = np.concatenate([_rotations(symbols, base, local, size, lo, hi) for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist())])
    transforms = before[suffixes]
    row_of = np.empty(total, np.int64)
    row_of[suffixes] = np.arange(total)
    onward = row_of[base + (local - take) % size][suffixes]
    # The interleave: rows of all shards in merged order, with the number of the interval of equal prefixes each is in. Only
    # places with a whole window before them are of use. An interval of one row stays one for good and is left out.
    rows = row_of[np.flatnonzero(local >= window)]
    interval, count = np.zeros(len(rows), np.int64), 1
    for _ in range(window // take):
        key = transforms[rows] * count + interval
        order = np.argsort(key)
        rows, key = onward[rows[order]], key[order]
        border = np.append(True, key[1:] != key[:-1]) if len(key) else np.zeros(0, bool)
        several = ~(border & np.append(border[1:], True)) if len(key) else border
        rows, interval = rows[several], np.cumsum(border[several]) - 1
        if not len(rows):
            break
        count = int(interval[-1]) + 1
    again = np.sort(suffixes[rows])
    borders = np.searchsorted(again, np.append(firsts, total))
    return [again[a:b] - f for a, b, f in zip(borders[:-1].tolist(), borders[1:].tolist(), firsts.tolist())]


def spans(places: np.ndarray) -> list[tuple[int, int]]:
    """Runs (from, to) of following places."""
    if not len(places):
        return []
    cut = np.flatnonzero(np.diff(places) > 1)
    return list(zip(places[np.append(0, cut + 1)].tolist(), (places[np.append(cut, len(places) - 1)] + 1).tolist()))


SPAN = "doc_id long, row_id long, first long, last long"


def _merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows in segments that occur once; rows come sorted by key and body."""

    def work(held):
        order: dict[tuple[int, int], int] = {}
        bodies = []
        for key, body_hash, body, *_ in held:
            if (key, body_hash) not in order:
                order[key, body_hash] = len(bodies)
                bodies.append(body)
        found = repeated_windows(bodies)
        rows = []
        for key, body_hash, _, copies, doc_id, row_id, start in held:
            if copies == 1:
                rows += [(doc_id, row_id, start + a, start + b) for a, b in spans(found[order[key, body_hash]])]
        columns = list(zip(*rows)) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "row_id", "first", "last"])

    held, size = [], 0
    names = ["key", "body_hash", "body", "copies", "doc_id", "row_id", "start"]
    for batch in batches:
        for row in zip(*(batch.column(n).to_pylist() for n in names)):
            if size >= MERGE_BYTES and row[0] != held[-1][0]:
                yield work(held)
                held, size = [], 0
            held.append(row)
            size += len(row[2])
    if held:
        yield work(held)


PIECE_NAMES = ["key", "body_hash", "doc_id", "row_id", "start", "windows", "at", "copies", "body"]
PIECE = "key long, body_hash long, doc_id long, row_id long, start long, windows long, at long, copies long, body binary"


def _piece_batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * len(PIECE_NAMES)
    kinds = [pa.int64()] * (len(PIECE_NAMES) - 1) + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], PIECE_NAMES)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Bodies of the segments that are asked of each text."""
    for batch in batches:
        rows = []
        for doc_id, row_id, text, wanted in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "row_id", "text", "wanted"))):
            whole = text.encode()
            for w in wanted:
                start, n = w["start"], w["windows"]
                rows.append((w["key"], w["body_hash"], doc_id, row_id, start, n, w["at"], w["copies"], whole[start : start + n - 1 + WINDOW]))
        yield _piece_batch(rows)


def _refine(granule: int):
    """Cut segments into runs of at most ``granule`` windows, named after the gram's place in them and the bytes that all such windows share."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, _, doc_id, row_id, start, windows, at, copies, body in zip(*(batch.column(n).to_pylist() for n in PIECE_NAMES)):
                sums, back = prefix_sums(np.frombuffer(body, np.uint8))
                groups = (at - np.arange(windows)) // granule
                edges = np.flatnonzero(np.concatenate([[True], groups[1:] != groups[:-1], [True]]))
                low, high = edges[:-1], edges[1:]
                group = groups[low]
                core_low = at - group * granule
                core = (sums[core_low - granule + 1 + WINDOW] - sums[core_low]) * back[core_low]
                whole = (sums[high - 1 + WINDOW] - sums[low]) * back[low]
                own = np.uint64(key & ((1 << 64) - 1))
                names = mixed(mixed(core + own) + group.astype(np.uint64)).view(np.int64)
                bodies = mixed(whole + (high - low).astype(np.uint64)).view(np.int64)
                out += [
                    (name, text, doc_id, row_id, start + a, b - a, at - a, copies, body[a : b - 1 + WINDOW])
                    for name, text, a, b in zip(names.tolist(), bodies.tolist(), low.tolist(), high.tolist())
                ]
            yield _piece_batch(out)

    return run


def _compared(pieces: DataFrame) -> DataFrame:
    """Spans of windows repeated between different pieces of a key, for pieces that occur once."""
    size = pieces.agg(F.sum(F.length("body"))).first()[0] or 0
    dealt = pieces.select("key", "body_hash", "body", "copies", "doc_id", "row_id", "start").repartition(max(1, -(-size // TASK_BYTES)), "key")
    return dealt.sortWithinPartitions("key", "body_hash").mapInArrow(_merge, SPAN)


def _settled(pieces: DataFrame, granules: tuple[int, ...]) -> list[DataFrame]:
    """Spans of windows of the pieces that are repeated; ``pieces`` is a stored table."""
    hot = stored(pieces.groupBy("key").agg(F.count_distinct("body_hash").alias("n")).where(F.col("n") > SPLIT).select("key"), "hot-grams")
    if not granules or not hot.limit(1).count():
        return [_compared(pieces)]
    finer = stored(pieces.join(hot, "key", "left_semi").select(*PIECE_NAMES).mapInArrow(_refine(granules[0]), PIECE), "finer")
    total = finer.groupBy("key", "body_hash").agg(F.sum("copies").alias("total"))
    counted = finer.join(total, ["key", "body_hash"])
    whole = counted.where("total > 1 and copies = 1").select("doc_id", "row_id", F.col("start").alias("first"), (F.col("start") + F.col("windows")).alias("last"))
    open_ = total.groupBy("key").agg(F.count("*").alias("n"), F.min("total").alias("least")).where("n > 1 and least = 1").select("key")
    # Of a piece that occurs several times one row is enough to compare others with.
    compared = counted.join(open_, "key", "left_semi").withColumn("copies", F.col("total")).select(*PIECE_NAMES)
    rest = stored(compared.where("copies = 1").union(compared.where("copies > 1").dropDuplicates(["key", "body_hash"])), "pieces")
    return [_compared(pieces.join(hot, "key", "left_anti")), whole, *_settled(rest, granules[1:])]


def repeated_spans(rows: DataFrame) -> DataFrame:
    """(doc_id, row_id, first, last): starts of windows that occur elsewhere; ``rows`` has doc_id, row_id and text."""
    all_ = stored(rows.mapInArrow(_segment, SEGMENT), "segments")
    shared = all_.groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select("key")
    found = stored(all_.join(shared, "key"), "repeated-grams")
    discard(all_)
    place = F.struct("doc_id", "row_id", "start", "windows", "at")
    bodies = stored(found.groupBy("key", "body_hash").agg(F.count("*").alias("copies"), F.min(place).alias("place")), "bodies")
    whole = found.join(bodies.where("copies > 1").select("key", "body_hash"), ["key", "body_hash"], "left_semi")
    whole = whole.select("doc_id", "row_id", F.col("start").alias("first"), (F.col("start") + F.col("windows")).alias("last"))
    open_ = bodies.groupBy("key").agg(F.count("*").alias("n"), F.min("copies").alias("least")).where("n > 1 and least = 1").select("key")
    asked = bodies.join(open_, "key", "left_semi").select("place.doc_id", "place.row_id", F.struct("key", "body_hash", "copies", "place.start", "place.windows", "place.at").alias("w"))
    asked = asked.groupBy(F.col("doc_id").alias("_doc"), F.col("row_id").alias("_row")).agg(F.collect_list("w").alias("wanted"))
    cut = rows.join(asked, rows["doc_id"].eqNullSafe(F.col("_doc")) & (rows["row_id"] == F.col("_row"))).select("doc_id", "row_id", "text", "wanted")
    pieces = stored(cut.mapInArrow(_cut, PIECE), "pieces")
    parts = [whole, *_settled(pieces, GRANULES)]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def _kept(text: str, found: list[dict] | None) -> tuple[bytes, int, int]:
    """Remaining bytes, removed bytes and removed runs of a text."""
    whole = text.encode()
    if not found:
        return whole, 0, 0
    runs: list[list[int]] = []
    for first, last in sorted((w["first"], w["last"] - 1 + WINDOW) for w in found):
        if runs and first <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], last)
        else:
            runs.append([first, last])
    edges = [0, *(e for run in runs for e in run), len(whole)]
    return b"".join(whole[a:b] for a, b in zip(edges[::2], edges[1::2])), sum(b - a for a, b in runs), len(runs)


RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, row_id long"


def _digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, row_id, text, found in zip(*(batch.column(n).to_pylist() for n in ("doc_id", "row_id", "text", "found"))):
            kept, removed, runs = _kept(text, found)
            rows.append((doc_id, len(kept) + removed, removed, runs, hashlib.sha256(kept).hexdigest(), row_id))
        kinds = [pa.int64()] * 4 + [pa.string(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], [f.split()[0] for f in RESULT.split(", ")])


def _shorten(text: pd.Series, found: pd.Series) -> pd.Series:
    # A character that lost a part of its bytes goes as a whole.
    return pd.Series([_kept(t, list(f))[0].decode(errors="ignore") if f is not None else t for t, f in zip(text, found)], dtype=object)


def _with_spans(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    small_batches(docs.sparkSession)
    rows = texts(docs).withColumn("row_id", F.xxhash64("doc_id", "text"))
    # Repeated rows share a group, and their spans are the same: a list is bounded by one document.
    found = repeated_spans(rows).groupBy(F.col("doc_id").alias("_doc"), F.col("row_id").alias("_row")).agg(F.collect_set(F.struct("first", "last")).alias("found"))
    return rows, found


def removals(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row."""
    rows, found = _with_spans(docs)
    both = rows.join(found, rows["doc_id"].eqNullSafe(F.col("_doc")) & (rows["row_id"] == F.col("_row")), "left")
    return both.select("doc_id", "row_id", "text", "found").mapInArrow(_digest, RESULT).drop("row_id")


def drop_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the repeated bytes gone from its texts (and n_chars, if there, counted anew); all rows stay."""
    _, found = _with_spans(docs)
    names = docs.columns
    carried = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    doc_id, text = (F.col(f"c{names.index(c)}") for c in ("doc_id", "text"))
    key = F.xxhash64(doc_id.cast("long"), F.coalesce(text, F.lit("")))
    both = carried.join(found, doc_id.cast("long").eqNullSafe(F.col("_doc")) & (key == F.col("_row")), "left")
    shorten = F.pandas_udf(_shorten, "string")
    both = both.withColumn("new_text", F.when(F.col("found").isNull(), text).otherwise(shorten(F.coalesce(text, F.lit("")), "found")))
    out = {"text": F.col("new_text")}
    if "n_chars" in names:
        out["n_chars"] = F.char_length("new_text").cast(dict(docs.dtypes)["n_chars"])
    return both.select(*[out.get(c, F.col(f"c{i}")).alias(c) for i, c in enumerate(names)])
