"""SentencePiece encoding and decoding over a lattice of pieces.

A text is cut into units (a word with the blanks before it) at places no piece crosses. Per batch the distinct new units
become a relation of characters; its substrings up to the longest piece's length are exploded, equi-joined
with the piece table on a hash, and the edges found are grouped by unit and end position. A Viterbi
fold walks the end positions and keeps the one best edge into each. In a BPE model an edge may follow another only if the two pieces
stay apart when merged alone, which the merge ranks tell; then exactly one edge stays per
reachable position, and the path is the segmentation of the model's own merges. (The scores of a BPE model are merge ranks, so the path
with the largest sum of scores is not the model's segmentation.) Characters without a piece
become their UTF-8 bytes.

The lattice work is done in tasks with numpy, on batches of documents; no row moves between tasks. Units met before are looked up in
a table that two generations bound.

Defined cases: a null or empty text has no pieces; very long units are folded like short ones; a text that holds the blank sign of the model itself
decodes with blanks for it, as the model does (``round_trip`` is false then); repeated rows give
repeated results; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from serieskit.llm.common import small_batches, texts

BLANK = "▁"
CACHE_UNITS = 300_000
_UNIT = re.compile(r"▁*[^▁\n\t]+|▁+|[\n\t]+")
_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, np.uint64)
    out[0] = 1
    have = 1
    step = base
    while have < n:
        take = min(have, n - have)
        out[have : have + take] = out[:take] * np.uint64(step)
        step = step * step & _MASK
        have += take
    return out


class PieceTable:
    """Pieces, merge ranks and the pairs of pieces that merge, read from a BPE model with byte fallback."""

    def __init__(self, path: str):
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        size = model.get_piece_size()
        self.ids = np.array([i for i in range(size) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))], np.int64)
        names = [model.id_to_piece(int(i)) for i in self.ids]
        if any(len(n) > 1 and re.search(r"[^▁]▁|[\n\t]", n) for n in names):
            raise ValueError("a piece crosses a border of units")
        self.byte_ids = np.zeros(256, np.int32)
        self.bytes: list[bytes] = []
        for i in range(size):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.byte_ids[int(piece[3:5], 16)] = i
                self.bytes.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i):
                self.bytes.append(b"")
            else:
                self.bytes.append(piece.replace(BLANK, " ").encode())
        # Ranks: characters first, then merges from the best score on.
        order = sorted(range(len(names)), key=lambda k: (len(names[k]) > 1, -model.get_score(int(self.ids[k])), k))
        self.names = [names[k] for k in order]
        self.ids = np.append(self.ids[order], -1).astype(np.int64)
        self.unknown = len(self.names)
        self.chars = sum(len(n) == 1 for n in self.names)
        self.longest = max(map(len, self.names))
        self._merges()
        self._hashes()

    def _merges(self) -> None:
        """Which pairs merge into what, and the last merge of every piece when it is built alone."""
        rank = {n: k for k, n in enumerate(self.names)}
        pairs = {}
        for name, k in rank.items():
            for cut in range(1, len(name)):
                left, right = rank.get(name[:cut]), rank.get(name[cut:])
                if left is not None and right is not None:
                    pairs[left, right] = k
        count = len(self.names)
        self.left, self.right = np.arange(count + 1), np.arange(count + 1)
        self.usable = np.ones(count + 1, bool)
        for name, k in rank.items():
            if len(name) == 1:
                continue
            parts = [rank.get(c, -1) for c in name]
            if -1 in parts:
                self.usable[k] = False
                continue
            while len(parts) > 2:
                best = min(((pairs[p], i) for i, p in enumerate(zip(parts, parts[1:])) if p in pairs), default=None)
                if best is None:
                    break
                parts[best[1] : best[1] + 2] = [best[0]]
            if len(parts) == 2 and pairs.get(tuple(parts)) == k:
                self.left[k], self.right[k] = parts
            else:
                self.usable[k] = False
        keys = np.array([a * (count + 1) + b for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array(list(pairs.values()), np.int64)[order]

    def _hashes(self) -> None:
        by_length: dict[int, list[tuple[int, int]]] = {}
        for k, name in enumerate(self.names):
            if self.usable[k]:
                by_length.setdefault(len(name), []).append((sum(ord(c) * pow(_BASE, i, 1 << 64) for i, c in enumerate(name)) & _MASK, k))
        self.by_length = {}
        for length, entries in by_length.items():
            entries.sort()
            self.by_length[length] = np.array([h for h, _ in entries], np.uint64), np.array([k for _, k in entries], np.int64)

    def apart(self, first: np.ndarray, second: np.ndarray) -> np.ndarray:
        """Whether two adjacent pieces stay two when their text is merged alone.

        Merges are taken back from the latest on; the pair parts for good if at no moment the pieces at the border
        merge before the merge just taken back. On equal ranks the left merge comes first.
        """
        count = self.unknown + 1
        a, b = first.copy(), second.copy()
        limit = np.full(len(a), np.iinfo(np.int64).max)
        fine = np.ones(len(a), bool)
        open_ = np.arange(len(a))
        while len(open_):
            x, y = a[open_], b[open_]
            keys = x * count + y
            at = np.minimum(np.searchsorted(self.pair_keys, keys), len(self.pair_keys) - 1)
            early = (self.pair_keys[at] == keys) & (self.pair_ranks[at] < limit[open_])
            fine[open_[early]] = False
            splits_x, splits_y = self.left[x] != x, self.left[y] != y
            take_x = splits_x & ((x > y) | ~splits_y)
            take_y = splits_y & ~take_x
            limit[open_] = np.where(take_x, x, y + 1)
            a[open_] = np.where(take_x, self.right[x], x)
            b[open_] = np.where(take_y, self.left[y], y)
            open_ = open_[~early & (take_x | take_y)]
        return fine


def encode_units(table: PieceTable, units: list[str]) -> list[bytes]:
    """Ids (32-bit little-endian) of every unit: explode, join, group, fold."""
    lengths = np.array([len(u) for u in units])
    chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    total = len(chars)
    firsts = np.cumsum(lengths) - lengths
    unit_end = np.repeat(firsts + lengths, lengths)
    power, back = _powers(_BASE, total + 1), _powers(pow(_BASE, -1, 1 << 64), total + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(chars * power[:total], dtype=np.uint64)])
    starts, ends, found = [], [], []
    at = np.arange(total)
    for length in range(1, min(table.longest, int(lengths.max(initial=0))) + 1):
        at = at[at + length <= unit_end[at]]
        if length in table.by_length:
            hashes, ranks = table.by_length[length]
            value = (sums[at + length] - sums[at]) * back[at]
            place = np.minimum(np.searchsorted(hashes, value), len(hashes) - 1)
            hit = hashes[place] == value
            starts.append(at[hit])
            ends.append(at[hit] + length)
            found.append(ranks[place[hit]])
        if length == 1:
            lone = np.ones(total, bool)
            if starts:
                lone[starts[0]] = False
            lone = np.flatnonzero(lone)
            starts.append(lone)
            ends.append(lone + 1)
            found.append(np.full(len(lone), table.unknown))
    starts, ends, found = (np.concatenate(x) for x in (starts, ends, found))
    depth = ends - np.repeat(firsts, lengths)[ends - 1]
    order = np.argsort(depth, kind="stable")
    starts, ends, found = starts[order], ends[order], found[order]
    cuts = np.searchsorted(depth[order], np.arange(1, int(lengths.max(initial=0)) + 2))
    # One slot per boundary behind a character; what stands before a unit's first character is no piece.
    last, came = np.full(total + 1, -1), np.zeros(total + 1, np.int64)
    first_char = np.zeros(total + 1, bool)
    first_char[firsts] = True
    for lo, hi in zip(cuts[:-1], cuts[1:]):
        s, e, piece = starts[lo:hi], ends[lo:hi], found[lo:hi]
        opens = first_char[s]
        before = np.where(opens, -1, last[s])
        fine = opens.copy()
        rest = np.flatnonzero(~opens & (before >= 0))
        if len(rest):
            pairs, inverse = np.unique(before[rest] * (table.unknown + 1) + piece[rest], return_inverse=True)
            fine[rest] = table.apart(pairs // (table.unknown + 1), pairs % (table.unknown + 1))[inverse]
        last[e[fine]], came[e[fine]] = piece[fine], s[fine]
    # Back from the ends of the units.
    here, unit = firsts + lengths, np.arange(len(units))
    path = []
    while len(here):
        path.append((unit, came[here], last[here]))
        here = came[here]
        going = here > firsts[unit]
        here, unit = here[going], unit[going]
    unit, place, piece = (np.concatenate(x) for x in zip(*path)) if path else (np.zeros(0, np.int64),) * 3
    order = np.argsort(place, kind="stable")
    unit, place, piece = unit[order], place[order], piece[order]
    ids = table.ids[piece].astype("<i4")
    borders = np.searchsorted(unit, np.arange(len(units) + 1))
    plain = ids.tobytes()
    out = [plain[4 * a : 4 * b] for a, b in zip(borders[:-1].tolist(), borders[1:].tolist())]
    for u in np.unique(unit[piece == table.unknown]).tolist():
        run = []
        for k in range(borders[u], borders[u + 1]):
            run.append(table.byte_ids[list(chr(int(chars[place[k]])).encode(errors="surrogatepass"))] if piece[k] == table.unknown else ids[k : k + 1])
        out[u] = np.concatenate(run).astype("<i4").tobytes()
    return out


class Encoder:
    def __init__(self, path: str):
        self.table = PieceTable(path)
        self.units: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def encode(self, batch: list[str]) -> list[bytes]:
        if len(self.units) > CACHE_UNITS:
            self.units, self.older = {}, self.units
        cut = [_UNIT.findall((" " + text).replace(" ", BLANK)) if text else [] for text in batch]
        units, new = self.units, []
        for unit in {u for text in cut for u in text}.difference(units):
            if unit in self.older:
                units[unit] = self.older[unit]
            else:
                new.append(unit)
        if new:
            units.update(zip(new, encode_units(self.table, new)))
        return [b"".join(map(units.__getitem__, text)) for text in cut]

    def decode(self, ids: np.ndarray) -> str:
        text = b"".join(map(self.table.bytes.__getitem__, ids.tolist())).decode(errors="replace")
        return text[1:] if text.startswith(" ") else text


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path)
    return _ENCODERS[path]


def _encode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            whole = batch.column("text").to_pylist()
            arrays = [np.frombuffer(b, "<i4") for b in enc.encode(whole)]
            sizes = np.array([len(a) for a in arrays], np.int64)
            offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
            values = np.concatenate(arrays) if arrays else np.zeros(0, np.int32)
            sound = [enc.decode(a) == t for a, t in zip(arrays, whole)]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), pa.array(sizes), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32())), pa.array(sound, pa.bool_()),
            ], ["doc_id", "n_pieces", "ids", "round_trip"])

    return run


def encode(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_pieces, ids, and whether the ids decode to the whole text, of every row."""
    small_batches(docs.sparkSession)
    return texts(docs, id_col, text_col).mapInArrow(_encode(model_path), "doc_id long, n_pieces long, ids array<int>, round_trip boolean")


def _decode(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(path)
        for batch in batches:
            out = [enc.decode(np.array(ids or [], np.int64)) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.string())], ["doc_id", "text"])

    return run


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """doc_id and the text that the ids of every row stand for; null ids are an empty text."""
    small_batches(encoded.sparkSession)
    return encoded.select("doc_id", "ids").mapInArrow(_decode(model_path), "doc_id long, text string")
