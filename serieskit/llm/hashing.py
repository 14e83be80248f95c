"""Vectorised hashes of words and of runs of words, for many byte texts at once.

Arithmetic is modulo 2**64, where a polynomial has texts of equal value for every base; words and word sequences are
therefore mixed piece by piece, each piece changing the state without a linear form.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np

CHUNK_BYTES = 2 << 20
# Words of more bytes are hashed one by one.
LONG_WORD = 64
_ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)
BASE = 0x2545F4914F6CDD1D

# White space as bytes: blank and the controls 9 to 13.
WHITE = np.zeros(256, bool)
WHITE[[32, 9, 10, 11, 12, 13]] = True
# All ASCII but letters and digits.
NOT_WORD = np.array([not chr(i).isalnum() if i < 128 else False for i in range(256)])


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def multipliers(n: int, seed: int) -> np.ndarray:
    """``n`` odd multipliers."""
    return mixed(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(_ODD[0]) + np.uint64(seed)) | np.uint64(1)


class Powers:
    """Powers of an odd base and of its inverse, grown when longer ones are asked for."""

    def __init__(self, base: int = BASE):
        self.bases = (base, pow(base, -1, 1 << 64))
        self.tables = [np.ones(1, np.uint64), np.ones(1, np.uint64)]

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        for i, base in enumerate(self.bases):
            table = self.tables[i]
            while len(table) < n:
                step = np.uint64(pow(base, len(table), 1 << 64))
                table = np.concatenate([table, table * step])
            self.tables[i] = table
        return self.tables[0][:n], self.tables[1][:n]


POWERS = Powers()


def chunks(texts: list[bytes], most: int = CHUNK_BYTES) -> Iterator[tuple[int, list[bytes]]]:
    """(first place, texts) with at most ``most`` bytes together, or one text that is longer alone."""
    first, size = 0, 0
    for i, text in enumerate(texts):
        if size and size + len(text) > most:
            yield first, texts[first:i]
            first, size = i, 0
        size += len(text) + 1
    if first < len(texts):
        yield first, texts[first:]


def word_hashes(texts: list[bytes], apart: np.ndarray = WHITE) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of lower-cased texts, and the place of each text's first word (one more at the end).

    Only A-Z are lower-cased; ``apart`` says which bytes stand between words.
    """
    joined = b"\n".join(texts).lower() + b"\n"
    data = np.frombuffer(joined + bytes(8), np.uint8)
    gap = apart[data[: len(joined)]]
    edges = np.flatnonzero(np.diff(np.concatenate([[True], gap]).astype(np.int8)))
    starts, ends = edges[0::2], edges[1::2]
    sizes = ends - starts
    # The eight bytes from every place on, as one number.
    eight = np.lib.stride_tricks.as_strided(data.view(np.uint8), (len(joined), 8), (1, 1))
    hashes = mixed(sizes.astype(np.uint64) + np.uint64(BASE))
    for done in range(0, min(LONG_WORD, int(sizes.max(initial=0))), 8):
        some = np.flatnonzero(sizes > done) if done else slice(None)
        piece = eight[starts[some] + done].view(np.uint64).ravel()
        left = np.minimum(sizes[some] - done, 8).astype(np.uint64)
        piece = piece & (np.uint64(0xFFFFFFFFFFFFFFFF) >> (np.uint64(64) - np.uint64(8) * left))
        hashes[some] = mixed(hashes[some] * np.uint64(_ODD[1]) + mixed(piece + np.uint64(_ODD[0])))
    for i in np.flatnonzero(sizes > LONG_WORD):
        hashes[i] = int.from_bytes(blake2b(joined[starts[i] : ends[i]], digest_size=8).digest(), "little")
    lengths = np.array([len(t) + 1 for t in texts], np.int64)
    begins = np.concatenate([[0], np.cumsum(lengths)])
    return hashes, np.searchsorted(starts, begins)


def runs(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of every run of ``k`` following words (as many as words; the last k - 1 are of no use)."""
    out = words.copy()
    for i in range(1, k):
        shifted = np.zeros_like(words)
        shifted[: len(words) - i] = words[i:]
        out = mixed(out * np.uint64(_ODD[1]) + shifted * np.uint64(_ODD[2]) + np.uint64(i))
    return out


def shingles(texts: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of every text's k-word shingles, their borders, and two hashes of every text's whole word sequence.

    A text with fewer than ``k`` words, but with words, has its whole sequence as one shingle.
    """
    words, borders = word_hashes(texts)
    counts = np.diff(borders)
    place = np.arange(len(words)) - np.repeat(borders[:-1], counts)
    whole = []
    for odd in _ODD[1:3]:
        placed = mixed(words ^ mixed(place.astype(np.uint64) * np.uint64(_ODD[0]) + np.uint64(odd)))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(placed, dtype=np.uint64)])
        whole.append(mixed(sums[borders[1:]] - sums[borders[:-1]] + counts.astype(np.uint64)))
    left = np.repeat(borders[1:], counts) - np.arange(len(words))
    keep = left >= k
    short = (counts < k) & (counts > 0)
    grams = runs(words, k) if len(words) else words
    if short.any():
        at = borders[:-1][short]
        keep[at] = True
        grams[at] = whole[0][short]
    sizes = np.where(short, 1, np.maximum(counts - k + 1, 0))
    return grams[keep], np.concatenate([[0], np.cumsum(sizes)]), whole[0], whole[1]
