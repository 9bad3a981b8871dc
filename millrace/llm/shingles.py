"""Word shingles of whole texts as sets of 64-bit hashes, computed by column."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WIDTH = 5
_CUT = 1 << 20  # bytes hashed at a time
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D  # odd, so it has an inverse modulo 2**64
# A 64-bit number for each byte value: the word hash is a polynomial in them.
_BYTE = np.random.default_rng(5).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS: dict[str, np.ndarray] = {}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        _POWERS["up"] = _powers(_BASE, n)
        _POWERS["down"] = _powers(pow(_BASE, -1, 1 << 64), n)
    return _POWERS["up"], _POWERS["down"]


def _hash_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and hash of each word of some bytes that end with a blank."""
    blank = (data == 32) | ((data >= 9) & (data <= 13))
    edges = np.flatnonzero(np.diff(blank.view(np.int8), prepend=1))
    starts, ends = edges[0::2], edges[1::2]
    up, down = _tables(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return starts, mix((sums[ends] - sums[starts]) * down[starts])


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of a text column and the number of words per text.

    A-Z are lower-cased, words are separated by the six ASCII blanks, null is
    an empty text.
    """
    texts = pc.fill_null(column.cast(pa.large_string()), "").cast(pa.large_binary())
    lengths = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    joined = b"\n".join(texts.to_pylist()) + b"\n"
    data = np.frombuffer(joined.lower(), np.uint8)
    starts, hashes = [], []
    at = 0
    while at < len(data):
        stop = min(len(data), at + _CUT)
        while True:  # to the last blank of the piece; a longer word makes it longer
            tail = data[at:stop]
            blanks = np.flatnonzero((tail[-4096:] == 32) | ((tail[-4096:] >= 9) & (tail[-4096:] <= 13)))
            if len(blanks):
                stop = stop - min(4096, len(tail)) + blanks[-1] + 1
                break
            stop = min(len(data), stop + _CUT)
        s, h = _hash_words(data[at:stop])
        starts.append(s + at)
        hashes.append(h)
        at = stop
    where = np.concatenate(starts) if starts else np.zeros(0, np.int64)
    values = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    bounds = np.searchsorted(where, np.concatenate([[0], np.cumsum(lengths)]))
    return values, np.diff(bounds)


def shingle_sets(column: pa.Array, width: int = WIDTH) -> list[np.ndarray]:
    """Sorted distinct shingle hashes per text.

    A text of fewer words than ``width`` has its whole sequence as the one
    shingle; a text without words has none.
    """
    words, counts = word_hashes(column)
    if not len(words):
        return [np.zeros(0, np.uint64) for _ in counts]
    rolled = words[: max(0, len(words) - width + 1)].copy()
    for k in range(1, width):
        rolled = mix(rolled * _STEP + words[k : k + len(rolled)])
    ends = np.cumsum(counts)
    out = []
    for start, end in zip(ends - counts, ends):
        n = end - start
        if n >= width:
            out.append(np.unique(rolled[start : end - width + 1]))
        elif n:
            one = np.array([n], np.uint64)
            for w in words[start:end]:
                one = mix(one * _STEP + w)
            out.append(one)
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def set_id(shingles: np.ndarray) -> int:
    """Signed 64-bit digest of a non-empty set, used together with its size."""
    total = mix(shingles ^ _STEP).sum(dtype=np.uint64) + np.uint64(len(shingles))
    return int(mix(np.array([total]))[0].astype(np.int64))
