"""Words of whole Arrow text columns as numpy arrays, without a Python object per word.

A word is a run of bytes other than the six ASCII white-space characters (``[^\\x20\\x09-\\x0D]+``); A-Z are
lower-cased before hashing. Everything works on UTF-8 bytes, so any script is kept whole. Texts are taken
in blocks of 256 KB (one text alone when it is longer), which bounds memory by the longest text: a block takes
about a hundred bytes of arrays for each of its own.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 18

_SPACES = np.zeros(256, dtype=bool)
_SPACES[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_CODE = np.random.default_rng(20240).integers(0, 2**63, 256).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_BASE, _INVERSE = 0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)


class _Powers:
    """Powers of the base and of its inverse, kept between calls. Pickles empty, so no task function carries them."""

    def __init__(self):
        self.kept = {}

    def __reduce__(self):
        return type(self), ()

    def up_to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        size = max(BLOCK_BYTES, n) + 1
        found = self.kept.get("both", ((), ()))
        if len(found[0]) < n + 1:
            found = []
            for base in (_BASE, _INVERSE):
                steps = np.full(size, base, dtype=np.uint64)
                steps[0] = 1
                found.append(np.cumprod(steps))
            if n <= 2 * BLOCK_BYTES:  # those of one very long word are not kept
                self.kept["both"] = tuple(found)
        return found[0], found[1]


_POWERS = _Powers()
_powers = _POWERS.up_to


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (the finaliser of a well-known public hash)."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_blocks(texts: pa.Array):
    """(first row, bytes, offsets) for blocks of rows; NULL counts as an empty text."""
    texts = texts.cast(pa.large_string()) if not pa.types.is_large_string(texts.type) else texts
    if texts.null_count:
        texts = texts.fill_null("")
    if len(texts) == 0:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, dtype=np.uint8)
    row = 0
    while row < len(texts):
        end = int(np.searchsorted(offsets, offsets[row] + BLOCK_BYTES, side="right")) - 1
        end = min(max(end, row + 1), len(texts))
        yield row, data[offsets[row]:offsets[end]], offsets[row:end + 1] - offsets[row]
        row = end


def word_bounds(data: np.ndarray, offsets: np.ndarray, between: np.ndarray = _SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and for each text the index of its first word (one more at the end)."""
    if len(data) == 0:
        none = np.zeros(0, dtype=np.int64)
        return none, none, np.zeros(len(offsets), dtype=np.int64)
    inside = ~between[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1] | cut[1:-1]
    ends[:-1] &= ~inside[1:] | cut[1:-1]
    starts = np.flatnonzero(begins)
    return starts, np.flatnonzero(ends) + 1, np.searchsorted(starts, offsets)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = _LOWER) -> np.ndarray:
    """One 64-bit hash per byte span, from prefix sums: no loop over spans or characters.

    Data longer than a block is worked on in stretches, each as long as the spans that begin in it, so the
    sums and powers in memory stay as long as a block unless one span is longer.
    """
    if len(data) <= 2 * BLOCK_BYTES:
        return _span_hashes(data, starts, ends, fold)
    out, stretch = np.empty(len(starts), dtype=np.uint64), starts // BLOCK_BYTES
    order = np.argsort(stretch, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(stretch[order])) + 1):
        if len(part):
            low, high = starts[part].min(), ends[part].max()
            out[part] = _span_hashes(data[low:high], starts[part] - low, ends[part] - low, fold)
    return out


def _span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray) -> np.ndarray:
    up, down = _POWERS.up_to(len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum(_CODE[fold[data]] * up[:len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of every run of ``size`` neighbours; index i is the run that begins at i."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    out = np.zeros(n, dtype=np.uint64)
    for k in range(size):
        out = out * np.uint64(0xD6E8FEB86659FD93) + hashes[k:k + n]
    return mix(out)


def shingle_sets(texts: pa.Array, size: int = 5):
    """(row, sorted distinct shingles) per text: runs of ``size`` words, the whole sequence when there are fewer."""
    for row, data, offsets in text_blocks(texts):
        starts, ends, first = word_bounds(data, offsets)
        words = span_hashes(data, starts, ends)
        runs = windows(words, size)
        for i in range(len(offsets) - 1):
            a, b = first[i], first[i + 1]
            if b - a >= size:
                yield row + i, np.unique(runs[a:b - size + 1])
            elif b > a:
                yield row + i, windows(words[a:b], int(b - a)) ^ np.uint64(b - a)
            else:
                yield row + i, np.zeros(0, dtype=np.uint64)
