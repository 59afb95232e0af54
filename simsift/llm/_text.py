"""Vectorised work on the bytes of Arrow text columns, a bounded chunk at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1_000_000

#: Byte classes. Bytes of multi-byte characters are never separators.
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
_ODD_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


_caches: dict[str, dict] = {}


def worker_cache(operator: str) -> dict:
    """What a worker keeps for an operator from task to task; that of other operators is dropped, so a
    worker that several operators use holds one's at most."""
    for other in [x for x in _caches if x != operator]:
        del _caches[other]
    return _caches.setdefault(operator, {})


class Chunk:
    """Some consecutive texts: rows first..last, their bytes and the offsets of each text in them."""

    def __init__(self, first: int, buf: np.ndarray, offsets: np.ndarray):
        self.first, self.buf, self.offsets = first, buf, offsets
        self.rows = len(offsets) - 1


def chunks(column: pa.Array, limit: int = CHUNK_BYTES, rows: int = 10_000) -> Iterator[Chunk]:
    """The texts of a column (null: empty) in pieces of about limit bytes and at most rows texts; a longer text is one piece."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if not len(column):
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    buf = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, first + rows)
        yield Chunk(first, buf[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def spans(chunk: Chunk, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes of a class: starts, ends, and where each text's runs begin in those arrays."""
    mask = inside[chunk.buf]
    n = len(mask)
    begins, stops = np.zeros(n + 1, bool), np.zeros(n + 1, bool)
    begins[:n] = mask
    begins[1:n] &= ~mask[:-1]
    stops[1:] = mask
    stops[1:n] &= ~mask[1:]
    edges = chunk.offsets
    at = edges[edges < n]
    begins[at] |= mask[at]
    at = edges[edges > 0]
    stops[at] |= mask[at - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops)
    return starts, ends, np.searchsorted(starts, edges)


def mix(h: np.ndarray) -> np.ndarray:
    """The 64-bit finaliser of MurmurHash3."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_powers: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = 1 << max(16, int(n).bit_length())
        out = []
        for base in (_ODD, _ODD_INVERSE):
            p = np.full(size, base, np.uint64)
            p[0] = 1
            out.append(np.multiply.accumulate(p))
        if size > 1 << 22:  # a rare huge text; its tables aren't kept
            return out[0], out[1]
        _powers[:] = out
    return _powers[0], _powers[1]


def span_hashes(buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each span, alike wherever the span stands."""
    up, down = powers(len(buf) + 1)
    sums = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum((buf.astype(np.uint64) + np.uint64(1)) * up[: len(buf)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def words(chunk: Chunk, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ (A-Z lower-cased) and where each text's words begin."""
    buf = LOWER[chunk.buf] if lower else chunk.buf
    starts, ends, first = spans(chunk, ~SPACES)
    return span_hashes(buf, starts, ends), first


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> list[np.ndarray]:
    """Of each text the sorted distinct hashes of its width-word shingles; of a shorter text one of all its words."""
    rolled = np.zeros(max(0, len(hashes) - width + 1), np.uint64)
    for k in range(width):
        rolled = rolled * np.uint64(0xD6E8FEB86659FD93) + hashes[k : len(hashes) - width + 1 + k]
    rolled = mix(rolled)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            out.append(np.unique(rolled[a : b - width + 1]))
        elif b > a:
            one = b - a
            for h in hashes[a:b].tolist():
                one = (one * 0xD6E8FEB86659FD93 + h) % (1 << 64)
            out.append(mix(np.array([one], np.uint64)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out
