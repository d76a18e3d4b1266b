"""Vectorised byte-level text helpers on Arrow string buffers (numpy only, used inside tasks).

Texts are handled as UTF-8 bytes.  Word and n-gram hashes come from one running
polynomial sum over the bytes, so no Python string is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

PIECE_BYTES = 1 << 18
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_MIX = np.random.default_rng(20).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 1 << 16, 0 if have is None else 2 * len(have))
        steps = np.full(size, np.uint64(base))
        steps[0] = np.uint64(1)
        have = np.multiply.accumulate(steps)
        if size <= 8 * PIECE_BYTES:
            _powers[base] = have
    return have[:n]


def finish(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; nulls count as empty."""
    if column.null_count:
        column = column.fill_null("")
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset:column.offset + len(column) + 1]
    if data is None or len(off) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    buf = np.frombuffer(data, dtype=np.uint8)[off[0]:off[-1]]
    return buf, off - off[0]


def slices(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 21) -> Iterator[pa.RecordBatch]:
    """The batches in slices of about ``most`` bytes of a string column, so copies and results stay small."""
    for batch in batches:
        size = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        for lo, hi in pieces(np.concatenate(([0], np.cumsum(size, dtype=np.int64))), most):
            yield batch.slice(lo, hi - lo)


def pieces(off: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``most`` bytes each (a longer single text is a range of its own)."""
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = int(np.searchsorted(off, off[lo] + most, side="right")) - 1
        hi = min(n, max(hi, lo + 1))
        yield lo, hi
        lo = hi


def byte_table(keep) -> np.ndarray:
    return np.array([bool(keep(b)) for b in range(256)])


def lower_ascii() -> np.ndarray:
    t = np.arange(256, dtype=np.uint8)
    t[65:91] += 32
    return t


LOWER = lower_ascii()


class Hasher:
    """Hashes of byte ranges of one buffer."""

    def __init__(self, buf: np.ndarray):
        n = len(buf)
        self._sum = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_MIX[buf] * _power(_BASE, n), out=self._sum[1:])
        self._inverse = _power(_INVERSE, n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return finish((self._sum[end] - self._sum[start]) * self._inverse[start]
                      + (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def word_spans(buf: np.ndarray, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every maximal run of kept bytes; runs end at row ends."""
    n = len(buf)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, z
    mask = keep[buf]
    edge = np.zeros(n + 1, bool)
    edge[off] = True
    before = np.concatenate(([False], mask[:-1])) & ~edge[:-1]
    after = np.concatenate((mask[1:], [False])) & ~edge[1:]
    start = np.flatnonzero(mask & ~before)
    end = np.flatnonzero(mask & ~after) + 1
    row = np.searchsorted(off, start, side="right") - 1
    return start, end, row


def runs(buf: np.ndarray, keep: np.ndarray, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Parts of the buffer of about ``most`` bytes that cut no run of kept bytes, so temporaries stay small for long texts."""
    lo, n = 0, len(buf)
    while n - lo > 2 * most:
        at, end = lo + most, None
        while end is None and at < n:
            free = np.flatnonzero(~keep[buf[at:at + most]])
            end, at = (at + int(free[0]) if len(free) else None), at + most
        if end is None:
            break
        yield lo, end
        lo = end
    yield lo, n


def word_hashes(buf: np.ndarray, off: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash and row of every maximal run of kept bytes, part by part."""
    out = []
    for lo, hi in runs(buf, keep):
        start, end, row = word_spans(buf[lo:hi], np.clip(off, lo, hi) - lo, keep)
        out.append((Hasher(buf[lo:hi])(start, end) if len(start) else np.zeros(0, np.uint64), row))
    return np.concatenate([h for h, _ in out]), np.concatenate([r for _, r in out])


def ragged(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Indices start[i] .. start[i]+length[i]-1 for all i, one after the other."""
    total = int(length.sum())
    begin = np.cumsum(length) - length
    return np.repeat(start - begin, length) + np.arange(total)


def segment_starts(row: np.ndarray) -> np.ndarray:
    """Where a new value begins in a sorted array."""
    if len(row) == 0:
        return np.zeros(0, np.int64)
    return np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))


def signed(h: np.ndarray) -> np.ndarray:
    return h.view(np.int64)


def _ascii_kinds() -> np.ndarray:
    """1 letters, 2 digits, 3 other visible characters but the apostrophe, 0 all other bytes."""
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = 3
    kind[0x30:0x3A] = 2
    kind[0x41:0x5B] = kind[0x61:0x7B] = 1
    kind[0x27] = 0
    return kind


_KIND = _ascii_kinds()


def may_cut(buf: np.ndarray) -> np.ndarray:
    """Where the split pattern of byte-level BPE vocabularies always begins a piece, whatever stands around.

    At ASCII white space right behind a visible ASCII character or a Latin-1 letter: no piece
    goes on from such a character into white space, and no look-ahead reaches over it.
    And between ASCII letters, digits and other signs, save at an apostrophe, which may begin an ending.
    """
    out = np.zeros(len(buf), bool)
    if len(buf) > 1:
        kind = _KIND[buf]
        visible = (kind > 0) | (buf == 0x27)
        visible[1:] |= (buf[1:] >= 0x80) & (buf[:-1] == 0xC3)
        blank = (buf == 32) | ((buf >= 9) & (buf <= 13))
        out[1:] = (blank[1:] & visible[:-1]) | ((kind[1:] != kind[:-1]) & (kind[1:] > 0) & (kind[:-1] > 0))
    return out


def units(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and rows of the units that texts can be encoded by, one after the other."""
    begins = np.append(may_cut(buf), False)
    begins[off] = True
    start = np.flatnonzero(begins[:len(buf)])
    return start, np.searchsorted(off, start, side="right") - 1


def sections(buf: np.ndarray, lo: int, hi: int, most: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """The text at ``lo`` to ``hi`` in parts of about ``most`` bytes, cut where :func:`may_cut` allows it."""
    while hi - lo > most:
        at, end = lo + most, None
        while end is None and at < hi:
            stop = min(hi, at + most)
            found = np.flatnonzero(may_cut(buf[at - 2:stop])[2:])
            end, at = (at + int(found[0]) if len(found) else None), stop
        if end is None:
            break
        yield lo, end
        lo = end
    yield lo, hi
