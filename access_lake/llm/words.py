"""Vectorised words and word-window fingerprints over a batch of texts.

A batch is one byte buffer (UTF-8 texts end to end) plus offsets. Words are
maximal runs of bytes other than the six separators 0x20 and 0x09-0x0D;
those never occur inside a multi-byte UTF-8 character, so byte runs and
character runs agree. All work is numpy over the whole batch.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
BASE_INV = pow(BASE, -1, 1 << 64)
SEGMENT = 1 << 20

SEPARATORS = np.zeros(256, dtype=bool)
SEPARATORS[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SCAN_BYTES = 4 << 20  #: bytes whose positions are expanded at once


def mix(x: np.ndarray) -> np.ndarray:
    """Final avalanche of a 64-bit fingerprint (splitmix64)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def text_buffer(column) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string or binary column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(buf: np.ndarray, offsets: np.ndarray, separators: np.ndarray = SEPARATORS):
    """Word starts and ends (byte positions) and the words per text."""
    n = len(buf)
    if n == 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets) - 1, np.int64)
    solid = ~separators[buf]
    first = solid.copy()
    first[1:] &= ~solid[:-1]
    at = offsets[:-1]
    at = at[at < n]
    first[at] = solid[at]
    last = solid.copy()
    last[:-1] &= ~solid[1:]
    at = offsets[1:] - 1
    at = at[at >= 0]
    last[at] = solid[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    counts = np.diff(np.searchsorted(starts, offsets))
    return starts, ends, counts


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, U)
    if n:
        out[0] = 1
    return np.multiply.accumulate(out, dtype=U) if n else out


class SpanHash:
    """64-bit fingerprints of byte spans, by prefix sums of a polynomial."""

    def __init__(self) -> None:
        self.up, self.down = powers(BASE, SEGMENT), powers(BASE_INV, SEGMENT)

    def __call__(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprints of the spans [start, end), in order and disjoint."""
        out = np.zeros(len(starts), U)
        k = 0
        while k < len(starts):
            lo = starts[k]
            j = int(np.searchsorted(ends, lo + SEGMENT, "right"))
            if j <= k:  # one span longer than a segment
                out[k] = self._long(buf[lo:ends[k]])
                k += 1
                continue
            hi = ends[j - 1]
            piece = (buf[lo:hi].astype(U) + U(1)) * self.up[:hi - lo]
            total = np.zeros(len(piece) + 1, U)
            np.cumsum(piece, out=total[1:])
            s, e = starts[k:j] - lo, ends[k:j] - lo
            out[k:j] = mix((total[e] - total[s]) * self.down[np.minimum(s, SEGMENT - 1)] + (e - s).astype(U) * U(0xD6E8FEB86659FD93))
            k = j
        return out

    def _long(self, span: np.ndarray) -> int:
        total, scale = 0, 1
        for i in range(0, len(span), SEGMENT):
            part = span[i:i + SEGMENT].astype(U) + U(1)
            total += scale * int((part * self.up[:len(part)]).sum(dtype=U))
            scale = scale * pow(BASE, SEGMENT, 1 << 64) % (1 << 64)
        total = (total + len(span) * 0xD6E8FEB86659FD93) % (1 << 64)
        return mix(np.array([total], U))[0]


def window_hash(h: np.ndarray, width: int) -> np.ndarray:
    """Fingerprint of each run of ``width`` consecutive values of ``h``.

    Built by doubling: H[a+b](i) = H[a](i) * BASE**b + H[b](i + a).
    """
    n = len(h) - width + 1
    if n <= 0:
        return np.zeros(0, U)
    cur, size, acc, done, bits = h, 1, None, 0, width
    while bits:
        if bits & 1:
            if acc is None:
                acc, done = cur, size
            else:
                m = len(h) - done - size + 1
                acc = acc[:m] * U(pow(BASE, size, 1 << 64)) + cur[done:done + m]
                done += size
        bits >>= 1
        if bits:
            m = len(cur) - size
            cur = cur[:m] * U(pow(BASE, size, 1 << 64)) + cur[size:]
            size *= 2
    return mix(acc[:n])


def word_ends(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First word of each text, and for each word the end of its text."""
    edge = np.concatenate([[0], np.cumsum(counts)])
    return edge, np.repeat(edge[1:], counts)


def slices(sizes: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Runs of rows whose sizes add up to ``most`` at most (one row may exceed)."""
    out, lo, total = [], 0, 0
    for i, s in enumerate(sizes.tolist()):
        if total + s > most and i > lo:
            out.append((lo, i))
            lo, total = i, 0
        total += s
    if lo < len(sizes):
        out.append((lo, len(sizes)))
    return out


def hashed_words(texts, lower: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Word fingerprints of a column of texts, and words per text; with
    ``lower``, of the texts with A-Z lower-cased."""
    buf, offsets = text_buffer(texts)
    span_hash, hashes, counts = SpanHash(), [], []
    for lo, hi in slices(np.diff(offsets), SCAN_BYTES):
        part, at = buf[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo]
        part = LOWER[part] if lower else part
        starts, ends, n = spans(part, at)
        hashes.append(span_hash(part, starts, ends))
        counts.append(n)
    none = np.zeros(0, np.int64)
    return np.concatenate([np.zeros(0, U), *hashes]), np.concatenate([none, *counts]).astype(np.int64)
