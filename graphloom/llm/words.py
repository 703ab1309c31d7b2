"""Vectorised word kernels over Arrow string columns.

A batch of texts is handled as one byte buffer: word borders come from a 256-entry class
table, and words are hashed eight bytes at a time, so no Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Bytes that are handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 21

U = np.uint64
_M1, _M2 = U(0xFF51AFD7ED558CCD), U(0xC4CEB9FE1A85EC53)
_BASE = 0x9E3779B97F4A7C15 | 1


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(33))
    x *= _M1
    x ^= x >> U(33)
    x *= _M2
    x ^= x >> U(33)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """n fixed odd 64-bit numbers."""
    return mix((np.arange(n, dtype=U) + U(1)) * U(_BASE) + U(seed * 0x632BE59BD9B4E019 & (1 << 64) - 1)) | U(1)


def class_table(separators: bytes) -> np.ndarray:
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


#: Words are runs of anything but space and tab to carriage return.
SPACED = class_table(b"\x20\x09\x0a\x0b\x0c\x0d")


_LOW = np.array([(1 << 8 * n) - 1 for n in range(9)], U)
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of each span's bytes, the same wherever it stands; with fold, A-Z count as a-z.

    A span is read as numbers of eight bytes. Each is mixed with its place before they are summed up, and
    the mixing isn't linear in any ring, so no pattern of repeats makes spans collide for every seed.
    """
    if not len(starts):
        return np.zeros(0, U)
    padded = np.concatenate([_FOLD[data] if fold else data, np.zeros(8, np.uint8)])
    eights = np.ndarray((len(padded) - 7,), "<u8", padded, 0, (1,))
    size = ends - starts
    n = np.maximum((size + 7) >> 3, 1)
    first = np.cumsum(n) - n
    keys = mix(np.arange(int(n.max()), dtype=U) * U(_BASE) + constants(1, seed)[0])
    if int(n.max()) == 1:
        return mix(mix((eights[starts] & _LOW[size]) ^ keys[0]) + size.astype(U))
    place = np.arange(int(n.sum())) - np.repeat(first, n)
    at = np.repeat(starts, n) + (place << 3)
    some = eights[at] & _LOW[np.minimum(np.repeat(ends, n) - at, 8)]
    return mix(np.add.reduceat(mix(some ^ keys[place]), first) + size.astype(U))


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets within the bytes) of runs of rows; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], np.int64, n + 1, column.offset * 8)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        yield at, end, data[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


class Words:
    """The words of a run of texts: start and end byte of each, and how many words precede each text.

    inside: which bytes belong to words. kinds, if given, has a number for each byte, and words are
    also cut between neighbours of kinds 1 and 2.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray, kinds: np.ndarray | None = None) -> None:
        self.data, self.offsets = data, offsets
        flags = np.zeros(len(data) + 1, bool)
        flags[:-1] = inside[data]
        before = np.zeros(len(data) + 1, bool)
        before[1:] = flags[:-1]
        cuts = offsets[:-1]
        cut_inside = before[cuts].copy()
        before[cuts] = False
        starts = flags & ~before
        before[cuts] = cut_inside
        ends = before & ~flags
        ends[cuts] |= cut_inside
        if kinds is not None and len(data):
            kind = kinds[data]
            cut = np.zeros(len(data) + 1, bool)
            cut[1:-1] = kind[1:] + kind[:-1] == 3
            cut[1:-1] &= (kind[1:] > 0) & (kind[:-1] > 0)
            starts |= cut
            ends |= cut
        self.starts = np.flatnonzero(starts)
        self.ends = np.flatnonzero(ends)
        self.first = np.searchsorted(self.starts, offsets)

    def __len__(self) -> int:
        return len(self.starts)

    def hashes(self, seed: int, fold: bool = False) -> np.ndarray:
        """A 64-bit hash of each word's bytes, the same wherever the word stands."""
        return span_hashes(self.data, self.starts, self.ends, seed, fold)

    def document(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.offsets) - 1), np.diff(self.first))


def runs(hashes: np.ndarray, k: int, seed: int) -> np.ndarray:
    """A hash of each k consecutive entries, across the borders of texts too."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, U)
    total = np.zeros(n, U)
    for i, c in enumerate(constants(k, seed)):
        total += hashes[i : i + n] * c
    return mix(total)
