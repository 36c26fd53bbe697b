"""Vectorised text kernels over Arrow string buffers.

All kernels work on the UTF-8 bytes of many documents at once, so a Python
worker pays numpy's per-call cost once per chunk instead of once per word.
Null texts count as empty.  Chunks are bounded in bytes; a single longer text
forms its own chunk, whose bytes are hashed in blocks of ``CHUNK_BYTES``, so a
worker holds arrays of its words but none of 64-bit numbers a byte.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20
U64 = np.uint64
_PRIME = 0x9E3779B97F4A7C15 | 1
_PRIME_INV = pow(_PRIME, -1, 1 << 64)

#: Word separators: space and 0x09-0x0D.
SEPARATOR = np.zeros(256, bool)
SEPARATOR[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Lower-cased, digits folded to one value.
FOLDED = LOWER.copy()
FOLDED[48:58] = 48
_CODE = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Powers:
    """Cached powers of the hash base and its inverse modulo 2**64."""

    up = np.ones(1, np.uint64)
    down = np.ones(1, np.uint64)

    @classmethod
    def get(cls, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(cls.up) < n:
            size = max(n, 2 * len(cls.up), CHUNK_BYTES + 4096)
            for name, base in (("up", _PRIME), ("down", _PRIME_INV)):
                p = np.full(size, U64(base))
                p[0] = 1
                setattr(cls, name, np.multiply.accumulate(p))
        return cls.up[:n], cls.down[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (n + 1) of a string or binary array; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    n = len(column)
    _, off, data = column.buffers()
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offs = np.frombuffer(off, np.int64 if wide else np.int32, n + 1, column.offset * (8 if wide else 4)).astype(np.int64)
    base, end = int(offs[0]), int(offs[-1])
    raw = np.frombuffer(data, np.uint8, end - base, base) if data is not None and end > base else np.zeros(0, np.uint8)
    return raw, offs - base


def chunks(column: pa.Array, most: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of whole texts of at most ``most`` bytes each."""
    raw, offs = buffers(column)
    n, i = len(offs) - 1, 0
    while i < n:
        j = int(np.searchsorted(offs, offs[i] + most, "right")) - 1
        j = min(n, max(j, i + 1))
        yield i, j, raw[offs[i] : offs[j]], offs[i : j + 1] - offs[i]
        i = j


class Words:
    """Word spans ``[start, end)`` of a chunk, with the row of each and the words before each row."""

    def __init__(self, raw: np.ndarray, offs: np.ndarray):
        n = len(raw)
        self.raw, self.offs = raw, offs
        inside = ~SEPARATOR[raw]
        first, last = np.empty(n, bool), np.empty(n, bool)
        if n:
            first[0], last[-1] = inside[0], inside[-1]
            first[1:] = inside[1:] & ~inside[:-1]
            last[:-1] = inside[:-1] & ~inside[1:]
            edge = offs[1:-1]
            edge = edge[(edge > 0) & (edge < n)]
            first[edge] = inside[edge]
            last[edge - 1] = inside[edge - 1]
        self.inside = inside
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        self.before = np.searchsorted(self.start, offs)
        self.count = np.diff(self.before)
        self.row = np.repeat(np.arange(len(offs) - 1), self.count)

    def hashes(self, table: np.ndarray | None = None) -> np.ndarray:
        return span_hashes(self.raw if table is None else table[self.raw], self.start, self.end)


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    up, _ = Powers.get(len(raw) + 1)
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_CODE[raw] * up[: len(raw)], out=out[1:])
    return out


def _long_sum(raw: np.ndarray) -> np.uint64:
    """The unmixed hash sum of one byte string of any length, block by block."""
    total = 0
    for at in range(0, len(raw), CHUNK_BYTES):
        total += int(prefix_hash(raw[at : at + CHUNK_BYTES])[-1]) * pow(_PRIME, at, 1 << 64)
    return U64(total % (1 << 64))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, prefix: np.ndarray | None = None) -> np.ndarray:
    """64-bit hashes of the byte strings ``raw[start:end]``; a string's length enters its hash.

    Without ``prefix`` the strings come in order and do not overlap.
    """
    size = (end - start).astype(np.uint64) * U64(0xD6E8FEB86659FD93)
    if prefix is None and len(raw) > 2 * CHUNK_BYTES:
        sums, i = np.empty(len(start), np.uint64), 0
        while i < len(start):
            j = int(np.searchsorted(end, start[i] + CHUNK_BYTES, "right"))
            if j <= i:
                sums[i], j = _long_sum(raw[start[i] : end[i]]), i + 1
            else:
                at = start[i]
                own = prefix_hash(raw[at : end[j - 1]])
                _, down = Powers.get(len(own))
                sums[i:j] = (own[end[i:j] - at] - own[start[i:j] - at]) * down[start[i:j] - at]
            i = j
        return mix(sums + size)
    prefix = prefix_hash(raw) if prefix is None else prefix
    _, down = Powers.get(len(raw) + 1)
    return mix((prefix[end] - prefix[start]) * down[start] + size)


def sequence_hashes(items: np.ndarray, width: int) -> np.ndarray:
    """Hashes of each run of ``width`` successive item hashes."""
    n = len(items) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for k in range(width):
        out = mix(out + items[k : k + n] + U64((k + 1) * 0xA24BAED4963EE407 % (1 << 64)))
    return out


def windows_in_rows(before: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts of item windows that stay in their row, the row of each, and windows before each row."""
    count = np.maximum(0, np.diff(before) - (width - 1))
    total = np.concatenate([[0], np.cumsum(count)])
    rows = np.repeat(np.arange(len(count)), count)
    return np.arange(total[-1]) - total[rows] + before[:-1][rows], rows, total


def row_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    out = np.zeros(len(bounds) - 1, np.int64)
    full = np.flatnonzero(np.diff(bounds))
    if len(full):
        out[full] = np.add.reduceat(values[: bounds[-1]], bounds[:-1][full], dtype=np.int64)
    return out


def counts_in_rows(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """How often each key occurs in its own row."""
    if not len(keys):
        return np.zeros(0, np.int64)
    own = mix(keys + rows.astype(np.uint64) * U64(0x9FB21C651E98DF25))
    order = np.argsort(own)
    s = own[order]
    new = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    sizes = np.diff(np.concatenate([new, [len(s)]]))
    out = np.empty(len(s), np.int64)
    out[order] = np.repeat(sizes, sizes)
    return out


def first_in_rows(rows: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Whether each item is the first with its key in its row."""
    if not len(keys):
        return np.zeros(0, bool)
    own = mix(keys + rows.astype(np.uint64) * U64(0x9FB21C651E98DF25))
    order = np.argsort(own, kind="stable")
    s = own[order]
    out = np.zeros(len(s), bool)
    out[order[np.concatenate([[True], s[1:] != s[:-1]])]] = True
    return out


def shingle_sets(raw: np.ndarray, offs: np.ndarray, width: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed word shingles of each text, sorted in each row, and their bounds by row.

    Letters A-Z are lower-cased.  A text of fewer words than ``width`` has its
    whole word sequence as its one shingle; one without words has none.
    """
    words = Words(raw, offs)
    h = words.hashes(LOWER)
    at, rows, _ = windows_in_rows(words.before, width)
    full = sequence_hashes(h, width)
    keys = full[at] if len(at) else np.zeros(0, np.uint64)
    short = np.flatnonzero((words.count > 0) & (words.count < width))
    if len(short):
        own = []
        for r in short:
            own.append(sequence_hashes(h[words.before[r] : words.before[r + 1]], int(words.count[r]))[0])
        keys, rows = np.concatenate([keys, np.array(own, np.uint64)]), np.concatenate([rows, short])
    order = np.lexsort((keys, rows))
    keys, rows = keys[order], rows[order]
    if len(keys):
        new = np.concatenate([[True], (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])])
        keys, rows = keys[new], rows[new]
    return keys, np.searchsorted(rows, np.arange(len(offs)))
