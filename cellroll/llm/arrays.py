"""Arrow text columns as numpy arrays: byte buffers, words, hashes.

All helpers work on a *block*: several whole texts laid end to end in one
byte buffer.  ``blocks`` cuts an Arrow batch into blocks of bounded size (a
single longer text is a block of its own), so memory per task stays bounded.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

BLOCK_BYTES = 512 << 10  # hashing a block takes some 100 times its bytes in a worker
GROUP_BYTES = 8 << 20
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0xD6E8FEB86659FD93  # odd: it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
# A random 64-bit value per byte, the same in every process.
BYTE_VALUE = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWERS: dict[int, np.ndarray] = {}
_HELD: dict[object, tuple[int | None, object]] = {}  # what `held` made, and the stage that last took it


def _trim():
    """glibc's malloc_trim, or nothing where there is none."""
    try:
        return ctypes.CDLL("libc.so.6").malloc_trim
    except (OSError, AttributeError):
        return lambda _: 0


_malloc_trim = _trim()


def _stage() -> int | None:
    task = TaskContext.get()
    return task.stageId() if task else None


def held(key: object, make: Callable[[], object]) -> object:
    """What a worker keeps for all tasks of a stage: made by its first task, dropped when the worker serves another stage."""
    _HELD[key] = _stage(), _HELD[key][1] if key in _HELD else make()
    return _HELD[key][1]


def free_memory() -> None:
    """Give freed memory back to the system: Python workers go from one stage to the next and would keep it, as they
    would what earlier stages held."""
    if _HELD:
        now = _stage()
        for key in [k for k, (stage, _) in _HELD.items() if stage != now]:
            del _HELD[key]
    pa.default_memory_pool().release_unused()
    _malloc_trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer, so that close inputs give unrelated outputs."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())  # a block's hashes start before its last byte: as many as its bytes, and one
        have = np.full(size, base, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 4 * BLOCK_BYTES:
            _POWERS[base] = have
    return have[:n]


def blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) for runs of rows of about ``limit`` bytes; NULL text is empty."""
    free_memory()
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("" if not pa.types.is_binary(column.type) else b"")
    column = column.cast(pa.large_binary())
    n = len(column)
    if not n:
        return
    _, off, data = column.buffers()
    off = np.frombuffer(off, dtype=np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    a = 0
    while a < n:
        b = int(np.searchsorted(off, off[a] + limit, side="right")) - 1
        b = min(n, max(b, a + 1))
        yield a, b, data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


class Rolling:
    """Hash of any substring of a sequence of 64-bit values, from prefix sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.empty(n + 1, dtype=np.uint64)
        self.sums[0] = 0
        np.cumsum(values * _powers(_BASE, n), out=self.sums[1:])
        self.inv = _powers(_INV, n + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mix((self.sums[end] - self.sums[start]) * self.inv[start])

    def every(self, length: int) -> np.ndarray:
        """Hashes of all substrings of ``length`` values, by start."""
        n = len(self.sums) - length
        if n <= 0:
            return np.zeros(0, np.uint64)
        return mix((self.sums[length:] - self.sums[:n]) * self.inv[:n])


def is_space(data: np.ndarray) -> np.ndarray:
    """ASCII white space: 0x20 and 0x09 to 0x0D."""
    return (data == 32) | ((data >= 9) & (data <= 13))


def ascii_lower(data: np.ndarray) -> np.ndarray:
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


class Words:
    """Words of a block of texts: runs of other bytes than ASCII white space, or of the bytes marked ``inside``."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, inside: np.ndarray | None = None):
        if inside is None:
            inside = ~is_space(data)
        first = inside.copy()
        first[1:] &= ~inside[:-1]
        cuts = offsets[:-1][offsets[:-1] < len(data)]
        first[cuts] = inside[cuts]
        last = inside.copy()
        last[:-1] &= ~inside[1:]
        ends = offsets[1:][offsets[1:] > 0] - 1
        last[ends] = inside[ends]
        self.start = np.flatnonzero(first)
        self.end = np.flatnonzero(last) + 1
        # words of text i: rows[i] to rows[i + 1]
        self.rows = np.searchsorted(self.start, offsets)

    def hashes(self, data: np.ndarray) -> np.ndarray:
        return Rolling(BYTE_VALUE[data]).of(self.start, self.end)


def row_of(bounds: np.ndarray) -> np.ndarray:
    """The row of each element, for rows that hold bounds[i]:bounds[i + 1]."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def distinct_by_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row; (values, bounds)."""
    order = np.lexsort((values, rows))
    v, r = values[order], rows[order]
    keep = np.ones(len(v), dtype=bool)
    keep[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[keep], r[keep]
    return v, np.searchsorted(r, np.arange(n_rows + 1))


def shingles(word_hash: np.ndarray, rows: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-word shingle hashes and their rows; a text of 1 to n-1 words is one shingle."""
    roll = Rolling(word_hash)
    every = roll.every(n)
    row = row_of(rows)
    ok = row[: len(every)] == row[n - 1:] if len(every) else np.zeros(0, bool)
    count = np.diff(rows)
    short = np.flatnonzero((count > 0) & (count < n))
    whole = roll.of(rows[short], rows[short + 1])
    return np.concatenate([every[ok], whole]), np.concatenate([row[: len(every)][ok], short])


def _windowed(values: np.ndarray, w: int, op: np.ufunc, fill: int) -> np.ndarray:
    """``op`` (minimum or maximum) over every w consecutive values, in linear time."""
    n = len(values)
    full = np.concatenate([values, np.full(-n % w, fill, values.dtype)]).reshape(-1, w)
    left = op.accumulate(full, axis=1).ravel()
    right = op.accumulate(full[:, ::-1], axis=1)[:, ::-1].ravel()
    return op(right[: n - w + 1], left[w - 1: n])


def winnow(hashes: np.ndarray, start: np.ndarray, size: np.ndarray, w: int) -> np.ndarray:
    """Positions that hold the smallest of some w consecutive hashes of one row.

    Row i's hashes are hashes[start[i]:start[i] + size[i]].  Equal smallest hashes are all kept, so two
    equal stretches of at least w hashes always share a position.  Rows of fewer than w hashes give nothing.
    """
    n = len(hashes)
    if n < w:
        return np.zeros(0, np.int64)
    low = _windowed(hashes, w, np.minimum, 2**64 - 1)
    good = size >= w
    edge = np.zeros(n + 2, dtype=np.int32)
    np.add.at(edge, start[good], 1)
    np.add.at(edge, start[good] + size[good] - w + 1, -1)
    low[np.cumsum(edge)[: len(low)] <= 0] = 0
    pad = np.zeros(w - 1, np.uint64)
    return np.flatnonzero(hashes == _windowed(np.concatenate([pad, low, pad]), w, np.maximum, 0))


class WordIndex(dict):
    """Numbers distinct words in the order they come; forgets all when ``keep`` words are known.

    ``rows(words)`` gives their numbers; ``fresh()`` the words that came since the last call of it.
    """

    def __init__(self, keep: int):
        super().__init__()
        self.keep, self.known = keep, 0

    def __missing__(self, word):
        self[word] = at = len(self)
        return at

    def rows(self, words: list) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), dtype=np.int64, count=len(words))

    def full(self) -> bool:
        """Call before each group of words; if true, everything kept by word number is to be dropped."""
        if len(self) <= self.keep:
            return False
        self.clear()
        self.known = 0
        return True

    def fresh(self) -> list:
        new = list(islice(reversed(self), len(self) - self.known))[::-1]
        self.known = len(self)
        return new


def ramp(size: np.ndarray) -> np.ndarray:
    """0..size[0]-1, 0..size[1]-1, ..."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - size, size)


def text_groups(batches, text_col: str = "text", limit: int = GROUP_BYTES):
    """(record batch slice, list of UTF-8 texts) of about ``limit`` bytes each; NULL text is empty."""
    for batch in batches:
        column = batch.column(text_col)
        for a, b, _, _ in blocks(column, limit):
            part = batch.slice(a, b - a)
            yield part, [x or b"" for x in part.column(text_col).cast(pa.binary()).to_pylist()]
