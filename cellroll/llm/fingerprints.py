"""Counting 64-bit fingerprints over a corpus: which of them are frequent, as a bit set of fixed size.

Tasks sort the fingerprints of a block and send each one once with its count.  They travel packed: a row holds
the sorted fingerprints of one range.  The number of ranges grows with the input, so what a worker holds of a
range stays the same; a frequent fingerprint is at most one entry of each block.

The bit set has BITS bits whatever the input.  A fingerprint that reaches the least count always has its bit; on
inputs with very many frequent ones, others have it too.  It is a filter before an exact step, never a result.
So the first KEPT bits of a fingerprint are enough: those that share them are counted as one, and pass more easily.
They travel as steps from one to the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Words, mix, ramp
from .repeats import batch

BITS = 27  # 2**27 bits: 16 MB
KEPT = 40  # bits of a fingerprint that are counted
PARTS = 6  # sent to the driver in 2**6 parts
RANGE_BYTES = 8 << 20  # bytes of text for each range: about a million fingerprints


def n_ranges(docs: DataFrame, text_col: str = "text") -> int:
    """Ranges for the fingerprints of all words of these texts."""
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    return 1 + min(size // RANGE_BYTES, 2**31 - 2)


def counted(values: np.ndarray, weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values and the number (or the sum of weights) of each."""
    if weights is None:
        values = np.sort(values)
    else:
        order = np.argsort(values)
        values, weights = values[order], weights[order]
    at = np.flatnonzero(np.concatenate([np.ones(min(len(values), 1), bool), values[1:] != values[:-1]]))
    if weights is None:
        return values[at], np.diff(np.concatenate([at, [len(values)]]))
    return values[at], np.add.reduceat(weights, at) if len(at) else np.zeros(0, np.int64)


def packed(fps: np.ndarray, counts: np.ndarray, ranges: int) -> Iterator[pa.RecordBatch]:
    """(range, fps, counts) rows of sorted distinct fingerprints; each row has the first KEPT bits of its first one
    and the steps to the others."""
    fps, counts = fps >> np.uint64(64 - KEPT) << np.uint64(64 - KEPT), counts.astype(np.int64)
    at = np.flatnonzero(np.concatenate([np.ones(min(len(fps), 1), bool), fps[1:] != fps[:-1]]))
    fps, counts = fps[at], np.add.reduceat(counts, at) if len(at) else counts
    at_range = ((fps >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    at = np.flatnonzero(np.concatenate([np.ones(min(len(fps), 1), bool), at_range[1:] != at_range[:-1]]))
    if not len(at):
        return
    off = np.concatenate([at, [len(fps)]])
    step = np.diff(fps, prepend=np.uint64(0))
    step[at] = fps[at]
    yield batch(range=at_range[at].astype(np.int32), fps=planes(step >> np.uint64(64 - KEPT), off), counts=planes(counts.astype(np.uint32), off))


def planes(values: np.ndarray, off: np.ndarray) -> pa.Array:
    """values[off[i]:off[i + 1]] as binary: all first bytes of a row's numbers, then all second ones, ...; so close
    numbers compress."""
    size = values.dtype.itemsize
    raw = values.view(np.uint8).reshape(-1, size)
    data = np.concatenate([raw[a:b].T.ravel() for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)])
    return pa.Array.from_buffers(pa.binary(), len(off) - 1, [None, pa.py_buffer((off * size).astype(np.int32)), pa.py_buffer(data)])


def unpacked(value, kind) -> np.ndarray:
    """The numbers of a row of ``planes``, from its bytes."""
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(np.frombuffer(value, np.uint8).reshape(size, -1).T).view(kind).ravel()


PACKED = "range int, fps binary, counts binary"


def frequent(rows: DataFrame, least: int) -> np.ndarray:
    """The bit set of the fingerprints whose counts in all PACKED rows sum up to ``least`` at least."""

    def merge(fps, counts):
        values, total = counted(np.concatenate(fps), np.concatenate(counts))
        bits = np.unique(values[total >= least] >> np.uint64(64 - BITS)).astype(np.int64)
        part = bits >> (BITS - PARTS)
        for p in np.unique(part).tolist():
            yield batch(part=np.array([p], np.int32), bits=pa.array([(bits[part == p] & ((1 << BITS - PARTS) - 1)).astype(np.int32).tobytes()], pa.binary()))

    def ranges(batches):
        last, fps, counts = None, [], []
        for rb in batches:
            for r, f, c in zip(rb.column(0).to_pylist(), rb.column(1), rb.column(2), strict=True):
                if r != last and fps:
                    yield from merge(fps, counts)
                    fps, counts = [], []
                last = r
                fps.append(np.cumsum(unpacked(f.as_buffer(), np.uint64)) << np.uint64(64 - KEPT))
                counts.append(unpacked(c.as_buffer(), np.uint32).astype(np.int64))
        if fps:
            yield from merge(fps, counts)

    def union(frame):
        out = np.zeros(1 << BITS - PARTS, bool)
        for x in frame["bits"]:
            out[np.frombuffer(x, np.int32)] = True
        return frame.iloc[:1].assign(bits=[np.packbits(out).tobytes()])

    found = rows.repartition("range").sortWithinPartitions("range").mapInArrow(ranges, "part int, bits binary")
    out = np.zeros((1 << PARTS, 1 << BITS - PARTS - 3), np.uint8)
    for r in found.groupBy("part").applyInPandas(union, "part int, bits binary").collect():
        out[r["part"]] = np.frombuffer(r["bits"], np.uint8)
    return out.ravel()


def has(bits: np.ndarray, fps: np.ndarray) -> np.ndarray:
    at = (fps >> np.uint64(64 - BITS)).astype(np.int64)
    return (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1


def gathered(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes data[start[i]:start[i] + size[i]], one after another."""
    return data[np.repeat(start, size) + ramp(size)]


def word_numbers(data: np.ndarray, words: Words, hashes: np.ndarray) -> np.ndarray:
    """A number for each word, the same for equal words only: hashes decide, and the text decides on the hashes."""
    _, first, number = np.unique(hashes, return_index=True, return_inverse=True)
    size = words.end - words.start
    like = first[number]
    if (size == size[like]).all() and (gathered(data, words.start, size) == gathered(data, words.start[like], size)).all():
        return number
    raw = data.tobytes()
    seen: dict[bytes, int] = {}
    return np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(words.start.tolist(), words.end.tolist(), strict=True)], np.int64)


def joined(data: np.ndarray, words: Words, first: np.ndarray, n: int) -> pa.Array:
    """The texts of the n words from each word ``first`` on, with one space between words."""
    at = (first[:, None] + np.arange(n)).ravel()
    size = (words.end - words.start)[at]
    wide = size.reshape(-1, n) + (np.arange(n) < n - 1)
    index = np.repeat(words.start[at], wide.ravel()) + ramp(wide.ravel())
    ends = np.cumsum(wide.ravel())
    inner = np.flatnonzero(np.tile(np.arange(n) < n - 1, len(first)))
    index[ends[inner] - 1] = len(data)
    off = np.concatenate([[0], ends.reshape(-1, n)[:, -1]]).astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(first), [None, pa.py_buffer(off), pa.py_buffer(np.append(data, np.uint8(32))[index])])


def lines(data: np.ndarray, words: Words, first: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, ends): the texts of the n[i] words from word first[i] on, one space between words and a line end after each text."""
    at = np.repeat(first, n) + ramp(n)
    size = (words.end - words.start)[at] + 1
    ends = np.cumsum(size)
    index = np.repeat(words.start[at], size) + ramp(size)
    index[ends - 1] = len(data)
    last = np.cumsum(n) - 1
    index[ends[last] - 1] = len(data) + 1
    return np.concatenate([data, np.array([32, 10], np.uint8)])[index], ends[last]


def name_hashes(names: list[str]) -> np.ndarray:
    """64-bit hashes of a few names, the same in every process."""
    out = []
    for name in names:
        h = 0xCBF29CE484222325
        for b in name.encode():
            h = (h ^ b) * 0x100000001B3 % (1 << 64)
        out.append(h)
    return mix(np.array(out, np.uint64))
