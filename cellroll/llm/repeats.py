"""Repeated stretches of texts, found from shared anchors; the common part of two operators.

A text is a sequence of units (bytes or words).  A *window* is ``length`` units; it is *repeated* if its
units also stand elsewhere.  Anchors are winnowed positions: every window holds one within its first
``reach`` positions, at the same place in all its copies.  So two copies of a window are two anchors of one
*class* (equal units from the anchor on) that agree ``o`` units to the left and ``length - o`` to the right
for some o below ``reach``.

Anchors whose whole neighbourhood (*context*: all units that any window through them can hold) is equal need
no closer look: all their windows are repeated.  One anchor of each other context of a class is compared unit
by unit (``extents``).  Spans of documents, not texts, move between steps; texts are joined to them by id.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, Rolling, blocks, mix, ramp, winnow
from .tables import saved

CLASS_BYTES = 48 << 20  # contexts of a class that one task compares; larger classes are compared by shuffled windows
_STEP = 0xC2B2AE3D27D4EB4F  # base of the window hashes


def table(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Record batches without NULLs as numpy columns."""
    for b in batches:
        if b.num_rows:
            yield {n: c.to_numpy(zero_copy_only=False) for n, c in zip(b.schema.names, b.columns, strict=True)}


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x) for x in columns.values()], names=list(columns))


def changes(columns: list[np.ndarray], before: tuple | None) -> np.ndarray:
    """Where sorted rows begin a new group; ``before`` is the last row of the rows before, or None."""
    new = np.zeros(len(columns[0]), dtype=bool)
    for x in columns:
        new[1:] |= x[1:] != x[:-1]
    new[0] = before is None or any(x[0] != y for x, y in zip(columns, before, strict=True))
    return new


def shared_groups(rows: Iterator[dict[str, np.ndarray]], keys: list[str]) -> Iterator[dict[str, np.ndarray]]:
    """Rows (sorted by ``keys``) of groups that have at least two rows, with a group number ``rank``.

    One row is held back between batches, whatever the groups' sizes; the rows keep their order.
    """
    held, count, number = None, 0, 0
    for t in rows:
        if held is not None:
            t = {k: np.concatenate([held[k], t[k]]) for k in t}
        n = len(t[keys[0]])
        new = changes([t[k] for k in keys], None)
        # the first row continues the held row's group, which had ``count`` rows before it
        again = np.ones(n, dtype=bool)
        again[:-1] = ~new[1:]
        inside = ~new | again
        inside[0] |= count > 0
        rank = number + np.cumsum(new) - 1
        number = int(rank[-1])
        size = n - int(np.flatnonzero(new)[-1])
        count = size - 1 + (count if size == n else 0)
        last = slice(n - 1, n)
        held = {k: v[last] for k, v in t.items()}
        t = t | {"rank": rank}
        # the last row waits: a later batch may bring its group's next row
        inside[n - 1] = False
        if inside.any():
            yield {k: v[inside] for k, v in t.items()}
    if held is not None and count > 0:
        yield {**held, "rank": np.array([number])}


def first_of_contexts(rows: Iterator[dict[str, np.ndarray]], later_only: bool) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows (rank, c, d, p, left, right, more) to rows (kind, rank, d, p, left, right).

    kind 0: all windows of the row's context are repeated (with ``later_only``: also stand earlier).
    kind 1: one row of each context of a class that has several contexts, to be compared.
    """
    names = ["rank", "c", "d", "p", "left", "right", "more"]
    held: dict[str, np.ndarray] | None = None  # first row of the last context
    several = False  # the held row's class had a context before it
    for t in rows:
        t = {k: t[k] for k in names} if held is None else {k: np.concatenate([held[k], t[k]]) for k in names}
        new = changes([t["rank"], t["c"]], None)
        at = np.flatnonzero(new)
        rank = t["rank"][at]
        same = rank[1:] == rank[:-1]
        multi = np.zeros(len(at), dtype=bool)
        multi[1:] |= same
        multi[:-1] |= same
        multi[0] |= several
        whole = ~new
        if not later_only:  # a context's first row is repeated too, if it has another one
            size = np.diff(np.concatenate([at, [len(new)]]))
            whole[at] = (size > 1) | t["more"][at]
        whole[at[-1]] = False  # the last context's first row waits
        yield from _rows(0, t, np.flatnonzero(whole))
        yield from _rows(1, t, at[:-1][multi[:-1]])
        several = bool(len(at) > 1 and same[-1]) or (len(at) == 1 and several)
        k = at[-1]
        held = {x: t[x][k:k + 1].copy() for x in names}
        held["more"][0] |= len(new) - k > 1
        if later_only:
            held["more"][0] = False
    if held is not None:
        if not later_only and held["more"][0]:
            yield from _rows(0, held, np.array([0]))
        if several:
            yield from _rows(1, held, np.array([0]))


def _rows(kind: int, t: dict[str, np.ndarray], at: np.ndarray) -> Iterator[dict[str, np.ndarray]]:
    if len(at):
        yield dict(kind=np.full(len(at), kind, np.int32), rank=t["rank"][at].astype(np.int64), d=t["d"][at], p=t["p"][at], left=t["left"][at], right=t["right"][at])


def extents(values: np.ndarray, left: np.ndarray, right: np.ndarray, rank: np.ndarray, reach: int, length: int, later_only: bool, order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest o for which a row's window (o units left of its anchor on) is repeated in its class.

    values: one row of reach - 1 + length units per anchor, the anchor at reach - 1; left and right: units
    that are there on each side.  -1: none.  With ``later_only`` a window counts if it stands in a row of
    smaller ``order``.
    """
    n = len(left)
    low, high = np.full(n, -1, np.int32), np.full(n, -1, np.int32)
    lift = BYTE_VALUE.__getitem__ if values.dtype == np.uint8 else np.asarray
    # hash of the window at offset o, moved one unit to the left at a time
    base, top = np.uint64(_STEP), np.uint64(pow(_STEP, length - 1, 1 << 64))
    window = np.zeros(n, dtype=np.uint64)
    for i in range(reach - 1 + length - 1, reach - 2, -1):
        window = window * base + lift(values[:, i])
    own = mix(rank.astype(np.uint64) + np.uint64(1))
    for o in range(reach):
        if o:
            at = reach - 1 - o
            window = (window - lift(values[:, at + length]) * top) * base + lift(values[:, at])
        rows = np.flatnonzero((left >= o) & (right >= length - o))
        if len(rows) < 2:
            continue
        key = mix(window[rows]) ^ own[rows]
        s = np.lexsort((order[rows], key)) if later_only else np.argsort(key, kind="stable")
        same = key[s][1:] == key[s][:-1]
        hit = np.zeros(len(rows), dtype=bool)
        hit[s[1:]] = same
        if not later_only:
            hit[s[:-1]] |= same
        at = rows[hit]
        low[at] = np.where(low[at] < 0, o, low[at])
        high[at] = o
    return low, high


def whole_classes(batches, names: list[str], most: int = 8_000) -> Iterator[dict[str, np.ndarray]]:
    """Rows sorted by ``rank`` in runs of whole classes, about ``most`` rows at a time."""
    held: list[dict[str, np.ndarray]] = []
    for t in table(batches):
        held.append(t)
        if sum(len(x["rank"]) for x in held) < most:
            continue
        t = {k: np.concatenate([x[k] for x in held]) for k in names}
        cut = int(np.flatnonzero(t["rank"] != t["rank"][-1])[-1]) + 1 if (t["rank"] != t["rank"][-1]).any() else 0
        if cut:
            yield {k: v[:cut] for k, v in t.items()}
        held = [{k: v[cut:] for k, v in t.items()}]
    if held:
        yield {k: np.concatenate([x[k] for x in held]) for k in names}


def union(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Marks the units of a text of n units that lie in any of the spans."""
    edge = np.zeros(n + 1, dtype=np.int32)
    np.add.at(edge, np.minimum(start, n), 1)
    np.add.at(edge, np.minimum(end, n), -1)
    return np.cumsum(edge)[:n] > 0


def collapsed(key: np.ndarray, c: np.ndarray, d: np.ndarray, p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Within one batch: first row of each (key, context) by (d, p), whether it has others, and the others."""
    order = np.lexsort((p, d, c, key))
    new = changes([key[order], c[order]], None) if len(order) else np.zeros(0, bool)
    at = np.flatnonzero(new)
    size = np.diff(np.concatenate([at, [len(order)]]))
    return order[at], size > 1, order[~new]


class Repeats:
    """Repeated stretches of documents (d, text) for one kind of unit.

    ``block`` turns (data, offsets) of a block of texts into (values, bounds): 64-bit units and each text's
    bounds.  An anchor's first ``keys[-1]`` units make its class, compared at growing lengths ``keys``.
    """

    def __init__(self, block: Callable, *, gram: int, length: int, keys: tuple[int, ...], later_only: bool):
        self.block, self.gram, self.length, self.keys, self.later_only = block, gram, length, keys, later_only
        self.reach = length - keys[-1] + 1  # anchors within the first ``reach`` positions of a window
        if gram > keys[0] or length - gram + 1 < self.reach:
            raise ValueError("anchors are grams of at most the first key's length")

    def anchors(self, decided: bool) -> Callable:
        """Anchor rows of batches; with ``decided`` the spans (d, a, b) that a batch alone shows to be repeated."""

        def run(batches):
            for rb in batches:
                for first, end, data, off in blocks(rb.column("text")):
                    values, bounds = self.block(data, off)
                    d = rb.column("d").slice(first, end - first).to_numpy(zero_copy_only=False)
                    yield from self._anchors(values, bounds, d, decided)

        return run

    def _anchors(self, values, bounds, d, decided):
        roll = Rolling(values)
        grams = roll.every(self.gram)
        size = np.diff(bounds)
        at = winnow(grams, bounds[:-1], np.maximum(0, size - self.gram + 1), self.reach)
        row = np.searchsorted(bounds, at, side="right") - 1
        low, high = np.maximum(bounds[row], at - self.reach + 1), np.minimum(bounds[row + 1], at + self.length)
        ok = (high - low >= self.length) & (bounds[row + 1] - at >= self.keys[-1])
        at, row, low, high = at[ok], row[ok], low[ok], high[ok]
        if not len(at):
            return
        steps = [roll.of(at + a, at + b) for a, b in zip((0, *self.keys), self.keys, strict=False)]
        c = roll.of(low, high) ^ mix((at - low).astype(np.uint64))
        p, d = (at - bounds[row]).astype(np.int32), d[row]
        keep, more, others = collapsed(steps[0], c, d, p)
        if decided:
            if not self.later_only:
                others = np.concatenate([others, keep[more]])
            a = p[others] - (at - low)[others]
            # spans of neighbouring anchors of one document run together
            yield batch(d=d[others], a=a.astype(np.int32), b=(p[others] + (high - at)[others]).astype(np.int32))
            return
        columns = {f"k{i}": k[keep].astype(np.int64) for i, k in enumerate(steps)}
        yield batch(**columns, c=c[keep].astype(np.int64), d=d[keep], p=p[keep], left=(at - low)[keep].astype(np.int32), right=(high - at)[keep].astype(np.int32), more=more)

    def classes(self, docs: DataFrame) -> DataFrame:
        """Anchors that share all keys with another one: sort by rank pairs at growing offsets, drop unique ones, rerank."""
        keys = [f"k{i}" for i in range(len(self.keys))]
        rest = "c long, d long, p int, left int, right int, more boolean"
        later_only = self.later_only

        def rerank(batches):
            # rows come sorted by all keys; each round's survivors stay sorted for the next one.  Ranks of one
            # partition never meet those of another: equal first keys share a partition
            base = TaskContext.get().partitionId() << 40
            rows, by = table(batches), ["k0"]
            for k in [*keys[1:], None]:
                rows, by = shared_groups(rows, by), ["rank", k]
            for t in first_of_contexts(rows, later_only):
                t["rank"] = t["rank"] + base
                yield batch(**t)

        rows = docs.mapInArrow(self.anchors(False), ", ".join(f"{k} long" for k in keys) + ", " + rest)
        rows = rows.repartition("k0").sortWithinPartitions(*keys, "c", "d", "p")
        return rows.mapInArrow(rerank, "kind int, rank long, d long, p int, left int, right int")

    def contexts(self, decide: bool) -> Callable:
        """Texts with lists of anchors to (rank, d, p, left, right, units), or to (rank, o, g, d, p) windows."""

        def run(batches):
            for rb in batches:
                for first, end, data, off in blocks(rb.column("text")):
                    part = rb.slice(first, end - first)
                    values, bounds = self.block(data, off)
                    items = part.column("items")
                    count = np.diff(items.offsets.to_numpy())
                    flat = {n: c.to_numpy(zero_copy_only=False) for n, c in zip(("rank", "p", "left", "right"), items.flatten().flatten(), strict=True)}
                    d = np.repeat(part.column("d").to_numpy(zero_copy_only=False), count)
                    at = flat["p"] + np.repeat(bounds[:-1], count)
                    if decide:
                        yield from self._windows(values, at, d, flat)
                        continue
                    for s in range(0, len(at), 4096):
                        cut = slice(s, s + 4096)
                        low = at[cut] - flat["left"][cut]
                        size = flat["left"][cut] + flat["right"][cut]
                        own = values[np.repeat(low, size) + ramp(size)]
                        own = own.astype(np.uint8) if self.bytes else own
                        ends = np.concatenate([[0], np.cumsum(size)]) * own.itemsize
                        units = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(size), [None, pa.py_buffer(ends.astype(np.int64).tobytes()), pa.py_buffer(own.tobytes())]).cast(pa.binary())
                        yield batch(rank=flat["rank"][cut], d=d[cut], p=flat["p"][cut], left=flat["left"][cut], right=flat["right"][cut], units=units)

        return run

    bytes = False

    def _windows(self, values, at, d, flat):
        roll = Rolling(self.lift(values))
        for o in range(self.reach):
            ok = np.flatnonzero((flat["left"] >= o) & (flat["right"] >= self.length - o))
            if len(ok):
                g = roll.of(at[ok] - o, at[ok] - o + self.length)
                yield batch(rank=flat["rank"][ok], o=np.full(len(ok), o, np.int32), g=g.astype(np.int64), d=d[ok], p=flat["p"][ok])

    def lift(self, values: np.ndarray) -> np.ndarray:
        return BYTE_VALUE[values] if self.bytes else values

    def compare(self, batches):
        """Contexts sorted by class to (d, a, b): what the windows that are repeated in their class cover."""
        reach, length = self.reach, self.length
        for t in whole_classes(batches, ["rank", "d", "p", "left", "right", "units"]):
            starts = np.flatnonzero(changes([t["rank"]], None))
            # a few thousand rows at a time, whole classes
            group = np.cumsum(changes([t["rank"]], None)) - 1
            cuts = [0]
            for s in [*starts[1:], len(group)]:
                if s - cuts[-1] >= 3000 or s == len(group):
                    cuts.append(int(s))
            for x, y in zip(cuts, cuts[1:], strict=False):
                n = y - x
                if n < 2:
                    continue
                left, right = t["left"][x:y].astype(np.int64), t["right"][x:y].astype(np.int64)
                raw = np.frombuffer(b"".join(t["units"][x:y]), dtype=np.uint8 if self.bytes else np.uint64)
                values = np.zeros((n, reach - 1 + length), dtype=raw.dtype)
                size = left + right
                values[np.repeat(np.arange(n), size), np.repeat(reach - 1 - left, size) + ramp(size)] = raw
                order = np.arange(n)  # rows are sorted by (d, p) within a class
                low, high = extents(values, left, right, t["rank"][x:y], reach, length, self.later_only, order)
                hit = np.flatnonzero(low >= 0)
                if len(hit):
                    p = t["p"][x:y][hit]
                    yield batch(d=t["d"][x:y][hit], a=(p - high[hit]).astype(np.int32), b=(p - low[hit] + length).astype(np.int32))

    def spans(self, docs: DataFrame, what: str) -> DataFrame:
        """(d, spans) of the documents (d, text) that have any repeated window."""
        docs = docs.select("d", "text")
        found = saved(self.classes(docs), what)
        items = found.where("kind = 1")
        most = CLASS_BYTES // ((self.reach - 1 + self.length) * (1 if self.bytes else 8))
        big = items.groupBy("rank").count().where(F.col("count") > most).select("rank")
        schema = "rank long, d long, p int, left int, right int, units binary"
        large = big.limit(1).count() > 0
        few = items.join(big, "rank", "left_anti") if large else items
        compared = self._listed(few, docs).mapInArrow(self.contexts(False), schema)
        compared = compared.repartition("rank").sortWithinPartitions("rank", "d", "p").mapInArrow(self.compare, "d long, a int, b int")
        parts = [docs.mapInArrow(self.anchors(True), "d long, a int, b int"), found.where("kind = 0").selectExpr("d", "p - left as a", "p + right as b"), compared]
        if large:
            parts.append(self._large(items.join(big, "rank", "left_semi"), docs))
        rows = parts[0]
        for x in parts[1:]:
            rows = rows.unionByName(x)
        return rows.groupBy("d").agg(F.collect_list(F.struct("a", "b")).alias("spans"))

    def _listed(self, items: DataFrame, docs: DataFrame) -> DataFrame:
        lists = items.groupBy("d").agg(F.collect_list(F.struct("rank", "p", "left", "right")).alias("items"))
        return docs.join(lists, "d")

    def _large(self, items: DataFrame, docs: DataFrame) -> DataFrame:
        """For classes of very many contexts: every window is counted by a shuffle of (class, place, hash)."""
        windows = saved(self._listed(items, docs).mapInArrow(self.contexts(True), "rank long, o int, g long, d long, p int"), "windows")
        first = windows.groupBy("rank", "o", "g").agg(F.count("*").alias("n"), F.min(F.struct("d", "p")).alias("first")).where("n > 1")
        hit = windows.join(first, ["rank", "o", "g"])
        if self.later_only:
            hit = hit.where("d != first.d or p != first.p")
        length = self.length
        return hit.groupBy("d", "p").agg(F.min("o").alias("low"), F.max("o").alias("high")).select("d", (F.col("p") - F.col("high")).alias("a"), (F.col("p") - F.col("low") + length).alias("b"))
