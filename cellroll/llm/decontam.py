"""Benchmark passages in documents, up to edits.

Words are compared: runs of letters and digits in lower case.  An item is found in a document where the
item's words turn into a run of the document's words with at most (1 - similarity) of the item's length in
word edits (insert, delete, replace).

Method: the CGK random walk embeds a word sequence so that few edits become few differing places: at each
step it writes the word it stands on, and a random bit of that word decides whether it moves on.  All
windows of the documents, one from every word, are embedded with several walks; so are the item's windows,
one from every ``STRIDE``-th word up to its end.  Sampled places of an embedding are a hash key (bit
sampling), and windows that share any of the repeated keys are candidates.  Candidates are then verified by
the exact edit distance of the whole item against the document's words around the window, so clean documents
are left alone.

Embeddings of one window for items of different sizes differ only past the item's end, so a document's window
is embedded once, over the same STEPS steps for all items.  Items of under SHORT words would leave too little
to sample.  Such an item is cut into one piece more than its allowed edits: as an edit spoils one piece at
most, one piece at least stands unchanged, and its hash makes the candidate.  So items of under SHORT words are
always found, and so are exact copies of any item.  With the defaults, items of 15 to 60 words with a tenth of
their words edited are found with recall above 0.9 (tests measure it).

NULL and empty texts hold nothing; items without words match nothing; repeated rows of one id count once.
Items are taken ITEMS_AT_ONCE at a time, so what is sent to the tasks is bounded at any number of items.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, Rolling, Words, blocks, mix, row_of
from .tables import id_text, importable

SIMILARITY = 0.8
STEPS, WALKS, KEYS, PLACES = 20, 4, 3, 5  # steps of a walk; walks; keys for each walk; sampled places of a key
STRIDE, SHORT = 2, 15
CANDIDATES_AT_ONCE = 500_000  # of pieces, before they are verified
ITEMS_AT_ONCE = 20_000
BLOCK = 2 << 20  # bytes of text that are embedded at a time; which of several equally good places is given depends on it
FILTER_BITS = 20
FOUND = "doc_id long, item_id long, edits int, item_words int, at int"
_TO_SPACE = np.arange(256, dtype=np.uint8)
for _b in range(128):
    if not chr(_b).isalnum():
        _TO_SPACE[_b] = 32
    elif 65 <= _b <= 90:
        _TO_SPACE[_b] = _b + 32


def word_hashes(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of a block, and each text's bounds.  Bytes beyond ASCII belong to words."""
    clean = _TO_SPACE[data]
    words = Words(clean, off)
    return Rolling(BYTE_VALUE[clean]).of(words.start, words.end), words.rows


def plan(seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(a random odd factor for each walk and step, sampled places for each walk and key)."""
    rng = np.random.default_rng(seed)
    factor = rng.integers(1, 2**63, (WALKS, STEPS), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    # one place in each fifth of a growing run of steps: short runs miss edits, long ones differ more
    run = [STEPS * (KEYS + k) // (2 * KEYS - 1) for k in range(KEYS)]
    places = np.array([[[r * i // PLACES + rng.integers(0, r * (i + 1) // PLACES - r * i // PLACES) for i in range(PLACES)] for r in run] for _ in range(WALKS)])
    return factor, places


def keys(words: np.ndarray, start: np.ndarray, end: np.ndarray | None = None) -> Iterator[tuple[int, np.ndarray]]:
    """(number, key of every window) for each walk and sample; windows begin at ``start``.

    A walk that passes ``end`` (an item's last word) writes 0.
    """
    factor, places = plan()
    n = len(words)
    padded = np.concatenate([words, np.zeros(STEPS + 1, np.uint64)])
    for w in range(WALKS):
        at = start.copy()
        key = np.full((KEYS, len(start)), w + 1, dtype=np.uint64)
        for j in range(STEPS):
            own = padded[at]
            if end is not None:
                own = np.where(at < end, own, np.uint64(0))
            for k in np.flatnonzero((places[w] == j).any(axis=1)):
                key[k] = (key[k] ^ own) * np.uint64(0x9E3779B97F4A7C15)
                key[k] ^= key[k] >> np.uint64(29)
            at += ((own * factor[w, j]) >> np.uint64(63)).astype(np.int64)
            np.minimum(at, n + STEPS, out=at)
        for k in range(KEYS):
            yield w * KEYS + k, key[k]


class Items:
    """Benchmark items with their keys, sorted for look-up."""

    def __init__(self, ids: list[int], texts: list[str | None], similarity: float):
        column = pa.array([x or "" for x in texts], pa.string())
        words, self.ids, size = [], np.array(ids, dtype=np.int64), []
        for a, b, data, off in blocks(column, BLOCK):
            h, rows = word_hashes(data, off)
            words.append(h)
            size.append(np.diff(rows))
        self.words = np.concatenate(words) if words else np.zeros(0, np.uint64)
        self.size = np.concatenate(size) if size else np.zeros(0, np.int64)
        self.bounds = np.concatenate([[0], np.cumsum(self.size)])
        self.edits = np.floor((1 - similarity) * self.size + 1e-9).astype(np.int64)
        start, item = [], []
        for i in np.flatnonzero(self.size >= SHORT):
            offs = np.arange(0, max(1, self.size[i] - STEPS // 2), STRIDE)
            start.append(self.bounds[i] + offs)
            item.append(np.full(len(offs), i))
        start = np.concatenate(start) if start else np.zeros(0, np.int64)
        item = np.concatenate(item) if item else np.zeros(0, np.int64)
        offset = start - self.bounds[item]
        all_keys, number = [], []
        for _, key in keys(self.words, start, self.bounds[item + 1]) if len(start) else ():
            all_keys.append(key)
            number.append(np.arange(len(start)))
        # pieces of short items, by their numbers of words
        pieces = []
        for i in np.flatnonzero((self.size > 0) & (self.size < SHORT)):
            n, parts = int(self.size[i]), min(int(self.edits[i]) + 1, int(self.size[i]))
            cuts = [n * j // parts for j in range(parts + 1)]
            pieces += [(b - a, int(i), a) for a, b in zip(cuts, cuts[1:], strict=False)]
        pieces = np.array(pieces, dtype=np.int64).reshape(-1, 3)
        self.short = sorted(set(pieces[:, 0].tolist()))
        roll = Rolling(self.words)
        base = len(start)
        for n in self.short:
            own = pieces[pieces[:, 0] == n]
            begin = self.bounds[own[:, 1]] + own[:, 2]
            all_keys.append(roll.of(begin, begin + n))
            number.append(base + np.arange(len(own)))
            base += len(own)
            item, offset = np.concatenate([item, own[:, 1]]), np.concatenate([offset, own[:, 2]])
        self.item, self.offset = item, offset
        key = np.concatenate(all_keys) if all_keys else np.zeros(0, np.uint64)
        number = np.concatenate(number) if number else np.zeros(0, np.int64)
        order = np.argsort(key, kind="stable")
        self.key, self.number = key[order], number[order]
        own = np.repeat(np.arange(len(self.size)), self.size).astype(np.uint64)
        self.holds = np.zeros(1 << FILTER_BITS, dtype=bool)  # hashed (item, word) pairs
        self.holds[self._bit(self.words + own * np.uint64(0x9E3779B97F4A7C15))] = True
        self.filter = np.zeros(1 << FILTER_BITS, dtype=bool)
        self.filter[self._bit(self.key)] = True

    @staticmethod
    def _bit(key: np.ndarray) -> np.ndarray:
        return (mix(key) >> np.uint64(64 - FILTER_BITS)).astype(np.int64)

    def lookup(self, key: np.ndarray, most: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(window, number of an item's window) for all windows that share this key, in parts of about ``most``."""
        at = np.flatnonzero(self.filter[self._bit(key)])
        low, high = np.searchsorted(self.key, key[at], "left"), np.searchsorted(self.key, key[at], "right")
        n = high - low
        at, low, n = at[n > 0], low[n > 0], n[n > 0]
        part = (np.cumsum(n) - n) // (most or max(1, n.sum()))
        for p in np.unique(part):
            a, b = np.searchsorted(part, p, "left"), np.searchsorted(part, p, "right")
            m = n[a:b]
            hit = np.repeat(np.arange(a, b), m)
            place = np.repeat(low[a:b], m) + np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
            yield at[hit], self.number[place]

    def candidates(self, words: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(text, item, supposed start) of all candidates of a block in parts, each once in a part."""
        row = row_of(bounds)
        if len(self.key):
            start = np.arange(len(words))
            parts = [x for _, key in keys(words, start) for x in self.lookup(key)]
            if parts:
                yield self._once(row, len(words), *(np.concatenate(x) for x in zip(*parts, strict=True)))
        roll = Rolling(words)
        for n in self.short:
            every = roll.every(n)
            ok = np.flatnonzero(row[: len(every)] == row[n - 1:]) if len(every) else np.zeros(0, np.int64)
            for at, number in self.lookup(every[ok], CANDIDATES_AT_ONCE):
                yield self._once(row, len(words), ok[at], number)

    def _once(self, row: np.ndarray, n_words: int, at: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        item, text = self.item[number], row[at]
        begin = at - self.offset[number]
        # nearby starts of one item are one candidate: the verified stretch has room on both sides
        room = np.maximum(1, self.edits[item])
        place = (begin + 2 * n_words) // room
        order = np.lexsort((place, item, text))
        t, i, p = text[order], item[order], place[order]
        new = np.ones(len(order), dtype=bool)
        new[1:] = (t[1:] != t[:-1]) | (i[1:] != i[:-1]) | (p[1:] != p[:-1])
        first = order[new]
        return text[first], item[first], begin[first]

    def verify(self, words: np.ndarray, bounds: np.ndarray, text: np.ndarray, item: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """Least word edits between each item and any run of words near its supposed start (exact up to the item's limit)."""
        out = np.full(len(text), 2**30, dtype=np.int64)
        step = 2048
        by_size = np.argsort(self.size[item], kind="stable")
        for s in range(0, len(text), step):
            c = by_size[s:s + step]
            n, k = self.size[item[c]], self.edits[item[c]]
            # starts of one candidate differ by less than its edits; an alignment within its edits starts and ends that near
            low = np.maximum(begin[c] - 2 * k, bounds[text[c]])
            high = np.minimum(begin[c] + n + 3 * k + 1, bounds[text[c] + 1])
            width = int((high - low).max(initial=0))
            if width <= 0:
                continue
            at = low[:, None] + np.arange(width)
            inside = at < high[:, None]
            doc = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
            # an alignment keeps all but k of the item's words, so the stretch holds that many
            known = self.holds[self._bit(doc + item[c].astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15))] & inside
            likely = known.sum(axis=1) >= n - k
            if not likely.any():
                continue
            c, n, doc, inside = c[likely], n[likely], doc[likely], inside[likely]
            # row of distances: items' words so far against every end in the stretch, any start free
            dist = np.zeros((len(c), width + 1), dtype=np.int32)
            ramp_up = np.arange(width + 1, dtype=np.int32)
            final = np.full(len(c), 2**30, dtype=np.int64)
            for i in range(int(n.max())):
                own = self.words[np.minimum(self.bounds[item[c]] + i, len(self.words) - 1)]
                swap = dist[:, :-1] + ((doc != own[:, None]) | ~inside)
                new = np.empty_like(dist)
                new[:, 0] = i + 1
                np.minimum(swap, dist[:, 1:] + 1, out=new[:, 1:])
                new = np.minimum.accumulate(new - ramp_up, axis=1) + ramp_up
                dist = new
                done = np.flatnonzero(n == i + 1)
                if len(done):
                    final[done] = dist[done].min(axis=1)
            out[c] = final
        return out


def contaminated(docs: DataFrame, benchmark: DataFrame, *, similarity: float = SIMILARITY, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, item_id, edits, item_words, at: each item found in each document, at its best place (word number)."""
    spark = docs.sparkSession
    importable(spark)
    docs = id_text(docs, id_col, text_col)
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id is not null").distinct()
    found = None
    ids, texts = [], []
    for r in rows.toLocalIterator():
        ids.append(r["item_id"])
        texts.append(r["text"])
        if len(ids) == ITEMS_AT_ONCE:
            part = _search(docs, Items(ids, texts, similarity))
            found, ids, texts = part if found is None else found.unionByName(part), [], []
    if ids or found is None:
        part = _search(docs, Items(ids, texts, similarity))
        found = part if found is None else found.unionByName(part)
    best = F.min(F.struct("edits", "at", "item_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", "b.edits", "b.item_words", "b.at")


def _search(docs: DataFrame, items: Items) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(items)

    def run(batches):
        items = sent.value
        for rb in batches:
            for a, b, data, off in blocks(rb.column("text"), BLOCK):
                ids = rb.column("doc_id").slice(a, b - a)
                words, bounds = word_hashes(data, off)
                if not len(words):
                    continue
                for text, item, begin in items.candidates(words, bounds):
                    edits = items.verify(words, bounds, text, item, begin)
                    ok = np.flatnonzero(edits <= items.edits[item])
                    if len(ok):
                        at = np.maximum(0, begin[ok] - bounds[text[ok]])
                        columns = [ids.take(pa.array(text[ok])), pa.array(items.ids[item[ok]]), pa.array(edits[ok].astype(np.int32)), pa.array(items.size[item[ok]].astype(np.int32)), pa.array(at.astype(np.int32))]
                        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "item_id", "edits", "item_words", "at"])

    return docs.mapInArrow(run, FOUND)


def normal_words(text: str | None) -> list[str]:
    """A text's words as this module compares them (for tests)."""
    return re.findall(r"(?:[0-9a-z]|[^\x00-\x7f])+", re.sub(r"[A-Z]", lambda m: m[0].lower(), text or ""))
