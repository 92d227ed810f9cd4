"""Document fingerprints by winnowing.

Every run of ``gram`` code points of a text has a rolling hash; of every ``window`` consecutive ones the smallest
is chosen, of equal ones the rightmost, and the chosen ones are the fingerprint, each with its position.  So
whatever stretch of ``window + gram - 1`` code points two texts share, their fingerprints share a hash inside it,
and neighbouring positions are at most ``window`` apart, which keeps them in one byte each.  A text of fewer than
``window`` hashes is one window, a text of fewer than ``gram`` code points is one run; an empty text has an empty
fingerprint.  The likeness of two fingerprints is the Jaccard similarity of their hashes, counted as often as
they stand there (1 if both are empty).

NULL texts are empty.  Rows that repeat an id and rows with a NULL id are documents of their own, in the order of
(id, hash of the text), NULL first.  Other columns are left out.  Very long texts are fingerprinted whole.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import BYTE_VALUE, Rolling, _windowed, blocks, mix, ramp
from .repeats import batch
from .tables import keyed

GRAM, WINDOW = 8, 24
BLOCK = 1 << 20
PARTS = 4  # of the ids, for each shuffle partition
_LOW = np.uint64(0xFFFFFFFF)


def characters(data: np.ndarray) -> np.ndarray:
    """Where code points of UTF-8 begin."""
    return np.flatnonzero((data & 0xC0) != 0x80)


def winnowed(data: np.ndarray, off: np.ndarray, gram: int = GRAM, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, positions, bounds, code points) of the texts of a block: text i has hashes[bounds[i]:bounds[i + 1]] of
    32 bits at those code points."""
    if not 0 < window < 256:
        raise ValueError("window must be from 1 to 255: positions are kept as gaps of one byte")
    starts = characters(data)
    first = np.searchsorted(starts, off)  # code points of text i: first[i] to first[i + 1]
    size = np.diff(first)
    edge = np.append(starts, len(data))
    roll = Rolling(BYTE_VALUE[data])
    grams = np.where(size >= gram, size - gram + 1, np.minimum(size, 1))
    begin = np.repeat(first[:-1], grams) + ramp(grams)
    end = np.minimum(begin + gram, np.repeat(first[1:], grams))
    hashes = roll.of(edge[begin], edge[end]) >> np.uint64(32)
    place = np.arange(len(hashes), dtype=np.uint64)
    # of equal hashes the rightmost is the smallest key
    keys = (hashes << np.uint64(32)) | (_LOW - place)
    bounds = np.concatenate([[0], np.cumsum(grams)])
    low = np.flatnonzero((grams > 0) & (grams < window))
    chosen = [np.zeros(0, np.uint64)]
    if len(low):
        inside = np.repeat(bounds[low], grams[low]) + ramp(grams[low])
        chosen.append(np.minimum.reduceat(keys[inside], np.concatenate([[0], np.cumsum(grams[low])[:-1]])))
    if len(keys) >= window:
        least = _windowed(keys, window, np.minimum, 2**64 - 1)
        many = np.flatnonzero(grams >= window)
        windows = grams[many] - window + 1
        least = least[np.repeat(bounds[many], windows) + ramp(windows)]
        if len(least):
            chosen.append(least[np.concatenate([[True], least[1:] != least[:-1]])])
    keys = np.concatenate(chosen)
    at = (_LOW - (keys & _LOW)).astype(np.int64)
    order = np.argsort(at)
    at, keys = at[order], keys[order]
    cuts = np.searchsorted(at, bounds)
    row = np.repeat(np.arange(len(size)), np.diff(cuts))
    return (keys >> np.uint64(32)).astype(np.uint32), at - bounds[row], cuts, size


def packed_prints(hashes: np.ndarray, positions: np.ndarray, bounds: np.ndarray) -> list[str]:
    """A string for each fingerprint: ten hexadecimal digits for each hash, eight of it and two of the gap before it."""
    gap = np.diff(positions, prepend=0)
    heads = bounds[:-1][bounds[:-1] < bounds[1:]]
    gap[heads] = positions[heads]
    out = np.empty((len(hashes), 5), np.uint8)
    out[:, :4] = hashes.astype(">u4").view(np.uint8).reshape(-1, 4)
    out[:, 4] = gap
    text = out.tobytes().hex()
    return [text[10 * a:10 * b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]


def unpacked(text: str) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, positions) of a fingerprint's string."""
    raw = np.frombuffer(bytes.fromhex(text), np.uint8).reshape(-1, 5)
    return np.ascontiguousarray(raw[:, :4]).view(">u4").ravel().astype(np.uint32), np.cumsum(raw[:, 4].astype(np.int64))


def likeness(hashes: np.ndarray, bounds: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Jaccard similarity of the hashes of the texts a[i] and b[i], repeated ones counted."""
    pair = np.arange(len(a))
    size_a, size_b = np.diff(bounds)[a], np.diff(bounds)[b]
    index = np.concatenate([np.repeat(bounds[a], size_a) + ramp(size_a), np.repeat(bounds[b], size_b) + ramp(size_b)])
    code = np.concatenate([np.repeat(pair, size_a), np.repeat(pair, size_b)])
    side = np.repeat(np.array([0, 1]), [size_a.sum(), size_b.sum()])
    order = np.lexsort((hashes[index], code))
    value, code, side = hashes[index][order], code[order], side[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (value[1:] != value[:-1]) | (code[1:] != code[:-1])
    at = np.flatnonzero(new)
    in_b = np.add.reduceat(side, at) if len(at) else at
    in_a = np.diff(np.concatenate([at, [len(order)]])) - in_b
    union = np.bincount(code[at], np.maximum(in_a, in_b), len(a))
    both = np.bincount(code[at], np.minimum(in_a, in_b), len(a))
    return np.where(union > 0, both / np.maximum(union, 1), 1.0)


def fingerprints(docs: DataFrame, *, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, hashes (array of long), positions (array of int; code points) of every document."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for rb in batches:
            for a, b, data, off in blocks(rb.column("text"), BLOCK):
                hashes, at, bounds, size = winnowed(data, off, gram, window)
                cuts = pa.array(bounds.astype(np.int32))
                yield batch(doc_id=rb.column("doc_id").slice(a, b - a), n_chars=size.astype(np.int64), hashes=pa.ListArray.from_arrays(cuts, pa.array(hashes.astype(np.int64))), positions=pa.ListArray.from_arrays(cuts, pa.array(at.astype(np.int32))))

    return docs.mapInArrow(run, "doc_id long, n_chars long, hashes array<long>, positions array<int>")


def neighbours(docs: DataFrame) -> DataFrame:
    """(part, guest, d, doc_id, text): rows of ``keyed`` documents dealt into parts by d, each part sorted by d descending
    and ended by a guest, the first document of the next part (after the last part: of the first one).

    Parts are cut at quantiles of d, so none holds much more than its share.  Guests are one document for each part:
    their ids come from an aggregate with a row for each part and are broadcast.
    """
    spark = docs.sparkSession
    n = PARTS * int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = ", ".join(f"{i / (n + 1):.9f}D" for i in range(1, n + 1))
    cuts = docs.agg(F.expr(f"percentile_approx(d, array({steps}), {max(10_000, 4 * n)})")).first()[0] or []
    sent = spark.sparkContext.broadcast(np.unique(np.array(cuts, np.int64)))

    def deal(batches):
        for rb in batches:
            part = np.searchsorted(sent.value, rb.column("d").to_numpy(zero_copy_only=False), side="left")
            yield batch(part=part.astype(np.int32), **{x: rb.column(x) for x in ("d", "doc_id", "text")})

    ids = docs.select("d", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("text")).mapInArrow(deal, "part int, d long, doc_id long, text string")
    tops = sorted((r["part"], r["top"]) for r in ids.groupBy("part").agg(F.max("d").alias("top")).collect())
    # the part above a part has it as the next one; after the lowest part comes the highest again
    guests = spark.createDataFrame([(tops[i][0], tops[i - 1][1]) for i in range(len(tops))], "part int, d long")
    rows = docs.mapInArrow(deal, "part int, d long, doc_id long, text string").withColumn("guest", F.lit(0))
    guests = docs.join(F.broadcast(guests), "d").select("part", "d", "doc_id", "text", F.lit(1).alias("guest"))
    both = rows.unionByName(guests).select("part", "guest", "d", "doc_id", "text")
    return both.repartition("part").sortWithinPartitions("part", "guest", F.desc("d"))


def edited(text: bytes, starts: np.ndarray, after: bytes, after_starts: np.ndarray) -> bytes:
    """The last third (rounded down) of the code points of a text replaced by the first as many, or all, of another."""
    n = len(starts)
    cut = n // 3
    head = text if cut == 0 else text[: starts[n - cut]]
    return head + (after if cut >= len(after_starts) else after[: after_starts[cut]])


def fingerprint_report(docs: DataFrame, *, gram: int = GRAM, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next for every document.

    The next document is the one before it in the order of ids (after the smallest: the largest; a single document is its
    own).  The edited text has the last third of its code points replaced by the next document's first ones.
    """
    rows = neighbours(keyed(docs, id_col, text_col))

    def report(part: np.ndarray, guest: np.ndarray, ids: pa.Array, text: pa.Array):
        """Results of the rows that have their next row here: all but the guests and the last one."""
        own = np.flatnonzero(guest[:-1] == 0)
        if not len(own):
            return
        _, _, data, off = next(blocks(text, 1 << 62))
        starts = characters(data)
        cuts = np.searchsorted(starts, off)
        raw = data.tobytes()
        texts = [raw[a:b] for a, b in zip(off[:-1].tolist(), off[1:].tolist(), strict=True)]
        at = [starts[a:b] - o for a, b, o in zip(cuts[:-1].tolist(), cuts[1:].tolist(), off[:-1].tolist(), strict=True)]
        changed = [edited(texts[i], at[i], texts[i + 1], at[i + 1]) for i in own.tolist()]
        both = np.frombuffer(raw + b"".join(changed), np.uint8)
        off = np.concatenate([off, off[-1] + np.cumsum([len(x) for x in changed])])
        hashes, positions, bounds, size = winnowed(both, off, gram, window)
        prints = packed_prints(hashes, positions, bounds)
        later = len(texts) + np.arange(len(own))
        yield batch(
            doc_id=ids.take(pa.array(own)), n_chars=size[own].astype(np.int64), edited_sha256=[hashlib.sha256(x).hexdigest() for x in changed],
            fingerprint=[prints[i] for i in own.tolist()], edited_fingerprint=prints[len(texts):],
            near_edited=likeness(hashes, bounds, own, later), near_next=likeness(hashes, bounds, own, own + 1))

    def run(batches):
        held = None
        for rb in batches:
            for a, b, _, _ in blocks(rb.column("text"), BLOCK):
                here = rb.slice(a, b - a)
                if held is not None:
                    here = pa.Table.from_batches([held, here]).combine_chunks().to_batches()[0]
                yield from report(here.column("part").to_numpy(), here.column("guest").to_numpy(), here.column("doc_id"), here.column("text"))
                held = here.slice(here.num_rows - 1)

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")
