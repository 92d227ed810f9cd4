"""Removal of byte strings that stand more than once in the corpus, by distributed prefix doubling.

Of all suffixes only those at winnowed positions are sorted: every 400-byte string has one that starts within
its first 200 bytes, at the same place in all its copies.  Spark sorts these by their rank and the
key of the bytes that follow, at offsets that double (25, 50, 100, 200 bytes); a suffix that is alone with
its rank is dropped, the others are reranked.  What is left agrees in 200 bytes; bytes to both sides are
then compared within each rank, so that exactly the bytes of repeated 400-byte strings are found.

Matches never cross documents, and strings are judged on the input.  Empty, NULL and short texts lose
nothing.  Rows that repeat a doc_id are documents of their own.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import BYTE_VALUE, Rolling, blocks
from .repeats import Repeats, batch, union
from .tables import keyed

LENGTH = 400


class ByteRepeats(Repeats):
    """Units are bytes; hashes are taken over their 64-bit values."""

    bytes = True

    def __init__(self, length: int = LENGTH):
        core = length // 2
        super().__init__(lambda data, off: (data, off), gram=core // 8, length=length, keys=(core // 8, core // 4, core // 2, core), later_only=False)

    def _anchors(self, values, bounds, d, decided):
        yield from super()._anchors(BYTE_VALUE[values], bounds, d, decided)


def cut(batches):
    """(doc_id, text, spans) to the bytes that are left, with what was taken."""
    for rb in batches:
        for first, end, data, off in blocks(rb.column("text")):
            part = rb.slice(first, end - first)
            spans = part.column("spans").to_pylist()
            out = []
            for i, own in enumerate(spans):
                text = data[off[i]:off[i + 1]]
                if not own:
                    out.append((len(text), 0, 0, text.tobytes()))
                    continue
                gone = union(np.array([s["a"] for s in own]), np.array([s["b"] for s in own]), len(text))
                runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(text), int(gone.sum()), runs, text[~gone].tobytes()))
            yield part.column("doc_id"), out


def remove_repeated(docs: DataFrame, *, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and the kept bytes (binary) of every document, or their SHA-256."""
    docs = keyed(docs, id_col, text_col)
    spans = ByteRepeats(length).spans(docs, "suffix_ranks")

    def run(batches):
        for ids, out in cut(batches):
            n, removed, runs, kept = zip(*out, strict=True)
            last = pa.array([hashlib.sha256(x).hexdigest() for x in kept]) if digests else pa.array(kept, pa.binary())
            columns = {"doc_id": ids, "n_bytes": pa.array(n, pa.int64()), "n_removed": pa.array(removed, pa.int64()), "n_spans": pa.array(runs, pa.int64())}
            yield batch(**columns, **{"kept_sha256" if digests else "kept": last})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, " + ("kept_sha256 string" if digests else "kept binary")
    return docs.join(spans, "d", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)
