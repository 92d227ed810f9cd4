"""Removal of word sequences that already stood earlier, by seed and extend.

Seeds are winnowed anchors: 7-word grams such that every 20 consecutive words hold one, at the same place in
all copies.  Spark joins the documents on the seeds; each match is extended to both sides, and what reaches
20 words with an earlier place (smaller doc_id, or the same document further left) is removed.  Overlapping
extents of one document run together into maximal repeats.

Words are runs of other characters than ASCII white space.  Windows are judged on the input.  NULL and empty
texts have no words; texts of under 20 words keep all.  Rows that repeat a doc_id are documents of their own,
in the order of their text's hash.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import Words, blocks
from .repeats import Repeats, batch, union
from .tables import free_name, keyed

LENGTH, SEED = 20, 7


def word_values(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    words = Words(data, off)
    return words.hashes(data), words.rows


def repeats(length: int = LENGTH, seed: int = SEED) -> Repeats:
    return Repeats(word_values, gram=seed, length=length, keys=(seed,), later_only=True)


def kept_words(batches):
    """(text, spans, ..) to (batch slice, [(words, removed words, kept words or None if all)])."""
    for rb in batches:
        for first, end, data, off in blocks(rb.column("text")):
            part = rb.slice(first, end - first)
            out = []
            for i, own in enumerate(part.column("spans").to_pylist()):
                words = data[off[i]:off[i + 1]].tobytes().split()
                if own:
                    gone = union(np.array([s["a"] for s in own]), np.array([s["b"] for s in own]), len(words))
                    kept = [words[k] for k in np.flatnonzero(~gone)]
                else:
                    kept = words
                out.append((len(words), len(words) - len(kept), kept))
            yield part, out


def remove_earlier(docs: DataFrame, *, length: int = LENGTH, seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and the kept words joined by spaces (text), or their SHA-256."""
    docs = keyed(docs, id_col, text_col)
    spans = repeats(length, seed).spans(docs, "seeds")

    def run(batches):
        for part, out in kept_words(batches):
            kept = [b" ".join(k) for _, _, k in out]
            last = pa.array([hashlib.sha256(x).hexdigest() for x in kept]) if digests else pa.array([x.decode() for x in kept], pa.string())
            columns = {"doc_id": part.column("doc_id"), "n_words": pa.array([n for n, _, _ in out], pa.int64()), "n_removed": pa.array([n for _, n, _ in out], pa.int64())}
            yield batch(**columns, **{"kept_sha256" if digests else "text": last})

    schema = "doc_id long, n_words long, n_removed long, " + ("kept_sha256 string" if digests else "text string")
    return docs.join(spans, "d", "left").select("doc_id", "text", "spans").mapInArrow(run, schema)


def drop_earlier(docs: DataFrame, key: str, *, length: int = LENGTH, seed: int = SEED, text_col: str = "text", size_col: str | None = None) -> DataFrame:
    """The documents with all their columns, without word sequences that stand in one of smaller ``key``.

    Texts that lose nothing stay as they are; others are their kept words joined by spaces, and ``size_col``,
    if given, is their new length in characters.  A document that loses all its words goes.
    """
    at, own = free_name(docs, "span_key"), free_name(docs, "spans")
    spans = repeats(length, seed).spans(keyed(docs, key, text_col), "seeds").select(F.col("d").alias(at), F.col("spans").alias(own))
    names = docs.columns

    def rewrite(batches):
        for rb in batches:
            for first, end, data, off in blocks(rb.column(text_col)):
                part = rb.slice(first, end - first)
                texts, sizes = part.column(text_col).to_pylist(), None
                if size_col:
                    sizes = part.column(size_col).to_pylist()
                stay = np.ones(part.num_rows, dtype=bool)
                for i, spans in enumerate(part.column(own).to_pylist()):
                    if not spans:
                        continue
                    words = data[off[i]:off[i + 1]].tobytes().split()
                    gone = union(np.array([s["a"] for s in spans]), np.array([s["b"] for s in spans]), len(words))
                    texts[i] = b" ".join(words[k] for k in np.flatnonzero(~gone)).decode()
                    stay[i] = bool(texts[i])
                    if size_col:
                        sizes[i] = len(texts[i])
                columns = [pa.array(texts, pa.string()) if n == text_col else pa.array(sizes, part.column(n).type) if n == size_col else part.column(n) for n in names]
                yield pa.RecordBatch.from_arrays(columns, names=names).filter(pa.array(stay))

    return docs.join(spans, F.col(key) == F.col(at), "left").drop(at).mapInArrow(rewrite, docs.schema)
