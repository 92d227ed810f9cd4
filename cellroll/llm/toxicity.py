"""Toxicity scores of whole texts.

Model: a word is the mean of the embeddings of its character n-grams (edges marked, hashed into buckets), a
text the mean of its distinct words, and a linear softmax over the two labels reads the text.  Embeddings and softmax
are trained jointly, in numpy, on a bounded sample of labelled rows.  A misspelling that was never seen
shares most n-grams with the word it stands for, and so most of its vector.

As the softmax is linear, a word's share of a text's score is one number; it is computed once for each
distinct word of a batch.

Empty and NULL texts, and texts without words, get the score of the label shares alone.  Labels other than 0
and 1, and documents with several different labels, are not learned from.  With no labelled rows of both
labels every score is the share of label 1 (0.5 without any).
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import WordIndex, free_memory, text_groups
from .subwords import Adam, add_up, grams, plain_words
from .tables import held_out, id_text

SAMPLE_ROWS = 2500  # labelled rows that are learned from, for each label
LOW, HIGH, BUCKETS, WIDTH = 3, 5, 1 << 17, 4
SCALE = 40.0  # a text's mean vector is short as few of its words matter
EPOCHS, BATCH, RATE, LEAST_STEPS = 8, 64, 0.02, 150
PAD = 5  # empty words that every text counts besides its own: few words give no certainty
DECAY = 3e-4
THRESHOLD = 0.7
WORDS_KEPT = 400_000  # some 60 MB in a worker
GROUP = 2 << 20  # bytes of text that are cut into words at a time


@dataclass
class Model:
    weight: np.ndarray  # per bucket: difference of the two labels' logits
    bias: float

    def words(self, raw: list[bytes]) -> np.ndarray:
        """Each raw word's share: mean over its n-grams (0 where there are none)."""
        feature, owner = grams(plain_words(raw), LOW, HIGH, BUCKETS)
        n = np.bincount(owner, minlength=len(raw))
        return np.bincount(owner, self.weight[feature], len(raw)) / np.maximum(n, 1)

    def scores(self, sums: np.ndarray, n: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.bias + SCALE * sums / (n + PAD), -500, 500)))


def numbered_words(texts: Iterable[bytes]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Plain distinct words of all texts; the numbers of each text's distinct words, end to end, and their bounds.

    Texts are taken one by one, and only numbers are kept of each.
    """
    index = WordIndex(1 << 60)
    rows = [index.rows(list(dict.fromkeys(x.split()))).astype(np.int32) for x in texts]
    bounds = np.concatenate([[0], np.cumsum([len(x) for x in rows], dtype=np.int64)])
    words = index.fresh()
    index.clear()
    return plain_words(words), np.concatenate([np.zeros(0, np.int32), *rows]), bounds


def train(texts: Iterable[bytes], labels: np.ndarray, shares: tuple[float, float], seed: int = 7) -> Model:
    """Joint training of bucket embeddings and softmax; ``shares`` are the labels' shares in the whole."""
    rng = np.random.default_rng(seed)
    words, rows, bounds = numbered_words(texts)
    free_memory()  # of the texts and their words
    table = rng.normal(0, 0.1 / WIDTH, (BUCKETS, WIDTH))
    out = rng.normal(0, 0.3, (WIDTH, 2))
    bias = np.zeros(2)
    steps = [Adam(table.shape, RATE), Adam(out.shape, RATE), Adam(2, RATE)]
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(labels))))):
        perm = rng.permutation(len(labels))
        for a in range(0, len(perm), BATCH):
            docs = perm[a:a + BATCH]
            at = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs])
            doc = np.repeat(np.arange(len(docs)), bounds[docs + 1] - bounds[docs])
            some, word = np.unique(rows[at], return_inverse=True)
            f, o = grams([words[i] for i in some.tolist()], LOW, HIGH, BUCKETS)
            size = np.bincount(o, minlength=len(some))
            n = PAD + bounds[docs + 1] - bounds[docs]
            vector = add_up(table[f], o, len(some)) / np.maximum(size, 1)[:, None]
            share = SCALE / n[doc]
            mean = add_up(vector[word] * share[:, None], doc, len(docs))
            logit = mean @ out + bias
            p = np.exp(logit - logit.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(docs)), labels[docs]] -= 1
            p /= len(docs)
            back_mean = p @ out.T
            back_vector = add_up(back_mean[doc] * share[:, None], word, len(some)) / np.maximum(size, 1)[:, None]
            # Adam on the touched rows only
            buckets = np.flatnonzero(np.bincount(f, minlength=BUCKETS))
            grad = add_up(back_vector[o], f, BUCKETS)[buckets]
            s = steps[0]
            s.m[buckets] += 0.1 * (grad - s.m[buckets])
            s.v[buckets] += 0.01 * (grad * grad - s.v[buckets])
            s.t += 1
            table[buckets] -= s.rate * (s.m[buckets] / (1 - 0.9**s.t)) / (np.sqrt(s.v[buckets] / (1 - 0.99**s.t)) + 1e-8) + DECAY * table[buckets]
            steps[1].step(out, mean.T @ p)
            steps[2].step(bias, p.sum(axis=0))
    # the sample holds the labels evenly; the whole does not
    have = np.array([(labels == 0).mean(), (labels == 1).mean()])
    shift = np.log(max(shares[1], 1e-6) / max(have[1], 1e-6)) - np.log(max(shares[0], 1e-6) / max(have[0], 1e-6))
    return Model((table @ (out[:, 1] - out[:, 0])).astype(np.float64), float(bias[1] - bias[0] + shift))


def learn(docs: DataFrame, labels: DataFrame, *, rows: int = SAMPLE_ROWS) -> Model:
    """Train on at most ``rows`` rows of each label, those with the smallest hash of their id, none held out."""
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where("toxic in (0, 1) and doc_id is not null")
    known = known.groupBy("doc_id").agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("other")).where("toxic = other")
    known = known.where(~held_out()).join(docs.select("doc_id").distinct(), "doc_id", "left_semi")  # labels of documents that are here
    known = known.select("doc_id", "toxic", F.xxhash64("doc_id").alias("h"))
    counts = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    if len(counts) < 2:
        share = min(max(counts.get(1, 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
        return Model(np.zeros(BUCKETS), float(np.log(share / (1 - share))))
    # the ids first, then their texts: the sample's size bounds what reaches the driver
    picked = known.where("toxic = 0").orderBy("h", "doc_id").limit(rows).union(known.where("toxic = 1").orderBy("h", "doc_id").limit(rows))
    ids = {r["doc_id"]: r["toxic"] for r in picked.select("doc_id", "toxic").collect()}
    sample = docs.where(F.col("doc_id").isin(list(ids))).groupBy("doc_id").agg(F.min("text").alias("text")).orderBy("doc_id").collect()
    y = np.array([ids[r["doc_id"]] for r in sample])
    model = train(handed_out(sample), y, (counts[0] / total, counts[1] / total))
    free_memory()
    return model


def handed_out(sample: list) -> Iterator[bytes]:
    """The rows' texts; each row is dropped from the list as its text is taken."""
    sample.reverse()
    while sample:
        yield (sample.pop()["text"] or "").encode()


def scorer(model: Model):
    """Batches of rows to (batch slice, scores of its text column)."""

    def run(batches, text_col: str):
        index, known = WordIndex(WORDS_KEPT), np.zeros(0)
        for part, texts in text_groups(batches, text_col, GROUP):
            if index.full():
                known = np.zeros(0)
            split = [list(dict.fromkeys(x.split())) for x in texts]
            rows = index.rows(list(chain.from_iterable(split)))
            if new := index.fresh():
                known = np.concatenate([known, model.words(new)])
            n = np.fromiter(map(len, split), np.int64, len(split))
            sums = np.bincount(np.repeat(np.arange(len(n)), n), known[rows], len(n))
            yield part, model.scores(sums, n)

    return run


def toxicity(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1), predicted (1 if score >= threshold) of every document."""
    docs = id_text(docs, id_col, text_col)
    run = scorer(learn(docs, labels, rows=rows))

    def score(batches):
        for part, p in run(batches, "text"):
            columns = [part.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "score", "predicted"])

    scored = docs.mapInArrow(score, "doc_id long, score double, predicted int")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "score", "predicted")


def keep_clean(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD, rows: int = SAMPLE_ROWS) -> DataFrame:
    """The documents whose score is below the threshold, with all their columns."""
    run = scorer(learn(id_text(docs, id_col, text_col), labels, rows=rows))

    def keep(batches):
        for part, p in run(batches, text_col):
            yield part.filter(pa.array(p < threshold))

    return docs.mapInArrow(keep, docs.schema)
