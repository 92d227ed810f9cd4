"""Language of whole texts by a linear-chain conditional random field over their words.

Each word has a state, its language.  A word's features are itself (the lexicon), its prefixes and suffixes
and its character n-grams, hashed into buckets with one weight for each language; states of neighbouring
words are tied by learned transition weights.  Weights are fitted in numpy by forward-backward on sequences
cut from a sample of labelled documents, bounded for each language; a sequence switches between documents, so that switches
inside a text are learned too.  A text gets the language with the highest mean probability over its words,
and that mean as its score.

Texts without a letter, empty and NULL texts are ``und`` with score 0.  With no labelled rows at all every
text is ``und``.  Ties go to the first language in alphabetical order.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import GROUP_BYTES, WordIndex, ramp, text_groups
from .subwords import Adam, add_up, grams, plain_words, whole_and_affixes
from .tables import held_out, id_text

SAMPLE_ROWS = 250  # documents learned from, for each language
# every language is learned; with more than so many, fewer documents of each, but LEAST_ROWS if there are so many
LANGUAGES, LEAST_ROWS = 64, 20
COLUMNS = 16  # languages whose weights are gathered at once
BUCKETS, AFFIXES, LOW, HIGH = 1 << 17, (1, 2, 3), 2, 4
SEQUENCE, PIECE, EPOCHS, BATCH, RATE, DECAY = 64, (6, 48), 3, 128, 0.03, 1e-4
CHUNK = 256
WORDS_KEPT = 600_000
UNKNOWN = "und"


def features(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket, word) of all features, and each word's factor."""
    a, b = whole_and_affixes(words, AFFIXES, BUCKETS)
    c, d = grams(words, LOW, HIGH, BUCKETS)
    owner = np.concatenate([b, d])
    return np.concatenate([a, c]), owner, 1 / np.sqrt(np.maximum(1, np.bincount(owner, minlength=len(words))))


def has_letter(words: list[str]) -> np.ndarray:
    return np.fromiter((x.isalpha() or any(map(str.isalpha, x)) for x in words), bool, len(words))


def scores(weight: np.ndarray, f: np.ndarray, owner: np.ndarray, n: int) -> np.ndarray:
    """Sums of the features' weights for each word and language."""
    parts = [add_up(weight[:, a:a + COLUMNS][f], owner, n) for a in range(0, weight.shape[1], COLUMNS)]
    return np.concatenate(parts, axis=1)


@dataclass
class Model:
    languages: list[str]
    weight: np.ndarray  # buckets x languages
    transition: np.ndarray

    def emissions(self, raw: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """exp of each word's language scores (largest 1), and whether it has a letter."""
        words = plain_words(raw)
        out = np.empty((len(raw), len(self.languages)))
        for a in range(0, len(words), 50_000):
            f, owner, factor = features(words[a:a + 50_000])
            n = len(factor)
            s = scores(self.weight, f, owner, n) * factor[:, None]
            out[a:a + n] = np.exp(np.maximum(s - s.max(axis=1, keepdims=True), -30))
        return out, has_letter(words)


def marginals(emission: np.ndarray, size: np.ndarray, step: np.ndarray, words: np.ndarray | None = None) -> np.ndarray:
    """Forward-backward: each text's sum of state probabilities over its words; ``words``, an array of the shape of
    ``emission``, receives those of every word.

    emission: one row a word, texts end to end; size: words of each text; step: exp of the transitions.  Long
    texts are cut into chunks; products of the chunks' matrices carry the states from chunk to chunk.  With more than
    LANGUAGES states the products would cost more than they save, and texts are taken whole.
    """
    n_states = emission.shape[1]
    total = np.zeros((len(size), n_states))
    chunk = CHUNK if n_states <= LANGUAGES else max(CHUNK, int(size.max(initial=0)))
    pieces = -(-size // chunk)
    if not pieces.sum():
        return total
    doc = np.repeat(np.arange(len(size)), pieces)
    nth = ramp(pieces)
    first = np.repeat(np.cumsum(size) - size, pieces) + nth * chunk
    length = np.minimum(np.repeat(size, pieces) - nth * chunk, chunk)
    order = np.argsort(-length, kind="stable")
    begin, long = first[order], length[order]
    active = np.searchsorted(-long, -np.arange(chunk), side="left")  # chunks longer than t
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    n = len(order)
    enter, leave = np.full((n, n_states), 1 / n_states), np.ones((n, n_states))
    if pieces.max() > 1:
        many = np.flatnonzero(np.repeat(pieces, pieces)[order] > 1)
        rank = np.full(n, -1)
        rank[many] = np.arange(len(many))
        product = np.broadcast_to(np.eye(n_states), (len(many), n_states, n_states)).copy()
        own_long = long[many]
        for t in range(int(own_long.max())):
            k = int(np.searchsorted(-own_long, -t, side="left"))
            m = product[:k] if t == 0 else product[:k] @ step
            m = m * emission[begin[many[:k]] + t][:, None, :]
            product[:k] = m / m.sum(axis=(1, 2), keepdims=True)
        for j in range(1, int(pieces.max())):
            at = np.flatnonzero(nth == j)
            before = place[at - 1]
            v = np.einsum("ni,nij->nj", enter[before], product[rank[before]]) @ step
            enter[place[at]] = v / v.sum(axis=1, keepdims=True)
        value = np.ones((n, n_states))  # of a chunk's entry: what follows, its own words included
        last = np.repeat(pieces, pieces) - 1
        for j in range(int(pieces.max()) - 1, 0, -1):
            at = np.flatnonzero(nth == j)
            own = place[at]
            end = np.flatnonzero(nth[at] == last[at])
            leave[own[end]] = 1
            value[own] = np.einsum("nij,nj->ni", product[rank[own]], leave[own])
            v = value[own] @ step.T
            leave[place[at - 1]] = v / v.sum(axis=1, keepdims=True)
    most = int(long[0])
    forward = []
    state = enter
    for t in range(most):
        k = int(active[t])
        a = state[:k] if t == 0 else forward[t - 1][:k] @ step
        a = a * emission[begin[:k] + t]
        forward.append(a / a.sum(axis=1, keepdims=True))
    sums = np.zeros((n, n_states))
    back = leave
    for t in range(most - 1, -1, -1):
        k = int(active[t])
        g = forward[t] * back[:k]
        g /= g.sum(axis=1, keepdims=True)
        sums[:k] += g
        if words is not None:
            words[begin[:k] + t] = g
        b = (back[:k] * emission[begin[:k] + t]) @ step.T
        back = np.concatenate([b / b.sum(axis=1, keepdims=True), back[k:]])
    np.add.at(total, doc[order], sums)
    return total


def train(texts: list[bytes], labels: list[str], seed: int = 11) -> Model:
    """Fit by Adam on minibatches of sequences; each takes runs of words of several documents."""
    rng = np.random.default_rng(seed)
    languages = sorted(set(labels))
    number = {x: i for i, x in enumerate(languages)}
    index = WordIndex(1 << 60)
    rows = [index.rows(x.split()) for x in texts]
    words = plain_words(index.fresh())
    letters = has_letter(words)
    rows = [r[letters[r]] for r in rows]
    n_states = len(languages)
    kind = np.float64 if n_states <= LANGUAGES else np.float32
    weight, transition = np.zeros((BUCKETS, n_states), kind), np.zeros((n_states, n_states))
    # every document's words, cut into runs and dealt out again
    runs, run_label = [], []
    for r, y in zip(rows, labels, strict=True):
        at = 0
        while at < len(r):
            k = int(rng.integers(*PIECE))
            runs.append(r[at:at + k])
            run_label.append(number[y])
            at += k
    if not runs:
        return Model(languages, weight, transition)
    place = np.zeros(BUCKETS, np.int64)
    adam_w, adam_t = Adam(weight.shape, RATE), Adam(transition.shape, RATE)
    adam_w.m, adam_w.v = adam_w.m.astype(kind), adam_w.v.astype(kind)
    for _ in range(EPOCHS):
        perm = rng.permutation(len(runs))
        word = np.concatenate([runs[i] for i in perm])
        gold = np.repeat(np.array(run_label)[perm], [len(runs[i]) for i in perm])
        n = max(1, len(word) // SEQUENCE)
        size = min(SEQUENCE, len(word))
        word, gold = word[: n * size].reshape(n, size), gold[: n * size].reshape(n, size)
        for a in range(0, n, BATCH):
            w, y = word[a:a + BATCH], gold[a:a + BATCH]
            some, back = np.unique(w, return_inverse=True)
            back = back.reshape(w.shape)
            f, o, factor = features([words[i] for i in some.tolist()])
            score = scores(weight, f, o, len(some)) * factor[:, None]
            e = np.exp(score - score.max(axis=1, keepdims=True))[back]
            step = np.exp(transition)
            alpha, beta = np.empty_like(e), np.ones_like(e)
            alpha[:, 0] = e[:, 0] / e[:, 0].sum(axis=1, keepdims=True)
            for t in range(1, size):
                v = (alpha[:, t - 1] @ step) * e[:, t]
                alpha[:, t] = v / v.sum(axis=1, keepdims=True)
            pairs = np.zeros_like(transition)
            for t in range(size - 2, -1, -1):
                m = e[:, t + 1] * beta[:, t + 1]
                v = m @ step.T
                pairs += step * ((alpha[:, t] / (alpha[:, t] * v).sum(axis=1, keepdims=True)).T @ m)
                beta[:, t] = v / v.sum(axis=1, keepdims=True)
            p = alpha * beta
            p /= p.sum(axis=2, keepdims=True)
            p[np.arange(len(w))[:, None], np.arange(size)[None, :], y] -= 1
            np.subtract.at(pairs, (y[:, :-1].ravel(), y[:, 1:].ravel()), 1)
            grad_word = add_up(p.reshape(-1, n_states), back.ravel(), len(some)) * factor[:, None] / len(w)
            touched = np.flatnonzero(np.bincount(f, minlength=BUCKETS))
            place[touched] = np.arange(len(touched))
            s = adam_w
            s.t += 1
            for c in range(0, n_states, COLUMNS):
                at = np.ix_(touched, np.arange(c, min(c + COLUMNS, n_states)))
                grad = add_up(grad_word[:, c:c + COLUMNS][o], place[f], len(touched))
                s.m[at] += 0.1 * (grad - s.m[at])
                s.v[at] += 0.01 * (grad * grad - s.v[at])
                weight[at] -= s.rate * (s.m[at] / (1 - 0.9**s.t)) / (np.sqrt(s.v[at] / (1 - 0.99**s.t)) + 1e-8) + DECAY * weight[at]
            adam_t.step(transition, pairs / len(w))
    return Model(languages, weight, transition)


def learn(docs: DataFrame, *, rows: int = SAMPLE_ROWS) -> Model:
    """Train on every language: at most ``rows`` documents of each, those with the smallest hash of their id, none held out.

    With more than LANGUAGES languages the rows of each are lowered, so that all hold about as many together.
    """
    known = docs.where("lang is not null and doc_id is not null").where(~held_out())
    languages = known.select("lang").distinct().count()
    if languages > LANGUAGES:
        rows = min(rows, max(LEAST_ROWS, rows * LANGUAGES // languages))
    by_hash = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    ids = known.select("doc_id", "lang").withColumn("nth", F.row_number().over(by_hash)).where(F.col("nth") <= rows)
    picked = [r["doc_id"] for r in ids.select("doc_id").distinct().collect()]
    sample = known.where(F.col("doc_id").isin(picked)).select("doc_id", "lang", "text").dropDuplicates(["doc_id", "lang"]).orderBy("doc_id", "lang").collect()
    return train([(r["text"] or "").encode() for r in sample], [r["lang"] for r in sample])


def _scored(model: Model, batches):
    """(batch slice, words of its texts as lists, which have a letter, emissions of those that have, words with letters of each text)."""
    many = max(1, len(model.languages) / LANGUAGES)  # what is held grows with words x languages
    index = WordIndex(int(WORDS_KEPT / many))
    known, letter = np.zeros((0, len(model.languages))), np.zeros(0, bool)
    for part, texts in text_groups(batches, limit=int(GROUP_BYTES / many)):
        if index.full():
            known, letter = known[:0], letter[:0]
        split = [x.split() for x in texts]
        rows = index.rows(list(chain.from_iterable(split)))
        if new := index.fresh():
            e, has = model.emissions(new)
            known, letter = np.concatenate([known, e]), np.concatenate([letter, has])
        own = np.repeat(np.arange(len(split)), np.fromiter(map(len, split), np.int64, len(split)))
        keep = letter[rows]
        yield part, split, keep, known[rows[keep]], np.bincount(own[keep], minlength=len(split))


def predictor(model: Model):
    languages = [*model.languages, UNKNOWN]
    step = np.exp(model.transition)

    def run(batches):
        for part, _, _, emission, size in _scored(model, batches):
            mean = marginals(emission, size, step) / np.maximum(size, 1)[:, None]
            best = mean.argmax(axis=1)
            score = mean[np.arange(len(size)), best]
            best[size == 0], score[size == 0] = len(languages) - 1, 0.0
            yield part, [languages[i] for i in best.tolist()], np.clip(score, 0, 1)

    return run


def spans_of(best: np.ndarray, score: np.ndarray, keep: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(text, first word, words, language, mean score) of the runs of words of one language in each text.

    best, score: of the words with letters (``keep`` marks them among all words).  A word without a letter goes to
    the run before it, at the beginning of a text to the first run; a text without letters has no run.
    """
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = np.flatnonzero(keep)
    new = np.ones(len(at), dtype=bool)
    new[1:] = (best[1:] != best[:-1]) | (row[at[1:]] != row[at[:-1]])
    first = np.flatnonzero(new)
    text = row[at[first]]
    head = np.ones(len(first), dtype=bool)
    head[1:] = text[1:] != text[:-1]
    begin = np.where(head, bounds[text], at[first])
    last = np.append(head[1:], True)[: len(first)]
    end = np.where(last, bounds[text + 1], np.append(at[first][1:], 0)[: len(first)])
    count = np.diff(np.append(first, len(at)))
    mean = np.add.reduceat(score, first) / count if len(first) else np.zeros(0)
    return text, begin - bounds[text], end - begin, best[first], mean


def language_spans(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, spans: for every document an array of (first word, words, lang, score), the runs of words of one language.

    The labels of the words of code-switched texts, from the same marginals as ``language``: each word's likeliest
    language, and a run's score is its words' mean probability of it.  Words are counted from 0 between white
    space.  NULL and empty texts and texts without letters have no span.
    """
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = learn(labelled, rows=rows)
    kind = "array<struct<first: int, words: int, lang: string, score: double>>"
    docs = id_text(docs, id_col, text_col)
    if not model.languages:
        return docs.select("doc_id", F.expr(f"cast(array() as {kind})").alias("spans"))
    step = np.exp(model.transition)

    def label(batches):
        for part, split, keep, emission, size in _scored(model, batches):
            words = np.zeros_like(emission)
            marginals(emission, size, step, words)
            best = words.argmax(axis=1)
            bounds = np.concatenate([[0], np.cumsum([len(x) for x in split])])
            text, first, n, lang, score = spans_of(best, words[np.arange(len(best)), best], keep, bounds)
            cuts = np.searchsorted(text, np.arange(len(split) + 1)).astype(np.int32)
            values = pa.StructArray.from_arrays([pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array([model.languages[i] for i in lang.tolist()], pa.string()), pa.array(np.clip(score, 0, 1).astype(np.float64))], names=["first", "words", "lang", "score"])
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.ListArray.from_arrays(pa.array(cuts), values)], names=["doc_id", "spans"])

    return docs.mapInArrow(label, f"doc_id long, spans {kind}")


def language(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, lang_pred, score (0 to 1) of every document; held-out rows are not learned from."""
    labelled = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    model = learn(labelled, rows=rows)
    docs = id_text(docs, id_col, text_col)
    if not model.languages:
        scored = docs.select("doc_id", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    else:
        run = predictor(model)

        def predict(batches):
            for part, best, score in run(batches):
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(best, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

        scored = docs.mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return scored.select("doc_id", F.coalesce(held_out(), F.lit(False)).alias("held_out"), "lang_pred", "score")
