"""Exact token counts at every prefix of a text (sentencepiece .model of the BPE kind).

Method: prefix dynamic programming.  For every prefix of a word the last token of its encoding is found
from those of its shorter prefixes, so the count at each prefix is one more than the count before that last
token.  A text's counts are its words' counts added up: no vocabulary entry has a space mark after another
character, so nothing merges across the start of a word.

``token_counts(prefixes=True)`` keeps the counts of whole words: what a text cut after any word costs is read
off their running sum.  ``truncate`` doesn't read kept counts; each call counts the distinct words of its texts
anew and walks the prefixes of the one word that is cut.

Empty and NULL texts have 0 bytes and 0 tokens.  Repeated rows give repeated rows.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .arrays import WordIndex, text_groups
from .merges import Merges, padded
from .tables import id_text

WORDS_KEPT = 800_000
SPACE = "▁"
NORMAL, USER_DEFINED, UNUSED = 1, 4, 5


class PieceCounts:
    """Prefix counts for a BPE model with byte fallback, a leading space mark and no other normalisation."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2 as proto

        model = proto.ModelProto()
        with open(path, "rb") as f:
            model.ParseFromString(f.read())
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.add_dummy_prefix or any(p.type in (USER_DEFINED, UNUSED) for p in model.pieces):
            raise ValueError("only BPE models without a normaliser, user-defined or unused pieces are counted here")
        pieces = {p.piece: (i, p.score) for i, p in enumerate(model.pieces) if p.type == NORMAL}
        if any(SPACE in p.lstrip(SPACE) for p in pieces):
            raise ValueError("a piece holds a space mark inside")
        self.fallback = bool(model.trainer_spec.byte_fallback)
        chars = sorted({c for p in pieces for c in p})
        self.symbol = {c: i + 1 for i, c in enumerate(chars)}
        single = {c: k for c in chars if (k := pieces.get(c, (None, 0))[0]) is not None}
        extra = len(model.pieces)
        for c in chars:  # a character that is no piece itself can still stand inside one
            if c not in single:
                single[c], extra = extra, extra + 1
        tokens = {k: tuple(self.symbol[c] for c in p) for p, (k, _) in pieces.items()}
        tokens |= {k: (self.symbol[c],) for c, k in single.items()}
        by_score = {s: i for i, s in enumerate(sorted({s for _, s in pieces.values()}, reverse=True))}
        number = {**{c: k for c, k in single.items()}, **{p: k for p, (k, _) in pieces.items()}}
        ranks = {}
        for p, (k, s) in pieces.items():
            for i in range(1, len(p)):
                a, b = number.get(p[:i]), number.get(p[i:])
                if a is not None and b is not None:
                    ranks[a, b] = (by_score[s], k)
        self.merges = Merges(tokens, ranks)
        # tokens a last token stands for: a character outside the vocabulary is written as its bytes
        self.index = WordIndex(WORDS_KEPT)
        self.totals = np.zeros(0, np.int64)
        self.table = np.zeros(0x110000, dtype=np.int32)
        for c, i in self.symbol.items():
            self.table[ord(c)] = i

    def split(self, text: bytes) -> list[bytes]:
        """A text's words: runs of spaces with what follows them; a line break ends a word as nothing merges with it.

        The space mark that each word but the first after a line break begins with is implied by its kind:
        plain bytes stand for one mark and the bytes, bytes that begin with a line break for the bytes alone,
        and bytes that begin with a space for all of their spaces as marks.
        """
        if not text:
            return []
        if b"\xe2\x96\x81" in text:
            text = text.replace(b"\xe2\x96\x81", b" ")
        words = text.replace(b"\n", b" \n").split(b" ")
        if text[:1] == b"\n" or b"" in words:
            return [x[1:] if x[:1] == b" " and x[1:2] not in (b" ", b"") else x for x in RUNS.findall(b" " + text)]
        return words

    def prefix_counts(self, words: list[bytes]) -> list[np.ndarray]:
        """For each word as ``split`` gives it: tokens of each prefix, by character (its space marks included)."""
        chars = [("" if x[:1] == b"\n" else SPACE if x[:1] != b" " else "") + x.decode().replace(" ", SPACE) for x in words]
        order = sorted(range(len(chars)), key=chars.__getitem__)
        sizes = np.fromiter((len(chars[i]) for i in order), np.int64, len(order))
        code = np.frombuffer("".join([chars[i] for i in order]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32).astype(np.int64)
        symbols = self.table[code].astype(np.int64)
        more = np.where((symbols == 0) & self.fallback, (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF), 0)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        more = np.concatenate([[0], np.cumsum(more)])
        out: list = [None] * len(words)
        for pick in self.merges.slabs(sizes):
            _, count = self.merges.last_tokens(padded(symbols, bounds, pick), sizes[pick])
            for row, i in enumerate(pick.tolist()):
                a, b = bounds[i], bounds[i + 1]
                out[order[i]] = (a, b, count[row, :b - a] + (more[a + 1:b + 1] - more[a]))
        return [c for _, _, c in out]

    def last_counts(self, words: list[bytes]) -> np.ndarray:
        """Tokens of each whole word: the count at its last prefix."""
        chars = [("" if x[:1] == b"\n" else SPACE if x[:1] != b" " else "") + x.decode().replace(" ", SPACE) for x in words]
        order = np.array(sorted(range(len(chars)), key=chars.__getitem__), dtype=np.int64)
        sizes = np.fromiter(map(len, chars), np.int64, len(chars))[order]
        code = np.frombuffer("".join([chars[i] for i in order]).encode("utf-32-le"), dtype=np.uint32).astype(np.int64)
        symbols = self.table[code].astype(np.int64)
        more = np.where((symbols == 0) & self.fallback, (code > 0x7F).astype(np.int64) + (code > 0x7FF) + (code > 0xFFFF), 0)
        bounds = np.concatenate([[0], np.cumsum(sizes)])
        more = np.concatenate([[0], np.cumsum(more)])
        out = np.zeros(len(words), dtype=np.int64)
        for pick in self.merges.slabs(sizes):
            _, count = self.merges.last_tokens(padded(symbols, bounds, pick), sizes[pick])
            out[order[pick]] = count[np.arange(len(pick)), sizes[pick] - 1] + more[bounds[pick + 1]] - more[bounds[pick]]
        return out

    def word_counts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, list[list[bytes]]]:
        """Token counts of all words of the texts, each text's bounds, and the words."""
        if self.index.full():
            self.totals = np.zeros(0, np.int64)
        split = [self.split(x) for x in texts]
        rows = self.index.rows(list(chain.from_iterable(split)))
        if new := self.index.fresh():
            self.totals = np.concatenate([self.totals, self.last_counts(new)])
        bounds = np.concatenate([[0], np.cumsum(np.fromiter(map(len, split), np.int64, len(split)))])
        return self.totals[rows], bounds, split

    def within(self, text: bytes, budget: int) -> bytes:
        """The longest prefix (whole characters) of a text that has at most ``budget`` tokens."""
        counts, _, split = self.word_counts([text])
        sums = np.cumsum(counts)
        full = int(np.searchsorted(sums, budget, side="right"))
        if full == len(sums):
            return text
        # at most one word is looked into; counts of its prefixes need not grow with the prefix
        spent = int(sums[full - 1]) if full else 0
        words = split[0]
        size = sum(len(x) + (x[:1] not in (b"\n", b" ")) for x in words[:full])
        own = np.flatnonzero(self.prefix_counts([words[full]])[0] <= budget - spent)
        marks = "" if words[full][:1] == b"\n" else " " if words[full][:1] != b" " else ""
        part = (marks + words[full].decode())[: int(own[-1]) + 1 if len(own) else 0]
        return (b" " + text)[1: max(1, size + len(part.encode()))]


RUNS = re.compile(rb"\n[^ \n]*| +[^ \n]*")


@lru_cache(maxsize=2)
def _counter(path: str) -> PieceCounts:
    return PieceCounts(path)


def token_counts(docs: DataFrame, model: str, *, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text", prefixes: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    With ``prefixes`` also ``word_counts``, the token count of each word in order: its running sum answers
    what a text cut after any word would cost.
    """

    def run(batches):
        counter = _counter(model)
        for part, texts in text_groups(batches):
            counts, bounds, _ = counter.word_counts(texts)
            sums = np.concatenate([[0], np.cumsum(counts)])
            n = sums[bounds[1:]] - sums[bounds[:-1]]
            columns = [part.column("doc_id"), pa.array(np.fromiter(map(len, texts), np.int64, len(texts))), pa.array(n), pa.array(n > limit)]
            names = ["doc_id", "n_bytes", "n_tokens", "over_limit"]
            if prefixes:
                columns.append(pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(counts.astype(np.int32))))
                names.append("word_counts")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = "doc_id long, n_bytes long, n_tokens long, over_limit boolean"
    return id_text(docs, id_col, text_col).mapInArrow(run, schema + ", word_counts array<int>" * prefixes)


def truncate(docs: DataFrame, model: str, budget: int, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the longest prefix of each text with at most ``budget`` tokens (NULL text: empty)."""

    def run(batches):
        counter = _counter(model)
        for part, texts in text_groups(batches):
            cut = [counter.within(x, budget).decode() for x in texts]
            yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(cut, pa.string())], names=["doc_id", "text"])

    return id_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, text string")
