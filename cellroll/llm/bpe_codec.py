"""BPE encoding and decoding of whole texts with a word-end vocabulary (tokenizers .json).

Method: prefix-sharing trie traversal.  The distinct words of a batch are sorted, which is the depth-first
order of their trie; the last token of every prefix is carried from parent to child, and a prefix that
several words share is encoded once (``merges.Merges.last_tokens``).  Texts are then put together from
their words' tokens.

Empty and NULL texts have no tokens.  Repeated rows give repeated rows.  Words are remembered between
batches, at most WORDS_KEPT of them.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .arrays import WordIndex, held, ramp, text_groups
from .merges import Merges, padded
from .tables import id_text

WORDS_KEPT = 800_000
GROUP = 2 << 20  # bytes of text that are cut into words at a time
SCHEMA = "doc_id long, n_tokens long, ids binary, decoded string"
DIGEST = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_characters() -> list[str]:
    """The printable character that byte-level vocabularies write for each byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    spare = iter(range(256, 512))
    return [chr(b if b in plain else next(spare)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the kind: NFC, lower case, pattern split, bytes, word-end suffix, no decoder."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"]
        pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(r"\n|" + pattern)
        # outside these characters, and where a special token may stand, the library's own splitter decides:
        # Unicode versions differ in what is a letter
        self.unusual = re.compile(r"[^\n\x21-\x7e\xa1-\u02ff]|<\|")
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.split_special = regex.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self.byte_of = {c: b for b, c in enumerate(byte_characters())}
        symbol = {c: b + 1 for c, b in self.byte_of.items()}
        symbol |= {c + self.suffix: b + 256 for c, b in symbol.items()}
        tokens = {}
        for text, k in model["vocab"].items():
            end = text.endswith(self.suffix) and len(text) > len(self.suffix)
            body = text[: -len(self.suffix)] if end else text
            tokens[k] = (*(symbol[c] for c in body[:-1]), symbol[body[-1] + self.suffix * end])
        vocab, ranks = model["vocab"], {}
        for i, pair in enumerate(model["merges"]):
            a, b = pair.split(" ") if isinstance(pair, str) else pair
            ranks.setdefault((vocab[a], vocab[b]), (i, vocab[a + b]))
        self.merges = Merges(tokens, ranks)
        names = [""] * (max([*vocab.values(), *self.special.values()]) + 1)
        for text, k in [*vocab.items(), *self.special.items()]:
            names[k] = text
        self.names = [x.encode() for x in names]
        self.index = WordIndex(WORDS_KEPT)
        self.tokens = np.zeros(0, np.int32)  # of all known raw words, end to end
        self.bounds = np.zeros(1, np.int64)
        self.library = Tokenizer.from_file(path)

    def pieces_of(self, word: bytes) -> list:
        """Clean words and special ids of one raw word, by the library's own normaliser and splitter."""
        text, out = word.decode(), []
        for part in self.split_special.split(text) if self.split_special else [text]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                clean = self.library.normalizer.normalize_str(part)
                for x, _ in self.library.pre_tokenizer.pre_tokenize_str(clean):
                    out.append(bytes(self.byte_of[c] for c in x))
        return out

    def learn(self, raw: list[bytes]) -> None:
        """Encode raw words (no ASCII white space inside) that aren't known yet, in the order of their numbers."""
        fresh = raw
        joined = b"\n".join(raw).decode()
        hard = [] if self.unusual.search(joined) is None else [x for x in raw if self.unusual.search(x.decode())]
        if hard:
            drop = set(hard)
            raw = [x for x in raw if x not in drop]
            joined = b"\n".join(raw).decode()
        # for usual characters: one normalisation and one split of all words at once, line by line
        flat = self.pieces.findall(unicodedata.normalize("NFC", joined).lower()) if raw else []
        items = "\n".join(["" if x == "\n" else x for x in flat]).encode().split(b"\n") if flat else []
        rest = {x: self.pieces_of(x) for x in hard}
        clean = sorted({*items, *(y for p in rest.values() for y in p if isinstance(y, bytes))} - {b""})
        code = dict(zip(clean, self.encode(clean), strict=True))
        code |= {v: [v] for v in self.special.values()}
        found: dict[bytes, list[int]] = {}
        words, at = iter(raw), 0
        while at < len(items):  # an empty item ends a line
            word = next(words)
            own = code[items[at]]
            at += 1
            while at < len(items) and items[at]:
                own, at = own + code[items[at]], at + 1
            found[word] = own
            at += 1
        for word, p in rest.items():
            found[word] = [t for y in p for t in code[y]]
        size = np.fromiter((len(found[x]) for x in fresh), np.int64, len(fresh))
        self.bounds = np.concatenate([self.bounds, self.bounds[-1] + np.cumsum(size)])
        own = np.fromiter(chain.from_iterable(found[x] for x in fresh), np.int32, int(size.sum()))
        self.tokens = np.concatenate([self.tokens, own])

    def encode(self, clean: list[bytes]) -> list[list[int]]:
        """Ids of each of the sorted distinct words, by the trie walk."""
        size = np.fromiter(map(len, clean), dtype=np.int64, count=len(clean))
        bounds = np.concatenate([[0], np.cumsum(size)])
        symbols = np.frombuffer(b"".join(clean), dtype=np.uint8).astype(np.int64) + 1
        symbols[bounds[1:] - 1] += 256  # the last symbol of a word carries the suffix
        out: list = [None] * len(clean)
        for pick in self.merges.slabs(size):
            token, count = self.merges.last_tokens(padded(symbols, bounds, pick), size[pick])
            flat, ends = self.merges.spell(token, count, size[pick])
            ids, ends = flat.tolist(), ends.tolist()
            for i, a, b in zip(pick.tolist(), ends, ends[1:], strict=False):
                out[i] = ids[a:b]
        return out

    def texts(self, texts: list[bytes]) -> Iterator[np.ndarray]:
        """Ids of each text, as unsigned 32-bit integers."""
        if self.index.full():
            self.tokens, self.bounds = np.zeros(0, np.int32), np.zeros(1, np.int64)
        split = [x.split() for x in texts]
        rows = self.index.rows(list(chain.from_iterable(split)))
        if new := self.index.fresh():
            self.learn(new)
        start = self.bounds[rows]
        size = self.bounds[rows + 1] - start
        ids = self.tokens[np.repeat(start, size) + ramp(size)].astype("<u4")
        ends = np.concatenate([[0], np.cumsum(size)])
        at = 0
        for parts in split:
            yield ids[ends[at]:ends[at + len(parts)]]
            at += len(parts)

    def decode(self, ids: np.ndarray) -> bytes:
        """The tokens' own strings with a space between, as a vocabulary without a decoder gives them."""
        return b" ".join(map(self.names.__getitem__, ids.tolist()))


def _coder(path: str) -> WordBpe:
    """The vocabulary and the words known by it, for one stage: a worker that goes on to another one has no use for them."""
    return held(("word_bpe", path), lambda: WordBpe(path))


def encode_decode(docs: DataFrame, vocabulary: str, *, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids (binary, little-endian uint32) and decoded text of every document.

    With ``digests`` the last two are their SHA-256 in lowercase hex, ids_sha256 and decoded_sha256.
    ``vocabulary`` is the path of the vocabulary file, the same on every machine.
    """

    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] if digests else ["doc_id", "n_tokens", "ids", "decoded"]

    def run(batches):
        coder = _coder(vocabulary)
        for part, texts in text_groups(batches, limit=GROUP):
            n, first, second = [], [], []
            for ids in coder.texts(texts):
                data, text = ids.tobytes(), coder.decode(ids)
                n.append(len(ids))
                first.append(hashlib.sha256(data).hexdigest() if digests else data)
                second.append(hashlib.sha256(text).hexdigest() if digests else text.decode())
            kinds = (pa.string(), pa.string()) if digests else (pa.binary(), pa.string())
            columns = [part.column("doc_id"), pa.array(n, pa.int64()), pa.array(first, kinds[0]), pa.array(second, kinds[1])]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return id_text(docs, id_col, text_col).mapInArrow(run, DIGEST if digests else SCHEMA)
