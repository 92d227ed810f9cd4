"""Encoding, decoding and token counts against the libraries."""

import hashlib
import struct

import public_tokenizers
import pytest
from tokenizers import Tokenizer

from cellroll.llm.bpe_codec import encode_decode
from cellroll.llm.token_counts import PieceCounts, token_counts, truncate

VOCABULARY, MODEL = public_tokenizers.path("word_bpe_49k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "   ", "\n", "\n\n a", " \n", "a  b   c", "Hello world's I'LL 123 ab12", "<|endoftext|>x<|startoftext|> <s></s><unk><0x41>",
    "É é İstanbul ΣΑΣ ß ǅ ﬁ    \x1c\x85 á 日本語🎉", "don't'd ''s ___ --- 1.5e3", "՘x࢏y", "▁a ▁▁ b", "x\x00y", "a" * 3000, "ab " * 2000, "z" * 70 + " " * 41,
]


def sentencepiece_counts(texts):
    import sentencepiece

    return [len(x) for x in sentencepiece.SentencePieceProcessor(model_file=MODEL).encode([t or "" for t in texts], num_threads=1)]


def test_encode_decode_equals_the_library(frame):
    rows = [*enumerate(TEXTS), (3, TEXTS[8]), (3, TEXTS[8]), (None, "null id")]
    got = encode_decode(frame(rows), VOCABULARY).collect()
    assert len(got) == len(rows)
    library = Tokenizer.from_file(VOCABULARY)
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((i, len(ids), struct.pack(f"<{len(ids)}I", *ids), library.decode(ids, skip_special_tokens=False)))
    key = lambda r: (r[0] is None, r[0] or 0, r[1], bytes(r[2]))
    assert sorted([(r["doc_id"], r["n_tokens"], bytes(r["ids"]), r["decoded"]) for r in got], key=key) == sorted(want, key=key)


def test_digests(frame):
    r = encode_decode(frame([(1, "Hello you")]), VOCABULARY, digests=True).collect()[0]
    ids = Tokenizer.from_file(VOCABULARY).encode("Hello you", add_special_tokens=False).ids
    assert r["ids_sha256"] == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert r["decoded_sha256"] == hashlib.sha256(b"hello</w> you</w>").hexdigest()


def test_every_character_like_the_library():
    from cellroll.llm.bpe_codec import WordBpe

    library, own = Tokenizer.from_file(VOCABULARY), WordBpe(VOCABULARY)
    texts = [f"x{chr(c)}y {chr(c)}" for c in range(0, 0x11000) if not 0xD800 <= c < 0xE000]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in own.texts([t.encode() for t in texts])] == want


def test_token_counts_equal_the_library(frame):
    rows = [*enumerate(TEXTS), (3, TEXTS[8]), (None, "null id")]
    got = token_counts(frame(rows), MODEL, limit=100, prefixes=True).collect()
    want = sorted((i if i is not None else -1, len((t or "").encode()), n, n > 100) for (i, t), n in zip(rows, sentencepiece_counts([t for _, t in rows]), strict=True))
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in got) == want
    assert all(sum(r["word_counts"]) == r["n_tokens"] for r in got)


def test_counts_at_every_prefix_of_a_word():
    counter = PieceCounts(MODEL)
    for word in ("internationalisation", "日本é語", "aaaaaaaaaaaaaaaaaaaa"):
        got = counter.prefix_counts([word.encode()])[0]  # the space mark comes first
        assert got[1:].tolist() == sentencepiece_counts([word[:k] for k in range(1, len(word) + 1)])


@pytest.mark.parametrize("text", ["Hello there  big world of \n tokens é 日本語 and so on", "\nab", "   x  "])
def test_truncate_gives_the_longest_prefix(frame, text):
    for budget in range(0, 25, 3):
        cut = truncate(frame([(1, text)]), MODEL, budget).collect()[0]["text"]
        fits = [k for k, n in enumerate(sentencepiece_counts([text[:k] for k in range(len(text) + 1)])) if n <= budget]
        assert cut == text[: max(fits)]


def test_empty_tables(frame):
    assert encode_decode(frame([]), VOCABULARY).count() == 0
    assert token_counts(frame([]), MODEL).count() == 0
