"""Phrases, divergence of sources and fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_helpers import words

from cellroll.llm import divergence, fingerprints, phrases, winnowing

SCHEMA = "doc_id long, text string, lang string, source string, a long, rank string, part string, term int, guest string, d string"


@pytest.fixture(scope="module")
def rows():
    r = random.Random(3)
    vocabulary = ["".join(r.choice("abABé中'-9") for _ in range(r.randint(1, 4))) for _ in range(30)]
    vocabulary += ["".join(r.choice("abc") for _ in range(5)) for _ in range(400)]
    glue = [" ", " ", " ", "  ", "\t", ". ", "\n", ";", "\x0b", "\x00", " "]
    out = []
    for i in range(120):
        text = "".join(w + r.choice(glue) for w in words(r, vocabulary[: r.choice([5, 30, 430])], r.randint(0, 200)))
        out.append((i, text, r.choice(["en", "de", None, "und", ""]), r.choice(["s1", "s2", "s3", None, ""])))
    out += [(200, None, "en", "s1"), (201, "", "fr", "s9"), (202, " ,;", "fr", "s8"), (3, out[3][1], "en", "s4"), (3, out[3][1], "en", "s4"), (None, out[4][1], "de", "s1"), (None, "x", None, None)]
    out += [(300, "word " * 30_000, "en", "s5"), (301, "alone", "xx", "only")]
    return out


@pytest.fixture(scope="module")
def docs(spark, rows):
    from cellroll.llm.tables import importable

    importable(spark)
    return spark.createDataFrame([(*x, 1, "r", "p", 2, "g", "d") for x in rows], SCHEMA).repartition(5)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def brute_phrases(rows, least, top):
    n, f = Counter(), Counter()
    for _, text, lang, _ in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {k: a for k, a in f.items() if len(k[1]) > 1 and a >= least}
    out = defaultdict(list)
    for (lang, p), a in cand.items():
        if any(100 * b >= 50 * a for (o, q), b in cand.items() if o == lang and len(q) > len(p) and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))):
            continue
        score, k = min((1_000_000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out[lang].append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, x, y, n[lang], -s) for lang, found in out.items() for i, (s, a, p, x, y) in enumerate(sorted(found)[:top]))


@pytest.mark.parametrize("top", [2000, 7])
def test_phrases(docs, rows, top):
    got = phrases.collocations(docs, top=top)
    assert sorted(tuple(r)[:8] for r in got.collect()) == brute_phrases(rows, 10, top)


def test_first_places(docs, rows):
    text = {i: t for i, t, _, _ in rows if i is not None}
    for r in phrases.collocations(docs, top=50).collect():
        if r["first_doc"] is not None:
            here = lower(text[r["first_doc"]]).encode()[r["first_at"]:].decode()
            assert re.sub(r"[\x20\x09]+", " ", here).startswith(r["phrase"])


def test_collisions_come_apart(docs, rows, monkeypatch):
    """Fingerprints of 3 bits: nearly everything collides, and the result stays exact."""
    monkeypatch.setattr(phrases.Grams, "fingerprints", lambda self, n, real=phrases.Grams.fingerprints: ((lambda x: (x[0] & np.uint64(7 << 61), x[1]))(real(self, n))))
    data = np.frombuffer(b"a b a b. c d c d a b", np.uint8)
    grams = phrases.Grams(data, np.array([0, len(data)]), ["en"])
    fp, at = grams.fingerprints(2)
    first, count = grams.groups(np.zeros_like(fp), at, 2)
    raw = data.tobytes()
    found = {raw[grams.words.start[i]:grams.words.end[i + 1]]: c for i, c in zip(first.tolist(), count.tolist(), strict=True)}
    assert found == {b"a b": 3, b"b a": 1, b"c d": 2, b"d c": 1, b"d a": 1}
    words_ = fingerprints.word_numbers(data, grams.words, np.zeros(len(grams.row), np.uint64))
    assert words_.tolist() == [0, 1, 0, 1, 2, 3, 2, 3, 0, 1]


def test_large_counts_are_exact(spark):
    rows = [(10**13 + 7, 10**13 + 9, 10**14 + 3), (3, 3, 3), (10**15 - 1, 10**15 - 1, 10**15 - 1), (10, 12, 11)]
    df = spark.createDataFrame(rows, "a long, l long, r long")
    got = [x[0] for x in df.select(phrases.whole(df.a, df.l, df.r, 1_000_000)).collect()]
    assert got == [1_000_000 * a * a // (x * y) for a, x, y in rows]


def brute_divergence(rows, least, top):
    terms = [(lang or "", source or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))) for _, text, lang, source in rows]
    df, count = Counter(), Counter()
    for lang, source, w in terms:
        df.update((lang, x) for x in set(w))
        count.update((lang, source, x) for x in w)
    kept = {lang: sorted(x for o, x in df if o == lang and df[o, x] >= least) for lang, _, _ in terms}
    groups = sorted({(lang, source) for lang, source, _ in terms})

    def shares(lang, names):
        c = {x: sum(count[lang, s, x] for s in names) for x in kept[lang]}
        n = sum(c.values())
        return {x: 1 + 10**9 * (v + 2) // (n + 2 * len(c)) for x, v in c.items()}

    out = []
    for lang, source in groups:
        p = shares(lang, [source])
        others = [s for o, s in groups if o == lang]
        q = {s: shares(lang, [s]) for s in others if s != source}
        pair = sorted((-sum((p[x] - v[x]) ** 2 // (p[x] + v[x]) for x in p), s.encode()) for s, v in q.items())
        a = shares(lang, others)
        term = sorted((-((p[x] - a[x]) ** 2 // (p[x] + a[x])), x.encode()) for x in p if count[lang, source, x] and p[x] > a[x])[:top]
        out += [(lang, source, part, item.decode(), -v, i + 1) for part, found in (("pair", pair), ("term", term)) for i, (v, item) in enumerate(found)]
    return sorted(out)


@pytest.mark.parametrize("tile, terms", [(64, 4096), (1, 7)])
def test_divergence(docs, rows, tile, terms):
    got = divergence.source_divergence(docs, tile=tile, terms=terms)
    assert sorted(tuple(r) for r in got.collect()) == brute_divergence(rows, 10, 10)


def test_equal_subtrees_are_one_node():
    counts = np.tile(np.array([[1, 2, 1, 2, 0, 0, 0, 0]]), (3, 1))
    counts[2, 7] = 5
    levels, roots = divergence.trees(counts)
    assert [len(left) for left, _ in levels] == [3, 3, 2] and roots[0] == roots[1] != roots[2]
    pair, a, b, times = divergence.leaf_pairs(levels, roots[[0, 0]], roots[[1, 2]], 6)
    assert sorted(zip(pair.tolist(), a.tolist(), b.tolist(), times.tolist(), strict=True)) == [(0, 0, 0, 4), (0, 1, 1, 2), (0, 2, 2, 2), (1, 0, 0, 3), (1, 0, 5, 1), (1, 1, 1, 2), (1, 2, 2, 2)]


def test_shares_beyond_64_bits(spark):
    df = spark.createDataFrame([(10**13, 10**15, 10**7), (0, 0, 1)], "c long, n long, v long")
    got = [r[0] for r in df.select(divergence.share(df.c, df.n, df.v)).collect()]
    assert got == [1 + 10**9 * (c + 2) // (n + 2 * v) for c, n, v in [(10**13, 10**15, 10**7), (0, 0, 1)]]


def brute_winnow(text, gram, window, hash_of):
    h = [hash_of(text[i:i + gram]) for i in range(len(text) - gram + 1)] or ([hash_of(text)] if text else [])
    return sorted({min(range(i, min(i + window, len(h))), key=lambda j: (h[j], -j)) for i in range(max(1, len(h) - window + 1))}) if h else []


@pytest.mark.parametrize("gram, window", [(8, 24), (3, 4), (1, 1), (5, 255)])
def test_winnowing(rows, gram, window):
    texts = [t or "" for _, t, _, _ in rows if len(t or "") < 5000] + ["é", "aaaaaaaaaaaaaaaaaaaa", "中" * 50, "ab" * 40]
    raw = [t.encode() for t in texts]
    off = np.concatenate([[0], np.cumsum([len(x) for x in raw])])
    hashes, at, bounds, size = winnowing.winnowed(np.frombuffer(b"".join(raw), np.uint8), off, gram, window)
    assert size.tolist() == [len(t) for t in texts]
    seen = {}
    for i, text in enumerate(texts):
        # hashes of runs, from one-run texts
        def hash_of(run):
            if run not in seen:
                data = np.frombuffer(run.encode(), np.uint8)
                seen[run] = int(winnowing.winnowed(data, np.array([0, len(data)]), 10**6, 1)[0][0])
            return seen[run]

        a, b = bounds[i], bounds[i + 1]
        assert at[a:b].tolist() == brute_winnow(text, gram, window, hash_of)
        assert hashes[a:b].tolist() == [hash_of(text[j:j + gram]) for j in at[a:b].tolist()]
    for text, x in zip(winnowing.packed_prints(hashes, at, bounds), range(len(texts)), strict=True):
        h, p = winnowing.unpacked(text)
        assert h.tolist() == hashes[bounds[x]:bounds[x + 1]].tolist() and p.tolist() == at[bounds[x]:bounds[x + 1]].tolist()


def test_shared_stretches_share_a_hash():
    r = random.Random(1)
    for _ in range(50):
        middle = "".join(r.choice("ab c") for _ in range(8 + 24 - 1))
        pair = ["".join(r.choice("abcdé ") for _ in range(r.randint(0, 90))) + middle + "".join(r.choice("xyz") for _ in range(r.randint(0, 90))) for _ in range(2)]
        raw = [t.encode() for t in pair]
        hashes, _, bounds, _ = winnowing.winnowed(np.frombuffer(b"".join(raw), np.uint8), np.array([0, len(raw[0]), len(raw[0]) + len(raw[1])]))
        assert set(hashes[: bounds[1]].tolist()) & set(hashes[bounds[1]:].tolist())


def test_fingerprint_report(docs, rows):
    got = winnowing.fingerprint_report(docs).collect()
    assert len(got) == len(rows)
    # repeated ids and NULL ids: any order among themselves, so only ids of one row with such neighbours are compared
    known = defaultdict(list)
    for i, text, _, _ in rows:
        known[i].append(text or "")
    ids = sorted((i for i in known if i is not None), reverse=True)
    by_id = {r["doc_id"]: r for r in got}
    for i, after in zip(ids, ids[1:], strict=False):
        if i == 3 or after == 3 and known[i] == known[3]:
            continue
        text, follow = known[i][0], known[after][0]
        cut = len(text) // 3
        change = text[: len(text) - cut] + follow[:cut]
        r = by_id[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(text), hashlib.sha256(change.encode()).hexdigest())
        want = []
        for t in (text, change, follow):
            data = np.frombuffer(t.encode(), np.uint8)
            h, p, b, _ = winnowing.winnowed(data, np.array([0, len(data)]))
            want.append((winnowing.packed_prints(h, p, b)[0], Counter(h.tolist())))
        assert (r["fingerprint"], r["edited_fingerprint"]) == (want[0][0], want[1][0])
        for name, other in (("near_edited", want[1][1]), ("near_next", want[2][1])):
            union = sum((want[0][1] | other).values())
            assert r[name] == (sum((want[0][1] & other).values()) / union if union else 1.0)
    three = [r for r in got if r["doc_id"] == 3]
    assert len({r["fingerprint"] for r in three if r["n_chars"] == len(rows[3][1])}) == 1


def test_one_document_is_its_own_next(docs):
    r = winnowing.fingerprint_report(docs.where("doc_id = 7")).collect()
    assert len(r) == 1 and r[0]["near_next"] == 1.0


def test_fingerprints(docs, rows):
    got = winnowing.fingerprints(docs.where("doc_id = 10")).collect()[0]
    assert got["n_chars"] == len(rows[10][1]) and len(got["hashes"]) == len(got["positions"]) and got["positions"] == sorted(got["positions"])


def test_empty_tables(docs):
    none = docs.where("false")
    assert phrases.collocations(none).count() == 0 and divergence.source_divergence(none).count() == 0
    assert winnowing.fingerprint_report(none).count() == 0 and winnowing.fingerprints(none).count() == 0


def test_packed_fingerprints_travel_as_short_steps(spark):
    """Some 5 bytes each as sorted 64-bit numbers, under 4 as steps of 40 bits; and what is frequent is found."""
    r = np.random.default_rng(3)
    fps, counts = fingerprints.counted(r.integers(0, 2**64, 200_000, dtype=np.uint64))
    for ranges in (1, 3):
        rows = list(fingerprints.packed(fps, counts, ranges))
        assert sum(len(pa.compress(x.as_py(), "lz4", asbytes=True)) for rb in rows for x in rb.column("fps")) < 4 * len(fps)
    some = fps[::100]
    rows = [x for f, n in ((fps, 1), (some, 2), (some[::2], 1)) for rb in fingerprints.packed(f, np.full(len(f), n), 3) for x in rb.to_pylist()]
    bits = fingerprints.frequent(spark.createDataFrame([(x["range"], x["fps"], x["counts"]) for x in rows], fingerprints.PACKED), 4)
    assert fingerprints.has(bits, some[::2]).all()
    assert fingerprints.has(bits, fps).mean() < 0.02
