"""Toxicity and language: held-out quality, odd rows, marginals."""

import random
import zlib

import numpy as np
import pyarrow as pa
from llm_helpers import SF

from cellroll.llm import langid_crf, queries, toxicity


def held(i):
    return zlib.crc32(str(i).encode()) % 3 == 1


def labelled(n=600):
    r = random.Random(3)
    bad = ["grumblefax", "snorkwit", "plodderbex"]
    common = ["".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(300)]
    rows, labels = [], []
    for i in range(n):
        own = [r.choice(common) for _ in range(30)]
        if i % 4 == 0:
            for _ in range(3):
                own[r.randrange(30)] = r.choice(bad)
        rows.append((i, " ".join(own)))
        labels.append((i, int(i % 4 == 0), 9))
    return rows, labels, common


def test_scores_and_odd_rows(frame, spark):
    rows, labels, common = labelled()
    extra = [(1001, " ".join(common[:30])), (1002, None), (1003, ""), (1004, "!!! 123"), (1005, "word " * 40_000), (None, common[0]), (7, rows[7][1])]
    got = toxicity.toxicity(frame(rows + extra), spark.createDataFrame(labels, "doc_id long, toxic int, text long")).collect()
    assert len(got) == len(rows) + len(extra) and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in got)
    score = {r["doc_id"]: r["score"] for r in got}
    assert score[1001] < 0.3
    assert score[1002] == score[1003] and score[1002] < 0.7
    assert {r["doc_id"]: r["held_out"] for r in got if r["doc_id"] is not None} == {i: held(i) for i, _ in rows + extra if i is not None}
    out = [r for r in got if r["doc_id"] is not None and r["doc_id"] < 600 and r["held_out"]]
    assert np.mean([(r["doc_id"] % 4 == 0) == (r["predicted"] == 1) for r in out]) > 0.85


def test_held_out_quality_and_unseen_misspellings(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.learn(docs.select("doc_id", "text"), labels)
    known = {r["doc_id"]: r["toxic"] for r in labels.collect()}
    rows = [r for r in docs.collect() if r["doc_id"] in known and held(r["doc_id"])]
    clean = [r["text"] for r in rows if not known[r["doc_id"]] and r["lang"] == "en" and 100 < len(r["text"].split()) < 300][:40]
    bad = ["idiotts", "stupidd", "pathetiic", "disgustingg", "worthlless", "morons"]
    assert not any(w in r["text"] for r in rows for w in bad)
    spoilt = [t + " " + " ".join(bad) for t in clean]
    batch = pa.RecordBatch.from_pydict({"text": [r["text"] for r in rows] + clean + spoilt})
    scores = np.concatenate([p for _, p in toxicity.scorer(model)([batch], "text")])
    y = np.array([known[r["doc_id"]] for r in rows])
    own, a, b = scores[: len(rows)], scores[len(rows): len(rows) + len(clean)], scores[-len(clean):]
    order = own.argsort().argsort()
    n = int(y.sum())
    assert (order[y == 1].sum() - n * (n - 1) / 2) / (n * (len(y) - n)) > 0.85
    assert ((own >= 0.7) & (y == 1)).sum() > 0.7 * (own >= 0.7).sum()
    assert np.median(b) > 0.7 and np.median(a) < 0.1


def test_without_labels(frame, spark):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in toxicity.toxicity(frame([(1, "a"), (2, None)]), none).collect()} == {0.5}
    assert toxicity.toxicity(frame([]), none).count() == 0
    one = spark.createDataFrame([(1, 0), (2, None), (3, 5), (4, 0), (4, 1)], "doc_id long, toxic int")
    assert all(r["predicted"] == 0 for r in toxicity.toxicity(frame([(i, "a b") for i in range(5)]), one).collect())


def test_labels_of_held_out_rows_are_not_read(frame, spark):
    rows, labels, _ = labelled(120)
    flipped = [(i, 1 - y if held(i) else y, z) for i, y, z in labels]
    a, b = ({r["doc_id"]: r["score"] for r in toxicity.toxicity(frame(rows), spark.createDataFrame(x, "doc_id long, toxic int, n int")).collect()} for x in (labels, flipped))
    assert a == b


def test_filter_keeps_columns(frame, spark):
    rows, labels, _ = labelled()
    docs = frame(rows)
    kept = toxicity.keep_clean(docs, spark.createDataFrame(labels, "doc_id long, toxic int, n int"))
    assert kept.schema == docs.schema and 440 <= kept.count() <= 480


def brute_marginals(e, step):
    n, k = e.shape
    a = [e[0] / e[0].sum()]
    for t in range(1, n):
        v = (a[-1] @ step) * e[t]
        a.append(v / v.sum())
    b, total = np.ones(k), np.zeros(k)
    for t in range(n - 1, -1, -1):
        g = a[t] * b
        total += g / g.sum()
        b = step @ (e[t] * b)
        b /= b.sum()
    return total


def test_marginals_of_long_and_short_texts():
    r = np.random.default_rng(1)
    size = np.array([0, 5, 1, 256, 257, 900, 0, 513])
    e, step = r.random((size.sum(), 3)) + 0.01, np.exp(r.normal(0, 1, (3, 3)))
    at = np.cumsum(size) - size
    want = np.array([brute_marginals(e[a:a + n], step) if n else np.zeros(3) for a, n in zip(at, size, strict=True)])
    assert np.abs(langid_crf.marginals(e, size, step) - want).max() < 1e-9


def test_marginals_of_many_states():
    r = np.random.default_rng(2)
    size = np.array([3, 0, 600, 40])
    e, step = r.random((size.sum(), 70)) + 0.01, np.exp(r.normal(0, 1, (70, 70)))
    at = np.cumsum(size) - size
    want = np.array([brute_marginals(e[a:a + n], step) if n else np.zeros(70) for a, n in zip(at, size, strict=True)])
    assert np.abs(langid_crf.marginals(e, size, step) - want).max() < 1e-9


def test_every_language_is_learned(spark):
    r = random.Random(6)
    own = ["".join(r.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(80 * 12)]
    rows = []
    for k in range(80):  # the later a language, the rarer
        for _ in range(6 + (80 - k) // 8):
            rows.append((len(rows), " ".join(r.choice(own[k * 12:k * 12 + 12]) for _ in range(40)), f"l{k:02}"))
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {x["doc_id"]: x["lang_pred"] for x in langid_crf.language(df).collect()}
    learned = {lang for i, _, lang in rows if not held(i)}
    assert len(learned) > 75 and learned <= set(got.values())
    assert np.mean([got[i] == lang for i, _, lang in rows if held(i) and lang in learned]) > 0.95


def test_language_accuracy(spark):
    got = queries.op6_langid_crf(spark, SF).collect()
    want = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = [r for r in got if r["held_out"]]
    assert len(got) == len(want) and {r["doc_id"]: r["held_out"] for r in got} == {i: held(i) for i in want}
    assert np.mean([r["lang_pred"] == want[r["doc_id"]] for r in out]) > 0.98


def test_language_odd_rows_and_switches(spark):
    a, b = ["lorem", "ipsum", "dolor"], ["quick", "brown", "fox"]
    r = random.Random(1)
    rows = [(i, " ".join(r.choice(a if i % 2 else b) for _ in range(40)), "aa" if i % 2 else "bb") for i in range(60)]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "123 !!", "bb"), (103, " ".join(a * 30 + b * 10), None), (None, "quick fox", None), (104, "lorem " * 30_000, None), (1, rows[1][1], "aa")]
    df = spark.createDataFrame([(*x, 1.0) for x in rows], "doc_id long, text string, lang string, score double")
    got = {}
    for x in langid_crf.language(df).collect():
        got.setdefault(x["doc_id"], []).append((x["lang_pred"], x["score"]))
    assert got[100] == got[101] == got[102] == [("und", 0.0)] and len(got[1]) == 2
    assert got[103][0][0] == "aa" and 0.6 < got[103][0][1] < 0.9 and got[None][0][0] == "bb" and got[104][0][0] == "aa"
    none = langid_crf.language(df.withColumn("lang", df.lang.substr(0, 0)).where("false"))
    assert none.count() == 0


def test_labels_of_absent_documents_change_nothing(spark):
    """Labels may cover more than the documents: those of others neither fill the sample nor move the shares."""
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    more = labels.unionByName(spark.range(10**6, 10**6 + 20_000).selectExpr("id as doc_id", "1L as quality", "cast(id % 2 as bigint) as toxic"), allowMissingColumns=True)
    one, two = (toxicity.learn(docs.select("doc_id", "text"), x, rows=100) for x in (labels.select("doc_id", "quality", "toxic"), more.select("doc_id", "quality", "toxic")))
    assert one.bias == two.bias and (one.weight == two.weight).all()


def test_scores_are_plain_means(spark):
    """The scorer against its definition, one word and one n-gram at a time; and the same bits in every process."""
    import numpy as np

    from cellroll.llm.subwords import grams, plain_words

    model = toxicity.Model(np.random.default_rng(4).normal(0, 1, toxicity.BUCKETS), -1.5)
    texts = ["", "  ", "Foo bar foo, baz!", "é 12 -- x", "word " * 50 + "other"]
    table = pa.record_batch({"text": pa.array([*texts, None])})
    got = np.concatenate([p for _, p in toxicity.scorer(model)(iter([table]), "text")])
    for text, score in zip([*texts, ""], got, strict=True):
        words = list(dict.fromkeys(text.encode().split()))
        shares = []
        for w in words:
            buckets, _ = grams(plain_words([w]), toxicity.LOW, toxicity.HIGH, toxicity.BUCKETS)
            shares.append(model.weight[buckets].mean() if len(buckets) else 0.0)
        want = 1 / (1 + np.exp(-(model.bias + toxicity.SCALE * sum(shares) / (len(words) + toxicity.PAD))))
        assert abs(score - want) < 1e-12


def test_marginals_of_words():
    """Each word's probabilities against all paths, in short texts and in such that are cut into chunks."""
    rng = np.random.default_rng(8)
    step = np.exp(rng.normal(0, 1, (3, 3)))
    size = np.array([0, 1, 4, 0, langid_crf.CHUNK * 2 + 5, 3])
    e = np.exp(rng.normal(0, 1, (size.sum(), 3)))
    words = np.zeros_like(e)
    total = langid_crf.marginals(e, size, step, words)
    bounds = np.concatenate([[0], np.cumsum(size)])
    assert np.allclose(words.sum(axis=1), 1) and np.allclose([words[a:b].sum(axis=0) for a, b in zip(bounds, bounds[1:], strict=False)], total)
    import itertools

    for a, n in ((1, 4), (bounds[5], 3)):
        paths = list(itertools.product(range(3), repeat=n))
        weight = np.array([np.prod([e[a + i, s] for i, s in enumerate(p)]) * np.prod([step[x, y] for x, y in itertools.pairwise(p)]) for p in paths])
        for i in range(n):
            want = [weight[[p[i] == s for p in paths]].sum() / weight.sum() for s in range(3)]
            assert np.allclose(words[a + i], want)


def test_spans_cover_the_words_of_texts_with_letters():
    keep = np.array([0, 1, 1, 0, 1, 1, 0, 0, 0, 1], bool)
    best, score = np.array([0, 0, 1, 1, 0]), np.array([0.5, 1.0, 0.6, 0.8, 0.9])
    got = langid_crf.spans_of(best, score, keep, np.array([0, 7, 7, 8, 10]))
    assert [x.tolist() for x in got[:4]] == [[0, 0, 3], [0, 4, 0], [4, 3, 2], [0, 1, 0]] and np.allclose(got[4], [0.75, 0.7, 0.9])
    assert [len(x) for x in langid_crf.spans_of(best[:0], score[:0], keep[:0], np.array([0, 0]))] == [0] * 5


def test_code_switched_texts(spark):
    """Halves of documents of two languages put together: the words of each half get its language."""
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    rows = [r for r in docs.where("length(text) between 400 and 1500").collect()]
    by = {x: [r for r in rows if r["lang"] == x and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1][:8] for x in ("de", "en")}
    mixed, truth = [], {}
    for i, (a, b) in enumerate(zip(by["de"], by["en"], strict=False)):
        left, right = a["text"].split()[:40], b["text"].split()[:40]
        mixed.append((10**9 + 3 * i, " ".join(left + right), None))
        truth[10**9 + 3 * i] = ["de"] * len(left) + ["en"] * len(right)
    more = [(10**10, None, "de"), (10**10 + 1, "12 -- 7", None)]
    out = langid_crf.language_spans(docs.unionByName(spark.createDataFrame(mixed + more, docs.schema)))
    got = {r["doc_id"]: r["spans"] for r in out.where("doc_id >= 1000000000").collect()}
    assert got[10**10] == [] and got[10**10 + 1] == [] and len(truth) >= 4
    good = total = 0
    for i, want in truth.items():
        labels = [s["lang"] for s in got[i] for _ in range(s["words"])]
        assert len(labels) == len(want) and [s["first"] for s in got[i]] == np.cumsum([0, *[s["words"] for s in got[i]]])[:-1].tolist()
        good += sum(x == y for x, y in zip(labels, want, strict=True))
        total += len(want)
    assert good > 0.95 * total


def test_training_keeps_numbers_of_words_only(monkeypatch):
    """The driver holds a number for each word of the sample, not the word, and drops each text as it is taken."""
    import tracemalloc

    r = random.Random(8)
    words = [f"word{i}" for i in range(1000)]
    texts = [" ".join(r.sample(words, 300)).encode() for _ in range(2000)]
    monkeypatch.setattr(toxicity, "EPOCHS", 1)
    monkeypatch.setattr(toxicity, "BATCH", 8)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 1)
    monkeypatch.setattr(toxicity, "BUCKETS", 1 << 10)
    toxicity.train(texts[:2], np.arange(2), (0.5, 0.5))  # tables that are made once
    tracemalloc.start()
    toxicity.train(texts, np.arange(2000) % 2, (0.5, 0.5))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16e6, peak  # 600,000 words: 2.4 MB as numbers, some 30 MB as words
    sample = [{"text": x} for x in ("b a b", None, "c")]
    assert list(toxicity.handed_out(sample)) == [b"b a b", b"", b"c"] and not sample
    found, rows, bounds = toxicity.numbered_words([b"b a b", b"", b"a C"])
    assert found == ["b", "a", "c"] and rows.tolist() == [0, 1, 1, 2] and bounds.tolist() == [0, 2, 2, 4]
