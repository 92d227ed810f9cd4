"""The pipeline's stages, each on its own input, and the whole run."""

import random

import duckdb
import pyarrow as pa
import pytest
from llm_helpers import SMALL, words

import __spark_entry__ as entry
import corpus_pipeline
from cellroll.llm import arrays, bpe_codec, jaccard_join, queries, substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars", "key", "span_key"]
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture()
def docs(spark, vocabulary):
    r = random.Random(8)
    texts = [" ".join(words(r, vocabulary, 60)) for _ in range(20)]
    texts[5] = texts[2] + " tail"
    texts[9] = " ".join(texts[3].split()[10:50] + texts[9].split()[:30])
    rows = [(i, t, "en", "src", len(t), 1, "k") for i, t in enumerate(texts)]
    rows += [(30, None, None, None, None, 2, "k"), (31, "", "en", "src", 0, 2, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, key int, span_key string")


@pytest.mark.parametrize("odd", [False, True])
def test_stages(spark, docs, odd):
    if odd:  # a repeated row and a row without an id
        docs = docs.unionByName(docs.where("doc_id = 7")).unionByName(docs.where("doc_id = 8").selectExpr("cast(null as long) as doc_id", "concat('x ', text) as text", "lang", "source", "n_chars", "key", "span_key"))
    one = STAGES["ngram_jaccard_join"](spark, docs, SMALL)
    assert one.columns == COLUMNS
    rows = one.collect()
    ids = sorted([r["doc_id"] for r in rows if r["doc_id"] is not None])
    assert ids == sorted({i for i in [*range(20), 30, 31]} - {5} - ({8} if odd and None in [r["doc_id"] for r in rows] else set()))
    cut = STAGES["substring_dedup"](spark, docs, SMALL)
    assert cut.columns == COLUMNS
    text = {r["doc_id"]: (r["text"], r["n_chars"]) for r in cut.collect() if r["doc_id"] is not None}
    source = {r["doc_id"]: r["text"] for r in docs.collect() if r["doc_id"] is not None}
    assert text[9] == (" ".join(source[9].split()[40:]), len(" ".join(source[9].split()[40:])))
    assert text[5][0] == "tail" and text[2][0] == source[2] and text[30] == (None, None) and text[31] == ("", 0)
    assert all(text[i][0] == source[i] for i in (0, 1, 3, 4))


def test_leaks_go_and_clean_documents_stay(spark, docs):
    bench = spark.read.parquet(f"{SMALL}/benchmark.parquet").limit(1).collect()[0]["text"]
    dirty = docs.unionByName(spark.createDataFrame([(77, "so " + bench, "en", "s", 1, 1, "k")], docs.schema))
    out = STAGES["benchmark_decontamination"](spark, dirty, SMALL)
    assert out.columns == COLUMNS and sorted(r["doc_id"] for r in out.collect()) == [*range(20), 30, 31]


def test_toxic_stage_keeps_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    out = STAGES["toxicity"](spark, docs, SMALL)
    assert out.schema == docs.schema and 0.8 * docs.count() < out.count() <= docs.count()


def test_empty_input(spark, docs):
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), SMALL).count() == 0


def test_whole_run(spark):
    out = corpus_pipeline.run(spark, SMALL)
    n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
    rows = out.collect()
    assert 0.5 * n < len(rows) < n and len({r["doc_id"] for r in rows}) == len(rows)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "substring_dedup", "benchmark_decontamination", "bpe_encode_decode"]


def test_registered():
    own = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in own) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_sql_twins(spark):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMALL}/{t}.parquet')")
    for name, sql in queries.ORACLES.items():
        got = queries.QUERIES[name](spark, SMALL)
        cols = sorted(got.columns)
        want = con.execute(f"SELECT {', '.join(cols)} FROM ({sql})").fetchall()
        assert sorted(tuple(r) for r in got.select(cols).collect()) == sorted(want)


@pytest.mark.parametrize("name, keeps", [("ngram_jaccard_join", lambda rows: sorted(r["doc_id"] for r in rows)), ("substring_dedup", lambda rows: sorted((r["doc_id"], r["text"] or "") for r in rows))])
def test_one_repeated_id_leaves_the_others_alone(spark, docs, name, keeps):
    """Of equal documents 2 and 5 the first stays first, also while document 7 is there twice and rows are read in another order."""
    docs = docs.where("doc_id <> 5").unionByName(docs.where("doc_id = 2").selectExpr("5L as doc_id", "text", "lang", "source", "n_chars", "key", "span_key"))
    plain = [r for r in STAGES[name](spark, docs, SMALL).collect() if r["doc_id"] != 7]
    odd = docs.unionByName(docs.where("doc_id = 7")).orderBy("doc_id", ascending=False).repartition(3)
    again = [r for r in STAGES[name](spark, odd, SMALL).collect() if r["doc_id"] != 7]
    assert keeps(again) == keeps(plain)


def test_numbers_sort_like_ids(spark):
    from cellroll.llm.tables import numbered

    r = random.Random(3)
    ids = [None, None, *[r.randint(-50, 50) for _ in range(300)]]
    rows = numbered(spark.createDataFrame([(i, str(n % 7), n) for n, i in enumerate(ids)], "doc_id long, text string, row_number long").repartition(5), "d").collect()
    assert sorted(x["d"] for x in rows) == list(range(len(ids))) and sorted(x["row_number"] for x in rows) == list(range(len(ids)))
    low = float("-inf")
    by_number = [low if x["doc_id"] is None else x["doc_id"] for x in sorted(rows, key=lambda x: x["d"])]
    assert by_number == sorted(by_number)


def test_workers_drop_what_earlier_stages_held(monkeypatch):
    """A worker that encoded texts goes on to other stages without the vocabulary and the words it knows."""
    made = []
    monkeypatch.setattr(bpe_codec, "WordBpe", lambda path: made.append(path) or [path])
    monkeypatch.setattr(arrays, "_HELD", {})
    text = pa.array(["some words", None])
    for stage in (1, 1, 2):
        monkeypatch.setattr(arrays, "_stage", lambda stage=stage: stage)
        coder = bpe_codec._coder("p")
        list(arrays.blocks(text))
        assert bpe_codec._coder("p") is coder  # kept as long as its own stage reads texts
    assert made == ["p"]  # and handed on where the next stage takes it first
    monkeypatch.setattr(arrays, "_stage", lambda: 3)
    list(arrays.blocks(text))
    assert not arrays._HELD
    bpe_codec._coder("p")
    assert made == ["p", "p"]


@pytest.mark.parametrize("rows, most", [(2000, 64e6), (20, 12e6)])
def test_memory_of_a_worker(vocabulary, monkeypatch, rows, most):
    """Hashing takes blocks of texts, and tables no longer than these, whatever the batch."""
    import tracemalloc

    r = random.Random(9)
    texts = [" ".join(words(r, vocabulary, 600)) for _ in range(rows)]  # some 2,200 bytes each
    batch = pa.RecordBatch.from_pydict({"d": list(range(rows)), "text": texts})
    monkeypatch.setattr(arrays, "_POWERS", {})
    for run in (lambda: jaccard_join._blocks([batch], 5), lambda: substring_dedup.repeats().anchors(False)([batch])):
        tracemalloc.start()
        n = sum(1 for _ in run())
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert n >= 1 and peak < most, peak
