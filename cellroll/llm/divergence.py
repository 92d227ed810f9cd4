"""How the sources of a language differ in their words: hash-consed segment trees over the term counts of each source.

A language keeps the terms that stand in enough of its documents; its term ids are cut into blocks.  In a block,
a source's counts are the leaves of a binary tree.  Equal subtrees, of whatever sources, are one node.  Two
sources are priced by walking their trees together from the roots: a pair of nodes that comes up several times
is walked once and carries how often it came up, down to pairs of counts, each of them priced once.  Sums over
the blocks are the divergence of the two sources.  Sources are dealt into tiles, so that a task holds two tiles of
one block, however many sources there are; the pairs of sources are the result itself.

A term's share is p = 1 + floor(SCALE * (count + 2) / (N + 2 V)), with N the sum of the counts of all V kept terms,
and two shares p, q differ by floor((p - q) * (p - q) / (p + q)); all of it exact.

Terms are runs of ASCII letters (A-Z as a-z) and of characters beyond ASCII, in whole texts of any length.  NULL
text, language or source is ''.  Repeated rows and rows with a NULL id count as documents of their own; other
columns are left out.  Ties are in the order of the item's bytes.  An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import Words, ascii_lower, blocks, mix, row_of
from .fingerprints import PACKED, counted, frequent, has, joined, n_ranges, name_hashes, packed, word_numbers
from .repeats import batch
from .tables import saved

BLOCK = 3 << 20
SCALE = 1_000_000_000
TERMS = 4096  # terms of a block, about
TILE = 64  # sources of a tile, about
# Bytes of terms.
TERM_BYTES = np.isin(np.arange(256), list(range(0x41, 0x5B)) + list(range(0x61, 0x7B)) + list(range(0x80, 0x100)))


class Terms:
    """The terms of a block of texts."""

    def __init__(self, rb: pa.RecordBatch, data: np.ndarray, off: np.ndarray):
        self.data = ascii_lower(data)
        self.words = Words(self.data, off, TERM_BYTES[self.data])
        self.row = row_of(self.words.rows)
        self.hashes = self.words.hashes(self.data)
        self.langs, self.lang = _coded(rb.column("lang"))
        self.sources, self.source = _coded(rb.column("source"))

    def fingerprints(self) -> np.ndarray:
        return mix(self.hashes ^ name_hashes(self.langs)[self.lang[self.row]])


def _coded(column: pa.Array) -> tuple[list[str], np.ndarray]:
    code = column.dictionary_encode()
    return code.dictionary.to_pylist(), code.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def _once(row: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Where each (row, value) stands first."""
    order = np.lexsort((value, row))
    new = np.ones(len(order), dtype=bool)
    new[1:] = (row[order][1:] != row[order][:-1]) | (value[order][1:] != value[order][:-1])
    return order[new]


def _blocks(batches):
    for rb in batches:
        for a, b, data, off in blocks(rb.column("text"), BLOCK):
            yield Terms(rb.slice(a, b - a), data, off)


def term_counts(docs: DataFrame, least: int) -> DataFrame:
    """lang, source, term, n, docs for the terms that stand in ``least`` documents of their language, and perhaps a few more
    (the exact number of documents decides later); documents (lang, source, text) have no NULLs."""
    ranges = n_ranges(docs)

    def emit(batches):
        for t in _blocks(batches):
            fp = t.fingerprints()
            yield from packed(*counted(fp[_once(t.row, fp)]), ranges)

    sent = docs.sparkSession.sparkContext.broadcast(frequent(docs.mapInArrow(emit, PACKED), least))

    def write(batches):
        for t in _blocks(batches):
            good = np.flatnonzero(has(sent.value, t.fingerprints()))
            if not len(good):
                continue
            number, row = word_numbers(t.data, t.words, t.hashes)[good], t.row[good]
            in_doc = np.zeros(len(good), np.int64)
            in_doc[_once(row, number)] = 1
            group = t.lang[row] * len(t.sources) + t.source[row]
            order = np.lexsort((number, group))
            new = np.ones(len(order), dtype=bool)
            new[1:] = (number[order][1:] != number[order][:-1]) | (group[order][1:] != group[order][:-1])
            at = np.flatnonzero(new)
            first = order[at]

            def names(code, values):
                return pa.DictionaryArray.from_arrays(pa.array(code.astype(np.int32)), pa.array(values, pa.string())).cast(pa.string())

            yield batch(lang=names(t.lang[row[first]], t.langs), source=names(t.source[row[first]], t.sources), term=joined(t.data, t.words, good[first], 1), n=np.diff(np.concatenate([at, [len(order)]])).astype(np.int64), docs=np.add.reduceat(in_doc[order], at))

    rows = docs.mapInArrow(write, "lang string, source string, term string, n long, docs long")
    # blocks have counted already: nearly no two rows of a task are equal, so they are dealt out before they are summed
    return rows.repartition("lang", "source", "term").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + 2) / (total + 2 * terms)), exactly."""
    wide = "decimal(19,0)"
    return F.lit(1) + F.call_function("div", (count + 2).cast(wide) * F.lit(SCALE).cast("decimal(10,0)"), (total + 2 * terms).cast(wide))


def trees(counts: np.ndarray) -> tuple[list[tuple[np.ndarray, np.ndarray]], np.ndarray]:
    """Hash-consed trees over the rows of a matrix of counts (-1: no leaf), whose width is a power of two.

    Level by level from the leaves: (left, right) of each different node; and the root of each row.
    """
    levels, node = [], counts
    while node.shape[1] > 1:
        left, right = node[:, ::2].ravel(), node[:, 1::2].ravel()
        width = int(max(left.max(), right.max())) + 2
        values, number = np.unique((left + 1) * width + right + 1, return_inverse=True)
        levels.append((values // width - 1, values % width - 1))
        node = number.reshape(counts.shape[0], -1)
    return levels, node[:, 0]


def leaf_pairs(levels, roots_a: np.ndarray, roots_b: np.ndarray, leaves: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(pair, leaf of a, leaf of b, times) for pairs of roots: their trees walked together, equal pairs of nodes once."""
    pair, a, b, times = np.arange(len(roots_a)), roots_a, roots_b, np.ones(len(roots_a), np.int64)
    for left, right in reversed(levels):
        pair, a, b, times = np.tile(pair, 2), np.concatenate([left[a], right[a]]), np.concatenate([left[b], right[b]]), np.tile(times, 2)
        order = np.lexsort((b, a, pair))
        pair, a, b, times = pair[order], a[order], b[order], times[order]
        new = np.ones(len(pair), dtype=bool)
        new[1:] = (pair[1:] != pair[:-1]) | (a[1:] != a[:-1]) | (b[1:] != b[:-1])
        at = np.flatnonzero(new)
        pair, a, b, times = pair[at], a[at], b[at], np.add.reduceat(times, at)
    return pair, a, b, times


def divergences(counts: np.ndarray, n_terms: int, totals: list[int], pairs: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """What the pairs of rows of a matrix of counts differ by, summed over its ``n_terms`` columns.

    totals: N + 2 V of each row.
    """
    rows, used = counts.shape
    wide = 1 << max(0, (n_terms - 1).bit_length())
    # counts as small numbers: leaf 0 is the place of no term
    values, code = np.unique(np.concatenate([[0], counts.ravel()]), return_inverse=True)
    leaf = np.zeros((rows, wide), np.int64)
    leaf[:, :n_terms] = code[0] + 1
    leaf[:, :used] = code[1:].reshape(rows, used) + 1
    levels, roots = trees(leaf)
    a, b = pairs
    pair, x, y, times = leaf_pairs(levels, roots[a], roots[b], len(values) + 1)
    real = x > 0
    pair, x, y, times = pair[real], x[real] - 1, y[real] - 1, times[real]
    ask = [(values[c] + 2).tolist() for c in (x, y)]
    p, q = (np.array([1 + SCALE * c // totals[r] for c, r in zip(c_, who[pair].tolist(), strict=True)], np.int64) for c_, who in zip(ask, (a, b), strict=True))
    out = np.zeros(len(a), np.int64)
    np.add.at(out, pair, times * ((p - q) * (p - q) // (p + q)))
    return out


def _tile(frame):
    """Rows of one block and two tiles: (source, tile, term, n, total, terms); a source's first row has no term."""
    import pandas as pd

    lang, ta, tb = frame["lang"].iloc[0], int(frame["ta"].iloc[0]), int(frame["tb"].iloc[0])
    head = frame[frame["term"].isna()].drop_duplicates("source").sort_values("source")
    sources = head["source"].tolist()
    tile = head["tile"].to_numpy()
    a, b = np.meshgrid(np.flatnonzero(tile == ta), np.flatnonzero(tile == tb), indexing="ij")
    a, b = a.ravel(), b.ravel()
    if ta == tb:
        a, b = a[a < b], b[a < b]
    if not len(a):
        return pd.DataFrame({"lang": [], "a": [], "b": [], "value": []}).astype({"lang": str, "a": str, "b": str, "value": "int64"})
    body = frame[frame["term"].notna()]
    number = {s: i for i, s in enumerate(sources)}
    row = body["source"].map(number).to_numpy(np.int64)
    terms, column = np.unique(body["term"].to_numpy(str) if len(body) else np.zeros(0, "U1"), return_inverse=True)
    counts = np.zeros((len(sources), len(terms)), np.int64)
    counts[row, column] = body["n"].to_numpy(np.int64)
    n_terms = int(head["terms"].iloc[0])
    value = divergences(counts, n_terms, head["total"].astype(int).tolist(), (a, b)) if n_terms else np.zeros(len(a), np.int64)
    names = np.array(sources, dtype=object)
    return pd.DataFrame({"lang": lang, "a": names[a], "b": names[b], "value": value})


def source_divergence(docs: DataFrame, *, least: int = 10, top: int = 10, tile: int = TILE, terms: int = TERMS, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """lang, source, part, item, value, rank.

    part ``pair``: every other source of the language and the sum of the differences of all its kept terms;
    part ``term``: the ``top`` terms of the source whose share is above the language's, with the difference.
    """
    docs = docs.select(*(F.coalesce(F.col(x).cast("string"), F.lit("")).alias(y) for x, y in ((text_col, "text"), (lang_col, "lang"), (source_col, "source"))))
    groups = saved(docs.select("lang", "source").distinct(), "sources")
    counts = saved(term_counts(docs, least), "counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).where(F.col("docs") >= least)
    kept = saved(kept.drop("docs"), "terms")
    counts = saved(counts.drop("docs").join(kept, ["lang", "term"]), "kept")
    langs = groups.select("lang").distinct().join(kept.groupBy("lang").agg(F.count("*").alias("v"), F.sum("lang_n").alias("lang_total")), "lang", "left").na.fill(0, ["v", "lang_total"])
    langs = langs.join(groups.groupBy("lang").agg(F.count("*").alias("g")), "lang")
    langs = saved(langs.withColumn("blocks", F.expr(f"cast(1 + v div {terms} as int)")).withColumn("tiles", F.expr(f"cast(1 + g div {tile} as int)")), "langs")
    sums = counts.groupBy("lang", "source").agg(F.sum("n").alias("source_total"))
    groups = saved(groups.join(sums, ["lang", "source"], "left").na.fill(0, ["source_total"]).join(langs, "lang"), "groups")

    # pairs: the counts of a block and a tile go to every pair of tiles that holds the tile
    def dealt(df):
        df = df.withColumn("tile", F.pmod(F.xxhash64("source"), F.col("tiles")).cast("int"))
        df = df.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        return df.withColumn("ta", F.least("tile", "other")).withColumn("tb", F.greatest("tile", "other"))

    block = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
    sizes = kept.join(langs.select("lang", "blocks"), "lang").withColumn("block", block).groupBy("lang", "block").agg(F.count("*").alias("terms"))
    heads = groups.withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).join(sizes, ["lang", "block"], "left").na.fill(0, ["terms"])
    heads = dealt(heads).selectExpr("lang", "block", "ta", "tb", "source", "tile", "cast(null as string) as term", "0L as n", "cast(source_total as decimal(20,0)) + 2 * v as total", "terms")
    body = dealt(counts.join(langs.select("lang", "blocks", "tiles"), "lang").withColumn("block", block))
    body = body.selectExpr("lang", "block", "ta", "tb", "source", "tile", "term", "n", "cast(0 as decimal(20,0)) as total", "0L as terms")
    parts = heads.withColumn("total", F.col("total").cast("decimal(20,0)")).unionByName(body).groupBy("lang", "block", "ta", "tb").applyInPandas(_tile, "lang string, a string, b string, value long")
    pairs = parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))
    pairs = pairs.withColumn("side", F.explode(F.array(F.lit(0), F.lit(1))))
    pairs = pairs.select("lang", F.expr("if(side = 0, a, b)").alias("source"), F.lit("pair").alias("part"), F.expr("if(side = 0, b, a)").alias("item"), "value")

    own = counts.join(groups.select("lang", "source", "source_total", "v", "lang_total"), ["lang", "source"])
    own = own.withColumn("p", share(F.col("n"), F.col("source_total"), F.col("v"))).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("v"))).where("p > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), F.expr("((p - q) * (p - q)) div (p + q)").alias("value"))
    rank = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    return pairs.withColumn("rank", rank).unionByName(own.withColumn("rank", rank).where(F.col("rank") <= top))


ORACLE_SQL = r"""
    WITH d AS MATERIALIZED (
      SELECT row_number() OVER () AS i, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
    o AS MATERIALIZED (SELECT i, lang, source, term, count(*) AS n FROM (SELECT i, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
    k AS MATERIALIZED (SELECT lang, term, CAST(sum(n) AS BIGINT) AS n FROM o GROUP BY ALL HAVING count(*) >= 10),
    v AS (SELECT l.lang, count(term) AS v, CAST(coalesce(sum(n), 0) AS HUGEINT) AS n FROM (SELECT DISTINCT lang FROM d) l LEFT JOIN k ON k.lang = l.lang GROUP BY ALL),
    c AS MATERIALIZED (SELECT lang, source, term, CAST(sum(o.n) AS BIGINT) AS n FROM o SEMI JOIN k USING (lang, term) GROUP BY ALL),
    s AS MATERIALIZED (SELECT g.lang, g.source, CAST(coalesce(sum(c.n), 0) AS HUGEINT) AS total FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL),
    p AS MATERIALIZED (
      SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, CAST(1 + 1000000000 * CAST(coalesce(c.n, 0) + 2 AS HUGEINT) // (s.total + 2 * v.v) AS BIGINT) AS p,
        CAST(1 + 1000000000 * CAST(k.n + 2 AS HUGEINT) // (v.n + 2 * v.v) AS BIGINT) AS q
      FROM s JOIN v ON v.lang = s.lang JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
    f AS (
      SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
      FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
    r AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
      FROM s a JOIN s b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
      UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q)
    SELECT lang, source, part, item, value, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
    FROM r QUALIFY part = 'pair' OR rank <= 10"""
