"""Phrase collocations: the phrases of a few words that stand together more often than their parts suggest.

Every n-gram of words is a fingerprint by prefix polynomials (Rabin and Karp): the hash of any stretch of words
comes from two prefix sums.  For n = 1, 2, ... the fingerprints of a block are counted and shuffled packed, and
those that reach the least count over all documents set bits of a fixed-size filter.  An n-gram is only looked at
if both n-1-grams in it passed, as it can't be more frequent than they are.  Only fingerprints that passed are
then materialised: every block compares their occurrences with the text at the first one (collisions are told
apart there), and sends the phrase once with its count and the place of its first occurrence.  All blocks' phrases of one
range of fingerprints meet and are summed by language and text, so counts are exact whatever the fingerprints do.

Texts are cut at ``.,;:!?`` and line ends into pieces and those into words (anything between spaces and tabs); A-Z
count as a-z; no phrase spans pieces.  NULL and empty texts have no words; a NULL language is ``und``.  Repeated
rows count each time; other columns are left out.  Very long texts are counted whole.  An empty table gives no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .arrays import Rolling, Words, ascii_lower, blocks, mix, row_of
from .fingerprints import PACKED, counted, frequent, has, lines, n_ranges, name_hashes, packed, planes, unpacked, word_numbers
from .repeats import batch
from .tables import saved

BLOCK = 3 << 20
NO_ID = np.int64(2**63 - 1)  # stands for a NULL id: after all others
SALTS = 16  # parts of a language that are ranked by themselves before the last ranking
# Bytes that end a piece.
PIECE_ENDS = np.isin(np.arange(256), [ord(c) for c in ".,;:!?"] + list(range(0x0A, 0x0E)))
WORD_BYTES = ~PIECE_ENDS & ~np.isin(np.arange(256), [0x20, 0x09])


class Grams:
    """The n-grams of a block: their fingerprints (with the language) and where they stand."""

    def __init__(self, data: np.ndarray, off: np.ndarray, langs: list[str]):
        self.data = ascii_lower(data)
        self.words = Words(self.data, off, WORD_BYTES[self.data])
        self.row = row_of(self.words.rows)
        self.piece = np.cumsum(PIECE_ENDS[self.data])[self.words.start] if len(self.row) else np.zeros(0, np.int64)
        self.hashes = self.words.hashes(self.data)
        self.roll = Rolling(self.hashes)
        names, self.lang = np.unique(np.array(langs, dtype=object), return_inverse=True)
        self.names = names.tolist()
        self.salt = name_hashes(self.names)

    def fingerprints(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(fingerprint, first word) of every n-gram inside a piece."""
        fp = self.roll.every(n)
        end = np.arange(len(fp)) + n - 1
        at = np.flatnonzero((self.row[: len(fp)] == self.row[end]) & (self.piece[: len(fp)] == self.piece[end]))
        return mix(fp[at] ^ self.salt[self.lang[self.row[at]]]) + np.uint64(n), at

    def passed(self, n: int, bits: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Those whose n-1-grams, if any, have their bits."""
        fp, at = self.fingerprints(n)
        if n == 1:
            return fp, at
        ok = np.zeros(len(self.row) + 1, dtype=bool)
        less, there = self.fingerprints(n - 1)
        ok[there] = has(bits[n - 2], less)
        good = ok[at] & ok[at + 1]
        return fp[good], at[good]

    def groups(self, fp: np.ndarray, at: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(first word, count) of each different n-gram of one language; equal fingerprints are compared word by word."""
        order = np.argsort(fp, kind="stable")
        at = at[order]
        new = np.concatenate([[True], fp[order][1:] != fp[order][:-1]])
        first = np.flatnonzero(new)
        like = at[first][np.cumsum(new) - 1]
        same = self.lang[self.row[at]] == self.lang[self.row[like]]
        for j in range(n):
            same &= self.number[at + j] == self.number[like + j]
        if not same.all():  # a collision: sort by the words themselves
            keys = [at, *(self.number[at + j] for j in range(n)), self.lang[self.row[at]]]
            at = at[np.lexsort(keys)]
            new = np.ones(len(at), dtype=bool)
            new[1:] = self.lang[self.row[at[1:]]] != self.lang[self.row[at[:-1]]]
            for j in range(n):
                new[1:] |= self.number[at[1:] + j] != self.number[at[:-1] + j]
            first = np.flatnonzero(new)
        return at[first], np.diff(np.concatenate([first, [len(at)]]))

    @property
    def number(self) -> np.ndarray:
        if not hasattr(self, "_number"):
            self._number = word_numbers(self.data, self.words, self.hashes)
        return self._number


def _blocks(batches):
    for rb in batches:
        for a, b, data, off in blocks(rb.column("text"), BLOCK):
            yield rb.slice(a, b - a), off, Grams(data, off, rb.column("lang").slice(a, b - a).to_pylist())


def phrase_counts(docs: DataFrame, *, longest: int = 3, least: int = 10, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, n_words, phrase, a, doc_id, at: phrases of 1 to ``longest`` words that occur ``least`` times in a language, with the
    id of the first document that holds them and the byte at which they begin there; n_words 0: all words of the language."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.coalesce(F.col(lang_col).cast("string"), F.lit("und")).alias("lang"))
    context = docs.sparkSession.sparkContext
    ranges = n_ranges(docs)
    sent = []
    for n in range(1, longest + 1):
        def emit(batches, n=n, sent=tuple(sent)):
            bits = [x.value for x in sent]
            for _, _, grams in _blocks(batches):
                fp, _ = grams.passed(n, bits)
                yield from packed(*counted(fp), ranges)

        sent.append(context.broadcast(frequent(docs.mapInArrow(emit, PACKED), least)))

    def write(batches):
        bits = [x.value for x in sent]
        for part, off, grams in _blocks(batches):
            yield from _packed_phrases(part, off, grams, bits, ranges)

    def merge(batches):
        held, last = [], None
        for rb in batches:
            for row in rb.to_pylist():
                if row["range"] != last and held:
                    yield _merged(held, least)
                    held = []
                last = row["range"]
                held.append(row)
        if held:
            yield _merged(held, least)

    rows = docs.mapInArrow(write, "range int, lang string, phrases binary, counts binary, docs binary, places binary")
    return rows.repartition("range").sortWithinPartitions("range").mapInArrow(merge, "lang string, n_words int, phrase string, a long, doc_id long, at long")


def _packed_phrases(part: pa.RecordBatch, off: np.ndarray, grams: Grams, bits: list[np.ndarray], ranges: int):
    """Rows of the phrases of a block, one for each language and range of fingerprints; first the numbers of all words."""
    total = np.bincount(grams.lang[grams.row], minlength=len(grams.names)) if len(grams.row) else np.zeros(len(grams.names), np.int64)
    each = np.arange(len(total) + 1)
    place = ((grams.salt >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
    yield batch(range=place.astype(np.int32), lang=pa.array(grams.names, pa.string()), phrases=pa.array([b"\n"] * len(total), pa.binary()), counts=planes(total.astype(np.uint32), each), docs=planes(np.full(len(total), NO_ID), each), places=planes(np.zeros(len(total), np.uint32), each))
    found = []
    for n in range(1, len(bits) + 1):
        fp, at = grams.passed(n, bits)
        good = has(bits[n - 1], fp)
        if good.any():
            first, count = grams.groups(fp[good], at[good], n)
            of_word = np.zeros(len(grams.row), np.uint64)
            of_word[at] = fp
            found.append((first, np.full(len(first), n), count, ((of_word[first] >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)))
    if not found:
        return
    first, n, count, place = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((grams.lang[grams.row[first]], place))
    first, n, count, place = first[order], n[order], count[order], place[order]
    row = grams.row[first]
    lang = grams.lang[row]
    new = np.ones(len(first), dtype=bool)
    new[1:] = (place[1:] != place[:-1]) | (lang[1:] != lang[:-1])
    cuts = np.append(np.flatnonzero(new), len(first))
    text, ends = lines(grams.data, grams.words, first, n)
    text_cuts = np.concatenate([[0], ends])[cuts].astype(np.int32)
    ids = part.column("doc_id").fill_null(NO_ID).to_numpy(zero_copy_only=False)[row]
    yield batch(
        range=place[cuts[:-1]].astype(np.int32), lang=pa.array([grams.names[i] for i in lang[cuts[:-1]].tolist()], pa.string()),
        phrases=pa.Array.from_buffers(pa.binary(), len(cuts) - 1, [None, pa.py_buffer(text_cuts), pa.py_buffer(text)]),
        counts=planes(count.astype(np.uint32), cuts), docs=planes(ids, cuts), places=planes((grams.words.start[first] - off[row]).astype(np.uint32), cuts))


def _merged(held: list[dict], least: int) -> pa.RecordBatch:
    """The phrases of one range: packed rows of all blocks summed by language and text."""
    text = np.frombuffer(b"".join(x["phrases"] for x in held), np.uint8)
    off = np.concatenate([[0], np.flatnonzero(text == 10) + 1]).astype(np.int32)
    phrase = pa.Array.from_buffers(pa.string(), len(off) - 1, [None, pa.py_buffer(off), pa.py_buffer(text)])
    counts, docs, places = (np.concatenate([unpacked(x[name], kind) for x in held]) for name, kind in (("counts", np.uint32), ("docs", np.int64), ("places", np.uint32)))
    size = [len(x["counts"]) // 4 for x in held]
    lang = pa.array([x["lang"] for x in held], pa.string()).take(pa.array(np.repeat(np.arange(len(held)), size)))
    rows = pa.table({"lang": lang, "phrase": phrase, "a": counts.astype(np.int64), "doc_id": docs, "at": places.astype(np.int64)})
    # a document's occurrences are all in one block: the row of the smallest id has the first place
    rows = rows.take(pa.array(np.argsort(docs, kind="stable")))
    out = rows.group_by(["lang", "phrase"], use_threads=False).aggregate([("a", "sum"), ("doc_id", "first"), ("at", "first")])
    spaces = pc.count_substring(out["phrase"], " ")
    empty = pc.equal(out["phrase"], "\n")
    out = out.append_column("n_words", pc.cast(pc.if_else(empty, 0, pc.add(spaces, 1)), pa.int32()))
    out = out.filter(pc.or_(empty, pc.greater_equal(out["a_sum"], least))).combine_chunks()
    ids = pc.if_else(pc.equal(out["doc_id_first"], NO_ID), pa.scalar(None, pa.int64()), out["doc_id_first"])
    columns = {"lang": out["lang"], "n_words": out["n_words"], "phrase": pc.utf8_rtrim(out["phrase"], "\n"), "a": out["a_sum"], "doc_id": ids, "at": out["at_first"]}
    return pa.RecordBatch.from_arrays([pa.concat_arrays(x.chunks) if x.num_chunks else pa.array([], x.type) for x in columns.values()], names=list(columns))


def whole(ratio_of: Column, part: Column, other: Column, scale: int) -> Column:
    """floor(scale * a * a / (l * r)) in exact arithmetic: counts to 10**15, products to 38 digits."""
    a, left, right = (x.cast("decimal(16,0)") for x in (ratio_of, part, other))
    return F.call_function("div", a * a * F.lit(scale).cast("decimal(7,0)"), left * right)


def collocations(docs: DataFrame, *, longest: int = 3, least: int = 10, top: int = 2000, scale: int = 1_000_000, cover: int = 50, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, first_doc, first_at: each language's ``top`` phrases of 2 to ``longest`` words.

    The score is the least, over the cuts of the phrase into two parts that occur l and r times, of
    floor(scale * a * a / (l * r)); of equal cuts the first counts.  A phrase is left out if it stands inside a
    longer one that occurs at least ``cover`` times for each 100 of its own.  Ranked by score and a, both
    descending, then by the phrase's bytes.
    """
    counts = saved(phrase_counts(docs, longest=longest, least=least, id_col=id_col, text_col=text_col, lang_col=lang_col), "phrases")
    several = counts.where("n_words > 1")
    words = F.split("phrase", " ")

    def part(begin, size):
        return F.array_join(F.slice(words, begin, size), " ")

    cuts = several.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("n_words") - 1)))
    cuts = cuts.select("lang", "phrase", "n_words", "a", "doc_id", "at", "k", part(F.lit(1), F.col("k")).alias("left"), part(F.col("k") + 1, F.col("n_words") - F.col("k")).alias("right"))
    known = counts.where("n_words > 0")
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("left"), F.col("a").alias("l")), ["lang", "left"])
    cuts = cuts.join(known.select("lang", F.col("phrase").alias("right"), F.col("a").alias("r")), ["lang", "right"])
    cut = F.min(F.struct(whole(F.col("a"), F.col("l"), F.col("r"), scale).alias("score"), "k", "l", "r", "n_words", "a", "doc_id", "at")).alias("cut")
    scored = cuts.groupBy("lang", "phrase").agg(cut).select("lang", "phrase", "cut.*")

    # the most frequent longer phrase around each phrase
    inside = several.where("n_words > 2").withColumn("m", F.explode(F.sequence(F.lit(2), F.col("n_words") - 1)))
    inside = inside.withColumn("b", F.explode(F.sequence(F.lit(1), F.col("n_words") - F.col("m") + 1)))
    around = inside.select("lang", part(F.col("b"), F.col("m")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    kept = scored.join(around, ["lang", "phrase"], "left").where(F.expr(f"longer is null or 100 * longer < {cover} * a"))

    # a large language is ranked in parts first
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    kept = kept.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)))
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("rank") <= top)
    kept = kept.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    n = counts.where("n_words = 0").select("lang", F.col("a").alias("n"))
    return kept.join(n, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score", F.col("doc_id").alias("first_doc"), F.col("at").alias("first_at"))


def oracle_sql(top: int = 2000) -> str:
    return rf"""
    WITH w AS MATERIALIZED (
      SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w
      FROM (SELECT lang, unnest(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents WHERE text IS NOT NULL)),
    n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
    g AS MATERIALIZED (
      SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
      FROM w, (VALUES (1), (2), (3)) AS s(k) WHERE len(w) >= k),
    f AS MATERIALIZED (SELECT lang, phrase, k, count(*) AS a, string_split(phrase, ' ') AS w FROM g GROUP BY ALL HAVING count(*) >= 10),
    parts AS MATERIALIZED (
      SELECT lang, phrase, k, a, 1 AS i, w[1] AS x, array_to_string(w[2:], ' ') AS y FROM f WHERE k > 1
      UNION ALL SELECT lang, phrase, k, a, 2, array_to_string(w[1:2], ' '), w[3] FROM f WHERE k = 3),
    cuts AS (
      SELECT p.lang, p.phrase, p.k AS words, p.a, p.i, u.a AS l, v.a AS r, 1000000 * CAST(p.a AS HUGEINT) * p.a // (CAST(u.a AS HUGEINT) * v.a) AS score
      FROM parts p JOIN f u ON u.lang = p.lang AND u.phrase = p.x JOIN f v ON v.lang = p.lang AND v.phrase = p.y),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
    longer AS (
      SELECT lang, phrase, max(a) AS most FROM (
        SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM f WHERE k = 3)
      GROUP BY ALL)
    SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, b.a DESC, b.phrase) AS rank, b.phrase, b.a, l, r, n, CAST(score AS BIGINT) AS score
    FROM best b JOIN n ON n.lang = b.lang LEFT JOIN longer o ON o.lang = b.lang AND o.phrase = b.phrase AND b.words < 3
    WHERE most IS NULL OR 100 * most < 50 * b.a
    QUALIFY rank <= {top}"""
