"""Near-duplicate documents by the Jaccard similarity of their word n-gram sets: a self-join with adaptive
multi-match prefixes.

Shingles have one global order, rare ones first (by a hashed count over all documents, then by hash).  A
document's l-prefix are its first n - ceil(t n) + l shingles; two sets of similarity t share at least
min(l, l') shingles of their prefixes.  Each document chooses its l from the estimated cost of its
candidates: a longer prefix costs more rows, but asks for more shared shingles before a pair is verified.

Equal sets are one node, so copies cost nothing past the first.  Pairs inside one group of near copies are
not all listed: first every node is verified against a few nodes of its prefix lists and what links is joined
into components; nodes that are still apart from others of their lists are tried again, in each list with
a few more nodes in a random order.  Then all pairs that share enough prefix shingles and whose ends are
still apart are verified, so no link between components is lost and every component is exact.

Pairs that can't reach the similarity are told by parity bitmaps: bit h of a set's bitmap is the parity of its
shingles that hash to h, so two bitmaps differ in no more bits than the sets do in shingles.  A short bitmap, folded
from the whole one, travels with the lists; pairs are held against whole bitmaps before any text is moved, and texts
are moved for the pairs that remain only.

Words are runs of other characters than ASCII white space, A-Z in lower case.  A text of fewer words than n
is one shingle; a text without words has an empty set and is linked with nothing.  Rows that repeat a doc_id
count as documents of their own; each of them gives a row.  Sets are compared by 64-bit shingle hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .arrays import BLOCK_BYTES, Rolling, Words, ascii_lower, blocks, distinct_by_row, mix, ramp, row_of, shingles
from .components import components
from .repeats import batch, changes, table
from .tables import holding, keyed, saved

WORDS, PERCENT = 4, 85
SKETCH_BITS, SKETCH_PARTS = 21, 64  # counters of the hashed shingle counts: 2**21 of 4 bytes, whatever the input
LONGEST = 4  # l is 1 to LONGEST
TRIED = 4  # pairs of each set that are verified before components are first built
AGAIN = 4  # other sets of each of its lists that a set is then tried with
BITMAP = 16  # 64-bit numbers of a parity bitmap
FOLDED = 4  # 64-bit numbers of the bitmap that travels with the lists
DRAWN = 1024  # sets whose bitmaps are drawn at a time: 8 MB of counts


def sets(data: np.ndarray, off: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text of a block; (hashes, bounds)."""
    low = ascii_lower(data)
    words = Words(low, off)
    hashes, rows = shingles(words.hashes(low), words.rows, n)
    return distinct_by_row(hashes, rows, len(off) - 1)


def set_names(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A 64-bit name for each set, the same for equal sets."""
    return mix(Rolling(hashes).of(bounds[:-1], bounds[1:]) + np.diff(bounds).astype(np.uint64)).astype(np.int64)


def _blocks(batches, n: int) -> Iterator[tuple]:
    for rb in batches:
        for a, b, data, off in blocks(rb.column("text")):
            hashes, bounds = sets(data, off, n)
            yield rb.slice(a, b - a), hashes, bounds, set_names(hashes, bounds)


def _first_only(hashes, bounds, names):
    """The sets that come first under their name in a block, without empty ones."""
    _, first = np.unique(names, return_index=True)
    first = first[np.diff(bounds)[first] > 0]
    size = np.diff(bounds)[first]
    return hashes[np.repeat(bounds[:-1][first], size) + ramp(size)], np.concatenate([[0], np.cumsum(size)]), names[first]


def packed(counts: np.ndarray) -> bytes:
    """Counters as 32-bit numbers, their bytes dealt by weight (most counts are small) and compressed."""
    planes = np.minimum(counts, 2**31 - 1).astype("<i4").view(np.uint8).reshape(-1, 4).T
    return pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    planes = pa.decompress(data, 4 * (1 << SKETCH_BITS) // SKETCH_PARTS, codec="zstd", asbytes=True)
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view("<i4").ravel()


def sketch(docs: DataFrame, n: int) -> np.ndarray:
    """Hashed counts of shingles over all documents (copies inside a block count once): a fixed number of counters."""

    def count(batches):
        total = np.zeros(1 << SKETCH_BITS, dtype=np.int64)
        for _, hashes, bounds, names in _blocks(batches, n):
            hashes, _, _ = _first_only(hashes, bounds, names)
            total += np.bincount((hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64), minlength=1 << SKETCH_BITS)
        for i, part in enumerate(np.split(total, SKETCH_PARTS)):
            yield batch(part=np.array([i], np.int32), counts=pa.array([packed(part)], pa.binary()))

    def add(frame):
        return frame.iloc[:1].assign(counts=[packed(sum(unpacked(x).astype(np.int64) for x in frame["counts"]))])

    # two steps, so that no task gathers one part of every task of a large input
    parts = docs.mapInArrow(count, "part int, counts binary").withColumn("salt", F.spark_partition_id() % 32)
    parts = parts.groupBy("part", "salt").applyInPandas(add, "part int, counts binary, salt int").drop("salt")
    rows = parts.groupBy("part").applyInPandas(add, "part int, counts binary").collect()
    out = np.zeros((SKETCH_PARTS, (1 << SKETCH_BITS) // SKETCH_PARTS), np.int32)
    for r in rows:
        out[r["part"]] = unpacked(r["counts"])
    return out.ravel()


def prefixes(hashes: np.ndarray, bounds: np.ndarray, counts: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(shingle, row, place) of every set's prefix, and each set's l."""
    rows = row_of(bounds)
    seen = counts[(hashes >> np.uint64(64 - SKETCH_BITS)).astype(np.int64)]
    level = np.log2(np.maximum(seen, 1)).astype(np.int64)
    order = np.lexsort((hashes, level, rows))
    hashes, seen = hashes[order], seen[order]
    n = np.diff(bounds)
    least = -(-n * percent // 100)  # shingles that any partner shares
    base = n - least
    # expected partners of a shingle: what its counter holds above the mean of all counters
    others = np.concatenate([[0], np.cumsum(np.maximum(0, seen - 1 - counts.mean()))])
    cost = []
    for k in range(1, LONGEST + 1):
        end = bounds[:-1] + np.minimum(n, base + k)
        listed = others[end] - others[bounds[:-1]]
        cost.append(np.where(k <= least, (end - bounds[:-1]) + listed + n * listed / (16 * k * k), np.inf))
    best = np.argmin(np.array(cost), axis=0) + 1
    best = np.minimum(best, np.maximum(least, 1))
    size = np.minimum(n, base + best)
    place = ramp(size)
    return hashes[np.repeat(bounds[:-1], size) + place], np.repeat(np.arange(len(n)), size), place, best


def shared_prefixes(docs: DataFrame, counts: np.ndarray, n: int, percent: int) -> DataFrame:
    """(tok, s, n, l, p, hub, hn, prev, pn, few): prefix shingles that several sets have, each set with its size, l and the
    shingle's place in its order, the first one of its list and the one before it (itself for the first), and their sizes;
    few: the list is known to have no more than AGAIN + 1 sets."""
    sent = docs.sparkSession.sparkContext.broadcast(counts)

    def emit(batches):
        counts = sent.value
        for _, hashes, bounds, names in _blocks(batches, n):
            hashes, bounds, names = _first_only(hashes, bounds, names)
            tok, row, place, best = prefixes(hashes, bounds, counts, percent)
            if len(tok):
                # size, place and l in one number: these rows are the bulk of what is shuffled
                packed = (np.diff(bounds)[row] << 32) + place * 8 + best[row]
                yield batch(tok=tok.astype(np.int64), s=names[row], nl=packed.astype(np.int64))

    def lists(batches):
        """Sorted (tok, s) rows: drop repeats of a set and shingles of one set only; the first row leads its list."""
        last, lead, back = None, None, None  # last row; first row of its list; last set and its size
        several = False  # the list of the last row was given out
        for t in table(batches):
            new_tok = changes([t["tok"]], None if last is None else last[:1])
            new = changes([t["tok"], t["s"]], None if last is None else last[:2])
            tok, s, nl = t["tok"][new], t["s"][new], t["nl"][new]
            last_row = (t["tok"][-1], t["s"][-1])
            starts = new_tok[new]
            if len(tok):
                # the row before the first one, if its list goes on
                if not starts[0]:
                    tok, s, nl = (np.concatenate([[x], y]) for x, y in zip(lead, (tok, s, nl), strict=True))
                    starts = np.concatenate([[True], starts])
                prev, pn = np.concatenate([s[:1], s[:-1]]), np.concatenate([nl[:1], nl[:-1]])
                if not new_tok[new][0]:
                    prev[1], pn[1] = back  # the first row here is the lead, given in again
                at = np.flatnonzero(starts)
                prev[at], pn[at] = s[at], nl[at]
                size = np.diff(np.concatenate([at, [len(tok)]]))
                shared = np.repeat(size > 1, size)
                if several and not new_tok[new][0]:
                    shared[0] = False  # given out before
                # only lists that begin and end among these rows
                few = size <= AGAIN + 1
                few[0] &= bool(new_tok[new][0])
                few[-1] = False
                few = np.repeat(few, size)
                hub, hnl = np.repeat(s[at], size), np.repeat(nl[at], size)
                if shared.any():
                    yield batch(tok=tok[shared], s=s[shared], n=(nl >> 32)[shared].astype(np.int32), l=(nl & 7)[shared].astype(np.int32), p=((nl & 0xFFFFFFFF) >> 3)[shared].astype(np.int32), hub=hub[shared], hn=(hnl >> 32)[shared].astype(np.int32), prev=prev[shared], pn=(pn >> 32)[shared].astype(np.int32), few=few[shared])
                back = s[-1], nl[-1]
                lead = (tok[at[-1]], s[at[-1]], nl[at[-1]])
                several = bool(size[-1] > 1)
            last = last_row

    rows = docs.mapInArrow(emit, "tok long, s long, nl long").repartition("tok").sortWithinPartitions("tok", "s")
    return saved(rows.mapInArrow(lists, "tok long, s long, n int, l int, p int, hub long, hn int, prev long, pn int, few boolean"), "prefixes")


def close_enough(a: str, b: str, percent: int):
    """Set sizes that can reach the similarity."""
    return F.expr(f"100L * least({a}, {b}) >= {percent}L * greatest({a}, {b})")


def parities(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The parity bitmap of each set, BITMAP numbers in a row."""
    width, n = 64 * BITMAP, len(bounds) - 1
    out = np.empty((n, BITMAP), np.int64)
    for a in range(0, n, DRAWN):
        own = bounds[a:a + DRAWN + 1]
        place = row_of(own) * width + (hashes[own[0]:own[-1]] % np.uint64(width)).astype(np.int64)
        odd = np.bincount(place, minlength=(len(own) - 1) * width).astype(np.uint8) & 1
        out[a:a + DRAWN] = np.packbits(odd, bitorder="little").view(np.int64).reshape(-1, BITMAP)
    return out


def bitmaps(rows: DataFrame, n: int) -> DataFrame:
    """The columns of the rows without their text, and of each text's set n_shingles, name and parity bitmap (b0, b1, ...)."""
    kept = rows.drop("text").columns

    def draw(batches):
        for part, hashes, bounds, names in _blocks(batches, n):
            bits = parities(hashes, bounds)
            yield batch(**{c: part.column(c) for c in kept}, n_shingles=np.diff(bounds).astype(np.int64), name=names, **{f"b{i}": np.ascontiguousarray(bits[:, i]) for i in range(BITMAP)})

    schema = rows.drop("text").schema
    for c in ("n_shingles", "name", *(f"b{i}" for i in range(BITMAP))):
        schema = schema.add(c, "long")
    return saved(rows.mapInArrow(draw, schema), "sets")


def folded() -> list:
    """The short bitmap as columns: two sets' short bitmaps differ in no more bits than the whole ones."""
    return [F.expr(" ^ ".join(f"b{k}" for k in range(i, BITMAP, FOLDED))).alias(f"b{i}") for i in range(FOLDED)]


def shared_least(a: str, b: str, percent: int) -> str:
    """Shingles that sets of these sizes must share, as SQL."""
    return f"(({percent}L * ({a} + {b}) + {99 + percent}) div {100 + percent})"


def alike(x: str, y: str, percent: int, numbers: int = FOLDED):
    """Sizes ``{x}n``, ``{y}n`` and bitmaps ``{x}b0``, ... that can belong to two sets of the similarity."""
    differ = " + ".join(f"bit_count({x}b{i} ^ {y}b{i})" for i in range(numbers))
    return close_enough(f"{x}n", f"{y}n", percent) & F.expr(f"{differ} <= {x}n + {y}n - 2 * {shared_least(x + 'n', y + 'n', percent)}")


def members(shared: DataFrame, groups: DataFrame, maps: DataFrame) -> DataFrame:
    """(tok, s, n, l, p, c, b0, ...): the lists with each set's component c and bitmap."""
    of = groups.selectExpr("node as s", "component as c")
    return shared.select("tok", "s", "n", "l", "p").join(of, "s", "left").join(maps, "s").withColumn("c", F.coalesce("c", "s"))


def possible(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(a, b, da, db): the pairs (a, b) of set names whose whole bitmaps allow the similarity, with the keys of their texts."""
    x, y = (nodes.select(F.col("s").alias(name), *(F.col(c).alias(f"{name}{c}") for c in nodes.columns if c != "s")) for name in ("a", "b"))
    pairs = pairs.select("a", "b").join(x, "a").join(y, "b").where(alike("a", "b", percent, BITMAP))
    return pairs.select("a", "b", F.col("ad").alias("da"), F.col("bd").alias("db"))


def verified(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs (a, b) of set names that reach the similarity; da and db are the keys d of their texts."""
    # only texts of these pairs are moved
    texts = holding(texts, "d", pairs.select("da").union(pairs.select("db")))
    left, right = (texts.select(F.col("d").alias(f"d{x}"), F.col("text").alias(f"text_{x}")) for x in "ab")
    rows = pairs.join(right, "db").join(left, "da").select("a", "b", "text_a", "text_b")

    def check(batches):
        for rb in batches:
            step = max(1, int(rb.num_rows * BLOCK_BYTES / max(1, rb.nbytes)))
            for start in range(0, rb.num_rows, step):
                part = rb.slice(start, step)
                a, b = (part.column(x).to_numpy() for x in ("a", "b"))
                _, first, back = np.unique(a, return_index=True, return_inverse=True)
                one = [x for _, _, data, off in blocks(part.column("text_a").take(pa.array(first)), 1 << 62) for x in sets(data, off, n)]
                two = [x for _, _, data, off in blocks(part.column("text_b"), 1 << 62) for x in sets(data, off, n)]
                ok = np.zeros(len(a), dtype=bool)
                for i, k in enumerate(back.tolist()):
                    x = one[0][one[1][k]:one[1][k + 1]]
                    y = two[0][two[1][i]:two[1][i + 1]]
                    at = np.searchsorted(x, y)
                    both = int((x[np.minimum(at, len(x) - 1)] == y).sum()) if len(x) else 0
                    ok[i] = both > 0 and 100 * both >= percent * (len(x) + len(y) - both)
                if ok.any():
                    yield batch(a=a[ok], b=b[ok])

    return rows.mapInArrow(check, "a long, b long")


def near_duplicates(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that links reach), d (row key) for every document."""
    docs = keyed(docs, id_col, text_col)
    texts = docs.select("d", "text")
    named = bitmaps(docs, words).withColumnRenamed("name", "s")
    shared = shared_prefixes(texts, sketch(texts, words), words, percent)

    # every set against the first set, and the sets before it, with which it shares most lists
    near = shared.where("s != hub").where(close_enough("n", "hn", percent)).selectExpr("s", "hub as other")
    near = near.unionByName(shared.where("s != prev").where(close_enough("n", "pn", percent)).selectExpr("s", "prev as other"))
    nth = F.row_number().over(Window.partitionBy("s").orderBy(F.desc("count"), "other"))
    near = near.groupBy("s", "other").count().withColumn("nth", nth).where(F.col("nth") <= TRIED)
    near = near.select(F.least("s", "other").alias("a"), F.greatest("s", "other").alias("b")).distinct()
    # sets that share a list with another one; equal sets are represented by their first document
    wanted = shared.select("s").distinct()
    own = named.where("n_shingles > 0").join(wanted, "s", "left_semi").groupBy("s")
    nodes = saved(own.agg(F.min("d").alias("d"), F.min("n_shingles").alias("n"), *(F.min(f"b{i}").alias(f"b{i}") for i in range(BITMAP))), "nodes")
    first = saved(possible(near, nodes, percent), "first")
    links = saved(verified(first, texts, words, percent), "verified")
    groups = components(links)
    maps = nodes.select("s", *folded())
    own = ["s", "n", "c", *(f"b{i}" for i in range(FOLDED))]
    # each set of a list and the few before it, in an order of its own for every list
    order = Window.partitionBy("tok").orderBy(F.xxhash64("tok", "s"), "s")
    before = F.array(*(F.lag("x", k).over(order) for k in range(1, AGAIN + 1)))
    tried = members(shared, groups, maps).select("tok", "s", F.struct(*own).alias("x")).select("x", before.alias("before")).select("x", F.explode("before").alias("y"))
    tried = tried.where("x.c != y.c").where(alike("x.", "y.", percent))
    tried = tried.select(F.least("x.s", "y.s").alias("a"), F.greatest("x.s", "y.s").alias("b")).distinct().join(first, ["a", "b"], "left_anti")
    tried = saved(possible(tried, nodes, percent), "tried")
    found = saved(verified(tried, texts, words, percent), "verified")
    if found.limit(1).count():
        links = links.unionByName(found)
        groups = components(links)

    # in a list of few sets, each was tried with all others; longer lists that still hold several components: all pairs across them that share enough shingles
    # lists are dealt out once: the largest component of each and whether it has others are told where its rows are
    in_list, in_group = Window.partitionBy("tok"), Window.partitionBy("tok", "c")
    member = members(shared.where("not few"), groups, maps).repartition("tok").withColumn("n_c", F.count("*").over(in_group))
    member = member.withColumn("main", F.max(F.struct("n_c", "c")).over(in_list)["c"]).withColumn("low", F.min("c").over(in_list)).withColumn("high", F.max("c").over(in_list))
    member = saved(member.where("low < high").drop("n_c", "low", "high"), "members")
    outside = member.where("c != main").select("tok", *(F.col(x).alias(f"x{x}") for x in (*own, "l", "p")))
    pairs = outside.join(member, "tok").where("xc != c and (c = main or xs < s)").where(alike("x", "", percent))
    # two sets of known sizes must share `both` shingles, so the first min(l, l') of them stand in shorter prefixes
    both = shared_least("xn", "n", percent)
    pairs = pairs.where(f"xp < xn - {both} + least(xl, l) and p < n - {both} + least(xl, l)")
    pairs = pairs.groupBy(F.least("xs", "s").alias("a"), F.greatest("xs", "s").alias("b")).agg(F.count("*").alias("shared"), F.min(F.least("xl", "l")).alias("asked"))
    rest = saved(possible(pairs.where("shared >= asked"), nodes, percent), "pairs")
    more = verified(rest, texts, words, percent)
    groups = components(links.unionByName(saved(more, "verified")))

    joined = named.join(groups.selectExpr("node as s", "component as c"), "s", "left").withColumn("c", F.when(F.col("n_shingles") > 0, F.coalesce("c", "s")))
    low = joined.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("component_id"), F.min("d").alias("first"))
    out = joined.join(low, "c", "left")
    return out.select("d", "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("first", "d").alias("first"))


def join_report(docs: DataFrame, *, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    return near_duplicates(docs, words=words, percent=percent, id_col=id_col, text_col=text_col).select("doc_id", "n_shingles", "component_id")
