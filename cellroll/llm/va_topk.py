"""Exact top-k by integer inner product over a vector-approximation file.

Vectors are rounded to integers and laid out in blocks, each with its own grid: every component is kept as
one of 16 cells (4 bits), next to the exact vectors.  A block of queries meets every block of the file.  The
cells alone give each pair an upper and a lower bound of its score; exact vectors are then read in the order
of their upper bounds until the kth best exact score lies above all bounds that are left.  Blocks give
their own exact top k; the few rows of each query are merged at the end.

Similarity takes the place of distance: the highest upper bound is the smallest lower bound of a distance.
Vectors that are NULL, empty, or hold a NULL or non-finite component take no part, nor do rows without an id.
Vectors are compared with vectors of the same length only.  Repeated rows are candidates each; a query's own
id is never its candidate.  Scores beyond 64 bits saturate.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .tables import importable, saved

CELLS = 16
BLOCK_ROWS, QUERY_ROWS = 16_384, 1_024
EXACT = 2.0**53
FILE = "block long, n int, dim int, ids binary, low binary, step binary, cells binary, exact binary"


def rounded(vectors: DataFrame, id_col: str, vector_col: str, scale: float) -> DataFrame:
    """(vec_id, dim, v): floor(scale * x) of each component, for the vectors that take part."""
    x = F.col(vector_col).cast("array<double>")
    df = vectors.select(F.col(id_col).cast("long").alias("vec_id"), x.alias("x")).where("vec_id is not null and size(x) > 0")
    df = df.where("not exists(x, c -> c is null or isnan(c) or abs(c) = double('infinity'))")
    return df.select("vec_id", F.expr("size(x)").alias("dim"), F.expr(f"transform(x, c -> cast(floor({float(scale)!r}D * c) as double))").alias("v"))


def _pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One block of vectors as a row of the file."""
    v = np.stack(rows["v"].to_numpy())
    low, high = v.min(axis=0), v.max(axis=0)
    step = np.floor((high - low) / CELLS) + 1  # whole numbers, so bounds are exact
    cells = np.minimum((v - low) // step, CELLS - 1).astype(np.uint8)
    if cells.shape[1] % 2:
        cells = np.concatenate([cells, np.zeros((len(cells), 1), np.uint8)], axis=1)
    packed = cells[:, ::2] << 4 | cells[:, 1::2]
    ids = rows["vec_id"].to_numpy(dtype=np.int64)
    return pd.DataFrame({"block": [rows["block"].iloc[0]], "n": [len(rows)], "dim": [v.shape[1]], "ids": [ids.tobytes()], "low": [low.tobytes()], "step": [step.tobytes()], "cells": [packed.tobytes()], "exact": [v.tobytes()]}).astype({"n": "int32", "dim": "int32"})


def approximation_file(vectors: DataFrame, n_blocks: int) -> DataFrame:
    """The vectors (vec_id, dim, v) in blocks, a row each; vectors of one length share blocks."""
    # salted by the row's place, so that repeated rows spread out too
    block = F.pmod(F.xxhash64("vec_id", F.monotonically_increasing_id()), F.lit(n_blocks))
    return saved(vectors.withColumn("block", block).groupBy("block", "dim").applyInPandas(_pack, FILE), "vafile")


def _unpack(row) -> tuple:
    n, dim = int(row.n), int(row.dim)
    cells = np.frombuffer(row.cells, np.uint8).reshape(n, -1)
    cells = np.stack([cells >> 4, cells & 15], axis=2).reshape(n, -1)[:, :dim]
    return np.frombuffer(row.ids, np.int64), np.frombuffer(row.low), np.frombuffer(row.step), cells, np.frombuffer(row.exact).reshape(n, dim)


def _scores(exact: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Integer inner products; in Python integers where 53 bits might not do."""
    if np.abs(exact).max(initial=0) * np.abs(q).max(initial=0) * len(q) < EXACT:
        return (exact @ q).astype(np.int64)
    own = [int(c) for c in q]
    sums = [sum(int(a) * b for a, b in zip(row, own, strict=True)) for row in exact]
    return np.array([max(-(2**63), min(2**63 - 1, s)) for s in sums], dtype=np.int64)


def search_block(q_ids: np.ndarray, queries: np.ndarray, row, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """The k best of one block for each query, and how many exact vectors were read for them."""
    ids, low, step, cells, exact = _unpack(row)
    corner = low + cells * step
    # a component lies in [corner, corner + step - 1]
    base = corner @ queries.T
    top = base + np.maximum(queries, 0) @ (step - 1)
    wide = np.abs(corner).max(initial=0) * np.abs(queries).max(initial=0) * len(low) >= EXACT / 8
    slack = np.abs(top).max(initial=0) * 2.0**-40 if wide else 0.0  # bounds of huge products are not exact
    top += slack
    out_q, out_id, out_s, read = [], [], [], 0
    for j, q in enumerate(queries):
        other = ids != q_ids[j]
        bound = np.where(other, top[:, j], -np.inf)
        n = int(other.sum())
        if not n:
            continue
        best_s, best_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        want = min(n, max(4 * k, 32))
        taken = np.zeros(len(ids), dtype=bool)
        while True:
            if want < len(ids):
                some = np.argpartition(-bound, want - 1)[:want]
            else:
                some = np.arange(len(ids))
            some = some[other[some] & ~taken[some]]
            taken[some] = True
            read += len(some)
            s = _scores(exact[some], q)
            best_s, best_id = np.concatenate([best_s, s]), np.concatenate([best_id, ids[some]])
            order = np.lexsort((best_id, -best_s))[:k]
            best_s, best_id = best_s[order], best_id[order]
            rest = np.where(taken | ~other, -np.inf, bound).max(initial=-np.inf)
            if rest == -np.inf or len(best_s) == k and rest < best_s[-1]:
                break
            # read on: at least all that reach the kth score
            reach = int((bound >= best_s[-1]).sum()) if len(best_s) == k else want * 4
            want = min(len(ids), max(reach, want + 32))
        out_q.append(np.full(len(best_s), q_ids[j]))
        out_id.append(best_id)
        out_s.append(best_s)
    if not out_q:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), read
    return np.concatenate(out_q), np.concatenate(out_id), np.concatenate(out_s), read


def top_k(vectors: DataFrame, *, k: int = 5, every: int = 50, scale: float = 256.0, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best for each row whose id is divisible by ``every``."""
    importable(vectors.sparkSession)
    v = rounded(vectors, id_col, vector_col, scale)
    n = vectors.count()
    n_blocks = max(1, -(-n // BLOCK_ROWS))
    file = approximation_file(v, n_blocks)
    # rows of one query id are one query if they are equal
    asked = v.where(F.col("vec_id") % every == 0).dropDuplicates(["vec_id", "v"])
    n_query_blocks = max(1, -(-n // (every * QUERY_ROWS)))
    group = F.pmod(F.xxhash64(F.col("vec_id"), F.lit(1)), F.lit(n_query_blocks))
    asked = asked.withColumn("block", group).groupBy("block", "dim").applyInPandas(_pack, FILE)
    asked = asked.selectExpr("dim", "n as qn", "ids as qids", "exact as qexact")
    names = file.select("block", "dim").distinct()
    # each block of queries is sent to every block of the file: an equality join on the block's number
    sent = asked.join(names, "dim")
    pairs = file.join(sent, ["block", "dim"]).select("n", "dim", "ids", "low", "step", "cells", "exact", "qn", "qids", "qexact")

    def search(frames):
        for frame in frames:
            for row in frame.itertuples(index=False):
                queries = np.frombuffer(row.qexact).reshape(int(row.qn), int(row.dim))
                q, i, s, _ = search_block(np.frombuffer(row.qids, np.int64), queries, row, k)
                yield pd.DataFrame({"query_id": q, "vec_id": i, "score": s})

    found = pairs.mapInPandas(search, "query_id long, vec_id long, score long")
    best = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", best).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
