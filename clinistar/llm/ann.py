"""Operator 4: nearest neighbours by a block matrix join.

Vectors are packed into blocks: one row holds thousands of them as an int8
matrix with a scale, and the originals. Query blocks meet candidate blocks as
tiles of a matrix product. A tile's int8 product gives every inner product to
within a proved error; pairs that can't be among a query's ``k`` best of the
tile fall away, the rest are computed again in double precision, and the
tiles' sorted lists are merged by a heap. Nothing is approximate in the result.

A tile is the unit of work and of memory: ``QUERIES`` x ``CANDIDATES`` pairs,
whatever the table's size. Blocks are dealt by a hash of the id, so equal
vectors, however many, spread over all of them. The work is the stated query
set against all rows; only packed query blocks are repeated, once per
candidate block.
"""

from __future__ import annotations

import heapq
from itertools import islice

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clinistar.llm.common import staged, table

K = 20
#: Every how many ids is a query.
EVERY = 20
#: Vectors of a block.
CANDIDATES, QUERIES = 4096, 1024
#: Components multiplied at once: 127 * 127 * this is below 2**24, so that the
#: float32 product of int8 values is exact.
EXACT = 1024
#: Pairs recomputed at once.
PAIRS = 1 << 17

BLOCK = "dim int, block long, n int, ids binary, codes binary, scales binary, errors binary, vectors binary"


def usable(v: Column) -> Column:
    """Not null, not zero, and all components finite."""
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & finite & F.exists(v, lambda x: x != 0)


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """int8 codes, a scale for each row, and the length of what the codes miss."""
    scale = np.abs(x).max(axis=1) / 127
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    missed = np.sqrt(((x - codes * scale[:, None]) ** 2).sum(axis=1))
    return codes, scale, missed


def pack(rows: pd.DataFrame) -> pd.DataFrame:
    """One block. An id that occurs more than once counts once, with the
    vector that is largest component by component."""
    x = np.array([np.asarray(v, dtype=np.float64) for v in rows["embedding"]])
    ids = rows["vec_id"].to_numpy(dtype=np.int64)
    if len(np.unique(ids)) < len(ids):
        order = np.lexsort((*x.T[::-1], ids))
        last = np.r_[ids[order][1:] != ids[order][:-1], True]
        x, ids = x[order][last], ids[order][last]
    codes, scale, missed = quantise(x)
    data = [a.tobytes() for a in (ids, codes, scale, missed, x)]
    return pd.DataFrame([(x.shape[1], int(rows["block"].iloc[0]), len(ids), *data)], columns=[c.split()[0] for c in BLOCK.split(", ")])


def packed(vectors: DataFrame, n_blocks: int) -> DataFrame:
    block = F.pmod(F.xxhash64("vec_id"), F.lit(n_blocks))
    rows = vectors.withColumn("dim", F.size("embedding")).withColumn("block", block)
    return rows.groupBy("dim", "block").applyInPandas(lambda g: pack(g), BLOCK)


class Block:
    def __init__(self, row, dim: int, prefix: str):
        get = lambda name, kind: np.frombuffer(row[prefix + name], dtype=kind)
        self.ids, self.scale, self.missed = get("ids", np.int64), get("scales", np.float64), get("errors", np.float64)
        self.codes = get("codes", np.int8).reshape(-1, dim)
        self.x = get("vectors", np.float64).reshape(-1, dim)


def products(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact integer inner products of int8 rows."""
    total = 0
    for at in range(0, q.shape[1], EXACT):
        part = q[:, at : at + EXACT].astype(np.float32) @ c[:, at : at + EXACT].astype(np.float32).T
        total = total + part.astype(np.float64)
    return total


def tile(q: Block, c: Block, k: int) -> list[tuple[int, list[float], list[int]]]:
    """Each query's ``k`` best of the tile, best first, ties to smaller ids.

    With x = a + r and y = b + s, where a, b are what the codes stand for,
    |<x, y> - <a, b>| <= |x| |s| + |r| |b|.
    """
    with np.errstate(all="ignore"):
        near = products(q.codes, c.codes) * q.scale[:, None] * c.scale[None, :]
        long_q = np.sqrt((q.x**2).sum(axis=1))
        long_b = np.sqrt((c.x**2).sum(axis=1)) + c.missed
        error = (long_q[:, None] * c.missed[None, :] + q.missed[:, None] * long_b[None, :]) * (1 + 1e-9) + 1e-12 * np.abs(near)
        own = q.ids[:, None] == c.ids[None, :]
        low = np.where(own, -np.inf, near - error)
        if c.ids.size > k:
            least = np.partition(low, c.ids.size - k, axis=1)[:, c.ids.size - k]
            left = ~(near + error < least[:, None]) & ~own
        else:
            left = ~own
    qi, ci = np.nonzero(left)
    scores = np.empty(len(qi))
    for at in range(0, len(qi), PAIRS):
        some = slice(at, at + PAIRS)
        scores[some] = np.cumsum(q.x[qi[some]] * c.x[ci[some]], axis=1)[:, -1]  # summed in order
    order = np.lexsort((c.ids[ci], -scores, qi))
    qi, ci, scores = qi[order], ci[order], scores[order]
    starts = np.searchsorted(qi, np.arange(len(q.ids) + 1))
    out = []
    for i, (a, b) in enumerate(zip(starts[:-1], starts[1:])):
        b = min(b, a + k)
        if b > a:
            out.append((int(q.ids[i]), scores[a:b].tolist(), c.ids[ci[a:b]].tolist()))
    return out


def search(vectors: DataFrame, is_query: Column, k: int = K) -> DataFrame:
    """``query_id, rank, vec_id, score``: each query's ``k`` nearest rows by
    inner product, the query's own id left out.

    ``vectors`` needs ``vec_id, embedding``; other columns are ignored.
    ``is_query`` is a condition on ``vec_id``. A row takes no part if its id or
    vector is null, empty or zero, or a component is null or not finite.
    Vectors of different length aren't compared. A repeated id counts once
    (see ``pack``); equal vectors with different ids are separate rows, ties
    go to the smaller id. Fewer than ``k`` candidates give all of them; no
    rows, or no query, give no rows.
    """
    rows = vectors.select("vec_id", "embedding").where(F.col("vec_id").isNotNull() & usable(F.col("embedding")))
    counts = rows.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    n_c, n_q = max(1, -(-counts[0] // CANDIDATES)), max(1, -(-counts[1] // QUERIES))
    candidates = staged(packed(rows, n_c), "ann-candidates")
    queries = staged(packed(rows.where(is_query), n_q), "ann-queries")
    ours = queries.select("dim", F.col("block").alias("q_block"), *(F.col(c).alias(f"q_{c}") for c in ("ids", "codes", "scales", "errors", "vectors")))
    ours = ours.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_c - 1).cast("long"))))
    tiles = ours.join(candidates, ["dim", "block"])

    def multiply(g: pd.DataFrame) -> pd.DataFrame:
        row = g.iloc[0]
        dim = int(row["dim"])
        found = tile(Block(row, dim, "q_"), Block(row, dim, ""), k)
        return pd.DataFrame(found, columns=["query_id", "scores", "ids"])

    lists = tiles.groupBy("dim", "block", "q_block").applyInPandas(multiply, "query_id long, scores array<double>, ids array<long>")

    def merge(g: pd.DataFrame) -> pd.DataFrame:
        each = (zip((-s for s in scores), ids) for scores, ids in zip(g["scores"], g["ids"]))
        best = [*islice(heapq.merge(*each), k)]
        return pd.DataFrame({"query_id": int(g["query_id"].iloc[0]), "rank": range(1, len(best) + 1), "vec_id": [i for _, i in best], "score": [-s for s, _ in best]})

    return lists.groupBy("query_id").applyInPandas(merge, "query_id long, rank int, vec_id long, score double")


def op4_nearest(spark, sf_dir) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)


#: The same search in SQL: inner products in double precision, summed in order.
ORACLE = f"""
WITH parts AS (SELECT vec_id, embedding, unnest(embedding) AS c FROM embeddings WHERE vec_id IS NOT NULL),
v AS (SELECT DISTINCT vec_id, embedding::DOUBLE[] AS x, len(embedding) AS dim FROM parts
  GROUP BY vec_id, embedding HAVING bool_and(c IS NOT NULL AND isfinite(c)) AND bool_or(c <> 0)),
scored AS (SELECT q.vec_id AS query_id, c.vec_id, list_dot_product(q.x, c.x) AS score
  FROM v q JOIN v c ON q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % {EVERY} = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= {K}
"""
