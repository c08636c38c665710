"""Exact top-k by vector-approximation files: bounds from quantised cells, then exact vectors."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.vectors import clean, matrix, ranked, representatives, tiles

CELLS = 32
VISIT = 16
LONG = np.iinfo(np.int64)  # its ends are Python numbers


class Approximation:
    """A block of vectors as cell numbers per dimension; each cell knows its least and largest value.

    Cells hold about equally many vectors of the block, so they follow the data.
    """

    def __init__(self, x: np.ndarray, cells: int = CELLS):
        n, dims = x.shape
        cells = min(cells, n)
        order = np.argsort(x, axis=0, kind="stable")
        edges = np.linspace(0, n, cells + 1).astype(int)
        self.codes = np.empty((n, dims), dtype=np.uint8)
        self.low, self.high = np.empty((cells, dims), x.dtype), np.empty((cells, dims), x.dtype)
        columns = np.arange(dims)
        for c, (a, b) in enumerate(zip(edges[:-1], edges[1:], strict=True)):
            self.codes[order[a:b], columns] = c
            self.low[c] = x[order[a], columns]
            self.high[c] = x[order[b - 1], columns]

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products of each row of q with each vector, from cells alone."""
        columns = np.arange(q.shape[1])
        low, high = self.low[self.codes, columns], self.high[self.codes, columns]
        plus, minus = np.maximum(q, 0), np.minimum(q, 0)
        return plus @ low.T + minus @ high.T, plus @ high.T + minus @ low.T


def best_of_block(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, int]]:
    """The k best of the block for each query: scan the cells, then visit vectors by bound."""
    q, x = np.floor(256 * q), np.floor(256 * x)
    if q.shape[1] * np.abs(q).max() * np.abs(x).max() >= 2**53:  # doubles would not add exactly
        q, x = (np.array([[int(v) for v in row] for row in m], dtype=object) for m in (q, x))
    file, found = Approximation(x), []
    for a in range(0, len(query_ids), 128):
        low, high = file.bounds(q[a : a + 128])
        if x.dtype == object:
            low, high = np.clip(low, LONG.min, LONG.max), np.clip(high, LONG.min, LONG.max)
        for i, (own, least, most) in enumerate(zip(query_ids[a : a + 128].tolist(), low, high, strict=True), start=a):
            keep = ids != own
            floor = np.sort(least[keep])[-k] if keep.sum() >= k else None
            near = np.flatnonzero(keep if floor is None else keep & (most >= floor))
            near = near[np.argsort(-most[near], kind="stable")]
            best: list[tuple[int, int]] = []
            for b in range(0, len(near), VISIT):
                step = near[b : b + VISIT]
                if len(best) == k and most[step[0]] < best[-1][0]:
                    break  # no vector further on can reach the k-th score
                scores = x[step] @ q[i]
                best += [(min(max(int(s), LONG.min), LONG.max), j) for s, j in zip(scores.tolist(), ids[step].tolist(), strict=True)]
                best = sorted(best, key=lambda e: (-e[0], e[1]))[:k]
            found += [(own, j, s) for s, j in best]
    return found


FOUND = "query_id long, vec_id long, score long"


def top_k(vectors: DataFrame, is_query: Column, k: int, **blocks: int) -> DataFrame:
    """The ``k`` highest integer scores of each query with all other vectors, exactly.

    Components are floor(256 * x). ``vectors`` has ``vec_id`` and ``embedding``;
    ``is_query`` picks the queries. Returns query_id, rank, vec_id, score; ties go to the
    smaller vec_id; all candidates if there are fewer than ``k``. What `vectors.clean`
    leaves out takes no part (zero vectors do take part); vectors are compared with
    those of their own length only. Scores beyond a long stop at its ends. An empty table
    gives no rows.

    Each block of candidates is a vector-approximation file of its own. Classes of equal
    vectors are cut to the ids that can be among the ``k``.
    """
    n, wanted = vectors.count(), vectors.filter(is_query).count()
    rows = clean(vectors, nonzero=False)
    whole = rows.withColumn("vec", F.transform("vec", lambda x: F.when(F.abs(x) < 2.0**44, F.floor(256 * x) / F.lit(256.0)).otherwise(x)))
    queries, candidates = tiles(rows.filter(is_query), representatives(whole, k), wanted, n, **blocks)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = best_of_block(*matrix(left), *matrix(right), k)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        return pa.table({c: pa.array(v, pa.int64()) for c, v in zip(("query_id", "vec_id", "score"), columns, strict=True)})

    key = ["tile", "dim"]
    return ranked(queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(tile, FOUND), k)
