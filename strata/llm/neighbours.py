"""Nearest neighbours by a block matrix join with int8 product tiles and error bounds."""

from __future__ import annotations

import heapq

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from strata.llm.vectors import clean, matrix, ranked, representatives, tiles

STRIP = 2048


class Int8(object):
    """Rows as int8 codes times a scale, with the norms that bound the error of a product."""

    def __init__(self, x: np.ndarray):
        self.scale = np.abs(x).max(axis=1) / 127
        with np.errstate(divide="ignore", invalid="ignore"):
            codes = np.nan_to_num(np.rint(x / self.scale[:, None]), posinf=127, neginf=-127)
        self.codes = np.clip(codes, -127, 127).astype(np.int8)
        shown = self.codes * self.scale[:, None]
        self.error = np.linalg.norm(x - shown, axis=1)
        self.norm = np.linalg.norm(shown, axis=1)
        # float32 adds whole products below 2**24 exactly: the same as integer sums
        self.wide = np.float32 if x.shape[1] * 127 * 127 < 1 << 24 else np.float64

    def products(self, other: Int8, rows: slice, columns: slice) -> tuple[np.ndarray, np.ndarray]:
        """Approximate inner products of a tile, and how far each can be off."""
        tile = self.codes[rows].astype(self.wide) @ other.codes[columns].astype(self.wide).T
        near = tile * self.scale[rows, None] * other.scale[None, columns]
        off = np.outer(self.norm[rows] + self.error[rows], other.error[columns]) + np.outer(self.error[rows], other.norm[columns])
        return near, off * (1 + 1e-9) + 1e-12 * (np.abs(near) + np.outer(self.norm[rows], other.norm[columns]))


def exact(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added from first to last."""
    return np.add.accumulate(x * y, axis=1)[:, -1]


def best_of_tile(query_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int) -> list[tuple[int, int, float]]:
    """The k best candidates of each query in one tile, through one heap per query."""
    left, right = Int8(q), Int8(x)
    heaps: list[list[tuple[float, int]]] = [[] for _ in query_ids]
    floor = np.full(len(query_ids), -np.inf)
    for a in range(0, len(query_ids), 256):
        rows = slice(a, min(a + 256, len(query_ids)))
        for b in range(0, len(ids), STRIP):
            columns = slice(b, min(b + STRIP, len(ids)))
            near, off = left.products(right, rows, columns)
            own = query_ids[rows, None] == ids[None, columns]
            low = np.where(own, -np.inf, near - off)
            if low.shape[1] > k:
                kth = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
                np.maximum(floor[rows], kth, out=floor[rows])
            r, c = np.nonzero((near + off >= floor[rows, None]) & ~own)
            scores = exact(q[a + r], x[b + c])
            for i, j, score in zip((a + r).tolist(), ids[b + c].tolist(), scores.tolist(), strict=True):
                heap, entry = heaps[i], (score, -j)
                if len(heap) < k:
                    heapq.heappush(heap, entry)
                elif entry > heap[0]:
                    heapq.heapreplace(heap, entry)
            for i in set((a + r).tolist()):
                if len(heaps[i]) == k:
                    floor[i] = max(floor[i], heaps[i][0][0])
    return [(i, -j, score) for i, heap in zip(query_ids.tolist(), heaps, strict=True) for score, j in heap]


FOUND = "query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, is_query: Column, k: int, **blocks: int) -> DataFrame:
    """The ``k`` largest inner products of each query vector with all others, exactly.

    ``vectors`` has ``vec_id`` and ``embedding``; ``is_query`` picks the queries. Returns
    query_id, rank, vec_id, score; ties go to the smaller vec_id; all candidates if there
    are fewer than ``k``. Zero vectors and those that `vectors.clean` leaves out take no
    part; vectors are compared with those of their own length only. An empty table gives
    no rows.

    Queries and candidates are dealt into blocks. A task takes one tile: int8 products
    bound every inner product from both sides, pairs whose upper bound stays below the
    k-th lower bound are out, and the rest is recomputed from the original vectors.
    """
    n, wanted = vectors.count(), vectors.filter(is_query).count()
    rows = clean(vectors, nonzero=True)
    queries, candidates = tiles(rows.filter(is_query), representatives(rows, k), wanted, n, **blocks)

    def tile(left: pa.Table, right: pa.Table) -> pa.Table:
        found = []
        if left.num_rows and right.num_rows:
            found = best_of_tile(*matrix(left), *matrix(right), k)
        columns = list(zip(*found, strict=True)) or [[], [], []]
        types = pa.int64(), pa.int64(), pa.float64()
        return pa.table({c: pa.array(v, t) for c, v, t in zip(("query_id", "vec_id", "score"), columns, types, strict=True)})

    key = ["tile", "dim"]
    return ranked(queries.groupBy(*key).cogroup(candidates.groupBy(*key)).applyInArrow(tile, FOUND), k)
