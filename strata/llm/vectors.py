"""What the two vector searches share: clean rows, classes of equal vectors, blocks, final ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATE_BLOCK = 8192
QUERY_BLOCK = 4096


def clean(vectors: DataFrame, nonzero: bool) -> DataFrame:
    """Rows with an id and finite components as (vec_id, vec of doubles), one row per id.

    Repeated rows of an id count once (of different ones the smallest vector). Null ids,
    null or empty vectors, and null, infinite or NaN components take no part.
    """
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("vec"))
    bad = F.exists("vec", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    rows = rows.filter(F.col("vec_id").isNotNull() & (F.size("vec") > 0) & ~bad)
    if nonzero:
        rows = rows.filter(F.exists("vec", lambda x: x != 0))
    first = Window.partitionBy("vec_id").orderBy("vec")
    return rows.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")


def representatives(rows: DataFrame, k: int) -> DataFrame:
    """Of each class of equal vectors the k + 1 smallest ids.

    Ties go to the smaller id and a query leaves out only itself, so no other member of a
    class can be among the k nearest. Each map task cuts a large class before the shuffle.
    """
    smallest = Window.partitionBy("vec").orderBy("vec_id")
    return rows.withColumn("n", F.row_number().over(smallest)).filter(F.col("n") <= k + 1).drop("n")


def tiles(queries: DataFrame, candidates: DataFrame, n_queries: int, n_candidates: int, **blocks: int) -> tuple[DataFrame, DataFrame]:
    """Deal both sides into blocks and repeat each block for all blocks of the other side.

    Adds ``tile`` (and, to both, ``dim``: only vectors of one length are compared).
    Blocks are filled by a hash of the unique id, so they are even and bounded.
    """
    rows = max(1, -(-n_queries // blocks.get("query_block", QUERY_BLOCK)))
    columns = max(1, -(-n_candidates // blocks.get("candidate_block", CANDIDATE_BLOCK)))

    def dealt(df: DataFrame, n: int) -> Column:
        return F.pmod(F.xxhash64("vec_id"), F.lit(n))

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    left = queries.withColumn("own", dealt(queries, rows)).withColumn("other", all_of(columns))
    right = candidates.withColumn("own", dealt(candidates, columns)).withColumn("other", all_of(rows))
    left = left.withColumn("tile", F.col("own") * columns + F.col("other"))
    right = right.withColumn("tile", F.col("other") * columns + F.col("own"))
    return (
        left.select("tile", F.size("vec").alias("dim"), "vec_id", "vec"),
        right.select("tile", F.size("vec").alias("dim"), "vec_id", "vec"),
    )


def matrix(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Ids and vectors of one tile; all have one length."""
    ids = rows.column("vec_id").to_numpy()
    flat = rows.column("vec").combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return ids, flat.reshape(len(ids), -1) if len(ids) else np.empty((0, 0))


def ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of all tiles of a query; each task cuts its own part first."""
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
