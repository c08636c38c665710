"""Per-key ordering operators that hold when one key owns a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order_by``, which must end in a tie-breaker.

    Spark keeps one row per key in each map task before the shuffle (a partial
    group limit), so a hot key arrives as one row per task.
    """
    ranked = Window.partitionBy(*keys).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(ranked)).filter("_rn = 1").drop("_rn")


def neighbour(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    value: Column,
    out: str,
    ahead: bool = True,
    split: Column | None = None,
) -> DataFrame:
    """Add ``out``: ``value`` of the next (or previous) row of the key.

    ``split`` must not decrease as ``order`` grows. With it, each (key, split)
    piece is sorted on its own and only the edge row of a piece looks across to
    the neighbouring piece, so no task holds a whole key. ``order`` must be unique
    in a key.
    """
    step = F.lead if ahead else F.lag
    if split is None:
        return df.withColumn(out, step(value).over(Window.partitionBy(*keys).orderBy(order)))

    piece = [*keys, "_split"]
    in_piece = Window.partitionBy(*piece).orderBy(order)
    whole_piece = in_piece.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    nearest = (F.first if ahead else F.last)(value).over(whole_piece)
    local = (
        df.withColumn("_split", split)
        .withColumn(out, step(value).over(in_piece))
        .withColumn("_edge", step(F.lit(True)).over(in_piece).isNull())
        .withColumn("_nearest", nearest)
    )
    # The edge rows of a key meet in one group, one per piece; all others stay in
    # their pieces. One plan without branches, so nothing is computed twice.
    groups = local.withColumn("_group", F.when(~F.col("_edge"), F.col("_split")))
    beyond = step("_nearest").over(Window.partitionBy(*keys, "_group").orderBy("_split"))
    return groups.withColumn(out, F.when(F.col("_edge"), beyond).otherwise(F.col(out))).drop(
        "_split", "_edge", "_nearest", "_group"
    )


def bounded_rank(df: DataFrame, measure: str, out: str) -> DataFrame:
    """Add ``out``: the rank by ``measure``, greatest first, in one task. For tables
    whose row count has been checked; see ``global_rank`` for any other."""
    return df.withColumn(out, F.rank().over(Window.orderBy(F.desc_nulls_last(measure))).cast("long"))


def global_rank(df: DataFrame, measure: str, out: str, pieces: int = 64) -> DataFrame:
    """Add ``out``: the rank of each row by ``measure``, greatest first, ties equal, NULL last.

    Distinct values are cut into ranges; a value's rank is the rows in higher
    ranges plus those above it in its own range. No window runs over the whole.
    """
    values = df.groupBy(F.col(measure).alias("_value")).agg(F.count(F.lit(1)).alias("_rows"))
    cuts = df.approxQuantile(measure, [i / pieces for i in range(1, pieces)], 0.5 / pieces)
    bounds = F.array(*[F.lit(c) for c in sorted(set(cuts))]) if cuts else F.array().cast("array<double>")
    piece = F.size(F.filter(bounds, lambda c: F.col("_value") > c))
    spread = values.withColumn("_piece", F.when(F.col("_value").isNull(), -1).otherwise(piece))

    # At most `pieces` rows, so this window is bounded by the parameter.
    higher = Window.orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        spread.groupBy("_piece")
        .agg(F.sum("_rows").alias("_size"))
        .select("_piece", F.coalesce(F.sum("_size").over(higher), F.lit(0)).alias("_before"))
    )
    above = (
        Window.partitionBy("_piece")
        .orderBy(F.desc("_value"))
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    ranks = (
        spread.join(offsets, "_piece")
        .select(
            "_value",
            (F.lit(1) + F.col("_before") + F.coalesce(F.sum("_rows").over(above), F.lit(0))).alias(out),
        )
    )
    return df.join(ranks, df[measure].eqNullSafe(ranks["_value"])).drop("_value")
