"""Expectations and reconciliation checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

Rules = dict[str, Column]


def _holds(rule: Column) -> Column:
    """A rule that evaluates to NULL counts as violated."""
    return F.coalesce(rule, F.lit(False))


def expect_fail(df: DataFrame, rules: Rules) -> DataFrame:
    """Abort whichever job reads a violating row.

    The check is a filter on purpose: a helper column would be pruned, and the
    check with it, as soon as nobody reads it.
    """
    verdict = F.lit(True)
    for name, rule in reversed(rules.items()):
        verdict = F.when(~_holds(rule), F.raise_error(F.lit(f"expectation violated: {name}"))).otherwise(verdict)
    return df.filter(verdict)


def expect_drop(df: DataFrame, rules: Rules) -> DataFrame:
    """Keep the rows that satisfy every rule."""
    return df.filter(reduce(lambda a, b: a & b, [_holds(r) for r in rules.values()]))


def expect_metrics(df: DataFrame, rules: Rules) -> DataFrame:
    """Violations per rule and rows seen, in one pass: (rule, violations, rows)."""
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~_holds(rule)).alias(f"_v{i}") for i, rule in enumerate(rules.values())],
    )
    entries = [
        F.struct(F.lit(name).alias("rule"), F.col(f"_v{i}").alias("violations"))
        for i, name in enumerate(rules)
    ]
    return counts.select("rows", F.inline(F.array(*entries))).select("rule", "violations", "rows")


def observe_rules(df: DataFrame, rules: Rules, observation: Observation) -> DataFrame:
    """The same counts taken while the rows flow to their sink; read them from ``observation``."""
    return df.observe(
        observation,
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(~_holds(rule)).alias(name) for name, rule in rules.items()],
    )


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("cnt")).filter("cnt > 1")


def require_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key, or the job aborts."""
    rest = [c for c in df.columns if c not in keys]
    single = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("_n"), F.first(F.struct(*rest)).alias("_row")
    )
    return expect_fail(single, {f"one row per {', '.join(keys)}": F.col("_n") == 1}).select(
        *keys, "_row.*"
    )


def reconcile_totals(gold: DataFrame, source: DataFrame, measures: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Compare totals: one row per measure with both values and their difference.

    ``measures`` maps a name to (aggregate over gold, aggregate over source). Each
    side is aggregated on its own; only the two one-row results meet.
    """

    def totals(df: DataFrame, side: int) -> DataFrame:
        entries = [
            F.struct(F.lit(name).alias("measure"), pair[side].cast("double").alias("value"))
            for name, pair in measures.items()
        ]
        return df.agg(F.array(*entries).alias("_m")).select(F.lit(side).alias("side"), F.inline("_m"))

    def side_value(side: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("side") == side, F.col("value"))), F.lit(0.0))

    return (
        totals(gold, 0)
        .unionByName(totals(source, 1))
        .groupBy("measure")
        .agg(side_value(0).alias("gold_value"), side_value(1).alias("source_value"))
        .withColumn("difference", F.col("gold_value") - F.col("source_value"))
    )


def ghost_rows(gold: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Gold rows whose key has left the source."""
    return gold.join(source.select(*keys).distinct(), list(keys), "left_anti")


def batch_inventory(df: DataFrame, batch: str, loaded: str) -> DataFrame:
    """Rows and newest load time per batch."""
    return df.groupBy(batch).agg(F.count(F.lit(1)).alias("rows"), F.max(loaded).alias("loaded_at"))
