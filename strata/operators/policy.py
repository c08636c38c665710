"""Column masks and row filters, published as governed views."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The groups that see everything, and the rounding step of others.
FINANCE_GROUP = "finance"
OPS_GROUP = "mining_ops"
COST_STEP = 1000


def member_of(groups: Collection[str], group: str) -> Column:
    """Whether the reader belongs to a group; the reader's groups are known at planning."""
    return F.lit(group in groups)


def mask_total_cost(cost: Column | str, groups: Collection[str]) -> Column:
    """The cost itself for finance, rounded to thousands for everyone else."""
    cost = F.col(cost) if isinstance(cost, str) else cost
    return F.when(member_of(groups, FINANCE_GROUP), cost).otherwise(F.round(cost / COST_STEP) * COST_STEP)


def filter_by_site_status(status: Column | str, groups: Collection[str]) -> Column:
    """Operations see every site, others active ones; an unknown status stays hidden."""
    status = F.col(status) if isinstance(status, str) else status
    return member_of(groups, OPS_GROUP) | F.coalesce(status == "Active", F.lit(False))


def apply_policy(
    df: DataFrame, masks: dict[str, Column] | None = None, row_filter: Column | None = None
) -> DataFrame:
    """Filter on the true values, then replace masked columns in place."""
    visible = df if row_filter is None else df.filter(row_filter)
    masks = masks or {}
    return visible.select(*[masks[c].alias(c) if c in masks else F.col(c) for c in df.columns])


def publish_view(df: DataFrame, name: str) -> None:
    """Make a governed DataFrame readable by name."""
    df.createOrReplaceTempView(name)


def register_policy_functions(spark: SparkSession) -> None:
    """The mask and the filter as SQL functions; Spark inlines them into the query.

    The caller states the membership, for lack of an account service to ask.
    """
    spark.sql(
        f"""CREATE OR REPLACE TEMPORARY FUNCTION mask_total_cost(cost DOUBLE, is_finance BOOLEAN)
        RETURNS DOUBLE
        RETURN IF(is_finance, cost, ROUND(cost / {COST_STEP}) * {COST_STEP})"""
    )
    spark.sql(
        """CREATE OR REPLACE TEMPORARY FUNCTION filter_by_site_status(site_status STRING, is_ops BOOLEAN)
        RETURNS BOOLEAN
        RETURN is_ops OR COALESCE(site_status = 'Active', FALSE)"""
    )
