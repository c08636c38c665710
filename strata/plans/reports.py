"""Dashboard queries, target comparison and the usual questions to the gold layer.

They read the daily production summary (``total_tons``, ``total_cost`` per site and
day), as a dashboard does, or readings where noted.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import month_start, safe_ratio, within_days


def tons_by_day(daily: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Trend line: tons per day."""
    recent = daily.filter(within_days(as_of, days, "production_date"))
    return recent.groupBy("production_date").agg(F.sum("total_tons").alias("tons"))


def tons_total(daily: DataFrame, as_of: dt.date, days: int = 90) -> DataFrame:
    """Counter: tons of the period in one row."""
    recent = daily.filter(within_days(as_of, days, "production_date"))
    return recent.agg(F.coalesce(F.sum("total_tons"), F.lit(0)).alias("tons"))


def top_sites(daily: DataFrame, k: int = 10) -> DataFrame:
    """Sites with the most tons."""
    return (
        daily.groupBy("site_id")
        .agg(F.sum("total_tons").alias("tons"))
        .orderBy(F.desc("tons"), "site_id")
        .limit(k)
    )


def top_site_last_month(daily: DataFrame, as_of: dt.date) -> DataFrame:
    """Site with the most tons in the last full month."""
    return top_sites(_last_full_month(daily, as_of), 1)


def latest_days(daily: DataFrame, k: int = 10) -> DataFrame:
    """The newest rows of the daily summary."""
    return daily.orderBy(F.desc("production_date"), "site_id").limit(k)


def low_health(risk: DataFrame, below: int = 70) -> DataFrame:
    """Equipment under a health score."""
    return risk.filter(F.col("health_score") < below)


def lowest_health(risk: DataFrame, k: int = 15) -> DataFrame:
    """The ``k`` units in the worst state."""
    return (
        risk.select(
            "equipment_id", "equipment_name", "site_id", "site_name", "site_status", "health_score", "status"
        )
        .orderBy("health_score", "equipment_id", "site_id")
        .limit(k)
    )


def target_vs_actual(
    daily: DataFrame, targets: DataFrame, as_of: dt.date, days: int = 90
) -> DataFrame:
    """Actual tons against the monthly target per site and month."""
    actual = (
        daily.filter(within_days(as_of, days, "production_date"))
        .groupBy("site_id", month_start("production_date").alias("month"))
        .agg(F.sum("total_tons").alias("actual_tons"))
    )
    return actual.join(targets, "site_id").select(
        "site_id",
        "site_name",
        "month",
        "actual_tons",
        "monthly_target_tons",
        (F.col("actual_tons") - F.col("monthly_target_tons")).alias("delta_tons"),
        safe_ratio(F.col("actual_tons") * F.lit(100.0), F.col("monthly_target_tons")).alias("pct_of_target"),
    )


def top_target_deltas(comparison: DataFrame, k: int = 20) -> DataFrame:
    """The months furthest above target."""
    return comparison.orderBy(F.desc("delta_tons"), "site_id", "month").limit(k)


def missed_targets(daily: DataFrame, targets: DataFrame, as_of: dt.date) -> DataFrame:
    """Sites below target in the last full month, silent ones included."""
    actual = (
        _last_full_month(daily, as_of).groupBy("site_id").agg(F.sum("total_tons").alias("tons"))
    )
    tons = F.coalesce("tons", F.lit(0))
    return (
        targets.join(actual, "site_id", "left")
        .filter(tons < F.col("monthly_target_tons"))
        .select(
            "site_id",
            "site_name",
            tons.alias("actual_tons"),
            "monthly_target_tons",
            (tons - F.col("monthly_target_tons")).alias("delta_tons"),
        )
    )


def site_extent(production: DataFrame) -> DataFrame:
    """Rows and covered period per site."""
    return production.groupBy("site_id").agg(
        F.count(F.lit(1)).alias("daily_rows"),
        F.min("production_date").alias("earliest"),
        F.max("production_date").alias("latest"),
    )


def partition_counts(production: DataFrame, k: int = 10) -> DataFrame:
    """Rows of the newest days."""
    return (
        production.groupBy("production_date")
        .agg(F.count(F.lit(1)).alias("rows"))
        .orderBy(F.desc("production_date"))
        .limit(k)
    )


def _last_full_month(daily: DataFrame, as_of: dt.date) -> DataFrame:
    stop = as_of.replace(day=1)
    start = (stop - dt.timedelta(days=1)).replace(day=1)
    day = F.col("production_date")
    return daily.filter((day >= F.lit(start)) & (day < F.lit(stop)))
