"""Gold marts. All production marts roll up one additive site-day table.

Those marts take either readings or the site-day table (``site_day_measures``) that a
gold run computes once and stores, so that one pass over the readings serves all.

Aggregating to site and day before the joins keeps the only large shuffle at one
row per (site, day) and map task, whatever share of the readings one site holds.
Grade and cost are summed exactly, as limbs of whole numbers (``exact_sum``), so a mart is
the same for every partitioning and a total of parts is the total of the whole. Sites arrive marked for broadcast
only after a check of their number (``broadcast_if_small``); a larger dimension is
shuffled like any table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.functions.scalars import add_sums, carried, exact_sum, money_sum, safe_ratio, sum_value, within_days
from strata.operators.joins import is_small
from strata.operators.windows import bounded_rank, global_rank

SITE_ATTRIBUTES = ["site_id", "site_name", "location", "primary_mineral"]


def site_day_measures(production: DataFrame, *extra: Column) -> DataFrame:
    """Additive measures per site and day; sums of these rows are sums of their readings."""
    return production.groupBy("site_id", "production_date").agg(
        F.sum("tons_extracted").alias("tons"),
        carried(exact_sum("mineral_grade_percent")).alias("grade_sum"),
        F.count("mineral_grade_percent").alias("grade_count"),
        carried(exact_sum("total_cost_usd")).alias("cost_sum"),
        F.sum("operating_hours").alias("hours"),
        F.count(F.lit(1)).alias("readings"),
        *extra,
    )


def _measures(production: DataFrame, added_up: bool = False) -> DataFrame:
    """Site-day measures of readings; measures of one or more loads are added up per site and day.

    ``added_up`` says that they are: one row per site and day, as one load leaves them.
    """
    if "cost_sum" not in production.columns:
        return site_day_measures(production)
    if added_up:
        return production
    exact = [carried(add_sums(c)).alias(c) for c in ("grade_sum", "cost_sum")]
    added = [F.sum(c).alias(c) for c in ("tons", "grade_count", "hours", "readings")]
    return production.groupBy("site_id", "production_date").agg(*added, *exact)


def merge_site_days(measures: DataFrame) -> DataFrame:
    """Daily production summary from site-day measures of one or more loads."""
    return measures.groupBy("site_id", "production_date").agg(
        F.sum("tons").alias("total_tons"),
        _grade_over_rows().alias("avg_grade"),
        _cost_over_rows().alias("total_cost"),
        F.sum("readings").alias("record_count"),
    )


def _grade() -> Column:
    return safe_ratio(sum_value("grade_sum", is_carried=True), F.col("grade_count"))


def _cost() -> Column:
    return sum_value("cost_sum", is_carried=True)


def _grade_over_rows() -> Column:
    return safe_ratio(sum_value(add_sums("grade_sum")), F.sum("grade_count"))


def _cost_over_rows() -> Column:
    return sum_value(add_sums("cost_sum"))


def site_day_rollup(production: DataFrame, added_up: bool = False) -> DataFrame:
    """Daily production summary: site and day."""
    return _measures(production, added_up).select(
        "site_id",
        "production_date",
        F.col("tons").alias("total_tons"),
        _grade().alias("avg_grade"),
        _cost().alias("total_cost"),
        F.col("readings").alias("record_count"),
    )


def production_by_site(production: DataFrame, sites: DataFrame, added_up: bool = False) -> DataFrame:
    """Daily production with the attributes of its site."""
    return (
        _measures(production, added_up)
        .join(sites, "site_id")
        .select(
            *SITE_ATTRIBUTES,
            "mining_method",
            F.col("status").alias("site_status"),
            "production_date",
            F.col("tons").alias("tons_extracted"),
            _grade().alias("avg_grade_percent"),
            _cost().alias("total_cost_usd"),
            F.col("hours").alias("operating_hours"),
            F.col("readings").alias("record_count"),
        )
    )


def production_by_mineral(production: DataFrame, sites: DataFrame, added_up: bool = False) -> DataFrame:
    """Daily production per mineral.

    A site has one row per day before the join, so sites are counted as rows: a distinct
    count would hold all sites and days in memory a second time. Of rows that repeat a site
    one counts.
    """
    copies = Window.partitionBy("site_id", "primary_mineral").orderBy("site_id")
    places = sites.select("site_id", "primary_mineral", (F.row_number().over(copies) == 1).alias("_first"))
    return (
        _measures(production, added_up)
        .join(places, "site_id")
        .groupBy("primary_mineral", "production_date")
        .agg(
            F.count_if("_first").alias("site_count"),
            F.sum("tons").alias("total_tons_extracted"),
            _grade_over_rows().alias("avg_grade_percent"),
            _cost_over_rows().alias("total_cost_usd"),
            safe_ratio(_cost_over_rows(), F.sum("tons")).alias("avg_cost_per_ton_usd"),
        )
    )


def executive_daily(production: DataFrame, added_up: bool = False) -> DataFrame:
    """Totals, blended cost and reporting sites per day."""
    return (
        _measures(production, added_up)
        .groupBy(F.col("production_date").alias("report_date"))
        .agg(
            F.sum("tons").alias("total_tons_extracted"),
            _cost_over_rows().alias("total_production_cost_usd"),
            safe_ratio(_cost_over_rows(), F.sum("tons")).alias("blended_cost_per_ton_usd"),
            F.count("site_id").alias("sites_reporting_production"),
        )
    )


def site_performance(
    production: DataFrame, sites: DataFrame, as_of: dt.date, days: int = 30, added_up: bool = False
) -> DataFrame:
    """Sites by their tons of the last ``days`` days, ranked."""
    recent = production.filter(within_days(as_of, days, "production_date"))
    totals = (
        _measures(recent, added_up)
        .groupBy("site_id")
        .agg(
            F.sum("tons").alias("tons_last_30d"),
            _cost_over_rows().alias("cost_last_30d_usd"),
            safe_ratio(_cost_over_rows(), F.sum("tons")).alias("cost_per_ton_30d_usd"),
            _grade_over_rows().alias("avg_grade_percent_30d"),
        )
    )
    # A total exists per site at most, so the number of sites bounds the ranking.
    rank = bounded_rank if is_small(sites.select("site_id")) else global_rank
    return rank(totals, "tons_last_30d", "tons_rank").join(sites, "site_id").select(
        *SITE_ATTRIBUTES,
        "tons_last_30d",
        "cost_last_30d_usd",
        "cost_per_ton_30d_usd",
        "avg_grade_percent_30d",
        "tons_rank",
    )


def equipment_health_by_site(current: DataFrame, sites: DataFrame, as_of: dt.date) -> DataFrame:
    """Fleet counts, average health and cost per site, from current equipment rows."""
    return (
        current.groupBy("site_id")
        .agg(
            F.count(F.lit(1)).alias("equipment_count"),
            F.count_if(F.col("status") == "Operational").alias("operational_count"),
            F.count_if(F.col("status") == "Needs Attention").alias("needs_attention_count"),
            F.count_if(F.col("status") == "Monitor").alias("monitor_count"),
            safe_ratio(F.sum("health_score").cast("double"), F.count("health_score")).alias("avg_health_score"),
            money_sum("annual_maintenance_cost_usd").alias("total_annual_maintenance_cost_usd"),
            F.count_if(F.col("next_maintenance_date") <= F.lit(as_of)).alias("maintenance_overdue_count"),
        )
        .join(sites.select("site_id", "site_name", "primary_mineral"), "site_id")
    )


def maintenance_due(
    current: DataFrame, sites: DataFrame, as_of: dt.date, days: int = 30, healthy_from: int = 80
) -> DataFrame:
    """Equipment overdue, due within ``days``, or below the healthy score."""
    horizon = as_of + dt.timedelta(days=days)
    return (
        current.filter(
            (F.col("next_maintenance_date") <= F.lit(horizon)) | (F.col("health_score") < healthy_from)
        )
        .join(sites.select("site_id", "site_name", "location"), "site_id")
        .select(
            "site_id",
            "site_name",
            "location",
            "equipment_id",
            "equipment_name",
            "equipment_type",
            "health_score",
            "status",
            "last_maintenance_date",
            "next_maintenance_date",
            F.datediff("next_maintenance_date", F.lit(as_of)).alias("days_until_maintenance"),
            "annual_maintenance_cost_usd",
        )
    )


def _fleet_by_site(current: DataFrame, sites: DataFrame, as_of: dt.date) -> DataFrame:
    at_risk = (F.col("health_score") < 70) | (F.col("next_maintenance_date") <= F.lit(as_of))
    fleet = current.groupBy("site_id").agg(
        F.count("equipment_id").alias("units"), F.count_if(at_risk).alias("at_risk")
    )
    return sites.select("site_id", "status").join(fleet, "site_id", "left")


def fleet_snapshot(current: DataFrame, sites: DataFrame, as_of: dt.date) -> DataFrame:
    """One row of fleet counts. ``active_sites`` counts an active site once per unit
    it holds (at least once), as the joined view does; see fleet_snapshot_distinct."""
    weight = F.greatest(F.coalesce("units", F.lit(0)), F.lit(1))
    return _fleet_snapshot(_fleet_by_site(current, sites, as_of), F.sum(
        F.when(F.col("status") == "Active", weight).otherwise(0)
    ))


def fleet_snapshot_distinct(current: DataFrame, sites: DataFrame, as_of: dt.date) -> DataFrame:
    """The same row with every active site counted once."""
    return _fleet_snapshot(
        _fleet_by_site(current, sites, as_of), F.count_if(F.col("status") == "Active")
    )


def _fleet_snapshot(per_site: DataFrame, active: Column) -> DataFrame:
    return per_site.agg(
        F.count_distinct("site_id").alias("total_sites"),
        active.alias("active_sites"),
        F.coalesce(F.sum("units"), F.lit(0)).alias("total_equipment"),
        F.coalesce(F.sum("at_risk"), F.lit(0)).alias("equipment_at_risk"),
    )


def equipment_risk(current: DataFrame, sites: DataFrame) -> DataFrame:
    """Every unit with its site's attributes; units of unknown sites stay."""
    place = sites.select("site_id", "site_name", "location", F.col("status").alias("site_status"))
    return current.join(place, "site_id", "left").select(
        "equipment_id",
        "equipment_name",
        "equipment_type",
        "site_id",
        "site_name",
        "location",
        "site_status",
        "health_score",
        "status",
        "operating_hours",
        "next_maintenance_date",
        "annual_maintenance_cost_usd",
    )
