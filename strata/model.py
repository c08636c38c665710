"""The site, production, equipment and document views over the given tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import health_band, safe_ratio
from strata.operators.joins import broadcast_if_small

AS_OF = dt.date(2001, 6, 15)

# The columns of the given tables; declared, so that no file is opened
# to plan a query.
TABLES = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int,"
    " p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double,"
    " o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double,"
    " props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per site: supplier with its nation and region."""
    suppliers = table(spark, sf_dir, "supplier")
    rows = (
        suppliers
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("site_id"),
            F.col("s_name").alias("site_name"),
            F.col("n_name").alias("location"),
            F.col("r_name").alias("primary_mineral"),
            F.when(F.col("s_suppkey") % 3 == 0, "Open Pit")
            .when(F.col("s_suppkey") % 3 == 1, "Underground")
            .otherwise("Surface")
            .alias("mining_method"),
            F.when(F.col("s_acctbal") < 0, "Maintenance").otherwise("Active").alias("status"),
        )
    )
    return broadcast_if_small(rows, suppliers)


def production_of(lineitem: DataFrame) -> DataFrame:
    """Production readings, one per line item."""
    return lineitem.select(
        F.col("l_suppkey").alias("site_id"),
        F.col("l_shipdate").alias("production_datetime"),
        F.col("l_shipdate").cast("date").alias("production_date"),
        F.col("l_quantity").cast("int").alias("tons_extracted"),
        (F.col("l_discount") * 100).alias("mineral_grade_percent"),
        F.lit(1.0).alias("operating_hours"),
        safe_ratio(F.col("l_extendedprice"), F.col("l_quantity")).alias("cost_per_ton_usd"),
        F.col("l_extendedprice").alias("total_cost_usd"),
    )


def production(spark: SparkSession, sf_dir: str) -> DataFrame:
    return production_of(table(spark, sf_dir, "lineitem"))


def equipment_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maintenance events, one per order; ``event_id`` breaks ties of the sequence."""
    n_sites = table(spark, sf_dir, "supplier").agg(F.count(F.lit(1))).scalar()
    last = F.col("o_orderdate").cast("date")
    score = (60 + F.col("o_orderkey") % 39).cast("int")
    return table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("equipment_id"),
        (F.col("o_custkey") % n_sites).alias("site_id"),
        F.concat(F.lit("EQ-"), F.col("o_custkey").cast("string")).alias("equipment_name"),
        F.col("o_orderpriority").alias("equipment_type"),
        F.col("o_orderstatus").alias("category"),
        (F.col("o_orderkey") % 15000).cast("int").alias("operating_hours"),
        last.alias("last_maintenance_date"),
        F.date_add(last, (30 + F.col("o_orderkey") % 91).cast("int")).alias("next_maintenance_date"),
        score.alias("health_score"),
        health_band(score).alias("status"),
        F.col("o_totalprice").alias("annual_maintenance_cost_usd"),
        F.col("o_orderkey").alias("event_id"),
    )


EQUIPMENT_KEYS = ["equipment_id", "site_id"]


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly target per site."""
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").alias("site_id"),
        F.col("s_name").alias("site_name"),
        (120 + 20 * (F.col("s_suppkey") % 8)).cast("int").alias("monthly_target_tons"),
    )


def keyed_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Production orders with a unique key, the source of the change-data operators."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("site_id"),
        F.col("o_orderdate").cast("date").alias("production_date"),
        F.col("o_orderpriority").alias("priority"),
        (F.col("o_totalprice") / 1000).cast("int").alias("tons_extracted"),
        (25.0 + F.col("o_orderkey") % 30).alias("cost_per_ton_usd"),
        F.col("o_totalprice").alias("total_cost_usd"),
    )


SOURCE_KEYS = ["order_id"]

# The order book at three closings: what was known up to `upto`, kept from `since`
# on, with the costs of one priority class restated at twice their value. The newest
# closing has no end, and orders without a day are in it.
CLOSINGS = [
    {"upto": dt.date(2000, 6, 30), "since": None, "restated": []},
    {"upto": dt.date(2000, 12, 31), "since": dt.date(1995, 7, 1), "restated": ["1-URGENT"]},
    {"upto": None, "since": dt.date(1996, 1, 1), "restated": ["1-URGENT", "5-LOW"]},
]


def order_book(spark: SparkSession, sf_dir: str, closing: int) -> DataFrame:
    """The keyed source as it stood at one closing."""
    rule, day = CLOSINGS[closing], F.col("production_date")
    known = F.lit(True) if rule["since"] is None else day >= F.lit(rule["since"])
    known = known | day.isNull() if rule["upto"] is None else known & (day <= F.lit(rule["upto"]))
    return (
        keyed_source(spark, sf_dir)
        .filter(known)
        .withColumn(
            "total_cost_usd",
            F.when(F.col("priority").isin(rule["restated"]), F.col("total_cost_usd") * 2)
            .otherwise(F.col("total_cost_usd")),
        )
    )
