"""Registered queries over the given tables: name -> callable(spark, sf_dir)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata import model
from strata.functions import scalars as fx
from strata.model import AS_OF, EQUIPMENT_KEYS, SOURCE_KEYS
from strata.operators import changes, documents, grids, policy, quality, scd2, windows
from strata.operators.joins import broadcast_if_small
from strata.operators.partitions import map_partitions
from strata.plans import marts, reports

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Commit times of the order-book closings.
COMMITS = [dt.datetime(2001, 1, 1), dt.datetime(2001, 2, 1), dt.datetime(2001, 3, 1)]


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


# -- shared inputs ---------------------------------------------------------------


def _daily(spark, sf_dir, days: int | None = None):
    """Daily summary; ``days`` restricts the scan to the period before AS_OF."""
    readings = model.production(spark, sf_dir)
    if days is not None:
        readings = readings.filter(fx.within_days(AS_OF, days, "production_date", "production_datetime"))
    return marts.site_day_rollup(readings)


def _newest_event():
    return [F.desc("last_maintenance_date"), F.desc("event_id")]


def _history(spark, sf_dir):
    return scd2.scd2_history(
        model.equipment_events(spark, sf_dir),
        EQUIPMENT_KEYS,
        "last_maintenance_date",
        [F.desc("event_id")],
    )


def _current(spark, sf_dir):
    """Current rows need no intervals: they are the newest event of each key."""
    return windows.latest_per_key(model.equipment_events(spark, sf_dir), EQUIPMENT_KEYS, _newest_event())


def _risk(spark, sf_dir):
    return marts.equipment_risk(_current(spark, sf_dir), model.sites(spark, sf_dir))


def _feed(spark, sf_dir, version: int):
    return changes.change_feed(
        model.order_book(spark, sf_dir, version - 1),
        model.order_book(spark, sf_dir, version),
        SOURCE_KEYS,
        version,
        COMMITS[version],
    )


def _feeds(spark, sf_dir):
    return _feed(spark, sf_dir, 1).unionByName(_feed(spark, sf_dir, 2))


def _mirror_start(spark, sf_dir):
    return model.order_book(spark, sf_dir, 0).withColumns(
        {"_cdc_type": F.lit("insert"), "_cdc_timestamp": F.lit(COMMITS[0]).cast("timestamp")}
    )


def _audit(spark, sf_dir):
    start = model.order_book(spark, sf_dir, 0).withColumns(
        {
            "_operation": F.lit("INSERT"),
            "_commit_version": F.lit(0).cast("long"),
            "_commit_timestamp": F.lit(COMMITS[0]).cast("timestamp"),
        }
    )
    return start.unionByName(changes.audit_append(_feeds(spark, sf_dir)))


def _plain_time(df, name):
    return df.withColumn(name, F.col(name).cast("timestamp_ntz"))


# -- gold marts ------------------------------------------------------------------


@query
def production_by_site(spark, sf_dir):
    return marts.production_by_site(model.production(spark, sf_dir), model.sites(spark, sf_dir))


@query
def production_by_mineral(spark, sf_dir):
    return marts.production_by_mineral(model.production(spark, sf_dir), model.sites(spark, sf_dir))


@query
def site_day_rollup(spark, sf_dir):
    return _daily(spark, sf_dir)


@query
def executive_daily(spark, sf_dir):
    return marts.executive_daily(model.production(spark, sf_dir))


@query
def site_performance(spark, sf_dir):
    return marts.site_performance(model.production(spark, sf_dir), model.sites(spark, sf_dir), AS_OF)


@query
def equipment_health_by_site(spark, sf_dir):
    return marts.equipment_health_by_site(_current(spark, sf_dir), model.sites(spark, sf_dir), AS_OF)


@query
def maintenance_due(spark, sf_dir):
    return marts.maintenance_due(_current(spark, sf_dir), model.sites(spark, sf_dir), AS_OF)


@query
def fleet_snapshot(spark, sf_dir):
    return marts.fleet_snapshot(_current(spark, sf_dir), model.sites(spark, sf_dir), AS_OF)


@query
def fleet_snapshot_distinct(spark, sf_dir):
    return marts.fleet_snapshot_distinct(_current(spark, sf_dir), model.sites(spark, sf_dir), AS_OF)


@query
def equipment_risk(spark, sf_dir):
    return _risk(spark, sf_dir)


# -- reports ---------------------------------------------------------------------


@query
def tons_last_90d(spark, sf_dir):
    return reports.tons_by_day(_daily(spark, sf_dir, 90), AS_OF)


@query
def tons_total_90d(spark, sf_dir):
    return reports.tons_total(_daily(spark, sf_dir, 90), AS_OF)


@query
def top_sites(spark, sf_dir):
    return reports.top_sites(_daily(spark, sf_dir))


@query
def top_site_last_month(spark, sf_dir):
    return reports.top_site_last_month(_daily(spark, sf_dir, 62), AS_OF)


@query
def low_health(spark, sf_dir):
    return reports.low_health(_risk(spark, sf_dir))


@query
def lowest_health(spark, sf_dir):
    return reports.lowest_health(_risk(spark, sf_dir))


@query
def target_vs_actual(spark, sf_dir):
    return reports.target_vs_actual(_daily(spark, sf_dir, 90), model.targets(spark, sf_dir), AS_OF)


@query
def top_target_deltas(spark, sf_dir):
    return reports.top_target_deltas(target_vs_actual(spark, sf_dir))


@query
def missed_targets(spark, sf_dir):
    return reports.missed_targets(_daily(spark, sf_dir, 62), model.targets(spark, sf_dir), AS_OF)


@query
def site_extent(spark, sf_dir):
    return reports.site_extent(model.production(spark, sf_dir))


@query
def partition_counts(spark, sf_dir):
    return reports.partition_counts(model.production(spark, sf_dir))


# -- projections, functions ------------------------------------------------------


@query
def silver_passthrough(spark, sf_dir):
    bronze = model.production(spark, sf_dir).withColumn("_rescued_data", F.lit(None).cast("string"))
    return bronze.drop("_rescued_data")


@query
def silver_cleanse(spark, sf_dir):
    """Readings with a grade up to 5 percent and at least one ton: the range filters."""
    return quality.expect_drop(
        model.production(spark, sf_dir),
        {
            "tons": F.col("tons_extracted") >= 0,
            "grade": F.col("mineral_grade_percent").between(0, 5),
        },
    )


@query
def derive_cost(spark, sf_dir):
    """A chain of derived columns; the cast to INT cuts towards zero."""
    return (
        model.table(spark, sf_dir, "lineitem")
        .withColumn("net_price", F.col("l_extendedprice") * (1 - F.col("l_discount")))
        .withColumn("net_dollars", F.col("net_price").cast("int"))
        .withColumn("cost_per_ton", F.col("net_dollars") / F.col("l_quantity"))
        .select("l_orderkey", "l_linenumber", "l_partkey", "net_price", "net_dollars", "cost_per_ton")
    )


@query
def health_band(spark, sf_dir):
    events = model.equipment_events(spark, sf_dir)
    return events.select("event_id", "health_score", fx.health_band("health_score").alias("band"))


@query
def date_math(spark, sf_dir):
    day = F.col("o_orderdate").cast("date")
    return model.table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.date_add(day, 30).alias("plus_30"),
        F.date_sub(day, 90).alias("minus_90"),
        (day - F.expr("interval 30 days")).cast("date").alias("minus_interval"),
        fx.month_start(day).alias("month"),
        F.datediff(F.lit(AS_OF), day).alias("age_days"),
    )


@query
def time_spine(spark, sf_dir):
    """Every hour of the period the readings cover."""
    return grids.time_spine(spark, *grids.extent(model.production(spark, sf_dir), "production_date"))


@query
def slugify(spark, sf_dir):
    return model.table(spark, sf_dir, "customer").select(
        "c_custkey",
        fx.slugify(F.concat_ws(" - ", "c_name", "c_mktsegment")).alias("slug"),
    )


@query
def json_path(spark, sf_dir):
    return model.table(spark, sf_dir, "events").select(
        "event_id",
        fx.json_path("props", "$.k", "long").alias("k"),
        F.length("props").alias("props_length"),
    )


@query
def variant_path(spark, sf_dir):
    return model.table(spark, sf_dir, "events").select(
        "event_id", fx.variant_path("props", "$.k", "bigint").alias("k")
    )


# -- quality ---------------------------------------------------------------------


def _event_rules():
    return {
        "valid_equipment_id": F.col("equipment_id") > 0,
        "valid_site": F.col("site_id").isNotNull(),
        "healthy": F.col("health_score") >= 70,
    }


@query
def expect_fail(spark, sf_dir):
    """Passes every event: no key is missing."""
    return quality.expect_fail(
        model.equipment_events(spark, sf_dir), {"not_empty": F.col("equipment_id").isNotNull()}
    )


@query
def expect_drop(spark, sf_dir):
    return quality.expect_drop(model.equipment_events(spark, sf_dir), _event_rules())


@query
def expect_metrics(spark, sf_dir):
    return quality.expect_metrics(model.equipment_events(spark, sf_dir), _event_rules())


@query
def duplicate_keys(spark, sf_dir):
    return quality.duplicate_keys(model.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query
def reconcile_totals(spark, sf_dir):
    return quality.reconcile_totals(
        _daily(spark, sf_dir),
        model.production(spark, sf_dir),
        {
            "tons": (F.sum("total_tons"), F.sum("tons_extracted")),
            "cost": (fx.money_sum("total_cost"), fx.money_sum("total_cost_usd")),
            "rows": (F.sum("record_count"), F.count(F.lit(1))),
        },
    )


@query
def ghost_rows(spark, sf_dir):
    """Orders of the first closing that the second no longer holds."""
    return quality.ghost_rows(
        model.order_book(spark, sf_dir, 0), model.order_book(spark, sf_dir, 1), SOURCE_KEYS
    )


@query
def batch_inventory(spark, sf_dir):
    return _plain_time(
        quality.batch_inventory(_audit(spark, sf_dir), "_commit_version", "_commit_timestamp"),
        "loaded_at",
    )


# -- joins -----------------------------------------------------------------------


@query
def missing_site_days(spark, sf_dir):
    return grids.missing_site_days(model.sites(spark, sf_dir), model.production(spark, sf_dir))


@query
def lookup_join(spark, sf_dir):
    """Readings priced from a lookup of the parts, counted per part before the join."""
    parts = model.table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_retailprice")
    counts = model.table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.count(F.lit(1)).alias("n"))
    return (
        counts.join(broadcast_if_small(parts), F.col("l_partkey") == F.col("p_partkey"))
        .groupBy("p_brand")
        .agg(
            F.sum("n").alias("readings"),
            fx.sum_value(fx.exact_sum("p_retailprice", F.col("n"), wide=True)).alias("list_price"),
        )
    )


def _second_deletes(spark, sf_dir):
    return _feed(spark, sf_dir, 1).filter(F.col("_change_type") == changes.DELETE)


@query
def semi_keys(spark, sf_dir):
    return changes.semi_keys(
        model.order_book(spark, sf_dir, 0), _second_deletes(spark, sf_dir), SOURCE_KEYS
    )


@query
def anti_keys(spark, sf_dir):
    """Customers without an order in the second closing."""
    buyers = model.order_book(spark, sf_dir, 1).select(F.col("site_id").alias("c_custkey"))
    return changes.delete_matching(
        model.table(spark, sf_dir, "customer").select("c_custkey", "c_name"), buyers, ["c_custkey"]
    )


@query
def peer_access(spark, sf_dir):
    return grids.peer_access(model.table(spark, sf_dir, "supplier"), "s_suppkey")


# -- windows, changes, history ---------------------------------------------------


@query
def latest_per_key(spark, sf_dir):
    return _current(spark, sf_dir)


@query
def audit_latest(spark, sf_dir):
    return _plain_time(changes.audit_latest(_audit(spark, sf_dir), SOURCE_KEYS), "_commit_timestamp")


@query
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query
def scd2_subset(spark, sf_dir):
    return scd2.scd2_history(
        model.equipment_events(spark, sf_dir),
        EQUIPMENT_KEYS,
        "last_maintenance_date",
        [F.desc("event_id")],
        tracked=["status"],
    )


@query
def scd2_timestamps(spark, sf_dir):
    """What each user last did, as intervals: a sequence finer than days."""
    events = model.table(spark, sf_dir, "events").select("user_id", "ts", "event_type", "event_id")
    return scd2.scd2_history(
        events, ["user_id"], "ts", [F.desc("event_id")], tracked=["event_type"]
    )


@query
def scd2_current(spark, sf_dir):
    return scd2.scd2_current(_history(spark, sf_dir))


@query
def scd2_as_of(spark, sf_dir):
    return scd2.scd2_as_of(_history(spark, sf_dir), F.lit(dt.date(1999, 1, 1)))


@query
def scd2_apply(spark, sf_dir):
    """The newer events first, then the older ones as a late batch: the same history."""
    events = model.equipment_events(spark, sf_dir)
    newer = F.col("last_maintenance_date") >= F.lit(dt.date(1999, 1, 1))
    how = (EQUIPMENT_KEYS, "last_maintenance_date", [F.desc("event_id")])
    return scd2.scd2_apply(scd2.scd2_history(events.filter(newer), *how), events.filter(~newer), *how)


@query
def change_feed(spark, sf_dir):
    return _plain_time(_feed(spark, sf_dir, 1), "_commit_timestamp")


@query
def change_breakdown(spark, sf_dir):
    return _feeds(spark, sf_dir).groupBy("_commit_version", "_change_type").agg(F.count(F.lit(1)).alias("cnt"))


@query
def change_split(spark, sf_dir):
    return changes.as_mirror_rows(_feeds(spark, sf_dir)).withColumn(
        "_cdc_timestamp", F.col("_cdc_timestamp").cast("timestamp_ntz")
    )


@query
def strip_meta(spark, sf_dir):
    return changes.strip_meta(_feed(spark, sf_dir, 1))


@query
def net_changes(spark, sf_dir):
    return _plain_time(changes.net_changes(_feeds(spark, sf_dir), SOURCE_KEYS), "_commit_timestamp")


@query
def merge_upsert(spark, sf_dir):
    """Second closing merged into the first; nothing is deleted."""
    return changes.merge_upsert(
        model.order_book(spark, sf_dir, 0),
        changes.strip_meta(changes.upserts(_feed(spark, sf_dir, 1))),
        SOURCE_KEYS,
    )


@query
def merge_update(spark, sf_dir):
    """Restated tons; the cost is taken from the tons before the update."""
    adjusted = model.order_book(spark, sf_dir, 1).select(
        "order_id", (0.9 + fx.unit_hash("order_id") * 0.2).alias("adjustment")
    )
    return changes.merge_update(
        model.keyed_source(spark, sf_dir),
        adjusted,
        SOURCE_KEYS,
        {
            "tons_extracted": (F.col("t.tons_extracted") * F.col("s.adjustment")).cast("int"),
            "total_cost_usd": F.col("t.tons_extracted") * F.col("t.cost_per_ton_usd"),
        },
    )


@query
def delete_matching(spark, sf_dir):
    return changes.delete_matching(
        model.order_book(spark, sf_dir, 0), _second_deletes(spark, sf_dir), SOURCE_KEYS
    )


@query
def cdc_mirror(spark, sf_dir):
    return changes.cdc_mirror(_mirror_start(spark, sf_dir), _feeds(spark, sf_dir), SOURCE_KEYS).withColumn(
        "_cdc_timestamp", F.col("_cdc_timestamp").cast("timestamp_ntz")
    )


@query
def audit_append(spark, sf_dir):
    return _plain_time(_audit(spark, sf_dir), "_commit_timestamp")


@query
def key_sample(spark, sf_dir):
    """Two percent of the orders, chosen by key."""
    return changes.key_sample(model.keyed_source(spark, sf_dir), SOURCE_KEYS, 0.02)


@query
def incremental_slice(spark, sf_dir):
    """Readings after a high-water mark."""
    return model.production(spark, sf_dir).filter(
        F.col("production_datetime") > F.lit(AS_OF.isoformat()).cast("timestamp_ntz")
    )


@query
def get_watermark(spark, sf_dir):
    mark = F.max("production_datetime")
    return model.production(spark, sf_dir).agg(
        F.coalesce(mark, F.lit("1970-01-01").cast("timestamp_ntz")).alias("watermark")
    )


@query
def align_schema(spark, sf_dir):
    """Readings in the types and order declared for the production table."""
    from pyspark.sql.types import StructType

    wanted = StructType.fromDDL(
        "site_id int, production_datetime timestamp_ntz, production_date date, tons_extracted int,"
        " mineral_grade_percent double, operating_hours double, cost_per_ton_usd double,"
        " total_cost_usd double, note string"
    )
    return changes.align_schema(model.production(spark, sf_dir), wanted)


# -- governance ------------------------------------------------------------------


@query
def masked_costs(spark, sf_dir):
    daily = _daily(spark, sf_dir)
    return policy.apply_policy(daily, masks={"total_cost": policy.mask_total_cost("total_cost", set())})


@query
def masked_latest_days(spark, sf_dir):
    """The newest masked rows, as a reader outside finance sees them."""
    return reports.latest_days(masked_costs(spark, sf_dir))


@query
def mask_cost(spark, sf_dir):
    """The mask as an SQL function, for readers inside and outside finance."""
    policy.register_policy_functions(spark)
    return model.keyed_source(spark, sf_dir).selectExpr(
        "order_id",
        "mask_total_cost(total_cost_usd, true) AS finance_cost",
        "mask_total_cost(total_cost_usd, false) AS other_cost",
    )


@query
def filtered_risk(spark, sf_dir):
    return policy.apply_policy(
        _risk(spark, sf_dir), row_filter=policy.filter_by_site_status("site_status", set())
    )


@query
def partition_dispatch(spark, sf_dir):
    """Python partial sums per batch, merged by Spark."""

    # A local function travels to the workers whole; they need not have this package.
    def partial_tons(batches):
        for pdf in batches:
            grouped = pdf.groupby("site_id", as_index=False).agg(
                tons=("tons_extracted", "sum"), readings=("tons_extracted", "size")
            )
            yield grouped.astype({"tons": "int64", "readings": "int64"})

    readings = model.production(spark, sf_dir).select("site_id", "tons_extracted")
    partial = map_partitions(readings, partial_tons, "site_id long, tons long, readings long")
    return partial.groupBy("site_id").agg(F.sum("tons").alias("tons"), F.sum("readings").alias("readings"))


# -- documents -------------------------------------------------------------------


@query
def page_text(spark, sf_dir):
    return model.table(spark, sf_dir, "pages").select("page_id", documents.page_text("html").alias("text"))


@query
def document_chunks(spark, sf_dir):
    return documents.chunk_text(model.table(spark, sf_dir, "documents"), "doc_id", "text")


@query
def chunk_stats(spark, sf_dir):
    return documents.chunk_stats(document_chunks(spark, sf_dir))


@query
def sync_chunks(spark, sf_dir):
    """Index of the labelled documents brought up to all documents; toxic ones were
    indexed in upper case and are embedded again."""
    docs = model.table(spark, sf_dir, "documents")
    marks = model.table(spark, sf_dir, "labels").select("doc_id", "toxic")
    earlier = docs.join(marks, "doc_id").withColumn(
        "text", F.when(F.col("toxic") == 1, F.upper("text")).otherwise(F.col("text"))
    )
    index = documents.chunk_text(earlier, "doc_id", "text")
    fresh = documents.chunk_text(docs, "doc_id", "text")
    return documents.sync_chunks(index, fresh, documents.chunk_changes(index, fresh))


@query
def similar_topk(spark, sf_dir):
    """The three vectors nearest to the first one."""
    vectors = model.table(spark, sf_dir, "embeddings")
    probe = vectors.orderBy("vec_id").select("vec_id", "embedding").first()
    others = vectors.filter(F.col("vec_id") != probe["vec_id"])
    return documents.similar_topk(others, "vec_id", "embedding", list(probe["embedding"]), 3).select(
        "vec_id", F.round("score", 6).alias("score")
    )
