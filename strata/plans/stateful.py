"""Registered queries that write: streams, load strategies and versioned tables.

Each works in a fresh folder of the shared scratch space and returns what its
tables hold at the end.
"""

from __future__ import annotations

import datetime as dt
import time

from pyspark.sql import functions as F

from strata import model
from strata.model import AS_OF, EQUIPMENT_KEYS, SOURCE_KEYS
from strata.operators import documents, scd2
from strata.plans import loads, marts, medallion
from strata.plans.catalog import COMMITS, query
from strata.session import scratch_dir
from strata.sources import files, schemas, versions
from strata.streaming import ingest, tables

# Where the readings and events are cut into earlier and later deliveries.
MID_READINGS = dt.datetime(1999, 1, 1, 12)
MID_EVENTS = dt.datetime(2024, 1, 16)


def _ntz(moment: dt.datetime):
    return F.lit(moment.isoformat()).cast("timestamp_ntz")


def _before(time: str, moment: dt.datetime):
    """Rows of the earlier delivery; those without a time come with it."""
    return F.coalesce(F.col(time) < _ntz(moment), F.lit(True))


def _stream_path(sf_dir: str, name: str) -> str:
    """A file stream takes a single file only as a pattern; a folder works as well."""
    return f"{sf_dir}/{{{name}.parquet}}"


# -- ingest ----------------------------------------------------------------------


@query
def ingest_files(spark, sf_dir):
    """Line items streamed to bronze; the second run finds nothing new."""
    work = scratch_dir(spark, "ingest")
    src, dst, meta = _stream_path(sf_dir, "lineitem"), f"{work}/bronze", f"{work}/meta"
    rules = {"not_empty": F.col("l_orderkey").isNotNull()}
    ingest.ingest_files(spark, src, dst, meta, rules=rules)
    ingest.ingest_files(spark, src, dst, meta, rules=rules)
    return ingest.read_bronze(spark, dst, meta)


@query
def evolve_schema(spark, sf_dir):
    """A later delivery brings a new column; earlier rows have NULL in it."""
    work = scratch_dir(spark, "evolve")
    src, dst, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    events = model.table(spark, sf_dir, "events")
    early = _before("ts", MID_EVENTS)
    events.filter(early).drop("props").write.parquet(src)
    ingest.ingest_files(spark, src, dst, meta)
    events.filter(~early).write.mode("append").parquet(src)
    ingest.ingest_files(spark, src, dst, meta)
    return ingest.read_bronze(spark, dst, meta).drop(schemas.RESCUED)


def _event_landing(events):
    """Events as text rows whose error values are not numbers."""
    is_error = F.col("event_type") == "error"
    marked = F.when(is_error, F.concat(F.lit("bad-"), F.col("event_id").cast("string")))
    return events.select(
        "event_id", "user_id", F.coalesce(marked, F.col("value").cast("string")).alias("value")
    )


RESCUE_SCHEMA = "event_id bigint, user_id bigint, value double"


@query
def rescue_columns(spark, sf_dir):
    """JSON events against a declared schema: misfits are kept beside it."""
    from pyspark.sql.types import StructType

    work = scratch_dir(spark, "rescue")
    src, dst, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    _event_landing(model.table(spark, sf_dir, "events")).write.json(src)
    schema = StructType.fromDDL(RESCUE_SCHEMA)
    ingest.ingest_files(spark, src, dst, meta, fmt="json", schema=schema)
    return ingest.read_bronze(spark, dst, meta)


@query
def rescue_typed_files(spark, sf_dir):
    """The same with parquet files that disagree about the column's type."""
    from pyspark.sql.types import StructType

    work = scratch_dir(spark, "rescue-typed")
    src, root, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    events = model.table(spark, sf_dir, "events")
    fine = events.filter(F.col("event_type") != "error").select("event_id", "user_id", "value")
    broken = _event_landing(events.filter(F.col("event_type") == "error"))
    fine.write.parquet(src)
    broken.write.mode("append").parquet(src)
    schemas.save_schema(spark, f"{meta}/schema", StructType.fromDDL(RESCUE_SCHEMA), COMMITS[0], 0)
    ingest.ingest_typed_files(spark, src, root, meta)
    return versions.read(spark, root)


@query
def ingest_new_files(spark, sf_dir):
    """An ingest that starts with what arrives after its first run: the later delivery alone."""
    work = scratch_dir(spark, "ingest-new")
    src, dst, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    events, early = model.table(spark, sf_dir, "events"), _before("ts", MID_EVENTS)
    events.filter(early).write.parquet(src)
    time.sleep(1)  # file times are whole seconds on some stores
    ingest.ingest_files(spark, src, dst, meta, existing=False)
    time.sleep(1)
    events.filter(~early).write.mode("append").parquet(src)
    ingest.ingest_files(spark, src, dst, meta, existing=False)
    return ingest.read_bronze(spark, dst, meta).drop(schemas.RESCUED)


@query
def rescue_nested(spark, sf_dir):
    """Nested JSON events, some with misfits inside, an unknown inner field, or cut off: nothing is lost."""
    from pyspark.sql.types import StructType

    work = scratch_dir(spark, "rescue-nested")
    src, dst, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    is_error, is_click = F.col("event_type") == "error", F.col("event_type") == "click"
    bad = F.concat(F.lit("bad-"), F.col("event_id").cast("string"))
    inner = F.struct(
        F.when(is_error, bad).otherwise(F.col("value").cast("string")).alias("x"), F.col("user_id").alias("y"),
        F.when(is_click, F.col("event_type")).alias("z"),
    )
    items = F.array(F.struct(F.col("event_id").cast("string").alias("n")), F.struct(F.when(is_error, "none").otherwise("7").alias("n")))
    line = F.to_json(F.struct("event_id", inner.alias("p"), items.alias("items")))
    cut_off = F.concat(F.lit('{"event_id":'), F.col("event_id").cast("string"), F.lit(',"p":{'))
    events = model.table(spark, sf_dir, "events")
    events.select(F.when(F.col("event_id") % 97 == 0, cut_off).otherwise(line).alias("value")).write.text(src)
    schema = StructType.fromDDL("event_id bigint, p struct<x: double, y: bigint>, items array<struct<n: bigint>>")
    ingest.ingest_files(spark, src, dst, meta, fmt="json", schema=schema, evolution="rescue")
    bronze = ingest.read_bronze(spark, dst, meta)
    return bronze.select("event_id", "p.x", "p.y", F.col("items")[0]["n"].alias("n0"), F.col("items")[1]["n"].alias("n1"), schemas.RESCUED)


@query
def evolve_nested(spark, sf_dir):
    """A later delivery has new fields in a struct and in the structs of an array."""
    work = scratch_dir(spark, "evolve-nested")
    src, dst, meta = f"{work}/landing", f"{work}/bronze", f"{work}/meta"
    events, early = model.table(spark, sf_dir, "events"), _before("ts", MID_EVENTS)

    def delivery(rows, more: bool):
        of_p = [F.col("value").alias("x"), *([F.col("event_type").alias("y")] if more else [])]
        of_item = [F.col("user_id").alias("a"), *([F.col("event_id").alias("b")] if more else [])]
        return rows.select("event_id", F.struct(*of_p).alias("p"), F.array(F.struct(*of_item)).alias("items"))

    delivery(events.filter(early), False).write.parquet(src)
    ingest.ingest_files(spark, src, dst, meta)
    delivery(events.filter(~early), True).write.mode("append").parquet(src)
    ingest.ingest_files(spark, src, dst, meta)
    item = F.col("items")[0]
    return ingest.read_bronze(spark, dst, meta).select("event_id", "p.x", "p.y", item["a"].alias("a"), item["b"].alias("b"), schemas.RESCUED)


@query
def copy_into(spark, sf_dir):
    """Two deliveries loaded by three batch runs; each file counts once."""
    work = scratch_dir(spark, "copy")
    src, root = f"{work}/landing", f"{work}/table"
    readings = model.production(spark, sf_dir)
    early = _before("production_datetime", MID_READINGS)
    readings.filter(early).write.parquet(src)
    ingest.copy_into(spark, src, root)
    readings.filter(~early).write.mode("append").parquet(src)
    ingest.copy_into(spark, src, root)
    ingest.copy_into(spark, src, root)
    return versions.read(spark, root)


@query
def partitioned_source(spark, sf_dir):
    """Readings written by month and read back, the month from the directory names."""
    path = f"{scratch_dir(spark, 'partitioned')}/production"
    readings = model.production(spark, sf_dir).withColumn(
        "production_month", F.date_trunc("month", "production_date").cast("date")
    )
    files.write_partitioned(readings, path, ["production_month"])
    return files.read_partitioned(spark, path)


@query
def read_binary(spark, sf_dir):
    """Pages written as text files, read back as binary files and turned into text."""
    path = f"{scratch_dir(spark, 'pages')}/pages"
    one_line = F.regexp_replace("html", r"\s+", " ")
    model.table(spark, sf_dir, "pages").select(one_line.alias("value")).write.text(path)
    lines = files.read_text_documents(spark, path, "*.txt").select(
        F.explode(F.split("text", "\n")).alias("html")
    )
    return lines.filter("html <> ''").select(documents.page_text("html").alias("text"))


@query
def load_targets(spark, sf_dir):
    path = f"{scratch_dir(spark, 'targets')}/targets"
    model.targets(spark, sf_dir).write.csv(path, header=True)
    return files.load_targets(spark, path)


# -- streams between tables ------------------------------------------------------


@query
def stream_table(spark, sf_dir):
    """Bronze to silver as a stream with range checks."""
    work = scratch_dir(spark, "silver")
    rows = tables.table_stream(spark, _stream_path(sf_dir, "lineitem"))

    def silver(df):
        readings = model.production_of(df)
        return readings.filter(
            (F.col("tons_extracted") >= 0) & F.col("mineral_grade_percent").between(0, 5)
        )

    tables.stream_table(rows, f"{work}/silver", f"{work}/checkpoint", silver)
    return spark.read.parquet(f"{work}/silver")


NEW_SINCE = dt.date(1998, 1, 1)


def _new_period():
    """Events of the newer period; one without a day belongs to the older one."""
    return F.coalesce(F.col("last_maintenance_date") >= F.lit(NEW_SINCE), F.lit(False))


def _deliver_events(spark, sf_dir, src, periods):
    events = model.equipment_events(spark, sf_dir)
    for period in periods:
        events.filter(period).write.mode("append").parquet(src)
        yield tables.table_stream(spark, src, events.schema)


@query
def stream_upsert(spark, sf_dir):
    """Two deliveries of events, in order, upserted to one row per unit."""
    work = scratch_dir(spark, "upsert")
    newest = [F.desc("last_maintenance_date"), F.desc("event_id")]
    for rows in _deliver_events(spark, sf_dir, f"{work}/landing", [~_new_period(), _new_period()]):
        tables.stream_upsert(
            rows, f"{work}/table", EQUIPMENT_KEYS, newest, f"{work}/checkpoint",
            versions.part_by_key(EQUIPMENT_KEYS, 8),
        )
    return versions.read(spark, f"{work}/table")


@query
def stream_scd2(spark, sf_dir):
    """Two deliveries of events, the later period first, into one history."""
    work = scratch_dir(spark, "scd2")
    for rows in _deliver_events(spark, sf_dir, f"{work}/landing", [_new_period(), ~_new_period()]):
        tables.stream_scd2(
            rows, f"{work}/table", EQUIPMENT_KEYS, "last_maintenance_date", [F.desc("event_id")],
            f"{work}/checkpoint", versions.part_by_key(EQUIPMENT_KEYS, 8),
        )
    return versions.read(spark, f"{work}/table")


@query
def stream_scd2_subset(spark, sf_dir):
    """Two deliveries, the later period first, into one history over the status alone."""
    work, tracked = scratch_dir(spark, "scd2-subset"), ["status"]
    for rows in _deliver_events(spark, sf_dir, f"{work}/landing", [_new_period(), ~_new_period()]):
        tables.stream_scd2(
            rows, f"{work}/table", EQUIPMENT_KEYS, "last_maintenance_date", [F.desc("event_id")],
            f"{work}/checkpoint", versions.part_by_key(EQUIPMENT_KEYS, 8), tracked=tracked,
        )
    return scd2.scd2_merged(versions.read(spark, f"{work}/table"), EQUIPMENT_KEYS, "last_maintenance_date", tracked)


def _layers(spark, sf_dir):
    """Two deliveries through all layers; returns the folder of the tables."""
    base = scratch_dir(spark, "layers")
    landing = {name: f"{base}/landing/{name}" for name in medallion.KEYS}
    readings, events = model.production(spark, sf_dir), model.equipment_events(spark, sf_dir)
    early = _before("production_datetime", MID_READINGS)
    first = _new_period()
    model.sites(spark, sf_dir).write.parquet(landing[medallion.SITES])
    for rows, history in ((early, first), (~early, ~first)):
        readings.filter(rows).write.mode("append").parquet(landing[medallion.PRODUCTION])
        events.filter(history).write.mode("append").parquet(landing[medallion.EQUIPMENT])
        medallion.run_bronze(spark, landing, base)
        medallion.run_silver(spark, base, "event_id")
    medallion.run_gold(spark, base, AS_OF)
    return base


@query
def layers_production_by_site(spark, sf_dir):
    """The flagship mart as the layered run leaves it."""
    base = _layers(spark, sf_dir)
    return medallion.gold(spark, base, "production_by_site").drop("_refreshed_at")


@query
def layers_maintenance_due(spark, sf_dir):
    """Due equipment as the layered run leaves it; unit 0 fails an expectation."""
    base = _layers(spark, sf_dir)
    return medallion.gold(spark, base, "equipment_maintenance_due").drop("_refreshed_at")


# -- gold loads ------------------------------------------------------------------


@query
def load_full(spark, sf_dir):
    """Refreshed twice; the table holds the second result only."""
    root = f"{scratch_dir(spark, 'full')}/table"
    readings = model.production(spark, sf_dir)
    early = readings.filter(_before("production_datetime", MID_READINGS))
    loads.load_full(early, root, marts.site_day_rollup)
    loads.load_full(readings, root, marts.site_day_rollup)
    return versions.read(spark, root).drop("_refreshed_at")


@query
def load_incremental(spark, sf_dir):
    """Three runs: the first cut lies inside a day, the third run finds nothing."""
    root = f"{scratch_dir(spark, 'incremental')}/table"
    readings = model.production(spark, sf_dir)
    early = readings.filter(_before("production_datetime", MID_READINGS))
    for source in (early, readings, readings):
        loads.load_incremental(source, root, "production_datetime", date_col="production_date")
    return marts.merge_site_days(versions.read(spark, root))


@query
def load_changed_parts(spark, sf_dir):
    """A daily summary cut by year, refreshed after later years were delivered."""
    work = scratch_dir(spark, "refresh")
    readings = model.production(spark, sf_dir)
    early = _before("production_datetime", MID_READINGS)
    later_years = ~_before("production_datetime", dt.datetime(1999, 1, 1))
    for version, rows in enumerate((readings.filter(early), readings.filter(later_years))):
        versions.publish(rows, f"{work}/source", version, "delivery", _by_year())
        loads.load_changed_parts(
            spark, f"{work}/source", f"{work}/daily", f"{work}/state", "daily", marts.site_day_rollup, _by_year()
        )
    return versions.read(spark, f"{work}/daily")


def _publish_closing(spark, sf_dir, root, closing: int):
    """The order book of one closing as the next version, in parts by year."""
    versions.publish(
        model.order_book(spark, sf_dir, closing),
        root,
        closing,
        "closing",
        _by_year(),
        _names(spark, root),
        COMMITS[closing],
    )


def _by_year():
    return versions.part_by(F.year("production_date"))


def _names(spark, root):
    if versions.latest_version(spark, root) is None:
        return []
    return [r["part"] for r in versions.live_parts(spark, root).collect()]


def _follow(spark, sf_dir, consume):
    """Run a consumer after the first closing, after the two others, and once more."""
    work = scratch_dir(spark, "changes")
    for closing in range(3):
        _publish_closing(spark, sf_dir, f"{work}/source", closing)
        if closing != 1:
            consume(f"{work}/source", work)
    consume(f"{work}/source", work)
    return work


@query
def load_cdc(spark, sf_dir):
    def consume(source, work):
        loads.load_cdc(
            spark, source, f"{work}/mirror", f"{work}/state", "mirror", SOURCE_KEYS, _by_year(), COMMITS[0]
        )

    mirror = versions.read(spark, f"{_follow(spark, sf_dir, consume)}/mirror")
    return mirror.withColumn("_cdc_timestamp", F.col("_cdc_timestamp").cast("timestamp_ntz"))


@query
def load_audit(spark, sf_dir):
    def consume(source, work):
        loads.load_audit(spark, source, f"{work}/audit", f"{work}/state", "audit", SOURCE_KEYS, COMMITS[0])

    audit = versions.read(spark, f"{_follow(spark, sf_dir, consume)}/audit")
    return audit.withColumn("_commit_timestamp", F.col("_commit_timestamp").cast("timestamp_ntz"))


@query
def load_state(spark, sf_dir):
    """Two consumers of one source share the state table."""

    def consume(source, work):
        args = (spark, source)
        loads.load_cdc(*args, f"{work}/mirror", f"{work}/state", "mirror", SOURCE_KEYS, run_ts=COMMITS[0])
        loads.load_audit(*args, f"{work}/audit", f"{work}/state", "audit", SOURCE_KEYS, COMMITS[0])

    work = _follow(spark, sf_dir, consume)
    audited = versions.read(spark, f"{work}/audit").agg(F.max("_commit_version").alias("audited"))
    states = loads.load_state(spark, f"{work}/state").select("table_name", "last_version")
    return states.withColumn("audited_version", audited.scalar())


@query
def as_of_version(spark, sf_dir):
    """The source as it was at its second version."""
    root = f"{scratch_dir(spark, 'travel')}/source"
    for closing in range(3):
        _publish_closing(spark, sf_dir, root, closing)
    return versions.read(spark, root, 1)


@query
def as_of_time(spark, sf_dir):
    """The source as it looked at an hour between its second and its third version."""
    root = f"{scratch_dir(spark, 'travel-time')}/source"
    for closing in range(3):
        _publish_closing(spark, sf_dir, root, closing)
    moment = COMMITS[1] + dt.timedelta(hours=15)
    return versions.read(spark, root, versions.version_at(spark, root, moment))


@query
def version_history(spark, sf_dir):
    root = f"{scratch_dir(spark, 'history')}/source"
    for closing in range(3):
        _publish_closing(spark, sf_dir, root, closing)
    listed = versions.history(spark, root)
    return listed.withColumn("committed_at", F.col("committed_at").cast("timestamp_ntz"))
