"""Gold load strategies: full refresh, high-water-mark append, change mirror, audit log.

Every write is one version of a table (see ``strata.sources.versions``) and the
consumer's state is saved after it. A run that stops in between is repeated by the
next one with the same result.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.functions.scalars import run_stamp
from strata.operators.changes import apply_net, audit_append, net_changes
from strata.plans.marts import site_day_measures
from strata.sources import versions
from strata.sources.files import if_present, small_frame

STATE_SCHEMA = "table_name string, last_version long, updated_at timestamp"
EPOCH = dt.datetime(1970, 1, 1)


# -- consumer state --------------------------------------------------------------


def get_state(spark: SparkSession, state_dir: str, consumer: str) -> int | None:
    """Last version the consumer has processed, None before its first run."""
    states = load_state(spark, state_dir)
    if states is None:
        return None
    row = states.filter(F.col("table_name") == consumer).select("last_version").first()
    return None if row is None else row[0]


def load_state(spark: SparkSession, state_dir: str) -> DataFrame | None:
    """The newest state of every consumer."""
    log = if_present(lambda: spark.read.schema(STATE_SCHEMA).parquet(state_dir))
    if log is None:
        return None
    newest = F.max_by(F.struct("last_version", "updated_at"), F.struct("updated_at", "last_version"))
    return log.groupBy("table_name").agg(newest.alias("_s")).select("table_name", "_s.*")


def save_state(
    spark: SparkSession, state_dir: str, consumer: str, version: int, run_ts: dt.datetime | None = None
) -> None:
    """Append the consumer's new state."""
    row = small_frame(spark, {"table_name": [consumer], "last_version": [version]})
    row.withColumn("updated_at", run_stamp(run_ts)).coalesce(1).write.mode("append").parquet(state_dir)


# -- full refresh ----------------------------------------------------------------


def load_full(
    source: DataFrame,
    root: str,
    build: Callable[[DataFrame], DataFrame],
    run_ts: dt.datetime | None = None,
) -> int:
    """Replace the whole table, its schema included. Returns the new version."""
    spark = source.sparkSession
    version = _next(spark, root)
    versions.publish(
        build(source).withColumn("_refreshed_at", run_stamp(run_ts)), root, version, "full refresh", run_ts=run_ts
    )
    return version


# -- high-water-mark append ------------------------------------------------------


def get_watermark(spark: SparkSession, root: str, default: dt.datetime = EPOCH) -> dt.datetime:
    """Newest event time the table has taken in."""
    if versions.latest_version(spark, root) is None:
        return default
    mark = versions.read(spark, root).agg(F.max("_watermark_end")).first()[0]
    return default if mark is None else mark


def newer_than(source: DataFrame, time_col: str, mark: dt.datetime, date_col: str | None = None) -> DataFrame:
    """Rows after the mark; with ``date_col`` the date partitions before it are pruned."""
    after = F.col(time_col) > F.lit(mark.isoformat()).cast(source.schema[time_col].dataType)
    if date_col is not None:
        after = after & (F.col(date_col) >= F.lit(mark.date()))
    return source.filter(after)


def load_incremental(
    source: DataFrame,
    root: str,
    time_col: str,
    build: Callable[..., DataFrame] = site_day_measures,
    date_col: str | None = None,
    run_ts: dt.datetime | None = None,
) -> int | None:
    """Append the aggregate of the rows after the mark; None when there are none.

    Two batches may share a day, so what is appended must stay additive; see
    ``merge_site_days`` for reading it.
    ``build(rows, *extra)`` adds the extra aggregates, here the newest event time of
    each group: the next mark is their maximum. Rows that arrive at or below the
    mark are not picked up by this strategy.
    """
    spark = source.sparkSession
    mark = get_watermark(spark, root)
    fresh = newer_than(source, time_col, mark, date_col)
    if fresh.isEmpty():
        return None
    version = _next(spark, root)
    batch = build(fresh, F.max(time_col).alias("_watermark_end")).withColumns(
        {
            "_loaded_at": run_stamp(run_ts),
            "_watermark_start": F.lit(mark.isoformat()).cast(source.schema[time_col].dataType),
        }
    )
    versions.publish(batch, root, version, "append", versions.batch_part(version), run_ts=run_ts)
    return version


# -- refresh of changed parts ----------------------------------------------------


def load_changed_parts(
    spark: SparkSession,
    source_root: str,
    root: str,
    state_dir: str,
    consumer: str,
    build: Callable[[DataFrame], DataFrame],
    part: Column,
    run_ts: dt.datetime | None = None,
) -> int | None:
    """Refresh an aggregate by recomputing only the parts its source has rewritten.

    Source and result must be cut by the same ``part`` and a result row must depend
    on one part only, as a daily mart does on a source cut by days or months.
    """
    current = versions.latest_version(spark, source_root)
    last = get_state(spark, state_dir, consumer)
    if last is not None and last >= current:
        return None
    names = versions.parts_written(spark, source_root, -1 if last is None else last, current)
    rows = versions.read(spark, source_root, current, names)
    versions.publish(build(rows), root, current, "refresh", part, names, run_ts)
    save_state(spark, state_dir, consumer, current, run_ts)
    return current


# -- change consumers ------------------------------------------------------------


def load_cdc(
    spark: SparkSession,
    source_root: str,
    root: str,
    state_dir: str,
    consumer: str,
    keys: Sequence[str],
    part: Column | str = versions.WHOLE,
    run_ts: dt.datetime | None = None,
) -> int | None:
    """Keep a mirror of a versioned source, deletes included.

    The first run copies the source; later ones apply the net change per key to the
    parts it falls in. ``part`` must be derived from source columns; without it the
    mirror is one part.
    """
    current = versions.latest_version(spark, source_root)
    last = get_state(spark, state_dir, consumer)
    if last is None or versions.latest_version(spark, root) is None:
        start = versions.read(spark, source_root, current).withColumns(
            {"_cdc_type": F.lit("insert"), "_cdc_timestamp": run_stamp(run_ts)}
        )
        versions.publish(start, root, current, "bootstrap", part, run_ts=run_ts)
    elif last >= current:
        return None
    else:
        # The feed is joined once and kept beside the table: it is read three times.
        staged = f"{root}/staged_changes"
        feed = versions.read_changes(spark, source_root, keys, last + 1, current)
        feed.write.mode("overwrite").parquet(staged)
        feed = spark.read.schema(feed.schema).parquet(staged)
        if not feed.isEmpty():
            # Parts of old and new images: where a row leaves and where it arrives.
            names = versions.part_names(feed, part)
            before = versions.read(spark, root, last, names)
            after = apply_net(before, net_changes(feed, keys), keys)
            versions.publish(after, root, current, "merge", part, names, run_ts)
    save_state(spark, state_dir, consumer, current, run_ts)
    return current


def load_audit(
    spark: SparkSession,
    source_root: str,
    root: str,
    state_dir: str,
    consumer: str,
    keys: Sequence[str],
    run_ts: dt.datetime | None = None,
) -> int | None:
    """Append inserted and updated rows of a versioned source; never remove any."""
    current = versions.latest_version(spark, source_root)
    last = get_state(spark, state_dir, consumer)
    batch = versions.batch_part(current)
    if last is None or versions.latest_version(spark, root) is None:
        start = versions.read(spark, source_root, current).withColumns(
            {
                "_operation": F.lit("INSERT"),
                "_commit_version": F.lit(current).cast("long"),
                "_commit_timestamp": run_stamp(run_ts),
            }
        )
        versions.publish(start, root, current, "bootstrap", batch, run_ts=run_ts)
    elif last >= current:
        return None
    else:
        feed = versions.read_changes(spark, source_root, keys, last + 1, current)
        versions.publish(audit_append(feed), root, current, "append", batch, run_ts=run_ts)
    save_state(spark, state_dir, consumer, current, run_ts)
    return current


def _next(spark: SparkSession, root: str) -> int:
    newest = versions.latest_version(spark, root)
    return 0 if newest is None else newest + 1
