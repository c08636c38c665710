"""Tables of immutable versions on plain parquet.

Data of version N lies under ``data/_version=N/_part=P``. A version becomes
visible when its rows are appended to ``log``, the last step of a write, so a
failed or repeated write never shows half a version. A version replaces the parts
it names and leaves all others to earlier versions: a change to a few parts costs
those parts, not the table. One writer per table at a time.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Collection, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.functions.scalars import run_stamp
from strata.operators.changes import change_feed
from strata.sources.files import if_present, small_frame

WHOLE = "p"
LOG_SCHEMA = "version long, part string, empty boolean, op string, table_schema string, committed_at timestamp"
PARTITIONS = StructType([StructField("_version", LongType()), StructField("_part", StringType())])


def part_by(value: Column | str) -> Column:
    """Part name of a value; the prefix keeps it text when directories are read."""
    value = F.col(value) if isinstance(value, str) else value
    return F.concat(F.lit("p"), F.coalesce(value.cast("string"), F.lit("-none")))


def batch_part(version: int) -> str:
    """The part of an appended batch."""
    return f"p{version}"


def part_by_key(keys: Sequence[str], buckets: int) -> Column:
    """Part name from a hash of the key, for tables without a natural partition."""
    return part_by(F.pmod(F.xxhash64(*keys), F.lit(buckets)))


def read_log(spark: SparkSession, root: str) -> DataFrame | None:
    return if_present(lambda: spark.read.schema(LOG_SCHEMA).parquet(f"{root}/log"))


def latest_version(spark: SparkSession, root: str) -> int | None:
    log = read_log(spark, root)
    return None if log is None else log.agg(F.max("version")).first()[0]


def version_at(spark: SparkSession, root: str, moment: dt.datetime) -> int | None:
    """The version that was current at a time."""
    return read_log(spark, root).filter(F.col("committed_at") <= F.lit(moment)).agg(F.max("version")).first()[0]


def history(spark: SparkSession, root: str) -> DataFrame:
    """One row per version: what was done, when, and how many parts it wrote."""
    return read_log(spark, root).groupBy("version").agg(
        F.max("op").alias("operation"),
        F.max("committed_at").alias("committed_at"),
        F.count_distinct("part").alias("parts"),
    )


def stage(df: DataFrame, root: str, version: int, part: Column | str = WHOLE) -> list[str]:
    """Write the data of a version and return the names of its parts. Not yet visible.

    A ``part`` given by name takes all rows, without a shuffle.
    """
    path = f"{root}/data/_version={version}"
    if isinstance(part, str):
        df.write.mode("overwrite").parquet(f"{path}/_part={part}")
        return [part]
    # Rebalancing by part gives few files per part and splits a large part.
    placed = df.withColumn("_part", part).hint("rebalance", F.col("_part"))
    placed.write.mode("overwrite").partitionBy("_part").parquet(path)
    written = df.sparkSession.read.schema("_part string").parquet(path)
    return [r[0] for r in written.distinct().collect()]


def commit(
    spark: SparkSession,
    root: str,
    version: int,
    op: str,
    schema: StructType,
    parts: Iterable[str],
    replaces: Iterable[str] = (),
    run_ts: dt.datetime | None = None,
) -> None:
    """Make a staged version visible. Replaced parts without data become empty."""
    parts = set(parts)
    names = sorted(parts | set(replaces))
    (
        small_frame(spark, {"part": names, "empty": [n not in parts for n in names]})
        .select(
            F.lit(version).cast("long").alias("version"),
            "part",
            "empty",
            F.lit(op).alias("op"),
            F.lit(schema.json()).alias("table_schema"),
            run_stamp(run_ts).alias("committed_at"),
        )
        .coalesce(1)
        .write.mode("append")
        .parquet(f"{root}/log")
    )


def publish(
    df: DataFrame,
    root: str,
    version: int,
    op: str,
    part: Column | str = WHOLE,
    replaces: Iterable[str] = (),
    run_ts: dt.datetime | None = None,
) -> None:
    """Write a version and make it visible."""
    parts = stage(df, root, version, part)
    commit(df.sparkSession, root, version, op, df.schema, parts, replaces, run_ts)


def part_names(rows: DataFrame, part: Column | str) -> set[str]:
    """The parts that rows fall in."""
    if isinstance(part, str):
        return {part}
    return {r[0] for r in rows.select(part.alias("_part")).distinct().collect()}


def parts_written(spark: SparkSession, root: str, after: int, upto: int) -> set[str]:
    """The parts written by the versions after one and up to another."""
    log = read_log(spark, root).filter((F.col("version") > after) & (F.col("version") <= upto))
    return {r[0] for r in log.select("part").distinct().collect()}


def create_once(spark: SparkSession, root: str, schema: StructType, run_ts: dt.datetime | None = None) -> bool:
    """An empty version 0, unless the table exists already."""
    if latest_version(spark, root) is not None:
        return False
    commit(spark, root, 0, "create", schema, [], [WHOLE], run_ts)
    return True


def live_parts(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """The version that holds each part, as of ``version``: (part, version, empty, table_schema)."""
    log = read_log(spark, root)
    if log is None:
        raise ValueError(f"no table at {root}")
    if version is not None:
        log = log.filter(F.col("version") <= version)
    newest = F.max_by(F.struct("version", "empty", "table_schema"), "version")
    return log.groupBy("part").agg(newest.alias("_n")).select("part", "_n.*")


def read(
    spark: SparkSession, root: str, version: int | None = None, parts: Collection[str] | None = None
) -> DataFrame:
    """The table as of a version, whole or for some parts.

    Only directory names reach the driver; just the live directories are listed.
    """
    rows = live_parts(spark, root, version).collect()
    if not rows:
        raise ValueError(f"no version up to {version} at {root}")
    schema = StructType.fromJson(json.loads(max(rows, key=lambda r: r["version"])["table_schema"]))
    places = [
        (r["version"], r["part"]) for r in rows if not r["empty"] and (parts is None or r["part"] in parts)
    ]
    return _read_places(spark, root, schema, places).select(*schema.names)


def _read_places(spark, root: str, schema: StructType, places) -> DataFrame:
    full = StructType(schema.fields + PARTITIONS.fields)
    if not places:
        return spark.createDataFrame([], full)
    paths = [f"{root}/data/_version={v}/_part={p}" for v, p in places]
    return spark.read.schema(full).option("basePath", f"{root}/data").parquet(*paths)


def rewrite(
    spark: SparkSession,
    root: str,
    version: int,
    op: str,
    part: Column,
    touched: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    run_ts: dt.datetime | None = None,
) -> None:
    """Replace the parts named by ``touched`` with ``build(their rows before)``.

    "Before" is the state of the preceding version, whatever a failed attempt at
    this one left behind, so a repeated write gives the same version.
    """
    names = part_names(touched, part)
    before = read(spark, root, version - 1, names)
    publish(build(before), root, version, op, part, names, run_ts)


def read_changes(spark: SparkSession, root: str, keys: Sequence[str], start: int, end: int) -> DataFrame:
    """Change feed of the versions ``start .. end``.

    Each part written in the range is compared with the same part before that
    write; parts that did not change are never read. All versions share one join.
    """
    before = Window.partitionBy("part").orderBy("version")
    log = read_log(spark, root).filter(F.col("version") <= end)
    steps = (
        log.groupBy("part", "version")
        .agg(F.max("empty").alias("empty"), F.max("table_schema").alias("table_schema"))
        .withColumns(
            {
                "old_version": F.lag("version").over(before),
                "old_empty": F.coalesce(F.lag("empty").over(before), F.lit(True)),
            }
        )
        .filter(F.col("version") >= start)
    )
    rows = steps.collect()
    schema = StructType.fromJson(json.loads(max(rows, key=lambda r: r["version"])["table_schema"])) if rows else None
    if schema is None:
        raise ValueError(f"no versions {start} to {end} at {root}")
    new_places = [(r["version"], r["part"]) for r in rows if not r["empty"]]
    columns = schema.names

    new = _read_places(spark, root, schema, new_places).select(*columns, F.col("_version").alias("_at"))
    replaced = [r for r in rows if not r["old_empty"]]
    successor = small_frame(
        spark,
        {
            "_version": pa.array([r["old_version"] for r in replaced], pa.int64()),
            "_part": pa.array([r["part"] for r in replaced], pa.string()),
            "_at": pa.array([r["version"] for r in replaced], pa.int64()),
        },
    )
    old_places = [(r["old_version"], r["part"]) for r in replaced]
    old = _read_places(spark, root, schema, old_places).join(successor, ["_version", "_part"])
    commits = log.groupBy(F.col("version").alias("_at")).agg(F.min("committed_at").alias("_committed"))
    feed = change_feed(old.select(*columns, "_at"), new, [*keys, "_at"], F.col("_at"), F.lit(None))
    order = [*columns, "_change_type", "_commit_version"]
    return feed.join(commits, "_at").select(*order, F.col("_committed").alias("_commit_timestamp"))
