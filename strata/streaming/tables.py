"""Streams from table to table, with pass-through, upsert or history targets."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import BooleanType, StructField, StructType

from strata.operators.changes import merge_upsert
from strata.operators.scd2 import END, MERGED, START, scd2_apply
from strata.operators.windows import latest_per_key
from strata.sources import versions
from strata.sources.files import if_present
from strata.sources.schemas import quoted
from strata.streaming.ingest import ANY_AGE, AVAILABLE_NOW, BATCH, run

BUCKETS = 64


def table_stream(spark: SparkSession, src: str, schema: StructType | None = None, **options) -> DataFrame:
    """New rows of a parquet table; an ingested table's batch directories are no column of it."""
    schema = schema or spark.read.parquet(src).schema
    rows = spark.readStream.schema(schema).options(**{**ANY_AGE, **options}).parquet(src)
    return rows.select(*(quoted(c) for c in schema.names if c != BATCH))


def stream_table(
    rows: DataFrame,
    dst: str,
    checkpoint: str,
    transform: Callable[[DataFrame], DataFrame] = lambda df: df,
    trigger: str = AVAILABLE_NOW,
    partition_by: Sequence[str] = (),
) -> int | StreamingQuery:
    """Append a transformed stream to a parquet table."""
    writer = (
        transform(rows).writeStream.format("parquet").outputMode("append")
        .option("path", dst).option("checkpointLocation", checkpoint)
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return run(writer, trigger)


def stream_upsert(
    rows: DataFrame,
    root: str,
    keys: Sequence[str],
    order_by: Sequence[Column],
    checkpoint: str,
    part: Column | None = None,
    trigger: str = AVAILABLE_NOW,
) -> int | StreamingQuery:
    """Keep one row per key: the newest of each micro-batch replaces what was there.

    A batch rewrites only the parts its keys fall in, by default hash buckets.
    ``part`` must depend on key columns alone.
    """

    def merge(before: DataFrame, batch: DataFrame) -> DataFrame:
        return merge_upsert(before, batch, keys)

    def prepare(batch: DataFrame) -> DataFrame:
        return latest_per_key(batch, keys, order_by)

    return _stream_rewrite(rows, root, rows.schema, keys, checkpoint, part, trigger, prepare, merge)


def stream_scd2(
    rows: DataFrame,
    root: str,
    keys: Sequence[str],
    sequence_by: str,
    tie_break: Sequence[Column],
    checkpoint: str,
    part: Column | None = None,
    trigger: str = AVAILABLE_NOW,
    tracked: Sequence[str] | None = None,
) -> int | StreamingQuery:
    """Keep the full history per key; batches may arrive in any order.

    With ``tracked`` the table holds marked versions; ``scd2_merged`` reads the history of
    those columns from it.
    """
    kind = rows.schema[sequence_by].dataType
    marks = [] if tracked is None else [StructField(MERGED, BooleanType())]
    schema = StructType([*rows.schema.fields, StructField(START, kind), StructField(END, kind), *marks])

    def merge(before: DataFrame, batch: DataFrame) -> DataFrame:
        return scd2_apply(before, batch, keys, sequence_by, tie_break, tracked)

    return _stream_rewrite(rows, root, schema, keys, checkpoint, part, trigger, lambda b: b, merge)


def own_target(spark: SparkSession, root: str, stream_id: str) -> None:
    """Bind a target to the stream that fills it; another checkpoint is another stream.

    Versions follow the stream's batches, so a second stream would skip batches silently.
    """
    path = f"{root}/stream"
    saved = if_present(lambda: spark.read.schema("stream_id string").json(path))
    owners = [] if saved is None else [r["stream_id"] for r in saved.distinct().limit(2).collect()]
    if not owners:
        spark.createDataFrame([(stream_id,)], "stream_id string").coalesce(1).write.mode("append").json(path)
    elif owners != [stream_id]:
        raise ValueError(f"{root} is filled by the stream {owners[0]}; a new checkpoint needs a new target")


def _stream_rewrite(rows, root, schema, keys, checkpoint, part, trigger, prepare, merge):
    versions.create_once(rows.sparkSession, root, schema)
    part = versions.part_by_key(keys, BUCKETS) if part is None else part

    def apply(batch: DataFrame, batch_id: int) -> None:
        version = batch_id + 1
        session = batch.sparkSession
        own_target(session, root, session.sparkContext.getLocalProperty("sql.streaming.queryId"))
        if versions.latest_version(session, root) >= version or batch.isEmpty():
            return
        batch = prepare(batch).persist()
        try:
            versions.rewrite(
                session, root, version, "merge", part, batch, lambda before: merge(before, batch)
            )
        finally:
            batch.unpersist()

    writer = rows.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    return run(writer, trigger)
