"""Incremental file ingest, one list of files per batch.

A batch begins with the list of its files. The list is written once; the schema check, the
reading and the log of loaded files all use exactly that list, so a file that arrives
meanwhile belongs to the next batch, whatever its time. A batch counts as loaded when its
mark is written, the last step; one that stopped before is repeated from its own list.
"""

from __future__ import annotations

import datetime as dt
import functools
import json
import re
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StringType, StructField, StructType

from strata.operators.quality import Rules, expect_fail
from strata.sources import schemas, versions
from strata.sources.files import if_present, small_frame
from strata.sources.schemas import MALFORMED, RESCUED

AVAILABLE_NOW = "available_now"
BATCH = "_batch"
FILES_PER_BATCH = 10_000
POLL_SECONDS = 0.2
# The file source skips files older than a week before its newest one, which late deliveries are.
ANY_AGE = {"maxFileAge": "36500d"}
FILE_COLUMNS = "path string, modificationTime timestamp, length long, content binary"
LIST_SCHEMA = "path string, modified timestamp, length long"
MARK_SCHEMA = "batch long, rows long"
Sink = Callable[[DataFrame, int], None]


def run(writer, trigger: str) -> int | StreamingQuery:
    """Start a stream: catch up and return the rows read, or keep it running every
    ``trigger`` (such as ``1 minute``) and return its handle."""
    if trigger != AVAILABLE_NOW:
        return writer.trigger(processingTime=trigger).start()
    stream = writer.trigger(availableNow=True).start()
    rows: dict[int, int] = {}
    ended = False
    while not ended:  # a stream keeps its last 100 steps only, so they are noted on the way
        ended = stream.awaitTermination(POLL_SECONDS)
        rows |= {step.batchId: step.numInputRows for step in stream.recentProgress if step.numInputRows}
    return sum(rows.values())


def ingest_files(
    spark: SparkSession,
    src: str,
    dst: str,
    meta_dir: str,
    fmt: str = "parquet",
    evolution: str = "add_new_columns",
    existing: bool = True,
    trigger: str = AVAILABLE_NOW,
    rules: Rules | None = None,
    partition_by: Sequence[str] = (),
    options: dict | None = None,
    schema: StructType | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> int | StreamingQuery:
    """Append the files of ``src`` not seen before to the parquet table ``dst``.

    The schema is inferred on the first run (unless given) and kept in ``meta_dir``; each
    batch takes up the new columns of its own files, also inside structs, arrays and maps,
    and none with ``evolution="none"``. Values that do not fit, lines that do not parse and
    surplus CSV fields go to ``_rescued_data``. CSV files are read by their header's names and
    typed files by their own types, so files that disagree can lie side by side.
    ``existing=False`` starts with files that are newer than the first run.

    A catch-up run takes what is there when it starts and what arrived before its last
    batch, and returns the rows read. A stream kept running does the same whenever files
    arrive. Both share one log of loaded files in ``meta_dir``. Each batch is a directory
    (``_batch``, within the partitions of ``partition_by``) that a repeated batch replaces.
    """
    options = dict(options or {})
    if fmt == "csv":
        options.setdefault("header", "true")
    sink = functools.partial(_append, dst=dst, partition_by=partition_by)
    how = dict(src=src, meta_dir=meta_dir, fmt=fmt, evolution=evolution, existing=existing, rules=rules, options=options, schema=schema)
    return _start(spark, src, meta_dir, trigger, functools.partial(_catch_up, sink=sink, files_per_batch=files_per_batch, **how))


def ingest_typed_files(
    spark: SparkSession,
    src: str,
    root: str,
    meta_dir: str,
    fmt: str = "parquet",
    evolution: str = "add_new_columns",
    trigger: str = AVAILABLE_NOW,
    rules: Rules | None = None,
    files_per_batch: int = FILES_PER_BATCH,
) -> int | StreamingQuery:
    """The same into the versioned table ``root``: each batch is one version."""
    sink = functools.partial(_publish, root=root)
    how = dict(src=src, meta_dir=meta_dir, fmt=fmt, evolution=evolution, existing=True, rules=rules, options={}, schema=None)
    return _start(spark, src, meta_dir, trigger, functools.partial(_catch_up, sink=sink, files_per_batch=files_per_batch, **how))


def _start(spark: SparkSession, src: str, meta_dir: str, trigger: str, step: Callable[[SparkSession], int]) -> int | StreamingQuery:
    if trigger == AVAILABLE_NOW:
        return step(spark)
    # only names are streamed: they say when to look, the log says what is new
    names = spark.readStream.format("binaryFile").schema(FILE_COLUMNS).options(**ANY_AGE).load(src).select("path")
    writer = names.writeStream.foreachBatch(lambda batch, _: step(batch.sparkSession) and None)
    return run(writer.option("checkpointLocation", f"{meta_dir}/arrivals"), trigger)


def _append(rows: DataFrame, batch: int, dst: str, partition_by: Sequence[str]) -> None:
    placed = rows.withColumn(BATCH, F.lit(batch).cast("long"))
    writer = placed.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(*partition_by, BATCH).parquet(dst)


def _publish(rows: DataFrame, batch: int, root: str) -> None:
    newest = versions.latest_version(rows.sparkSession, root)
    if newest is None or newest < batch:
        versions.publish(rows, root, batch, "append", versions.batch_part(batch))


def _catch_up(spark: SparkSession, src: str, meta_dir: str, existing: bool, sink: Sink, files_per_batch: int, **how) -> int:
    """Load what an earlier run began and did not end, then the files not in the log. Returns rows."""
    batch, pending = _next(spark, meta_dir)
    total = 0
    if pending:
        total += _load(spark, src, meta_dir, batch, pending, sink, **how)
        batch += 1
    passes = None
    while passes is None or passes > 0:
        new = _new_files(spark, src, meta_dir, existing)
        if passes is None:
            passes = -(-new.count() // files_per_batch) + 1
        files = new.orderBy("modified", "path").limit(files_per_batch).collect()
        if not files:
            if batch == 0:
                _load_nothing(spark, src, meta_dir, sink, **how)
            break
        columns = {c: [f[c] for f in files] for c in ("path", "modified", "length")}
        small_frame(spark, columns).coalesce(1).write.mode("overwrite").parquet(f"{meta_dir}/files/{BATCH}={batch}")
        total += _load(spark, src, meta_dir, batch, columns["path"], sink, **how)
        batch, passes = batch + 1, passes - 1
    return total


def _listing(spark: SparkSession, src: str) -> DataFrame:
    """Names, times and sizes of all files; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src)
    return files.select("path", F.col("modificationTime").alias("modified"), "length")


def _logged(spark: SparkSession, meta_dir: str) -> DataFrame | None:
    return if_present(lambda: spark.read.schema(f"{LIST_SCHEMA}, {BATCH} long").parquet(f"{meta_dir}/files"))


def _new_files(spark: SparkSession, src: str, meta_dir: str, existing: bool) -> DataFrame:
    found, logged = _listing(spark, src), _logged(spark, meta_dir)
    if logged is not None:
        found = found.join(logged.select("path"), "path", "left_anti")
    return found if existing else found.filter(F.col("modified") > F.lit(_first_run(spark, f"{meta_dir}/start")))


def _next(spark: SparkSession, meta_dir: str) -> tuple[int, list[str]]:
    """The number of the next batch, and its files if it was begun before."""
    marks = if_present(lambda: spark.read.schema(MARK_SCHEMA).parquet(f"{meta_dir}/loaded"))
    done = None if marks is None else marks.agg(F.max("batch")).first()[0]
    batch, logged = 0 if done is None else done + 1, _logged(spark, meta_dir)
    begun = [] if logged is None else logged.filter(F.col(BATCH) == batch).select("path").orderBy("path").collect()
    return batch, [r["path"] for r in begun]


def _load(spark: SparkSession, src, meta_dir, batch: int, paths: list[str], sink: Sink, fmt, evolution, rules, options, schema) -> int:
    options = options | _base(src, paths)
    groups, wanted = _checked(spark, meta_dir, fmt, evolution, options, schema, paths)
    rows = None
    for found, members in groups:
        one = schemas.rescue_columns(_read(spark, fmt, options, found, wanted, members, evolution), wanted)
        rows = one if rows is None else rows.unionByName(one)
    if rows is None:  # files without a line
        rows = _empty(spark, wanted)
    if rules:
        rows = expect_fail(rows, rules)
    counted = Observation()
    sink(rows.observe(counted, F.count(F.lit(1)).alias("rows")), batch)
    n = counted.get.get("rows", 0)
    small_frame(spark, {"batch": [batch], "rows": [n]}).coalesce(1).write.mode("append").parquet(f"{meta_dir}/loaded")
    return n


def _load_nothing(spark: SparkSession, src, meta_dir, sink, fmt, evolution, rules, options, schema) -> None:
    """Schema and an empty table for a source whose files are all to be skipped."""
    paths = [r["path"] for r in _listing(spark, src).orderBy(F.desc("modified"), "path").limit(FILES_PER_BATCH).collect()]
    known = schemas.saved_schema(spark, f"{meta_dir}/schema")
    wanted = known[0] if known else _checked(spark, meta_dir, fmt, evolution, options | _base(src, paths), schema, paths)[1]
    sink(_empty(spark, wanted), 0)


def _empty(spark: SparkSession, schema: StructType) -> DataFrame:
    return spark.createDataFrame([], StructType([*schema.fields, StructField(RESCUED, StringType())]))


def _base(src: str, paths: list[str]) -> dict[str, str]:
    """Where columns in directory names (``day=2024-01-01``) begin, if there are any."""
    return {"basePath": src} if any(re.search(r"/[^/=]+=[^/]*/", p) for p in paths) and not re.search(r"[*?\[{]", src) else {}


def _checked(spark: SparkSession, meta_dir, fmt, evolution, options, given, paths) -> tuple[list[tuple[StructType, list[str]]], StructType]:
    """The files by the schema they hold, and the schema to ingest with, which is saved when it changes."""
    if evolution not in schemas.MODES:
        raise ValueError(f"evolution must be one of {schemas.MODES}")
    path = f"{meta_dir}/schema"
    saved = schemas.saved_schema(spark, path)
    start = saved[0] if saved else given
    text = fmt in schemas.TEXT_FORMATS
    if not paths:
        groups = []
    elif text and evolution == "none" and start is not None and fmt != "csv":
        groups = [(start, paths)]  # nothing to learn from the files
    else:
        groups = _by_schema(spark, fmt, options, paths)
    wanted = start
    for found, _ in groups:
        wanted = found if wanted is None else schemas.evolve(wanted, found, evolution)
    if wanted is None:
        raise ValueError("no files to infer a schema from")
    if saved is None or wanted != saved[0]:
        schemas.save_schema(spark, path, wanted, _utc_now(), saved[2] + 1 if saved else 0)
    return groups, wanted


def _read(spark: SparkSession, fmt, options, found: StructType, wanted: StructType, paths: list[str], evolution: str) -> DataFrame:
    """The files of one group: typed ones as they are, text ones as text with the lines that do not parse."""
    reader = spark.read.format(fmt).options(**options)
    names = [literal(p) for p in paths]
    if fmt not in schemas.TEXT_FORMATS:
        rows = reader.schema(found).load(names)
    else:
        # JSON is read by name, so wanted columns may be missing from the files; CSV by the place in the header
        more = [] if fmt == "csv" else [f for f in wanted if f.name not in found.names]
        reading = schemas.as_text(StructType([*found.fields, *more]))
        reader = reader.option("columnNameOfCorruptRecord", MALFORMED)
        rows = reader.schema(reading.add(MALFORMED, "string")).load(names)
        if fmt == "csv":
            in_file = [f.name for f in found if f.name not in _partition_names(paths)]
            surplus = _fields_in(F.col(MALFORMED), options) > len(in_file)  # a short line lacks nothing that is there
            rows = rows.withColumn(MALFORMED, F.when(surplus, F.col(MALFORMED)))
        else:  # how much of a broken line was read depends on where it breaks; it is kept whole
            whole, places = F.col(MALFORMED).isNull(), _partition_names(paths)
            parts = [c for c in rows.columns if c != MALFORMED and c not in places]
            rows = rows.withColumns({c: F.when(whole, F.col(schemas.quoted(c))) for c in parts})
    keep = [c for c in rows.columns if evolution != "none" or c in wanted.names or c == MALFORMED]
    return rows.select(*map(schemas.quoted, keep))


def _partition_names(paths: list[str]) -> set[str]:
    return set(re.findall(r"/([^/=]+)=[^/]*(?=/)", paths[0]))


def _fields_in(line, options: dict):
    """Number of fields of a CSV line: separators outside quotes, plus one."""
    sep, quote = options.get("sep", options.get("delimiter", ",")), options.get("quote", '"')
    bare = F.regexp_replace(line, f"{re.escape(quote)}(?:[^{re.escape(quote)}\\\\]|\\\\.|{re.escape(quote) * 2})*{re.escape(quote)}", "") if quote else line
    return (F.length(bare) - F.length(F.replace(bare, F.lit(sep), F.lit("")))) / len(sep) + 1


def read_bronze(spark: SparkSession, dst: str, meta_dir: str) -> DataFrame:
    """An ingested table in its newest schema; older rows have NULL in newer columns."""
    schema, _, _ = schemas.saved_schema(spark, f"{meta_dir}/schema")
    full = StructType([*schema.fields, StructField(RESCUED, StringType())])
    return spark.read.schema(full).parquet(dst).select(*map(schemas.quoted, full.names))


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)


def _first_run(spark: SparkSession, path: str) -> dt.datetime:
    """Time of the first run of this ingest."""
    saved = if_present(lambda: spark.read.schema("started_at timestamp").json(path))
    row = None if saved is None else saved.agg(F.min("started_at")).first()
    if row is not None and row[0] is not None:
        return row[0]
    now = spark.range(1).select(F.current_timestamp().alias("started_at"))
    now.coalesce(1).write.mode("append").json(path)
    return _first_run(spark, path)


def _by_schema(spark: SparkSession, fmt: str, options: dict, paths: list[str]) -> list[tuple[StructType, list[str]]]:
    """The files in groups that can be read together, each with its schema.

    Spark merges all footers in one job; only when types conflict are they read one by
    one, in tasks, and grouped there. CSV files are grouped by their header.
    """
    names = [literal(p) for p in paths]
    if fmt == "csv" and str(options.get("header", "false")).lower() == "true":
        return [(schemas.infer(spark, fmt, options, [literal(p) for p in members]), members) for members in _by_header(spark, names)]
    try:
        return [(schemas.infer(spark, fmt, options, names), paths)]
    except Exception as error:  # its class depends on the calling thread
        if "CANNOT_MERGE_SCHEMAS" not in str(error):
            raise
    groups = _by_footer(spark, paths) if fmt == "parquet" else {None: paths}
    for path, text in _one_by_one(spark, fmt, groups.pop(None, [])):
        groups.setdefault(text, []).append(path)
    # columns in directory names are not in the footers
    place = _partition_fields(spark, fmt, options, paths)
    found = [(StructType.fromJson(json.loads(text)), sorted(members)) for text, members in sorted(groups.items())]
    return [(StructType([*s.fields, *(f for f in place if f.name not in s.names)]), members) for s, members in found]


def _partition_fields(spark: SparkSession, fmt: str, options: dict, paths: list[str]) -> list[StructField]:
    names = _partition_names(paths) if "basePath" in options else set()
    if not names:
        return []
    return [f for f in spark.read.format(fmt).options(**options).schema("_ string").load([literal(p) for p in paths]).schema if f.name in names]


def _by_header(spark: SparkSession, names: list[str]) -> list[list[str]]:
    """CSV files with the same first line, in the order of those lines."""
    lines = spark.read.format("text").load(names).select(F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_block_start").alias("at"), "value")
    lines = lines.withColumn("line", F.monotonically_increasing_id()).filter("at = 0")
    first = lines.groupBy("path").agg(F.min_by("value", "line").alias("header"))
    groups = first.groupBy("header").agg(F.sort_array(F.collect_list("path")).alias("paths")).orderBy("header")
    return [[unquote(p) for p in r["paths"]] for r in groups.collect()]


def _by_footer(spark: SparkSession, paths: list[str]) -> dict[str | None, list[str]]:
    """Parquet files by the schema in their footers, which tasks read; None for places that only Spark reaches."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.fs as fs
        import pyarrow.parquet as pq
        from pyspark.sql.pandas.types import from_arrow_schema

        for batch in batches:
            found = []
            for path in batch.column("path").to_pylist():
                try:
                    local = path.startswith("file:")
                    system, place = (fs.LocalFileSystem(), re.sub("^file:/*", "/", path)) if local else fs.FileSystem.from_uri(path)
                    with system.open_input_file(place) as file:
                        schema = pq.read_schema(file)
                    own = (schema.metadata or {}).get(b"org.apache.spark.sql.parquet.row.metadata")
                    found.append(own.decode() if own else from_arrow_schema(schema).json())
                except (pa.ArrowInvalid, NotImplementedError, ImportError):
                    found.append(None)
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(found, pa.string())], names=["path", "schema"])

    listed = small_frame(spark, {"path": paths}).repartition(min(len(paths), spark.sparkContext.defaultParallelism))
    grouped = listed.mapInArrow(read, "path string, schema string").groupBy("schema").agg(F.collect_list("path").alias("paths"))
    return {r["schema"]: r["paths"] for r in grouped.collect()}


def _one_by_one(spark: SparkSession, fmt: str, paths: list[str]) -> list[tuple[str, str]]:
    """Schemas as Spark reads them, file by file."""
    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(lambda p: (p, spark.read.format(fmt).load(literal(p)).schema.json()), paths))


def literal(path: str) -> str:
    """A path whose own characters are not taken for a pattern."""
    return re.sub(r"([\\\[\]{}*?])", r"\\\1", path)


def copy_into(
    spark: SparkSession,
    src: str,
    root: str,
    fmt: str = "parquet",
    options: dict | None = None,
    files_per_version: int = 10_000,
) -> int:
    """Batch load that takes each file once. Returns the number of new files.

    Columns in directory names (``day=2024-01-01``) are loaded, columns that a delivery
    lacks stay, and names are taken literally. The list of loaded files is part of the version that loaded them, so both
    become visible together. More than ``files_per_version`` new files become
    several versions, so only that many names are held at a time.
    """
    total = loaded = _copy_version(spark, src, root, fmt, options, files_per_version)
    while loaded == files_per_version:
        loaded = _copy_version(spark, src, root, fmt, options, files_per_version)
        total += loaded
    return total


def _copy_version(spark, src, root, fmt, options, files_per_version) -> int:
    newest = versions.latest_version(spark, root)
    version = 0 if newest is None else newest + 1
    listing = (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(src).select("path")
    )
    if newest is not None:
        loaded = (
            spark.read.schema("path string, _version long").parquet(f"{root}/files")
            .filter(F.col("_version") <= newest)
        )
        listing = listing.join(loaded, "path", "left_anti")
    files = f"{root}/files/_version={version}"
    listing.limit(files_per_version).write.mode("overwrite").parquet(files)
    paths = [r["path"] for r in spark.read.schema("path string").parquet(files).collect()]
    if not paths:
        return 0
    reader = spark.read.format(fmt).options(**{"basePath": src, "mergeSchema": "true", **(options or {})})
    rows = reader.load([literal(p) for p in paths])
    if newest is not None:  # a delivery adds columns, it does not take any away
        before = versions.read(spark, root, newest, parts=()).limit(0)
        rows = before.unionByName(rows, allowMissingColumns=True)
    versions.publish(rows, root, version, "copy", versions.batch_part(version))
    return len(paths)
