"""Batch file sources and sinks."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Columns of the monthly target file.
TARGETS_SCHEMA = "site_id bigint, site_name string, monthly_target_tons int"


def small_frame(spark: SparkSession, columns: dict[str, list]) -> DataFrame:
    """A few rows of metadata; sent as Arrow, which starts no Python worker."""
    return spark.createDataFrame(pa.table(columns))


def if_present(read: Callable[[], DataFrame]) -> DataFrame | None:
    """The DataFrame, or None while its path does not exist yet."""
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def read_binary(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Whole files as rows: (path, content)."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern is not None:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", "content")


def read_text_documents(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """Files decoded as text: (path, text)."""
    return read_binary(spark, path, pattern).select("path", F.decode("content", "UTF-8").alias("text"))


def load_targets(spark: SparkSession, path: str) -> DataFrame:
    """Monthly targets from CSV files with a header; a malformed line is an error."""
    return spark.read.schema(TARGETS_SCHEMA).option("mode", "FAILFAST").csv(path, header=True)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], overwrite_present_only: bool = False) -> None:
    """Write a directory per partition value.

    The rebalance gives each value few files and splits a value too large for one
    task. ``overwrite_present_only`` leaves the other partitions as they are.
    """
    mode = "dynamic" if overwrite_present_only else "static"
    (
        df.hint("rebalance", *[F.col(c) for c in by])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", mode)
        .partitionBy(*by)
        .parquet(path)
    )


def read_partitioned(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """Read it back; a filter on a partition column prunes directories."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
