"""Python work per partition, in Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def map_partitions(
    df: DataFrame,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """Run ``fn`` once per partition over an iterator of batches."""
    return df.mapInPandas(fn, schema)


def dispatch(
    spark: SparkSession,
    tasks: int,
    fn: Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]],
    schema: StructType | str,
) -> DataFrame:
    """One task per id in ``0 .. tasks-1``, each its own partition."""
    return map_partitions(spark.range(0, tasks, 1, tasks), fn, schema)
