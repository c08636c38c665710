"""What the operators share: written tables, row keys, and words as numpy arrays."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import scratch_dir
from strata.sources.schemas import quoted

WORD = r"[^\x20\x09-\x0D]+"
SLICE_BYTES = 1 << 21


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


RELEASE = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def store(df: DataFrame, purpose: str, release: bool = False) -> DataFrame:
    """Write below ``spark.checkpoint.dir`` and read again: cuts the lineage for good.

    ``release`` lets Spark remove the shuffle files of this write as soon as it has ended.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, purpose)
    before = spark.conf.get(RELEASE, "false")
    if release:
        spark.conf.set(RELEASE, "true")
    try:
        df.write.parquet(path)
    finally:
        if release:
            spark.conf.set(RELEASE, before)
    return spark.read.schema(df.schema).parquet(path)


def named(name: str) -> Column:
    """The column of this very name, dots and all."""
    return F.col(quoted(name))


def hash_of(docs: DataFrame, names: list[str]) -> Column:
    """A hash of the values of some columns; maps count by their JSON text."""
    maps = [isinstance(docs.schema[c].dataType, (T.MapType, T.VariantType)) for c in names]
    return F.xxhash64(F.lit(0), *(F.to_json(F.struct(named(c).alias("m"))) if m else named(c) for c, m in zip(names, maps, strict=True)))


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % modulus


_SEPARATOR = np.zeros(256, dtype=bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20
_BASE = np.uint64(0x9E3779B97F4A7C15)
_STEP = np.uint64(0xD6E8FEB86659FD93)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values, one to one."""
    x = (x ^ (x >> np.uint64(32))) * _STEP
    x = (x ^ (x >> np.uint64(29))) * _BASE
    return x ^ (x >> np.uint64(32))


class Words(NamedTuple):
    """Words of a slice of texts: byte bounds in ``data``, a 64-bit hash, bounds per text."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    of: np.ndarray  # word index where each text begins, one entry more than texts

    def joined(self) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All words with one blank after each, and where each begins and ends in that."""
        size = self.end - self.start
        end = np.cumsum(size + 1) - 1
        out = np.full(int(end[-1]) + 1 if len(end) else 0, 0x20, dtype=np.uint8)
        word = np.repeat(np.arange(len(size)), size)
        inside = np.arange(len(word)) + word
        out[inside] = self.data[np.arange(len(word)) + np.repeat(self.start - np.cumsum(size) + size, size)]
        return out.tobytes(), end - size, end


def words(texts: pa.Array, lower: bool = False, hashes: bool = True) -> Words:
    """Split texts at ASCII white space; a null text has no words."""
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8)[offsets[0] : offsets[-1]] if data else np.empty(0, np.uint8)
    offsets = offsets - offsets[0]
    inside = ~_SEPARATOR[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:-1]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | edge[1:-1]
    start, end = np.flatnonzero(first), np.flatnonzero(last) + 1
    if lower:
        data = _LOWER[data]
    value = np.empty(0, np.uint64)
    if hashes and len(start):
        size = end - start
        at = np.concatenate(([0], np.cumsum(size)[:-1]))
        power = np.multiply.accumulate(np.full(int(size.max()), _BASE))
        place = np.arange(int(size.sum())) - np.repeat(at, size)
        value = np.add.reduceat((data[inside].astype(np.uint64) + np.uint64(1)) * power[place], at)
        value = mix(value + size.astype(np.uint64) * _STEP)
    return Words(data, start, end, value, np.searchsorted(start, offsets))


def grams(value: np.ndarray, length: int) -> np.ndarray:
    """Hashes of the runs of ``length`` words beginning at each word, as if all were one text."""
    n = max(0, len(value) - length + 1)
    out = np.zeros(n, dtype=np.uint64)
    for i in range(length):
        out = out * _BASE + value[i : i + n]
    return mix(out + np.uint64(length))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows with about ``limit`` bytes of text; a longer row comes alone."""
    texts = batch.column(column)
    sizes = np.asarray(pc.binary_length(texts).fill_null(0), dtype=np.int64)
    piece = np.cumsum(sizes) // limit
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(piece)) + 1, [len(sizes)])) if len(sizes) else [0]
    for a, b in zip(bounds[:-1], bounds[1:], strict=True):
        yield batch.slice(a, b - a)
