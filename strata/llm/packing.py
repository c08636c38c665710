"""Packing: documents into token sequences of a fixed length with little padding."""

from __future__ import annotations

import base64
import functools
import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import slices, store

CAPACITY = 2048
END_ID = 1
GROUP_PIECES = 1 << 14
UNPACKED_ROWS = 1 << 10


def vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


@functools.cache
def encoder(path: str):
    """The vocabulary as ranks gives the ids of its tokenizer file, in a fifth of the time.

    The added tokens stand in the tokenizer file beside the ranks, if there is one.
    """
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    added, beside = {}, f"{os.path.splitext(path)[0]}.json"
    if os.path.exists(beside):
        with open(beside, encoding="utf-8") as file:
            added = {token["content"]: token["id"] for token in json.load(file)["added_tokens"]}
    return tiktoken.Encoding("packing", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=added)


def encode(encoding, text: str) -> list[int]:
    """Ids of a text, which is cut at the added tokens first, as the tokenizer does."""
    if any(token in text for token in encoding.special_tokens_set):
        return encoding.encode(text, allowed_special="all")
    return encoding.encode_ordinary(text)


PIECES = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("doc_tokens", T.LongType()),
    ]
)
IDS = T.StructField("ids", T.ArrayType(T.IntegerType()))


PACKED = T.StructField("packed_ids", T.BinaryType())


def pieces(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, keep_ids: bool = False, packed: bool = False) -> DataFrame:
    """Tokenize every document and cut it into pieces of at most ``capacity`` ids.

    ``keep_ids`` adds the ids as an array; with ``packed`` they are bytes (``packed_ids``, two
    an id if the vocabulary allows), which ``pack`` turns into the array at its end.

    A document is its ids and one end id; a null or empty text is the end id alone. The
    string of an added token is that token's id, as with the tokenizer itself.
    Only ``doc_id`` and ``text`` are read, so other columns may have any name. Repeated
    rows give repeated pieces and a null ``doc_id`` is kept.
    """
    path = path or vocabulary()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = encoder(path)
        narrow = "<u2" if encoding.max_token_value < 1 << 16 else "<u4"
        for batch in batches:
            for part in slices(batch, "text"):
                rows, ids = [], []
                for doc_id, text in zip(part.column("doc_id").to_pylist(), part.column("text"), strict=True):
                    doc = np.array([*encode(encoding, text.as_py() or ""), END_ID], dtype="<u4")
                    for start in range(0, len(doc), capacity):
                        piece = doc[start : start + capacity]
                        rows.append((doc_id, start, len(piece), zlib.crc32(piece.tobytes()), len(doc)))
                        if keep_ids:
                            ids.append(piece.astype(narrow).tobytes() if packed else piece.astype(np.int32))
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)] or [pa.array([], pa.int64())] * 5
                if keep_ids:
                    columns.append(pa.array(ids, pa.binary() if packed else pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    schema = T.StructType([*PIECES.fields, PACKED if packed else IDS]) if keep_ids else PIECES
    return docs.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(cut, schema)


def first_fit(lengths: np.ndarray, capacity: int) -> tuple[list[int], list[int]]:
    """First fit of lengths in the given order: bin and offset of each.

    A tournament tree over the bins holds the most room below each node, so the leftmost
    bin with enough room is found on one way down.
    """
    leaves = 1 << max(1, len(lengths) - 1).bit_length()
    room = [capacity] * (2 * leaves)
    bins, offsets = [], []
    for length in lengths.tolist():
        node = 1
        while node < leaves:
            node *= 2
            if room[node] < length:
                node += 1
        bins.append(node - leaves)
        offsets.append(capacity - room[node])
        room[node] -= length
        while node > 1:
            node //= 2
            room[node] = max(room[2 * node], room[2 * node + 1])
    return bins, offsets


def unpacked(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Rows with their ids as an array instead of bytes."""
    if PACKED.name not in batch.schema.names:
        return batch
    place = batch.schema.get_field_index(PACKED.name)
    lengths = batch.column("length").to_numpy()
    held = [np.frombuffer(b.as_buffer(), dtype=f"<u{len(b.as_buffer()) // n}").astype(np.int32) for b, n in zip(batch.column(place), lengths, strict=True)]
    return batch.set_column(place, "ids", pa.array(held, pa.list_(pa.int32())))


def pack(cut: DataFrame, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Place pieces (rows with a ``length`` of 1 to ``capacity``) into sequences.

    The pieces are written once and dealt at random into groups of about
    ``group_pieces``; each group is packed by first-fit decreasing on its own. Dealing
    ignores all keys, so no document, source or repeated row can fill one group. Adds
    ``sequence_id`` (group and bin) and ``offset``; columns of these names are replaced.
    An empty table gives an empty table.
    """
    cut = store(cut.drop("sequence_id", "offset"), "packing")
    groups = max(1, -(-cut.count() // group_pieces))
    fields = [IDS if f.name == PACKED.name else f for f in cut.schema.fields]
    schema = T.StructType([*fields, T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        group = TaskContext.get().partitionId()
        held = [b for b in batches if b.num_rows]  # one group: bounded by group_pieces
        if not held:
            return
        rows = pa.Table.from_batches(held)
        bins, offsets = first_fit(rows.column("length").to_numpy(), capacity)
        rows = rows.append_column("sequence_id", pa.array((group << 32) + np.array(bins, dtype=np.int64)))
        rows = rows.append_column("offset", pa.array(offsets, pa.int64()))
        yield from (unpacked(b) for b in rows.to_batches(UNPACKED_ROWS))

    order = [F.col(c) for c in cut.columns if not isinstance(cut.schema[c].dataType, T.MapType) and c != "length"]
    return cut.repartition(groups).sortWithinPartitions(F.desc("length"), *order).mapInArrow(place, schema)


def sequences(packed: DataFrame, capacity: int = CAPACITY, pad_id: int = 0) -> DataFrame:
    """The sequences themselves from packed pieces with ``ids``: one padded array per sequence.

    A sequence whose length is a power of two is left unpadded.
    """
    rows = packed.groupBy("sequence_id").agg(
        F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda p: p["ids"])).alias("ids")
    )
    size = F.size("ids")
    padding = F.when(F.bit_count(size) == 1, 0).otherwise(capacity - size)
    return rows.select("sequence_id", F.concat("ids", F.array_repeat(F.lit(pad_id), padding)).alias("ids"), size.alias("n_ids"))
