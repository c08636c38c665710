"""Substring dedup: relative Lempel-Ziv parsing of documents against indexed reference blocks."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.llm.common import Words, grams, hash_of, mix, named, slices, words

LENGTH = 20
GRAM = 8
GROUP_ROWS = 2048
CROWDED = 10_000
KEY = ("doc_id", "text_hash")  # of a document; rows of one key differ in other columns only


def anchors(split: Words, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows that share their smallest gram: hash of the gram, first window, windows.

    Windows are numbered by their first word in the slice and lie within one text. Equal
    windows have equal smallest grams, so all occurrences of a window meet under one hash;
    which windows are equal is decided later on the words themselves.
    """
    none = np.empty(0, np.int64)
    gram = grams(split.hash, min(GRAM, length))
    n = len(split.hash) - length + 1
    if n <= 0:
        return np.empty(0, np.uint64), none, none
    least, place = gram[:n].copy(), np.arange(n)
    for step in range(1, length - min(GRAM, length) + 1):
        smaller = gram[step : step + n] < least
        least[smaller] = gram[step : step + n][smaller]
        place[smaller] = np.flatnonzero(smaller) + step
    bounds = split.of
    text = np.searchsorted(bounds, np.arange(n), side="right") - 1
    inside = np.flatnonzero(np.arange(n) + length <= bounds[text + 1])
    if not len(inside):
        return np.empty(0, np.uint64), none, none
    key = place[inside]
    new = np.ones(len(inside), dtype=bool)
    new[1:] = (key[1:] != key[:-1]) | (inside[1:] != inside[:-1] + 1) | (text[inside[1:]] != text[inside[:-1]])
    first = np.flatnonzero(new)
    return least[inside[first]], inside[first], np.diff(np.append(first, len(inside)))


def condensed(docs: DataFrame, groups: int) -> DataFrame:
    """Rows for grouping: grp, doc_id, text_hash, rest (the other columns), rows, text.

    Equal rows are one document. Those that a task reads together are already counted
    here, so a row that is repeated very often does not reach one group as often.
    """
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    doc_id, text = docs["doc_id"].cast("long"), docs["text"].cast("string")
    text_hash = F.xxhash64(text)
    rows = docs.select(
        F.pmod(F.xxhash64(doc_id, text_hash), F.lit(groups)).cast("int").alias("grp"), doc_id.alias("doc_id"), text_hash.alias("text_hash"),
        hash_of(docs, rest).alias("rest_hash"), F.struct(F.lit(0).alias("_"), *map(named, rest)).alias("rest"),
        F.lit(1).cast("long").alias("rows"), text.alias("text"),
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, rows = distinct(batch)
            if len(first) < batch.num_rows:
                batch = batch.take(pa.array(first)).set_column(5, batch.schema.field("rows"), pa.array(rows))
            yield batch

    return rows.mapInArrow(count, rows.schema)


def distinct(batch: pa.RecordBatch | pa.Table, key: tuple[str, ...] = ("doc_id", "text_hash", "rest_hash")) -> tuple[np.ndarray, np.ndarray]:
    """First position of each distinct ``key``, and its rows."""
    place: dict[tuple, int] = {}
    first, rows = [], []
    columns = (batch.column(c).to_pylist() for c in (*key, "rows"))
    for i, (*key, n) in enumerate(zip(*columns, strict=True)):
        j = place.setdefault(tuple(key), len(first))
        if j == len(first):
            first.append(i)
            rows.append(0)
        rows[j] += n
    return np.array(first, dtype=np.int64), np.array(rows, dtype=np.int64)


def requests(grouped: DataFrame, length: int) -> DataFrame:
    """(anchor, grp, total) of all anchors that occur at least twice in the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            once, _ = distinct(batch, KEY)
            if len(once) < batch.num_rows:
                batch = batch.take(pa.array(once))
            parts = []
            for part in slices(batch, "text"):
                split = words(part.column("text"))
                hashes, first, _ = anchors(split, length)
                text = np.searchsorted(split.of, first, side="right") - 1
                parts.append((hashes, part.column("grp").to_numpy()[text]))
            hashes, group = (np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (np.empty(0, np.uint64), np.empty(0, np.int32))
            order = np.lexsort((group, hashes))
            hashes, group = hashes[order], group[order]
            new = np.ones(len(hashes), dtype=bool)
            new[1:] = (hashes[1:] != hashes[:-1]) | (group[1:] != group[:-1])
            at = np.flatnonzero(new)
            columns = [pa.array(hashes[at].view(np.int64)), pa.array(group[at]), pa.array(np.diff(np.append(at, len(hashes))))]
            yield pa.RecordBatch.from_arrays(columns, names=["anchor", "grp", "n"])

    found = grouped.select("grp", *KEY, "rows", "text").mapInArrow(run, "anchor long, grp int, n long")
    total = F.sum("n").over(Window.partitionBy("anchor"))
    return found.withColumn("total", total).filter("total > 1").select("anchor", "grp", "total")


PASSAGE = "block long, doc_id long, text_hash long, start long, windows long, passage binary"


def passages(grouped: DataFrame, live: DataFrame, length: int, crowded: int) -> DataFrame:
    """The passages around repeated anchors, on their way to the reference block of the anchor.

    A block takes all passages of one anchor. If the anchor is crowded, its windows go one
    by one to blocks by their own hash instead. Equal passages of a group are sent once;
    the later ones are repeats already (rows without ``passage``).
    """

    def run(docs: pa.Table, wanted: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if docs.num_rows and wanted.num_rows:
            order = np.argsort(wanted.column("anchor").to_numpy().view(np.uint64))
            known = wanted.column("anchor").to_numpy().view(np.uint64)[order]
            crowd = wanted.column("total").to_numpy()[order] > crowded
            first, _ = distinct(docs, KEY)
            docs = docs.select(["doc_id", "text_hash", "text"]).take(pa.array(first))
            keys = list(zip(docs.column("doc_id").to_pylist(), docs.column("text_hash").to_pylist(), strict=True))
            rank = sorted(range(len(keys)), key=lambda i: (keys[i][0] is None, keys[i]))
            docs, keys = docs.take(pa.array(rank)), [keys[i] for i in rank]
            sent: set[bytes] = set()
            base = 0
            for batch in docs.combine_chunks().to_batches():
                for part in slices(batch, "text"):
                    split = words(part.column("text"))
                    hashes, start, windows = anchors(split, length)
                    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                    joined, begins, ends = split.joined()
                    for j in np.flatnonzero(known[at] == hashes).tolist():
                        a, n = int(start[j]), int(windows[j])
                        text = int(np.searchsorted(split.of, a, side="right")) - 1
                        key, begin = keys[base + text], a - int(split.of[text])
                        spans = [(a + i, 1) for i in range(n)] if crowd[at[j]] else [(a, n)]
                        for b, m in spans:
                            passage = joined[begins[b] : ends[b + m + length - 2]]
                            block = hashes[j]
                            if crowd[at[j]]:
                                block = mix(grams(split.hash[b : b + length], length))[0]
                            new = passage not in sent
                            sent.add(passage)
                            if not new:  # nothing to look up, so to any block
                                block = mix(np.array([key[1] + begin + b - a]).view(np.uint64))[0]
                            out.append((int(block.view(np.int64)), *key, begin + b - a, m, passage if new else None))
                    base += part.num_rows
        columns = list(zip(*out, strict=True)) or [[]] * 6
        types = [pa.int64()] * 5 + [pa.binary()]
        names = ["block", "doc_id", "text_hash", "start", "windows", "passage"]
        return pa.table({c: pa.array(v, t) for c, v, t in zip(names, columns, types, strict=True)})

    return grouped.groupBy("grp").cogroup(live.groupBy("grp")).applyInArrow(run, PASSAGE)


class Block:
    """A reference: the passages read so far, indexed by their windows."""

    def __init__(self, length: int):
        self.length, self.texts, self.index = length, [], {}

    def parse(self, passage: bytes) -> list[tuple[int, int]]:
        """Factor a passage greedily against the reference: (first window, windows) of each repeat.

        A factor is the longest run of words that continues a match of one window. After
        it, at its boundary, the next window is looked up on its own, so repeats that
        stretch over two factors are found. What has no match joins the reference.
        """
        text, length = passage.split(b" "), self.length
        at = np.concatenate(([0], np.cumsum([len(w) + 1 for w in text]))).tolist()
        self.texts.append(text)
        found, i = [], 0
        while i + length <= len(text):
            window = passage[at[i] : at[i + length] - 1]
            hit = self.index.setdefault(window, (len(self.texts) - 1, i))
            if hit == (len(self.texts) - 1, i):
                i += 1
                continue
            other, j, run = self.texts[hit[0]], hit[1], length
            while i + run < len(text) and j + run < len(other) and text[i + run] == other[j + run]:
                run += 1
            found.append((i, run - length + 1))
            i += run - length + 1
        return found


def repeats(sent: DataFrame, length: int) -> DataFrame:
    """(doc_id, text_hash, start, windows): windows whose words also begin earlier.

    A block is read in the order of documents and positions. Rows without ``passage`` are
    repeats already and pass through.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, block = None, Block(length)
        for batch in batches:
            out = []
            columns = (batch.column(c).to_pylist() for c in ("block", "doc_id", "text_hash", "start", "windows", "passage"))
            for key, doc_id, text_hash, start, windows, passage in zip(*columns, strict=True):
                if passage is None:
                    out.append((doc_id, text_hash, start, windows))
                    continue
                if key != now:
                    now, block = key, Block(length)
                out += [(doc_id, text_hash, start + i, n) for i, n in block.parse(passage)]
            columns = list(zip(*out, strict=True)) or [[]] * 4
            names = ["doc_id", "text_hash", "start", "windows"]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    order = ["block", F.asc_nulls_last("doc_id"), "text_hash", "start"]
    parsed = sent.repartition("block").sortWithinPartitions(*order)
    return parsed.mapInArrow(run, "doc_id long, text_hash long, start long, windows long")


def deduplicate(docs: DataFrame, length: int = LENGTH, group_rows: int = GROUP_ROWS, crowded: int = CROWDED, as_is: bool = False) -> DataFrame:
    """Remove every word inside a window of ``length`` words whose words also begin earlier.

    Earlier is a smaller doc_id, or a smaller position in the same document; a null id
    comes last, and different texts under one id follow each other by a hash of the text.
    Returns the columns of ``docs`` with ``text`` replaced by the kept words joined by one
    space, and n_words, n_removed; with ``as_is`` a text that loses nothing stays as it is,
    white space included. A null text stays null, with no words. Rows that agree in
    doc_id and text are one document and get the same result, whatever else they hold. Windows are judged on the input.

    Anchors that occur only once cannot begin a repeat, so only passages around the others
    are sent, each to the reference block of its anchor, and factored there.
    """
    groups = max(1, -(-docs.count() // group_rows))
    grouped = condensed(docs, groups)
    sent = passages(grouped, requests(grouped, length), length, crowded)
    spans = repeats(sent, length)
    spans = spans.select(F.pmod(F.xxhash64("doc_id", "text_hash"), F.lit(groups)).cast("int").alias("grp"), "doc_id", "text_hash", "start", "windows")
    rest = grouped.schema["rest"]
    schema = T.StructType(
        [T.StructField("doc_id", T.LongType()), T.StructField("rest", rest.dataType), T.StructField("rows", T.LongType()), T.StructField("text", T.StringType()),
         T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType())]
    )

    def cut(rows: pa.Table, found: pa.Table) -> pa.Table:
        spans_of = defaultdict(list)
        columns = (found.column(c).to_pylist() for c in ("doc_id", "text_hash", "start", "windows"))
        for doc_id, text_hash, start, windows in zip(*columns, strict=True):
            spans_of[doc_id, text_hash].append((start, start + windows + length - 1))
        first, count = distinct(rows)
        rows = rows.take(pa.array(first, pa.int64())).combine_chunks()
        kept, n_words, n_removed = [], [], []
        for batch in rows.to_batches():
            for part in slices(batch, "text"):
                split = words(part.column("text"), hashes=False)
                joined, begins, ends = split.joined()
                keys = zip(part.column("doc_id").to_pylist(), part.column("text_hash").to_pylist(), part.column("text").is_null().to_pylist(), strict=True)
                for i, (doc_id, text_hash, null) in enumerate(keys):
                    a, b = int(split.of[i]), int(split.of[i + 1])
                    keep = np.ones(b - a, dtype=bool)
                    for s, e in spans_of.get((doc_id, text_hash), ()):
                        keep[s:e] = False
                    edges = np.flatnonzero(np.diff(np.concatenate(([False], keep, [False])))).tolist()
                    runs = [joined[begins[a + s] : ends[a + e - 1]] for s, e in zip(edges[::2], edges[1::2], strict=True)]
                    text = part.column("text")[i].as_py() if as_is and keep.all() else b" ".join(runs).decode()
                    kept.append(None if null else text)
                    n_words.append(b - a)
                    n_removed.append(b - a - int(keep.sum()))
        out = [rows.column("doc_id"), rows.column("rest"), pa.array(count), pa.array(kept, pa.string()), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64())]
        return pa.table(dict(zip(schema.names, out, strict=True)))

    done = grouped.groupBy("grp").cogroup(spans.groupBy("grp")).applyInArrow(cut, schema)
    done = done.withColumn("rows", F.explode(F.array_repeat(F.lit(0), F.col("rows").cast("int"))))
    names = [c for c in docs.columns if c not in ("doc_id", "text")]
    taken = [F.col(c) if c in ("doc_id", "text") else F.col("rest")[c].alias(c) for c in docs.columns]
    return done.select(*taken, *(c for c in ("n_words", "n_removed") if c not in names))
