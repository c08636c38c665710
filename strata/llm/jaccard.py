"""N-gram Jaccard join: light sets by subsets of two, heavy sets by inverted lists."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from fractions import Fraction
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import grams, mix, slices, store, words
from strata.llm.components import components

SHINGLE = 5
PERCENT = 80
SKETCH = 1 << 24
MOST = (1 << 16) - 1
CHUNK = 1 << 16
LONG_LIST = 32
FILTER_BITS = 1 << 26
BLOCK = 4096
SLICE_BYTES = 1 << 19


def shingle_sets(texts: pa.Array, length: int) -> list[np.ndarray]:
    """The distinct shingles of each text as sorted 64-bit hashes.

    A text with fewer words has its whole sequence as the one shingle, one without words none.
    """
    split = words(texts, lower=True)
    whole, out = grams(split.hash, length), []
    for a, b in zip(split.of[:-1].tolist(), split.of[1:].tolist(), strict=True):
        if b - a >= length:
            out.append(np.unique(whole[a : b - length + 1]))
        else:
            out.append(grams(split.hash[a:b], b - a) if b > a else np.empty(0, np.uint64))
    return out


def class_of(values: np.ndarray) -> int:
    """One number for a set, whatever its order: equal sets are one class."""
    return int(mix(np.append(mix(values), np.uint64(len(values)))).sum().astype(np.int64))


FOUND = "doc_id long, n long, cls long, text_hash long, chunk int, counts binary"


def scan(docs: DataFrame, length: int) -> DataFrame:
    """Set size and class of every document, and in the same pass how often shingles occur.

    Each task counts its shingles in SKETCH cells, up to MOST in a cell, and ends with them in
    packed chunks (rows with ``chunk``); the sums of all tasks give a rarity order of bounded size.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH, dtype=np.uint16)
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column("text"), length)
                values = np.concatenate([*sets, np.empty(0, np.uint64)])
                cell, count = np.unique((values % np.uint64(SKETCH)).astype(np.int32), return_counts=True)
                cells[cell] = np.minimum(cells[cell] + count, MOST).astype(np.uint16)
                n = part.num_rows
                columns = [
                    part.column("doc_id"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([class_of(s) for s in sets], pa.int64()), part.column("text_hash"),
                    pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "cls", "text_hash", "chunk", "counts"])
            pa.default_memory_pool().release_unused()  # the worker is used again by later stages
        chunks = [packed(cells[a : a + CHUNK]) for a in range(0, SKETCH, CHUNK)]
        empty = pa.nulls(len(chunks), pa.int64())
        columns = [empty, empty, empty, empty, pa.array(range(len(chunks)), pa.int32()), pa.array(chunks, pa.binary())]
        yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "n", "cls", "text_hash", "chunk", "counts"])

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(run, FOUND)


def packed(cells: np.ndarray) -> bytes:
    """Counts as bytes, all low ones before all high ones, which are mostly zero."""
    return zlib.compress(cells.astype("<u2").view(np.uint8).reshape(-1, 2).T.tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    low, high = np.frombuffer(zlib.decompress(data), dtype=np.uint8).reshape(2, -1)
    return low + 256.0 * high


def rarity(scanned: DataFrame) -> np.ndarray:
    """Per cell of the sketch the logarithm of its count in a byte: SKETCH bytes at any size of the corpus."""

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(CHUNK)
        for batch in batches:
            for counts in batch.column("counts"):
                total += unpacked(counts.as_py())
        levels = np.minimum(255, 4 * np.log2(1 + total)).astype(np.uint8)
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([levels.tobytes()], pa.binary())], names=["chunk", "levels"])

    # partial sums first: many tasks send chunks, and a chunk is one group
    parts = scanned.filter("chunk IS NOT NULL").select("chunk", "counts")
    rows = parts.groupBy("chunk").applyInArrow(add, "chunk int, levels binary").collect()
    order = np.zeros(SKETCH, dtype=np.uint8)
    for row in rows:
        order[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["levels"], dtype=np.uint8)
    return order


def prefix(n: int, percent: int, shared: int = 1) -> int:
    """How many of a set's rarest shingles hold ``shared`` common ones with any similar set."""
    return min(n, n - -(-percent * n // 100) + shared)


def boundary(sizes: list[tuple[int, int]], percent: int) -> int:
    """The set size up to which subsets cost less than lists, from (size, number of classes).

    A light set writes every pair of its prefix. A heavy one writes its prefix and is read
    once for each other set on those lists, whose expected length is the number of prefix
    shingles per cell of the sketch. Sets just below the boundary take both ways.
    """
    on_lists = 1 + sum(prefix(n, percent) * c for n, c in sizes) / SKETCH
    best, cost_of = 0, {}
    for limit in range(0, 129):
        light = sum(c * prefix(n, percent, 2) * (prefix(n, percent, 2) - 1) / 2 for n, c in sizes if n <= limit)
        heavy = sum(c * prefix(n, percent) * on_lists for n, c in sizes if 100 * n >= percent * (limit + 1))
        cost_of[limit] = light + heavy
        best = min(best, limit, key=cost_of.__getitem__)
    return best


def bands(percent: int) -> np.ndarray:
    """Where each band of set sizes begins: similar sets are in one band or in two that follow each other."""
    starts = [least_size(percent)]
    while starts[-1] < 1 << 40:
        starts.append(starts[-1] * 100 // percent + 1)
    return np.array(starts)


def least_size(percent: int) -> int:
    """From this size on one shingle more leaves a set similar: n / (n + 1) >= percent / 100."""
    return ceil(Fraction(percent, 100 - percent))


def least_shared(n, other, percent: int):
    """How many shingles similar sets of two sizes share at least."""
    return -(-percent * (n + other) // (100 + percent))


OWN, LOWER, SUBSET = 0, 1, 2


def keys(docs: DataFrame, order: np.ndarray, light: int, length: int, percent: int) -> DataFrame:
    """(key, cls, n, kind): the lists and subsets of two on which a set may meet similar ones.

    Lists are kept by shingle and band of set sizes. A set is on the lists of its band with
    its whole prefix (OWN), and on those of the next band (LOWER) with the few shingles that
    hold a common one with the smallest set there: as many rows as without bands and a
    quarter more, but a list only grows with the sets of like size. Sets so small that one
    shingle more breaks the similarity only link when equal.
    """
    least, starts = least_size(percent), bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                found: list[tuple[np.ndarray, int, int, int]] = []
                for values in shingle_sets(part.column("text"), length):
                    n, cls = len(values), class_of(values)
                    if n < least or cls in seen:
                        continue
                    seen.add(cls)
                    spread = mix(values)
                    by_rarity = (order[(values % np.uint64(SKETCH)).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (spread >> np.uint64(8))
                    rare = spread[np.argsort(by_rarity, kind="stable")[: prefix(n, percent, 2)]]
                    if n <= light:
                        a, b = np.triu_indices(len(rare), 1)
                        found.append((mix(rare[a] + rare[b] + np.uint64(1)), cls, n, SUBSET))
                    if 100 * n >= percent * (light + 1):
                        band = int(np.searchsorted(starts, n, side="right"))
                        found.append((mix(rare[: prefix(n, percent)] ^ np.uint64(band)), cls, n, OWN))
                        if 100 * n >= percent * starts[band]:
                            up = n - int(least_shared(n, starts[band], percent)) + 1
                            found.append((mix(rare[:up] ^ np.uint64(band + 1)), cls, n, LOWER))
                if found:
                    count = [len(f[0]) for f in found]
                    columns = [pa.array(np.concatenate([f[0] for f in found]).view(np.int64))]
                    kinds = (np.int64, np.int32, np.int8)
                    columns += [pa.array(np.repeat(np.array([f[i] for f in found], kinds[i - 1]), count)) for i in (1, 2, 3)]
                    yield pa.RecordBatch.from_arrays(columns, names=["key", "cls", "n", "kind"])
            pa.default_memory_pool().release_unused()

    return docs.select(F.col("text").cast("string")).mapInArrow(run, "key long, cls long, n int, kind byte")


def lists_needed(n: np.ndarray, kind: np.ndarray, other: np.ndarray, other_kind: np.ndarray, light: int, percent: int, starts: np.ndarray) -> np.ndarray:
    """On how many lists two sets must meet to be similar; 0 if meeting says enough, -1 for a pair to leave out.

    All shared shingles up to the end of one of the two prefixes are in both, so at most the
    rest of that set can be shared beyond the lists on which the two meet. Two light sets
    meet on subsets, two sets of the lower band on the lists of their own.
    """

    def rest(size: np.ndarray, how: np.ndarray) -> np.ndarray:
        above = starts[np.searchsorted(starts, size, side="right")]
        return np.where(how == LOWER, least_shared(size, above, percent), -(-percent * size // 100)) - 1

    need = np.maximum(1, least_shared(n, other, percent) - np.maximum(rest(n, kind), rest(other, other_kind)))
    both_light = np.maximum(n, other) <= light
    subset = (kind == SUBSET) | (other_kind == SUBSET)
    need[subset] = 0
    out = (100 * n < percent * other) | (100 * other < percent * n) | (kind == LOWER) & (other_kind == LOWER) | both_light & ~subset
    need[out] = -1
    return need


def meetings(posted: DataFrame, light: int, percent: int, long_list: int) -> DataFrame:
    """Who meets on a list: pairs (u, v, need) with u < v, one row per list, and for longer lists (member, head, null).

    Lists come out of the window one after the other; a task holds no more than one batch
    of them and the beginning of a list.
    """
    starts = bands(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(u: np.ndarray, v: np.ndarray, need: np.ndarray | None) -> pa.RecordBatch:
            count = pa.nulls(len(u), pa.int32()) if need is None else pa.array(need.astype(np.int32))
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v), count], names=["u", "v", "need"])

        def tied(cls: np.ndarray, head: int) -> pa.RecordBatch:
            return out(cls, np.full(len(cls), head, np.int64), None)

        def met(key: np.ndarray, cls: np.ndarray, n: np.ndarray, kind: np.ndarray) -> Iterator[pa.RecordBatch]:
            """Of whole lists."""
            first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
            size = np.diff(np.append(first, len(key)))
            within = np.repeat(size, size)
            head = np.repeat(first, size)
            far = (within > long_list) & (kind[head] != LOWER)
            if far.any():
                yield out(cls[far], cls[head[far]], None)
            left = within - (np.arange(len(key)) - head) - 1  # members that follow
            at = np.flatnonzero((within <= long_list) & (kind != LOWER) & (left > 0))
            for d in range(1, long_list):
                at = at[left[at] >= d]
                if not len(at):
                    break
                need = lists_needed(n[at], kind[at], n[at + d], kind[at + d], light, percent, starts)
                good = need >= 0
                a, b = cls[at[good]], cls[at[good] + d]
                yield out(np.minimum(a, b), np.maximum(a, b), need[good])

        held = [np.empty(0, t) for t in (np.int64, np.int64, np.int64, np.int8)]
        running: tuple[int, int, int] | None = None  # key, head and its kind of a long list that goes on
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = [np.concatenate([h, batch.column(c).to_numpy().astype(h.dtype)]) for h, c in zip(held, ("key", "cls", "n", "kind"), strict=True)]
            key, cls = rows[0], rows[1]
            keep = np.append(True, (key[1:] != key[:-1]) | (cls[1:] != cls[:-1]))  # several tasks may post a class
            rows = [r[keep] for r in rows]
            if running:
                more = int(np.argmax(np.append(rows[0] != running[0], True)))
                if more and running[2] != LOWER:
                    yield tied(rows[1][:more], running[1])
                rows = [r[more:] for r in rows]
                if not len(rows[0]):
                    held = rows
                    continue
                running = None
            last = int(np.append(0, np.flatnonzero(rows[0][1:] != rows[0][:-1]) + 1)[-1])
            held = [r[last:] for r in rows]
            if last:
                yield from met(*(r[:last] for r in rows))
            if len(held[0]) > long_list:
                running = (int(held[0][0]), int(held[1][0]), int(held[3][0]))
                if running[2] != LOWER:
                    yield tied(held[1], running[1])
                held = [h[:0] for h in held]
        if len(held[0]):
            yield from met(*held)

    of_key = Window.partitionBy("key").orderBy("kind", "cls")
    beside = posted.withColumn("before", F.lag("cls").over(of_key)).withColumn("after", F.lead("cls").over(of_key))
    beside = beside.filter("before <> cls OR after <> cls").select("key", "cls", "n", "kind")
    return beside.mapInArrow(run, "u long, v long, need int")


def candidates(met: DataFrame, crowds: DataFrame) -> DataFrame:
    """Pairs (u, v) that meet on lists enough, or on a subset, and are not of one crowd."""
    pairs = met.filter("need IS NOT NULL").groupBy("u", "v").agg(F.count_if(F.col("need") > 0).alias("lists"), F.min("need").alias("least"), F.max("need").alias("need"))
    pairs = pairs.filter("least = 0 OR lists >= need").select("u", "v")
    cu = crowds.select(F.col("cls").alias("u"), F.col("crowd").alias("cu"))
    cv = crowds.select(F.col("cls").alias("v"), F.col("crowd").alias("cv"))
    joined = pairs.join(cu, "u", "left").join(cv, "v", "left")
    return joined.filter(~F.coalesce(F.col("cu") == F.col("cv"), F.lit(False))).select("u", "v")


def wanted_bits(wanted: DataFrame) -> np.ndarray:
    """FILTER_BITS bits that tell which text hashes may be wanted; more texts only make it less sharp."""
    per_chunk = CHUNK * 8

    def fill(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(per_chunk, dtype=bool)
        for batch in batches:
            bits[batch.column("bit").to_numpy() % per_chunk] = True
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([np.packbits(bits).tobytes()], pa.binary())], names=["chunk", "bits"])

    bit = F.pmod("text_hash", F.lit(FILTER_BITS)).cast("int")
    places = wanted.select(bit.alias("bit")).distinct().withColumn("chunk", F.floor(F.col("bit") / per_chunk).cast("int"))
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for row in places.groupBy("chunk").applyInArrow(fill, "chunk int, bits binary").collect():
        out[row["chunk"] * CHUNK : (row["chunk"] + 1) * CHUNK] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out


def sets_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(cls, n, shingles) of the wanted classes (cls, text_hash), one document's text for each.

    A filter of fixed size keeps most other texts out of the shuffle; the join decides.
    """
    bits = wanted_bits(wanted)

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = batch.column("t").to_numpy() % FILTER_BITS
            yield batch.filter(pa.array((bits[bit // 8] >> (7 - bit % 8).astype(np.uint8)) & 1 == 1))
            pa.default_memory_pool().release_unused()

    texts = docs.select(F.xxhash64("text").alias("t"), F.col("text").cast("string"))
    texts = texts.mapInArrow(sift, texts.schema).groupBy("t").agg(F.first("text").alias("text"))
    texts = texts.join(wanted.select(F.col("text_hash").alias("t"), F.col("cls").alias("wanted")), "t").select("text", "wanted")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                sets = shingle_sets(part.column("text"), length)
                columns = [
                    part.column("wanted"), pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["cls", "n", "shingles"])

    return texts.mapInArrow(run, "cls long, n long, shingles array<long>")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (u, v) whose whole sets reach the similarity."""
    left = sets.select(F.col("cls").alias("u"), F.col("n").alias("nu"), F.col("shingles").alias("su"))
    right = sets.select(F.col("cls").alias("v"), F.col("n").alias("nv"), F.col("shingles").alias("sv"))
    both = F.size(F.array_intersect("su", "sv"))
    joined = pairs.select("u", "v").join(left, "u").join(right, "v")
    return joined.filter(100 * both >= percent * (F.col("nu") + F.col("nv") - both)).select("u", "v")


def crowd_links(members: DataFrame, sets: DataFrame, percent: int, block: int = BLOCK) -> DataFrame:
    """Links inside crowds (cls, crowd), as a forest, without listing pairs.

    Members are dealt into blocks, and a task compares two blocks of one crowd by inverted
    lists. Only links that join two parts are returned.
    """
    sizes = members.groupBy("crowd").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    own = sets.join(members.join(sizes, "crowd"), "cls").withColumn("own", F.pmod(F.xxhash64("cls"), F.col("blocks")).cast("int"))
    dealt = own.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("crowd", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "cls", "n", "shingles")

    def tile(table: pa.Table) -> pa.Table:
        links = forest(table, percent)
        return pa.table({"u": pa.array([a for a, _ in links], pa.int64()), "v": pa.array([b for _, b in links], pa.int64())})

    return dealt.groupBy("crowd", "a", "b").applyInArrow(tile, "u long, v long")


def forest(table: pa.Table, percent: int) -> list[tuple[int, int]]:
    """Links of one tile that join two parts.

    A shingle that most members have is listed by those that lack it, so lists are short
    among near copies too: two sets share all such shingles, less what one or the other
    lacks, plus what both lack, plus the other shingles both have.
    """
    cls, n = table.column("cls").to_numpy(), table.column("n").to_numpy()
    held = table.column("shingles").combine_chunks()
    rows = np.repeat(np.arange(len(n)), np.diff(held.offsets.to_numpy()))
    _, token = np.unique(held.flatten().to_numpy(), return_inverse=True)
    usual = np.flatnonzero(np.bincount(token) * 2 > len(n))
    is_usual = np.zeros(token.max() + 1 if len(token) else 0, dtype=bool)
    is_usual[usual] = True
    place = np.cumsum(is_usual) - 1
    lacks = np.ones((len(n), len(usual)), dtype=bool)
    of_usual = is_usual[token]
    lacks[rows[of_usual], place[token[of_usual]]] = False
    lacking, missed = np.nonzero(lacks)
    n_lacks = lacks.sum(axis=1)
    rows, token = np.concatenate([rows[~of_usual], lacking]), np.concatenate([token[~of_usual], usual[missed]])
    by_token = np.argsort(token, kind="stable")
    start = np.searchsorted(token[by_token], np.arange(len(is_usual) + 1))
    lists, length = rows[by_token], np.diff(start)
    mine = length[token] > 1  # a list of one tells nothing about pairs
    rows, token = rows[mine], token[mine]
    by_row = np.argsort(rows, kind="stable")
    at = np.searchsorted(rows[by_row], np.arange(len(n) + 1))
    part, links = np.arange(len(n)), []
    for i in range(len(n)):
        found = [lists[start[t] : start[t + 1]] for t in token[by_row[at[i] : at[i + 1]]].tolist()]
        common = np.bincount(np.concatenate(found), minlength=len(n)) if found else np.zeros(len(n), int)
        both = len(usual) - n_lacks[i] - n_lacks + common
        near = np.flatnonzero((100 * both >= percent * (n[i] + n - both)) & (part != part[i]))
        for j in near.tolist():
            if part[j] != part[i]:
                links.append((int(cls[i]), int(cls[j])))
                part[part == part[j]] = part[i]
    return links


def join(docs: DataFrame, length: int = SHINGLE, percent: int = PERCENT, long_list: int = LONG_LIST, block: int = BLOCK) -> DataFrame:
    """Documents with linked shingle sets: (doc_id, n_shingles, cls, component_id), one row per row.

    Two sets are linked when 100 * shared >= percent * united; equal sets are one class and
    linked. ``component_id`` is the smallest non-null id reachable. A null or empty text has
    no shingles and is its own component. Null ids are allowed (their component may be
    null), repeated rows are kept, an empty table gives no rows, and only ``doc_id`` and
    ``text`` are read. Shingles are compared by 64-bit hashes.

    Lists are kept by band of set sizes. Those longer than ``long_list`` do not give pairs:
    their members form a crowd, whose links `crowd_links` finds block by block. All other
    lists give candidate pairs; those that share enough of their lists are checked on the
    whole sets.
    """
    scanned = store(scan(docs, length), "jaccard")
    documents = scanned.filter("chunk IS NULL").select("doc_id", "n", "cls", "text_hash")
    classes = documents.filter("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("first_id"), F.min("text_hash").alias("text_hash"))
    sizes = [(r["n"], r["c"]) for r in classes.groupBy("n").agg(F.count(F.lit(1)).alias("c")).collect()]  # one row per set size
    light = boundary(sizes, percent)
    posted = keys(docs, rarity(scanned), light, length, percent)
    met = store(meetings(posted, light, percent, long_list), "jaccard", release=True)
    crowds = store(
        components(met.filter("need IS NULL").select("u", "v"))
        .select(F.col("node").alias("cls"), F.col("component").alias("crowd")), "jaccard",
    )
    pairs = store(candidates(met, crowds), "jaccard", release=True)
    involved = pairs.select(F.col("u").alias("cls")).union(pairs.select("v")).union(crowds.select("cls")).distinct()
    wanted = store(classes.join(involved, "cls").select("cls", "text_hash"), "jaccard")
    sets = store(sets_of(docs, wanted, length), "jaccard", release=True)
    links = verified(pairs, sets, percent).union(crowd_links(crowds, sets, percent, block))
    parts = components(store(links, "jaccard", release=True))
    grouped = classes.join(parts, classes["cls"] == parts["node"], "left")
    grouped = grouped.select(F.col("cls").alias("c"), F.col("n").alias("size"), F.coalesce("component", "cls").alias("part"), "first_id")
    ids = grouped.groupBy("part").agg(F.min("first_id").alias("component_id"))
    of_class = grouped.join(ids, "part").select("c", "size", "part", "component_id")
    joined = documents.join(of_class, (F.col("cls") == F.col("c")) & (F.col("n") == F.col("size")), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("part", "cls").alias("part"), "text_hash", component.alias("component_id"))
