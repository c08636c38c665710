"""SimHash near-dedup: fingerprints joined with themselves by walking a binary trie in pairs of nodes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, store, words
from strata.llm.components import components

SHINGLE = 3
BUDGET = 3
QUARTERS = BUDGET + 1
SEED = 42
BITS = 64
STEP = 1 << 16
GROUP_ROWS = 1 << 15
FRONTIER = 1 << 18


def majority(hashes: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Per text the bits that over half of its hashes have; ``first`` and ``count`` say where a text's hashes are.

    Bits are counted STEP hashes at a time, so a text of any length takes the same room.
    """
    ones = np.zeros((len(first), BITS), dtype=np.int64)
    of = np.repeat(np.arange(len(first)), count)
    for a in range(0, len(hashes), STEP):
        text = of[a : a + STEP]
        begins = np.flatnonzero(np.diff(text, prepend=-1))
        bits = np.unpackbits(hashes[a : a + STEP].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones[text[begins]] += np.add.reduceat(bits, begins, axis=0, dtype=np.int32)
    packed = np.packbits(2 * ones > count[:, None], axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).reshape(-1)


def text_fingerprints(texts: pa.Array, length: int = SHINGLE) -> np.ndarray:
    """Fingerprint of each text over its shingles, repeats included; a text without words has 0."""
    import xxhash

    split = words(texts, lower=True, hashes=False)
    joined, start, end = split.joined()
    count = np.diff(split.of)
    last = np.minimum(length, count) - 1  # a shorter text is one shingle
    shingles = np.maximum(count - length, 0) + (count > 0)
    first = np.concatenate(([0], np.cumsum(shingles)[:-1])) if len(count) else np.empty(0, np.int64)
    word = np.repeat(split.of[:-1] - first, shingles) + np.arange(int(shingles.sum()))
    bounds = zip(start[word].tolist(), end[word + np.repeat(last, shingles)].tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in bounds), dtype=np.uint64, count=len(word))
    return majority(hashes, first, shingles)


def fingerprints(docs: DataFrame, length: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every row; the fingerprint's 64 bits are those of a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                fp = text_fingerprints(part.column("text"), length).view(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, "doc_id long, fp long")


def quarters(mask: int, parts: int) -> list[int]:
    """The bits outside ``mask`` cut into ``parts`` masks."""
    free = [b for b in range(BITS) if not mask >> b & 1]
    bounds = [round(i * len(free) / parts) for i in range(parts + 1)]
    return [sum(1 << b for b in free[a:z]) for a, z in zip(bounds[:-1], bounds[1:], strict=True) if a < z]


def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(fp, mask, held): each fingerprint once for every quarter of the bits outside its ``mask``."""
    for batch in batches:
        fp, mask = (batch.column(c).to_numpy() for c in ("fp", "mask"))
        out = []
        for known in np.unique(mask).tolist():
            own = fp[mask == known]
            for quarter in quarters(known & (1 << BITS) - 1, QUARTERS):
                wider = np.full(len(own), quarter, dtype=np.uint64).view(np.int64) | known
                out.append(np.stack([own, wider, own & wider]))
        columns = np.concatenate([np.empty((3, 0), np.int64), *out], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["fp", "mask", "held"])


def subtrees(distinct: DataFrame, group_rows: int) -> DataFrame:
    """(fp, mask, held): the subtrees in which fingerprints meet, ``held`` being their bits in ``mask``.

    With one trie per quarter of the bits, which has the quarter's bits on its upper levels,
    a pair within the budget of three errors agrees in one whole quarter, so the upper levels
    need only pairs of equal nodes, and each of those is a group of rows. A group of over
    ``group_rows`` is cut again in the same way by its other bits, however large it is:
    fingerprints are distinct, so the cuts end with the bits.
    """
    group_rows = max(group_rows, 1 << QUARTERS)  # what is cut has more free bits than errors
    rest, out = distinct.select("fp", F.lit(0).cast("long").alias("mask")), None
    while True:
        dealt = store(rest.mapInArrow(deal, "fp long, mask long, held long"), "simhash")
        sizes = dealt.groupBy("mask", "held").agg(F.count(F.lit(1)).alias("members"))
        large = store(sizes.filter(F.col("members") > group_rows).select("mask", "held"), "simhash")
        if large.isEmpty():
            return dealt if out is None else out.unionAll(dealt)
        small = dealt.join(large, ["mask", "held"], "left_anti").select("fp", "mask", "held")
        out = small if out is None else out.unionAll(small)
        rest = dealt.join(large, ["mask", "held"], "left_semi").select("fp", "mask")


def near_pairs(fp: np.ndarray, first: np.ndarray, last: np.ndarray, budget: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places (i, j) of all pairs within the budget, inside each of the sorted runs ``first`` to ``last`` of ``fp``.

    Walks pairs of trie nodes from the root down. A node is a run of sorted fingerprints with
    equal upper bits; each level splits both nodes of a pair by the next bit, a pair of unlike
    children has one more differing bit, and a pair over the budget is dropped with all
    below it. The pairs to do are a stack of bounded blocks, deepest first.
    """
    todo = [(BITS, first, last, first, last, np.zeros(len(first), np.int8))]
    while todo:
        bit, a, b, c, d, differ = todo.pop()
        if len(a) > FRONTIER:
            todo += [(bit, *(x[i : i + FRONTIER] for x in (a, b, c, d, differ))) for i in range(0, len(a), FRONTIER)]
            continue
        same = a == c
        alone = (b - a == 1) & (d - c == 1)
        if alone.any():  # two single fingerprints: their bits tell
            i, j = a[alone & ~same], c[alone & ~same]
            near = np.bitwise_count(fp[i] ^ fp[j]) <= budget
            yield i[near], j[near]
        if bit == 0 or alone.all():
            continue
        a, b, c, d, differ, same = (x[~alone] for x in (a, b, c, d, differ, same))
        mark = np.uint64(1 << (bit - 1))
        middle, other = split(fp, a, b, mark), split(fp, c, d, mark)
        lower, upper = (a, middle, c, other, differ), (middle, b, other, d, differ)
        unlike, likewise = (a, middle, other, d, differ + 1), (middle[~same], b[~same], c[~same], other[~same], differ[~same] + 1)
        children = [np.concatenate(x) for x in zip(lower, upper, unlike, likewise, strict=True)]
        keep = (children[0] < children[1]) & (children[2] < children[3]) & (children[4] <= budget)
        if keep.any():
            todo.append((bit - 1, *(x[keep] for x in children)))


def split(fp: np.ndarray, a: np.ndarray, b: np.ndarray, mark: np.uint64) -> np.ndarray:
    """Where in each run ``a`` to ``b``, whose upper bits are equal, the ones at ``mark`` begin."""
    value = np.where(b > a, fp[np.minimum(a, len(fp) - 1)], np.uint64(0))
    bound = (value & ~(mark | (mark - np.uint64(1)))) | mark
    low, high = a.copy(), b.copy()
    while (open_ := np.flatnonzero(low < high)).size:
        middle = (low[open_] + high[open_]) // 2
        less = fp[middle] < bound[open_]
        low[open_[less]], high[open_[~less]] = middle[less] + 1, middle[~less]
    return low


def forest(n: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """For each of ``n`` places the smallest place linked with it by ``pairs``."""
    part = np.arange(n)

    def roots(x: np.ndarray) -> np.ndarray:
        while (part[x] != x).any():
            part[x] = part[part[x]]
            x = part[x]
        return x

    for i, j in pairs:
        while len(i):
            u, v = roots(i), roots(j)
            apart = u != v
            i, j, u, v = i[apart], j[apart], u[apart], v[apart]
            np.minimum.at(part, np.maximum(u, v), np.minimum(u, v))
    return roots(np.arange(n))


def links(groups: DataFrame) -> DataFrame:
    """(u, v): a forest over the linked fingerprints of every subtree (fp, mask, held).

    Rows arrive sorted, and whole groups are walked together, some GROUP_ROWS rows at a time.
    """

    def walk(rows: np.ndarray) -> pa.RecordBatch:
        mask, held, fp = rows
        edge = np.flatnonzero(np.concatenate(([True], (np.diff(mask) != 0) | (np.diff(held) != 0)))) if len(fp) else np.empty(0, np.int64)
        last = np.append(edge[1:], len(fp))
        some = last - edge > 1
        values = fp.view(np.uint64)
        part = forest(len(fp), near_pairs(values, edge[some], last[some], BUDGET))
        linked = np.flatnonzero(part != np.arange(len(fp)))
        return pa.RecordBatch.from_arrays([pa.array(fp[linked]), pa.array(fp[part[linked]])], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((3, 0), dtype=np.int64)
        for batch in batches:
            held = np.concatenate([held, np.stack([batch.column(c).to_numpy() for c in ("mask", "held", "fp")])], axis=1)
            if held.shape[1] >= GROUP_ROWS:
                same = (held[0] == held[0, -1]) & (held[1] == held[1, -1])
                whole = held.shape[1] - int(same.sum())  # the last group may go on
                if whole:
                    yield walk(held[:, :whole].copy())
                    held = held[:, whole:]
        yield walk(held.copy())

    # signed order differs from the trie's between groups only: a sign bit outside the mask is sorted last
    order = ["mask", "held", F.col("fp") < 0, "fp"]
    return groups.repartition("mask", "held").sortWithinPartitions(*order).mapInArrow(run, "u long, v long")


def near(docs: DataFrame, length: int = SHINGLE, group_rows: int = GROUP_ROWS) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per row: documents linked at BUDGET or fewer differing bits.

    The fingerprint is 16 hex digits. A null or empty text and one without words have the
    fingerprint zero, which is linked like any other. ``component_id`` is the smallest
    non-null id reachable and null where there is none. Repeated rows are kept; equal
    fingerprints are one class, however many rows have them. A long text is read whole. An
    empty table gives no rows. Only ``doc_id`` and ``text`` are read.
    """
    found = store(fingerprints(docs, length), "simhash")
    classes = store(found.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "simhash")
    parts = components(store(links(subtrees(classes, group_rows)), "simhash"))
    grouped = classes.join(parts, classes["fp"] == parts["node"], "left").select("fp", F.coalesce("component", "fp").alias("part"), "first_id")
    ids = grouped.groupBy("part").agg(F.min("first_id").alias("component_id"))
    of_class = grouped.join(ids, "part").select("fp", "component_id")
    fingerprint = F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint")
    return found.join(of_class, "fp").select("doc_id", fingerprint, "component_id")
