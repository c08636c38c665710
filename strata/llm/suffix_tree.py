"""Language-model scoring by a probabilistic suffix tree over words."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import mix, slices, store, words

PRIOR = 0.1
DEPTH = 3
LEAST_COUNT = 10
LEAST_GAIN = 0.01
GROUP_ROWS = 8192
GROUP_BYTES = 1 << 24
CROWDED = 1 << 21
SHARES = 8
END = np.uint64(0x9D2C5680A7C3E1B5)
LOW, HALF = np.uint64(0xFFFFFFFF), np.uint64(32)


class Learned(NamedTuple):
    """Per depth a DataFrame (ctx, suffix, total, followers, kept) of the tested contexts; (slice, bin, value) with the
    counts and numbers of each slice's words; the tokens and distinct tokens in all."""

    levels: list[DataFrame]
    vocabulary: DataFrame
    total: int
    distinct_tokens: int


class Text(NamedTuple):
    """Words of a slice, an end after each text, and where each text begins."""

    token: np.ndarray
    of: np.ndarray
    place: np.ndarray  # position of each token in its text


def read(part: pa.RecordBatch) -> Text:
    split = words(part.column("text"), lower=True)
    count = np.diff(split.of)
    token = np.full(len(split.hash) + len(count), END)
    token[np.arange(len(split.hash)) + np.repeat(np.arange(len(count)), count)] = split.hash
    of = split.of + np.arange(len(split.of))
    return Text(token, of, np.arange(len(token)) - np.repeat(of[:-1], count + 1))


def key_of(state: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Key of a context and the word before it, which make a longer context."""
    return mix(token.astype(np.uint64) + mix(state + np.uint64(1)))


def packed(values: np.ndarray) -> bytes:
    """Values as compressed bytes, the first bytes of all before the second ones."""
    split = np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T) if values.size else np.empty(0, np.uint8)
    return len(values).to_bytes(8, "little") + (pa.compress(split.tobytes(), "zstd", asbytes=True) if values.size else b"")


def unpacked(data: bytes, dtype: type) -> np.ndarray:
    n, size = int.from_bytes(data[:8], "little"), np.dtype(dtype).itemsize
    if not n:
        return np.empty(0, dtype)
    split = np.frombuffer(pa.decompress(data[8:], n * size, "zstd"), np.uint8).reshape(size, n)
    return np.ascontiguousarray(split.T).view(dtype).ravel()


def batch_of(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


SLICE = pa.schema([("slice", pa.int64()), ("n", pa.int64()), *((c, pa.binary()) for c in ("word", "trained", "at", "hash", "size", "weight"))])
SLICE_DDL = "slice long, n long, word binary, trained binary, at binary, hash binary, size binary, weight binary"


def sliced(docs: DataFrame, training: Column, group_rows: int, group_bytes: int) -> DataFrame:
    """Texts as numbers of their slice's words, a row per slice of about ``group_bytes`` of text.

    Equal texts of a slice are one, weighted by its training rows. ``n`` is the number of
    training tokens. Of each word: its 64-bit hash and its training tokens; of each text:
    the hash that Spark gives it, its tokens with the end, and its weight.
    """

    def one(number: int, held: dict[int, int], parts: list[Text], weight: list[int]) -> pa.RecordBatch:
        token, size = np.concatenate([p.token for p in parts]), np.concatenate([np.diff(p.of) for p in parts])
        each = np.array(weight, dtype=np.uint32)
        word, at, n = np.unique(token, return_inverse=True, return_counts=True)
        order = np.argsort(-n, kind="stable")  # small numbers for frequent words
        rank = np.empty(len(word), dtype=np.uint32)
        rank[order] = np.arange(len(word))
        at = rank[at]
        trained = np.bincount(at, np.repeat(each, size), len(word))
        columns = {"word": word[order], "trained": trained, "at": at, "hash": np.array([*held], dtype=np.int64), "size": size.astype(np.uint32), "weight": each}
        return batch_of([{"slice": number, "n": int(trained.sum())} | {c: packed(x) for c, x in columns.items()}], SLICE)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: dict[int, int] = {}
        parts: list[Text] = []
        weight: list[int] = []
        rows = size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                for begin in range(0, part.num_rows, group_rows):
                    some = part.slice(begin, group_rows)
                    if rows and (rows + some.num_rows > group_rows or size + some.column("text").nbytes > group_bytes):
                        yield one(number, held, parts, weight)
                        number, held, parts, weight, rows, size = number + 1, {}, [], [], 0, 0
                    first = []
                    for i, (h, t) in enumerate(zip(some.column("hash").to_pylist(), some.column("training").to_pylist(), strict=True)):
                        place = held.setdefault(h, len(held))
                        if place == len(weight):
                            first.append(i)
                            weight.append(0)
                        weight[place] += t
                    if first:
                        parts.append(read(some.take(pa.array(first))))
                    rows, size = rows + some.num_rows, size + some.column("text").nbytes
        if parts:
            yield one(number, held, parts, weight)

    text = F.coalesce(docs["text"].cast("string"), F.lit(""))
    rows = docs.select(text.alias("text"), F.xxhash64(text).alias("hash"), F.coalesce(training, F.lit(False)).cast("int").alias("training"))
    return rows.mapInArrow(run, SLICE_DDL)


ASKED = pa.schema([("part", pa.int64()), ("bin", pa.int32()), ("key", pa.binary()), ("value", pa.binary())])
ASKED_DDL = "part long, bin int, key binary, value binary"


def asking(part: int, key: np.ndarray, value: np.ndarray, bins: int) -> pa.RecordBatch:
    """Rows of ``summed`` for keys and their values, (keys, n) doubles."""
    to = mix(key) % np.uint64(bins)
    order = np.argsort(to, kind="stable")
    bounds = np.searchsorted(to[order], np.arange(bins + 1, dtype=np.uint64))
    held = [(b, order[x:y]) for b, (x, y) in enumerate(zip(bounds[:-1], bounds[1:], strict=True)) if y > x]
    return batch_of([{"part": part, "bin": b, "key": packed(key[at]), "value": packed(value[at].ravel())} for b, at in held], ASKED)


def summed(asked: DataFrame, width: int, bins: int, least: float = 0.0, crowded: int | None = None) -> DataFrame:
    """To every (part, bin, key, value) the sums of its keys' values over all parts.

    Keys whose first sum is under ``least`` are left out. With ``crowded``, none is and the
    keys are not sent back: each has its first sum, its second one in SHARES of
    ``crowded``, and its number, small if the first sum is large. A bin's row without part
    then has the number of first sums above zero as ``n`` and the largest share as ``most``.
    """
    schema = pa.schema([*ASKED, ("n", pa.int64()), ("most", pa.int64())])

    def run(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [r for batch in batches for r in batch.to_pylist()]
        keys = [unpacked(r["key"], np.uint64) for r in rows]
        key, at = np.unique(np.concatenate(keys), return_inverse=True)
        values = np.concatenate([unpacked(r["value"], np.float64).reshape(-1, width) for r in rows])
        sums = np.stack([np.bincount(at, v, len(key)) for v in values.T], axis=1)
        bin_ = group[0].as_py()
        if crowded:
            number = np.empty(len(key))
            number[np.argsort(-sums[:, 0], kind="stable")] = np.arange(len(key), dtype=float) * bins + bin_ + 1
            if len(number) and number.max() > float(LOW):
                raise OverflowError("more than 2^32 distinct words")
            sums = np.stack([sums[:, 0], np.ceil(sums[:, 1] * SHARES / crowded), number], axis=1)
            yield batch_of([{"bin": bin_, "n": int((sums[:, 0] > 0).sum()), "most": int(sums[:, 1].max())}], schema)
        first = 0
        for r, asked in zip(rows, keys, strict=True):
            mine, first = sums[at[first : first + len(asked)]], first + len(asked)
            held = mine[:, 0] >= least
            sent = (None, mine) if crowded else (packed(asked[held]), mine[held])
            yield batch_of([{"part": r["part"], "bin": bin_, "key": sent[0], "value": packed(sent[1].ravel())}], schema)

    return asked.groupBy("bin").applyInArrow(run, f"{ASKED_DDL}, n long, most long")


def asked_words(row: dict, bins: int) -> pa.RecordBatch:
    """The words of a slice with their training tokens and their places in its distinct texts."""
    at = unpacked(row["at"], np.uint32)
    word, trained = unpacked(row["word"], np.uint64), unpacked(row["trained"], np.float64)
    return asking(row["slice"], word, np.stack([trained, np.bincount(at, minlength=len(word))], axis=1), bins)


WORD = {"count": np.float64, "number": np.uint32, "crowd": np.uint32}
TEXT = {"hash": np.int64, "size": np.uint32, "known": np.uint32, "base": np.float64}
RESOLVED = pa.schema([("slice", pa.int64()), *((c, pa.binary()) for c in ("at", "weight", *WORD, *TEXT))])
RESOLVED_DDL = ", ".join(["slice long", *(f"{c} binary" for c in ("at", "weight", *WORD, *TEXT))])


def resolved(row: dict, told: dict[int, np.ndarray], bins: int, chance: Callable) -> dict:
    """A slice whose words have their counts, numbers and parts in the corpus; its texts have their sums of single tokens."""
    word = unpacked(row["word"], np.uint64)
    value = np.empty((len(word), 3))
    value[np.argsort(mix(word) % np.uint64(bins), kind="stable")] = np.concatenate([told[b] for b in sorted(told)])
    at, size = unpacked(row["at"], np.uint32), unpacked(row["size"], np.uint32)
    begin = np.cumsum(size, dtype=np.int64) - size
    known = np.add.reduceat((value[:, 0] > 0).astype(np.uint32)[at], begin)
    base = np.add.reduceat(np.log10(chance(value[:, 0]))[at], begin)
    columns = {"count": value[:, 0].copy(), "number": value[:, 2].astype(np.uint32), "crowd": value[:, 1].astype(np.uint32), "known": known.astype(np.uint32), "base": base}
    return {c: row[c] for c in ("slice", "at", "weight", "hash", "size")} | {c: packed(x) for c, x in columns.items()}


COLUMNS = {"w": np.uint32, "w1": np.uint32, "w2": np.uint32, "w3": np.uint32, "weight": np.uint32, "text": np.uint32, "count": np.float64}
PLACED = pa.schema([("part", pa.int64()), ("slice", pa.int64()), *((c, pa.binary()) for c in COLUMNS)])
PLACED_DDL = ", ".join(["part long", "slice long", *(f"{c} binary" for c in COLUMNS)])


def placed(row: dict, parts: int, depth: int, least: float, crowded_only: bool) -> Iterator[dict]:
    """The places of a slice by the word before them, a row per part.

    A place has its word and the words before it as numbers (0: none, or too rare to be
    in a context). A word with more than a share of places has a part of its own, numbered
    below zero; a crowded one is dealt over several by what follows it. ``crowded_only`` gives the places of those, without texts and equal
    ones as one; a part needs the sums of contexts that only other parts have learned.
    """
    at, size, weight = (unpacked(row[c], np.uint32) for c in ("at", "size", "weight"))
    count, number, crowd = (unpacked(row[c], t) for c, t in WORD.items())
    text = np.repeat(np.arange(len(size), dtype=np.uint32), size)
    place = np.arange(len(at), dtype=np.uint32) - np.repeat(np.cumsum(size, dtype=np.uint32) - size, size)
    frequent = np.where(count >= least, number, 0).astype(np.uint32)
    fits = place >= 1
    fits[1:] &= ((frequent > 0) & (crowd > SHARES) if crowded_only else frequent > 0)[at[:-1]]
    first = np.flatnonzero(fits)
    if not len(first):
        return
    place, text, last = place[first], text[first], at[first - 1]
    before = [frequent[last]]
    for d in (2, 3):
        there = (place >= d) & (before[-1] > 0) & (d <= depth)
        before.append(np.where(there, frequent[at[np.maximum(first - d, 0)]], 0).astype(np.uint32))
    at = at[first]
    del place, first, fits
    w, weight = number[at], weight[text]
    if crowded_only:
        low, high = before[2].astype(np.uint64) << HALF | w, before[0].astype(np.uint64) << HALF | before[1]
        order = np.lexsort((low, high))
        new = np.flatnonzero((np.diff(low[order], prepend=~low[order[:1]]) != 0) | (np.diff(high[order], prepend=high[order[:1]]) != 0))
        weight = np.add.reduceat(weight[order], new, dtype=np.uint32)
        order = order[new]
        at, w, last, text, before = at[order], w[order], last[order], np.zeros(len(order), np.uint32), [b[order] for b in before]
    own = -1 - (number.astype(np.int64) << 30)
    part = np.where(crowd > 1, own, (mix(number.astype(np.uint64)) % np.uint64(parts)).astype(np.int64))[last]
    dealt = np.flatnonzero((crowd > SHARES)[last])
    part[dealt] -= (mix(w[dealt].astype(np.uint64)) % (-(-crowd[last[dealt]].astype(np.int64) // SHARES)).astype(np.uint64)).astype(np.int64)
    order = np.argsort(before[0], kind="stable")  # compresses better
    order = order[np.argsort(part[order], kind="stable")]
    bounds = np.concatenate(([0], np.flatnonzero(np.diff(part[order])) + 1, [len(order)]))
    for x, y in zip(bounds[:-1], bounds[1:], strict=True):
        mine = order[x:y]
        kinds, some = np.unique(w[mine], return_index=True)
        columns = (w[mine], *(b[mine] for b in before), weight[mine], np.diff(text[mine], prepend=np.uint32(0)), count[at[mine[some]]])
        yield {"part": int(part[mine[0]]), "slice": row["slice"]} | {c: packed(v) for c, v in zip(COLUMNS, columns, strict=True)}


def places(slices_: DataFrame, **how: object) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                (row,) = batch.slice(i, 1).to_pylist()
                yield batch_of([*placed(row, **how)], PLACED)

    return slices_.select("slice", "at", "size", "weight", *WORD).mapInArrow(run, PLACED_DDL)


class Rows(NamedTuple):
    """Places of a part: their word and the words before, training rows, chance of the word alone; the texts of each slice."""

    w: np.ndarray
    before: list[np.ndarray]
    weight: np.ndarray
    p: np.ndarray
    text: list[tuple[int, np.ndarray]]


def gathered(found: pa.Table | list[pa.RecordBatch], depth: int, chance: Callable) -> Rows:
    held: dict[str, list] = {c: [np.empty(0, t)] for c, t in COLUMNS.items()}
    p, text = [np.empty(0)], []
    for batch in found.to_batches() if isinstance(found, pa.Table) else found:
        for i in range(batch.num_rows):
            (r,) = batch.slice(i, 1).to_pylist()
            mine = {c: unpacked(r[c], t) for c, t in COLUMNS.items()}
            _, at = np.unique(mine["w"], return_inverse=True)
            p.append(chance(mine["count"])[at])
            text.append((r["slice"], np.cumsum(mine["text"], dtype=np.uint32)))
            for c in ("w", "w1", "w2", "w3", "weight"):
                held[c].append(mine[c])
    columns = {c: np.concatenate(held.pop(c)) for c in ("w", "w1", "w2", "w3", "weight")}
    return Rows(columns["w"], [columns[f"w{d}"] for d in range(1, depth + 1)], columns["weight"], np.concatenate(p), text)


def extended(ctx: np.ndarray, before: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Contexts longer by the word before: the shorter one of each, the number of each place's one, their keys."""
    found, at = np.unique(ctx.astype(np.uint64) << HALF | before, return_inverse=True)
    up = (found >> HALF).astype(np.int64)
    return up, at, key_of(key[up], found & LOW)


def followers(ctx: np.ndarray, w: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each place's pair of context and word; of the pairs the context and the training count."""
    pairs, pair = np.unique(ctx.astype(np.uint64) << HALF | w, return_inverse=True)
    return pair, (pairs >> HALF).astype(np.int64), np.bincount(pair, weight, len(pairs))


def shapes(rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Keys of all contexts of a part, with their occurrences and distinct followers in it."""
    at, ctx, key = np.arange(len(rows.w)), np.zeros(len(rows.w), np.int64), np.zeros(1, np.uint64)
    keys, values = [np.empty(0, np.uint64)], [np.empty((0, 2))]
    for before in rows.before:
        held = before[at] > 0
        at, ctx = at[held], ctx[held]
        _, ctx, key = extended(ctx, before[at], key)
        _, of, c = followers(ctx, rows.w[at], rows.weight[at])
        keys.append(key)
        values.append(np.stack([np.bincount(of, c, len(key)), np.bincount(of, c > 0, len(key))], axis=1))
    return np.concatenate(keys), np.concatenate(values)


class Told(NamedTuple):
    """Sums over all parts by key."""

    key: np.ndarray
    value: np.ndarray

    def of(self, key: np.ndarray) -> np.ndarray:
        """The values of each key, zeros for one that is not there."""
        if not len(self.key):
            return np.zeros((len(key), self.value.shape[1]))
        at = np.minimum(np.searchsorted(self.key, key), len(self.key) - 1)
        return np.where((self.key[at] == key)[:, None], self.value[at], 0)


def told_by(rows: list[dict], width: int) -> Told:
    key = np.concatenate([np.empty(0, np.uint64), *(unpacked(r["key"], np.uint64) for r in rows)])
    value = np.concatenate([np.empty((0, width)), *(unpacked(r["value"], np.float64).reshape(-1, width) for r in rows)])
    order = np.argsort(key)
    return Told(key[order], value[order])


class Level(NamedTuple):
    key: np.ndarray
    suffix: np.ndarray
    n: np.ndarray
    t: np.ndarray
    kept: np.ndarray
    gains: np.ndarray  # (contexts, cases)


def climbed(rows: Rows, least: float, least_gain: float, shape: Told | None = None, gains: Told | None = None) -> tuple[list[Level], np.ndarray]:
    """The candidates of a part by depth, and the chance of each place's word by the retained ones.

    Every context seen ``least`` times is a candidate. It is retained if its own counts,
    each left out in turn, predict what follows better than its parent by ``least_gain``
    nats per occurrence. Its distribution is (c + t * parent) / (n + t), with n occurrences
    and t distinct followers, so it adds up to one.

    A part holds whole contexts, so it needs nothing else, or some followers of a crowded
    word, whose sums over all its parts are ``shape`` (n, t) and ``gains``. Which of the
    shorter contexts are retained is open while ``gains`` is not there, so a gain is
    then given for each case.
    """
    at, ctx, key, case = np.arange(len(rows.w)), np.zeros(len(rows.w), np.int64), np.zeros(1, np.uint64), np.zeros(1, np.int64)
    open_ = shape is not None and gains is None
    p, out, levels = [rows.p], rows.p.copy(), []
    for before in rows.before:
        held = before[at] > 0
        at, ctx, p, suffix = at[held], ctx[held], [x[held] for x in p], key
        up, ctx, key = extended(ctx, before[at], key)
        sums = shape.of(key) if shape else None
        n = sums[:, 0] if shape else np.bincount(ctx, rows.weight[at], len(key))
        held = n[ctx] >= least
        at, ctx, p = at[held], ctx[held], [x[held] for x in p]
        pair, of, c = followers(ctx, rows.w[at], rows.weight[at])
        t = sums[:, 1] if shape else np.bincount(of, c > 0, len(key)).astype(float)
        seen = np.flatnonzero(c > 0)
        of, some = of[seen], c[seen]
        case = case[up]
        gain = np.zeros((len(key), len(p)))
        for i, x in enumerate(p):
            if gains is None:
                above = np.empty(len(c))
                above[pair] = x
                above = above[seen]
                gain[:, i] = np.bincount(of, some * np.log((some - 1 + t[of] * above) / ((n[of] - 1 + t[of]) * above)), len(key))
        mine = gains.of(key)[np.arange(len(key)), 1 + case] if gains else gain[:, 0]
        kept = (n >= least) & (mine > least_gain * n)
        own = [(c[pair] + t[ctx] * x) / (n[ctx] + t[ctx]) for x in p]
        if open_:
            p = [*p, *own]
        else:
            p = [np.where(kept[ctx], own[0], p[0])]
            out[at] = p[0]
        case = case + kept * (1 << len(levels))
        levels.append(Level(key, suffix[up], n, t, kept, gain))
    return levels, out


GAIN = pa.schema([("slice", pa.int64()), ("text", pa.binary()), ("gain", pa.binary())])
GAIN_DDL = "slice long, text binary, gain binary"
LEVEL = pa.schema([("depth", pa.int32()), ("ctx", pa.int64()), ("suffix", pa.int64()), ("total", pa.int64()), ("followers", pa.int64()), ("kept", pa.bool_())])
LEVEL_DDL = "depth int, ctx long, suffix long, total long, followers long, kept boolean"


def given_levels(rows: Rows, levels: list[Level], p: np.ndarray, least: float) -> Iterator[pa.Table]:
    for d, level in enumerate(levels, start=1):
        at = np.flatnonzero(level.n >= least)
        columns = (np.full(len(at), d, np.int32), level.key[at].view(np.int64), level.suffix[at].view(np.int64), level.n[at].astype(np.int64), level.t[at].astype(np.int64), level.kept[at])
        yield pa.table([pa.array(x) for x in columns], schema=LEVEL)


def given_gains(rows: Rows, levels: list[Level], p: np.ndarray, least: float) -> Iterator[pa.Table]:
    """By slice and text what the contexts add to the logarithm of the text's chance."""
    gain, first = np.log10(p / rows.p), 0
    for number, text in rows.text:
        mine, first = gain[first : first + len(text)], first + len(text)
        sums = np.bincount(text, mine)
        at = np.flatnonzero(sums)
        yield pa.Table.from_pylist([{"slice": number, "text": packed(at.astype(np.uint32)), "gain": packed(sums[at])}], GAIN)


SCORED_DDL = "hash long, n_tokens long, n_known long, base double, gain double"


def of_texts(base: pa.Table, gains: pa.Table) -> pa.Table:
    """The sums of a slice's texts."""
    (row,) = base.to_pylist()
    columns = {c: unpacked(row[c], t) for c, t in TEXT.items()}
    gain = np.zeros(len(columns["hash"]))
    for r in gains.to_pylist():
        gain[unpacked(r["text"], np.uint32)] += unpacked(r["gain"], np.float64)
    return pa.table({"hash": columns["hash"], "n_tokens": columns["size"].astype(np.int64), "n_known": columns["known"].astype(np.int64), "base": columns["base"], "gain": gain})


class Corpus(NamedTuple):
    """The resolved slices, what they were told of their words, and how their places are dealt and tested."""

    slices: DataFrame
    vocabulary: DataFrame
    total: int
    distinct_tokens: int
    chance: Callable
    hot: bool  # some word is crowded
    how: dict


def corpus(docs: DataFrame, training: Column, depth: int, least_count: int, least_share: float, group_rows: int, group_bytes: int, crowded: int) -> Corpus:
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col("text").cast("string"))), F.lit(0))).first()
    parts = max(1, -(-rows // group_rows), -(-5 * size // (4 * group_bytes)))
    bins = max(1, -(-parts // 6))
    stored = store(sliced(docs, training, group_rows, group_bytes), "suffix-tree")

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield asked_words(batch.slice(i, 1).to_pylist()[0], bins)

    asked = stored.select("slice", "word", "trained", "at").mapInArrow(ask, ASKED_DDL)
    vocabulary = store(summed(asked, 2, bins, crowded=crowded), "suffix-tree", release=True)
    total = stored.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    distinct_tokens, most = vocabulary.filter("part IS NULL").agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.max("most"), F.lit(0))).first()
    whole = total + PRIOR * (distinct_tokens + 1)

    def chance(count: np.ndarray) -> np.ndarray:
        return (count + PRIOR) / whole if total else np.ones(len(count))

    def resolve(row: pa.Table, told: pa.Table) -> pa.Table:
        values = {r["bin"]: unpacked(r["value"], np.float64).reshape(-1, 3) for r in told.to_pylist()}
        return pa.Table.from_pylist([resolved(r, values, bins, chance) for r in row.to_pylist()], RESOLVED)

    told = vocabulary.filter("part IS NOT NULL").select(F.col("part").alias("of"), "bin", "value")
    found = stored.drop("n", "trained").groupBy("slice").cogroup(told.groupBy("of")).applyInArrow(resolve, RESOLVED_DDL)
    how = {"parts": parts, "depth": depth, "least": max(2, least_count, math.ceil(least_share * total))}
    return Corpus(store(found, "suffix-tree", release=True), vocabulary, int(total), int(distinct_tokens), chance, most > SHARES, how)


def over_parts(all_: Corpus, least_gain: float, give: Callable, schema: str) -> DataFrame:
    """What ``give`` makes of the rows, levels and chances of every part."""
    (depth, least, parts), chance = (all_.how[c] for c in ("depth", "least", "parts")), all_.chance
    every = places(all_.slices, crowded_only=False, **all_.how).groupBy("part")

    def whole(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = gathered([*batches], depth, chance)
        for t in give(rows, *climbed(rows, least, least_gain), least):
            yield from t.to_batches()

    if not all_.hot:
        return every.applyInArrow(whole, schema)
    crowd, cases = places(all_.slices, crowded_only=True, **all_.how).groupBy("part"), 1 << (depth - 1)

    def first(group: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield asking(group[0].as_py(), *shapes(gathered([*batches], depth, chance)), parts)

    def second(found: pa.Table, told: pa.Table) -> pa.Table:
        levels, _ = climbed(gathered(found, depth, chance), least, least_gain, told_by(told.to_pylist(), 2))
        at = [np.flatnonzero(x.n >= least) for x in levels]
        value = [np.pad(x.gains[a], ((0, 0), (1, cases - x.gains.shape[1]))) for x, a in zip(levels, at, strict=True)]
        return pa.Table.from_batches([asking(found.column("part")[0].as_py(), np.concatenate([x.key[a] for x, a in zip(levels, at, strict=True)]), np.concatenate(value), parts)], ASKED)

    def last(found: pa.Table, told: pa.Table) -> pa.Table:
        rows, told = gathered(found, depth, chance), told.to_pylist()
        sums = [told_by([r for r in told if r["n"] == n], width) for n, width in ((0, 2), (1, 1 + cases))] if told else []
        return pa.concat_tables([*give(rows, *climbed(rows, least, least_gain, *sums), least)])

    def of(told: DataFrame, n: int) -> DataFrame:
        return told.select(F.col("part").alias("of"), "key", "value", F.lit(n).alias("n"))

    shape = store(summed(crowd.applyInArrow(first, ASKED_DDL), 2, parts, least=least), "suffix-tree", release=True)
    asked = crowd.cogroup(of(shape, 0).groupBy("of")).applyInArrow(second, ASKED_DDL)
    gains = store(summed(asked, 1 + cases, parts), "suffix-tree", release=True)
    return every.cogroup(of(shape, 0).unionAll(of(gains, 1)).groupBy("of")).applyInArrow(last, schema)


def learn(docs: DataFrame, depth: int, least_count: int, least_share: float, least_gain: float, crowded: int = CROWDED) -> Learned:
    """The contexts of the tree that ``score`` learns from all given texts.

    A context seen ``least_count`` times is tested (more often if ``least_share`` of all tokens is more).
    """
    all_ = corpus(docs, F.lit(True), depth, least_count, least_share, GROUP_ROWS, GROUP_BYTES, crowded)
    found = store(over_parts(all_, least_gain, given_levels, LEVEL_DDL).distinct(), "suffix-tree", release=True)
    levels = [found.filter(F.col("depth") == d).drop("depth") for d in range(1, depth + 1)]
    return Learned(levels, all_.vocabulary.select(F.col("part").alias("slice"), "bin", "value"), all_.total, all_.distinct_tokens)


def score(docs: DataFrame, training: Column, depth: int = DEPTH, least_share: float = 0.0, least_gain: float = LEAST_GAIN, group_rows: int = GROUP_ROWS, least_count: int = LEAST_COUNT, group_bytes: int = GROUP_BYTES, crowded: int = CROWDED) -> DataFrame:
    """Log10 probability of every whole text under a tree learned from the ``training`` rows.

    Returns doc_id, n_tokens, n_known (tokens seen in training), train_tokens, base_score
    (single tokens only) and score (longest retained contexts), one row per row. A null or
    empty text is its end token. Null ids and repeated rows are kept, an empty table gives
    no rows, and with nothing to learn from every token has the chance of an unknown one.
    Only ``doc_id`` and ``text`` are read besides ``training``. ``depth`` is 3 at most.

    Each text is split once, in slices of ``group_rows`` rows or ``group_bytes`` of text.
    Every place then goes to the part of the word before it, so a part holds whole
    subtrees: it counts, tests and applies their contexts, and gives sums by text. A word
    with more than ``crowded`` places is dealt over parts by what follows it; these
    exchange the sums of their contexts. Texts and words are compared by 64-bit hashes.
    """
    if not 1 <= depth <= 3:
        raise ValueError("depth must be 1, 2 or 3")
    all_ = corpus(docs, training, depth, least_count, least_share, group_rows, group_bytes, crowded)
    gains = over_parts(all_, least_gain, given_gains, GAIN_DDL).select(F.col("slice").alias("of"), "text", "gain")
    of_text = all_.slices.select("slice", *TEXT).groupBy("slice").cogroup(gains.groupBy("of")).applyInArrow(of_texts, SCORED_DDL)
    of_text = of_text.groupBy("hash").agg(*(F.min(c).alias(c) for c in ("n_tokens", "n_known", "base", "gain")))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), F.xxhash64(F.coalesce(docs["text"].cast("string"), F.lit(""))).alias("hash"))
    columns = ("doc_id", "n_tokens", "n_known", F.lit(all_.total).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), (F.col("base") + F.col("gain")).alias("score"))
    return rows.join(of_text, "hash").select(*columns)
