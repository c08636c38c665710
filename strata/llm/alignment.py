"""Cross-tokenizer alignment: two tokenizations of a text cut into groups where both have a token end."""

from __future__ import annotations

import base64
import functools
import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, store

CHUNK_BYTES = 1 << 24
SLICE_BYTES = 1 << 18
B_BITS = 15


class Tokenizers(NamedTuple):
    """Both tokenizers, the bytes of each id joined with where they begin, and the ids as text."""

    a: object
    b: object
    bytes_a: np.ndarray
    bytes_b: np.ndarray
    at_a: np.ndarray
    at_b: np.ndarray
    written: np.ndarray  # per id and sign: the id with ",", "|" or ";" after it


def joined(pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    return np.frombuffer(b"".join(pieces), dtype=np.uint8), np.concatenate(([0], np.cumsum([len(p) for p in pieces])))


@functools.cache
def tokenizers(ranks_path: str, pieces_path: str) -> Tokenizers:
    """The byte-level vocabulary from its ranks (the ids of its tokenizer file), the other from its model."""
    import public_tokenizers
    import sentencepiece
    import tiktoken

    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    a = tiktoken.Encoding("alignment", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    b = sentencepiece.SentencePieceProcessor(model_file=pieces_path)
    entries = [b""] * (max(ranks.values()) + 1)
    for piece, i in ranks.items():
        entries[i] = piece
    pieces = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in range(b.vocab_size())]
    if len(pieces) > 1 << B_BITS or len(entries) > 1 << (31 - B_BITS):
        raise ValueError("pairs of ids of these vocabularies do not fit 31 bits")
    written = np.array([f"{i}{sign}" for i in range(max(len(entries), len(pieces))) for sign in ",|;"], dtype=object)
    return Tokenizers(a, b, *(x for pair in zip(joined(entries), joined(pieces), strict=True) for x in pair), written)


def spelled(ids: np.ndarray, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a row of tokens, and where each token ends in them."""
    size = at[ids + 1] - at[ids]
    end = np.cumsum(size)
    return data[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(at[ids] - end + size, size)], end


def cuts(a_end: np.ndarray, b_end: np.ndarray, a_of: np.ndarray, b_of: np.ndarray) -> np.ndarray:
    """Tokens of a after which both tokenizations have an end, by divide and conquer, all texts at once.

    ``a_of`` and ``b_of`` bound each text's tokens; both begin and end together there. In each
    interval the end of a nearest its middle that b has too is located by bisecting b's ends,
    in windows that double as long as none is found; the interval is divided there and both halves are
    dealt with alike. An interval without a common end inside is one group.
    """
    some = np.diff(a_of) > 0
    low, high, b_low, b_high = a_of[:-1][some], a_of[1:][some], b_of[:-1][some], b_of[1:][some]
    found = [high - 1]
    while len(low):
        inside = (high - low > 1) & (b_high - b_low > 1)
        low, high, b_low, b_high = (x[inside] for x in (low, high, b_low, b_high))
        middle = (low + high - 2) // 2
        cut, place = np.full(len(low), -1), np.zeros(len(low), np.int64)
        pending, seen, width = np.arange(len(low)), 0, 1
        while len(pending):
            m, first, last = middle[pending], low[pending], high[pending] - 2
            probes, owner = [], []
            for begin, stop in ((np.maximum(first, m - width + 1), m - seen), (m + max(seen, 1), np.minimum(last, m + width - 1))):
                n = np.maximum(stop - begin + 1, 0)
                probes.append(np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n) + np.repeat(begin, n))
                owner.append(np.repeat(np.arange(len(pending)), n))
            probe, own = np.concatenate(probes), np.concatenate(owner)
            at = np.searchsorted(b_end, a_end[probe])
            hit = b_end[np.minimum(at, len(b_end) - 1)] == a_end[probe]
            probe, own, at = probe[hit], own[hit], at[hit]
            nearest = np.lexsort((probe, np.abs(probe - m[own]), own))
            owners, one = np.unique(own[nearest], return_index=True)
            cut[pending[owners]], place[pending[owners]] = probe[nearest][one], at[nearest][one]
            wider = (cut[pending] < 0) & ((m - width + 1 > first) | (m + width - 1 < last))
            pending, seen, width = pending[wider], width, 2 * width
        divided = cut >= 0
        low, high, b_low, b_high, cut, place = (x[divided] for x in (low, high, b_low, b_high, cut, place))
        found.append(cut)
        low, high = np.concatenate([low, cut + 1]), np.concatenate([cut + 1, high])
        b_low, b_high = np.concatenate([b_low, place + 1]), np.concatenate([place + 1, b_high])
    return np.sort(np.concatenate(found))


class Aligned(NamedTuple):
    """What alignment gives per text; ``codes`` are the linked id pairs, ``of`` bounds them per text."""

    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]
    codes: np.ndarray
    of: np.ndarray


def tokenized(texts: list[str | None], t: Tokenizers) -> list[tuple[np.ndarray, np.ndarray]]:
    """Ids of both tokenizers; none for a text that one of them does not spell again."""
    b_ids, out, none = t.b.encode([x or "" for x in texts], num_threads=1), [], (np.empty(0, np.int64),) * 2
    for text, b in zip(texts, b_ids, strict=True):
        if not text:
            out.append(none)
            continue
        a, b = np.array(t.a.encode_ordinary(" " + text), dtype=np.int64), np.array(b, dtype=np.int64)
        want = np.frombuffer((" " + text).encode(), dtype=np.uint8)
        same = all(np.array_equal(spelled(*x)[0], want) for x in ((a, t.bytes_a, t.at_a), (b, t.bytes_b, t.at_b)))
        out.append((a, b) if same else none)
    return out


def align(texts: list[str | None], t: Tokenizers) -> Aligned:
    """Groups and links of each text's two tokenizations."""
    both = tokenized(texts, t)
    n_a, n_b = (np.array([len(x[i]) for x in both], dtype=np.int64) for i in (0, 1))
    a, b = (np.concatenate([*(x[i] for x in both), np.empty(0, np.int64)]) for i in (0, 1))
    a_of, b_of = (np.concatenate(([0], np.cumsum(n))) for n in (n_a, n_b))
    a_end, b_end = spelled(a, t.bytes_a, t.at_a)[1], spelled(b, t.bytes_b, t.at_b)[1]
    cut = cuts(a_end, b_end, a_of, b_of)
    n_groups = np.diff(np.searchsorted(cut, a_of))
    a_begin = np.concatenate(([0], a_end[:-1])) if len(a_end) else a_end
    first, last = np.searchsorted(b_end, a_begin, "right"), np.searchsorted(b_end, a_end, "left")
    each = last - first + 1
    linked = np.arange(int(each.sum())) - np.repeat(np.cumsum(each) - each, each) + np.repeat(first, each)
    codes = (np.repeat(a, each) << B_BITS) | b[linked]
    upto = np.concatenate(([0], np.cumsum(each)))
    b_cut = np.searchsorted(b_end, a_end[cut])
    sign_a, sign_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    sign_a[cut], sign_b[b_cut] = 1, 2
    group_a, group_b = np.searchsorted(cut, np.arange(len(a))), np.searchsorted(b_cut, np.arange(len(b)))
    b_before = np.concatenate(([0], b_cut + 1))
    written = np.empty(len(a) + len(b), dtype=np.int64)
    written[np.arange(len(a)) + b_before[group_a]] = 3 * a + sign_a
    written[np.arange(len(b)) + (cut + 1)[group_b] if len(b) else []] = 3 * b + sign_b
    written, digest = t.written[written], []
    for i, j in zip((a_of + b_of)[:-1].tolist(), (a_of + b_of)[1:].tolist(), strict=True):
        digest.append(hashlib.sha256("".join(written[i:j].tolist())[:-1].encode()).hexdigest() if j > i else "")
    return Aligned(n_a, n_b, n_groups, np.diff(upto[a_of]), digest, codes, upto[a_of])


ROWS = "chunk long, pair_codes array<int>, pair_times array<int>, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, codes array<int>, times array<int>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def per_text(values: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct codes of each text with how often each is there, and new bounds."""
    text = np.repeat(np.arange(len(of) - 1), np.diff(of))
    both, times = np.unique((text << 31) | values, return_counts=True)
    return both & ((1 << 31) - 1), times, np.searchsorted(both, np.arange(len(of)) << 31)


def aligned(docs: DataFrame, ranks_path: str, pieces_path: str, chunk_bytes: int) -> DataFrame:
    """A row per document with its linked id pairs, and rows without a document with those of a chunk (``pair_codes``).

    Chunks are what one task reads next to each other, about ``chunk_bytes`` of text; a
    longer document is a chunk of its own.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        t, chunk, held, total = tokenizers(ranks_path, pieces_path), TaskContext.get().partitionId() << 32, 0, []
        names, numbers = [c.split()[0] for c in ROWS.split(", ")], pa.list_(pa.int32())

        def summary() -> pa.RecordBatch:
            codes, at = np.unique(np.concatenate([c for c, _ in total]), return_inverse=True)
            times = np.bincount(at, np.concatenate([n for _, n in total]), len(codes)).astype(np.int32)
            lists = [pa.array([x.astype(np.int32)], numbers) for x in (codes, times)]
            columns = [pa.array([chunk]), *lists, *(pa.nulls(1, pa.int64()) for _ in range(5)), pa.nulls(1, pa.string()), *(pa.nulls(1, numbers) for _ in range(2))]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                size = part.column("text").nbytes
                if total and held + size > chunk_bytes:
                    yield summary()
                    chunk, held, total = chunk + 1, 0, []
                found = align(part.column("text").to_pylist(), t)
                codes, times, of = per_text(found.codes, found.of)
                held += size
                whole, at = np.unique(codes, return_inverse=True)
                total.append((whole, np.bincount(at, times, len(whole))))
                if len(total) > 64:  # sum up as we go
                    merged, at = np.unique(np.concatenate([c for c, _ in total]), return_inverse=True)
                    total = [(merged, np.bincount(at, np.concatenate([n for _, n in total]), len(merged)))]
                n, bounds = part.num_rows, pa.array(of.astype(np.int32))
                columns = [
                    pa.array(np.full(n, chunk)), pa.nulls(n, numbers), pa.nulls(n, numbers), part.column("doc_id"), *map(pa.array, found[:4]), pa.array(found.digest, pa.string()),
                    *(pa.ListArray.from_arrays(bounds, pa.array(x.astype(np.int32))) for x in (codes, times)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=names)
        if total:
            yield summary()

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, ROWS)


def flat(lists: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of a column of lists in a row, and the bounds of each list."""
    whole = lists.combine_chunks()
    return whole.flatten().to_numpy(), np.concatenate(([0], np.cumsum(np.diff(whole.offsets.to_numpy()))))


def counted(rows: pa.Table, known: pa.Table) -> pa.Table:
    """Results of a chunk's documents, given the corpus-wide counts of its id pairs."""
    order = np.argsort(known.column("code").to_numpy())
    code, count, best = (known.column(c).to_numpy(zero_copy_only=False)[order] for c in ("code", "count", "best"))
    codes, of = flat(rows.column("codes"))
    times, _ = flat(rows.column("times"))
    at = np.searchsorted(code, codes)
    upto = [np.concatenate(([0], np.cumsum(x))) for x in (times * best[at], times.astype(np.int64) * count[at])] if len(code) else [np.zeros(1, np.int64)] * 2
    n_best, count_sum = (pa.array(x[of[1:]] - x[of[:-1]], pa.int64()) for x in upto)
    columns = {c: rows.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
    return pa.table({**columns, "n_best": n_best, "count_sum": count_sum, "groups_sha256": rows.column("groups_sha256")})


def groups(docs: DataFrame, ranks_path: str | None = None, pieces_path: str | None = None, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Align both tokenizations of every text: one row per row.

    Returns doc_id, n_a, n_b (tokens), n_groups, n_links (pairs of tokens whose bytes
    overlap), n_best (links whose id pair is the most frequent of its second id in the whole corpus,
    ties included), count_sum (the corpus-wide counts of all links) and groups_sha256. A
    null or empty text, and one that a tokenizer does not spell again byte by byte, has no
    tokens: zeros and an empty string. Null ids and repeated rows are kept (all of them
    count), an empty table gives no rows, only ``doc_id`` and ``text`` are read. A text is
    tokenized whole, so the longest one sets the memory of a task.

    Documents are tokenized once and kept as id pairs; pairs are summed per chunk before
    they are shuffled, and each chunk gets back the counts of its own pairs.
    """
    import public_tokenizers

    ranks_path = ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken")
    pieces_path = pieces_path or public_tokenizers.path("piece_bpe_32k.model")
    found = store(aligned(docs, ranks_path, pieces_path, chunk_bytes), "alignment")
    asked = found.filter("pair_codes IS NOT NULL").select("chunk", F.explode(F.arrays_zip("pair_codes", "pair_times")).alias("p"))
    asked = asked.select("chunk", F.col("p.pair_codes").alias("code"), F.col("p.pair_times").alias("n"))
    counts = asked.groupBy("code").agg(F.sum("n").alias("count"))
    second = F.col("code").bitwiseAND(F.lit((1 << B_BITS) - 1))
    counts = store(counts.withColumn("second", second), "alignment")
    most = counts.groupBy("second").agg(F.max("count").alias("most"))  # a row per id of the vocabulary
    counts = counts.join(F.broadcast(most), "second").select("code", "count", (F.col("count") == F.col("most")).alias("best"))
    known = asked.join(counts, "code").select(F.col("chunk").alias("of"), "code", "count", "best")
    rows = found.filter("pair_codes IS NULL").drop("pair_codes", "pair_times")
    return rows.groupBy("chunk").cogroup(known.groupBy("of")).applyInArrow(counted, RESULT)
