"""Language identification: each document as a mixture of languages, fitted by expectation-maximisation."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices

SLICE_BYTES = 1 << 18  # a text's trigrams take some hundred times its bytes while it is fitted
BUCKETS = 1 << 15
ORDER = 3
STEPS = 12
HELD_LANGUAGES = 64
UNKNOWN = "und"

# Lower case for A-Z; other ASCII bytes that are not letters count as blanks.
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[:128] = 0x20
for _c in range(26):
    _FOLD[0x41 + _c] = _FOLD[0x61 + _c] = 0x61 + _c


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashed byte trigrams of the texts, one blank added at both ends: text, bucket, count.

    Trigrams of three blanks say nothing and are left out.
    """
    texts = texts.cast(pa.large_string()).fill_null("")
    offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    raw = np.frombuffer(raw, dtype=np.uint8)[offsets[0] : offsets[-1]] if raw else np.empty(0, np.uint8)
    size = np.diff(offsets)
    owner = np.repeat(np.arange(len(size)), size)
    data = np.full(len(raw) + 2 * len(size), 0x20, dtype=np.uint8)
    data[np.arange(len(raw)) + 2 * owner + 1] = _FOLD[raw]
    owner = np.repeat(np.arange(len(size)), size + 2)
    wide = data.astype(np.uint32)
    gram = (wide[:-2] << 16) | (wide[1:-1] << 8) | wide[2:]
    whole = (owner[:-2] == owner[2:]) & (gram != 0x202020)
    bucket = ((gram[whole] * np.uint32(0x9E3779B1)) >> np.uint32(32 - 15)).astype(np.int64)
    key, count = np.unique(owner[:-2][whole] * BUCKETS + bucket, return_counts=True)
    return key // BUCKETS, key % BUCKETS, count


class Model(NamedTuple):
    """Learned languages in order, and the probability of each bucket in each of them."""

    languages: list[str]
    share: np.ndarray
    chance: np.ndarray  # buckets x languages


def learn(docs: DataFrame) -> Model:
    """Bucket counts of every language over all given rows with text and ``lang``.

    Tasks add up their rows before the shuffle, so the driver receives one array of
    BUCKETS counts per language, whatever the size of the corpus.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}

        def flush() -> Iterator[pa.RecordBatch]:
            for lang, sums in held.items():
                at = np.flatnonzero(sums)
                columns = [pa.array([lang] * len(at), pa.string()), pa.array(at), pa.array(sums[at])]
                yield pa.RecordBatch.from_arrays(columns, names=["lang", "bucket", "n"])
            held.clear()

        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                text, bucket, n = features(part.column("text"))
                names, of = np.unique(np.array(part.column("lang").to_pylist(), dtype=object), return_inverse=True)
                for i, lang in enumerate(names.tolist()):
                    mine = of[text] == i
                    held.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
                    held[lang] += np.bincount(bucket[mine], n[mine], BUCKETS).astype(np.int64)
                if len(held) >= HELD_LANGUAGES:
                    yield from flush()
        yield from flush()

    rows = docs.select("text", F.col("lang").cast("string")).filter("text IS NOT NULL AND lang IS NOT NULL")
    sums = rows.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    per_language = sums.groupBy("lang").agg(F.collect_list("bucket").alias("bucket"), F.collect_list("n").alias("n")).collect()
    per_language.sort(key=lambda r: r["lang"])
    counts = np.zeros((BUCKETS, len(per_language)))
    for i, row in enumerate(per_language):
        counts[row["bucket"], i] = row["n"]
    total = counts.sum(axis=0)
    share = (total + 1) / (total + 1).sum()
    return Model([r["lang"] for r in per_language], share, (counts + 0.5) / (total + 0.5 * BUCKETS))


class Mixture:
    """The texts of a slice as mixtures of languages."""

    def __init__(self, model: Model, text: np.ndarray, bucket: np.ndarray, count: np.ndarray):
        self.texts, self.start = np.unique(text, return_index=True)
        self.row = np.searchsorted(self.texts, text)
        self.count, self.chance = count.astype(float), model.chance[bucket]
        self.total = np.add.reduceat(self.count, self.start)

    def fit(self, allowed: np.ndarray, steps: int = STEPS) -> tuple[np.ndarray, np.ndarray]:
        """Language shares per text by EM within the allowed sets, and the log-likelihood."""
        share = allowed / allowed.sum(axis=1, keepdims=True)
        for _ in range(steps):
            joint = self.chance * share[self.row]
            joint *= (self.count / joint.sum(axis=1))[:, None]
            share = np.add.reduceat(joint, self.start, axis=0) / self.total[:, None]
        return share, self.likelihood(share)

    def likelihood(self, share: np.ndarray) -> np.ndarray:
        """Per text; trigrams overlap, so each counts a third."""
        mixed = (self.chance * share[self.row]).sum(axis=1)
        return np.add.reduceat(self.count * np.log(mixed), self.start) / ORDER

    def subset(self, keep: np.ndarray) -> Mixture:
        part = object.__new__(Mixture)
        rows = keep[self.row]
        part.texts = self.texts[keep]
        _, part.start, part.row = np.unique(self.row[rows], return_index=True, return_inverse=True)
        part.count, part.chance, part.total = self.count[rows], self.chance[rows], self.total[keep]
        return part


def select(mixture: Mixture, model: Model) -> np.ndarray:
    """Shares of the language set with the best penalised likelihood, per text.

    The candidates are the best single language, and the sets met when the language with
    the least share is taken out of the full set one at a time. Each language costs half
    the log of the text's length.
    """
    languages = len(model.languages)
    n = len(mixture.texts)
    single = np.add.reduceat(mixture.count[:, None] * np.log(mixture.chance), mixture.start, axis=0) / ORDER + np.log(model.share)
    top = single.argmax(axis=1)
    best = np.zeros((n, languages))
    best[np.arange(n), top] = 1
    value = mixture.likelihood(best)
    cost = 0.5 * np.log(mixture.total + 1)
    open_texts = np.ones(n, dtype=bool)
    allowed = np.ones((n, languages))
    for size in range(languages, 1, -1):
        if not open_texts.any():
            break
        part, at = mixture.subset(open_texts), np.flatnonzero(open_texts)
        share, fitted = part.fit(allowed[at])
        gain = fitted - (size - 1) * cost[at] - value[at]
        better = gain > 0
        best[at[better]], value[at[better]] = share[better], value[at[better]] + gain[better]
        # by concavity no smaller set can beat the best one if even this fit, without its price, does not
        open_texts[at[fitted + 1e-9 - cost[at] <= value[at]]] = False
        least = np.where(allowed[at] > 0, share, np.inf).argmin(axis=1)
        allowed[at, least] = 0
    return best


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """Add ``lang_pred`` and ``score`` to (doc_id, text): the largest language of the document's set and its share.

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned.
    Repeated rows and null ids are kept; other columns are not read.
    """
    columns = [F.col("doc_id").cast("long"), "text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters")]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                names, scores = [UNKNOWN] * part.num_rows, np.zeros(part.num_rows)
                letters = part.column("letters").to_numpy(zero_copy_only=False)
                if model.languages and letters.any():
                    text, bucket, count = features(part.column("text"))
                    wanted = letters[text]
                    mixture = Mixture(model, text[wanted], bucket[wanted], count[wanted])
                    share = select(mixture, model)
                    for i, lang, score in zip(mixture.texts.tolist(), share.argmax(axis=1).tolist(), share.max(axis=1), strict=True):
                        names[i], scores[i] = model.languages[lang], min(1.0, score)
                columns = [part.column("doc_id"), pa.array(names), pa.array(scores)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "lang_pred", "score"])

    return docs.select(*columns).mapInArrow(predict, "doc_id long, lang_pred string, score double")


def accepted(docs: DataFrame, model: Model, least: float = 0.5) -> DataFrame:
    """The documents, with all their columns, that have a language with at least ``least`` of the text."""

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                scores = np.zeros(part.num_rows)
                if model.languages:
                    mixture = Mixture(model, *features(part.column("text")))
                    scores[mixture.texts] = select(mixture, model).max(axis=1)
                letters = pc.fill_null(pc.match_substring_regex(part.column("text"), r"\p{L}"), False)
                yield part.filter(pc.and_(letters, pa.array(scores >= least)))
            pa.default_memory_pool().release_unused()  # the worker is used again by later stages

    return docs.mapInArrow(sift, docs.schema)
