"""Quality classifier: heuristic labellers weighed by expectation-maximisation teach a hashed linear scorer."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import slices, store, words

# Common English insults. No such list is whole, so a text without one gets no vote.
INSULTS = (
    "idiot idiotic imbecile moron moronic cretin stupid dumb dumbass dimwit halfwit nitwit numbskull dunce loser pathetic scum "
    "scumbag worthless useless trash garbage vermin parasite lowlife clown buffoon jerk creep weirdo freak degenerate disgusting "
    "repulsive revolting despicable contemptible vile coward spineless liar hypocrite bastard bitch asshole arsehole dickhead prick "
    "wanker tosser twat douchebag douche jackass motherfucker fucker fuck shithead shit bullshit dipshit slut whore retard pervert"
).split()
TASKS = ("poor", "toxic")
FEATURES = 1 << 18
SAMPLE = 16_000
EPOCHS = 8
BATCH = 512
PREFIX = 5
SHARE = 0.1
START = np.array([[0.5, 3.0, 1.5], [3.0, 1.0, 1.0]])  # yes, no, silent; first row: where the truth is no
HEURISTICS = ("poor_letters", "poor_symbols", "poor_capitals", "poor_separators", "poor_repeats", "toxic_insults", "toxic_repeated")
_INSULT = re.compile(rb"(?<![A-Za-z])(?:" + "|".join(INSULTS).encode() + rb")s?(?![A-Za-z])", re.IGNORECASE)


def _bytes(*kinds: str) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[list("".join(kinds).encode())] = True
    return table


_CAPITAL = _bytes("ABCDEFGHIJKLMNOPQRSTUVWXYZ")
_LETTER = _CAPITAL | _bytes("abcdefghijklmnopqrstuvwxyz")
_LETTER[0xC0:] = True  # first bytes of other characters
_FIRST = (np.arange(256) & 0xC0) != 0x80
_SYMBOL = _bytes("#$%&*!|<>{}=^~@", chr(0x5C))
_SIGN = _FIRST & ~_LETTER & ~_bytes("0123456789")


def votes(batch: pa.RecordBatch) -> np.ndarray:
    """One column per heuristic labeller: 1 yes, 0 no, NaN where it has no opinion.

    The labellers overlap: letters, symbols, capitals, lone signs between words and words
    said twice running for poor text, insults and several of them for toxic text. The two
    for toxic text say yes or nothing: a text without a listed word may be toxic in others.
    """
    n = batch.num_rows
    split = words(batch.column("text"))
    at = np.concatenate(([0], np.cumsum(np.asarray(pc.binary_length(batch.column("text")).fill_null(0), dtype=np.int64))))

    def bytes_in(table: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(table[split.data])))[at])

    def words_in(mask: np.ndarray) -> np.ndarray:
        return np.diff(np.concatenate(([0], np.cumsum(mask)))[split.of])

    count = np.diff(split.of)
    chars, letters, capitals, symbols = map(bytes_in, (_FIRST, _LETTER, _CAPITAL, _SYMBOL))
    lone = words_in((split.end - split.start == 1) & _SIGN[split.data[split.start]])
    twice = np.zeros(len(split.hash), dtype=bool)
    twice[1:] = split.hash[1:] == split.hash[:-1]
    twice[split.of[:-1][count > 0]] = False
    places = np.fromiter((m.start() for m in _INSULT.finditer(split.data.tobytes())), dtype=np.int64)
    insults = np.bincount(np.searchsorted(at, places, side="right") - 1, minlength=n) if len(places) else np.zeros(n, int)

    def vote(part: np.ndarray, whole: np.ndarray, yes: float, no: float, least: int = 5) -> np.ndarray:
        share = part / np.maximum(whole, 1)
        return np.where(count < least, np.nan, np.where(share >= yes, 1.0, np.where(share < no, 0.0, np.nan)))

    return np.stack(
        [
            vote(chars - letters, chars, 0.35, 0.25, 0), vote(symbols, count, 0.5, 0.15), vote(capitals, letters, 0.5, 0.2),
            vote(lone, count, 0.1, 0.03), vote(words_in(twice), count, 0.2, 0.05),
            np.where(insults > 0, 1.0, np.nan), np.where(insults > 1, 1.0, np.nan),
        ],
        axis=1,
    )


def vote_table(docs: DataFrame, labels: DataFrame | None) -> DataFrame:
    """(doc_id, text_hash, votes): the heuristics and, where there are any, the given labels.

    An id with several labels has no vote when they disagree. Texts are not carried along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                cast = votes(part)
                columns = [pa.array(cast[:, j], pa.float64(), from_pandas=True).cast(pa.int32()) for j in range(len(HEURISTICS))]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_hash"), *columns], names=["doc_id", "text_hash", *HEURISTICS])

    schema = "doc_id long, text_hash long, " + ", ".join(f"{h} int" for h in HEURISTICS)
    found = hashed(docs).mapInArrow(run, schema)
    if labels is None:
        return found.withColumn("poor_label", F.lit(None).cast("int")).withColumn("toxic_label", F.lit(None).cast("int"))

    def agreed(value: Column) -> Column:
        return F.when(F.min(value) == F.max(value), F.min(value)).cast("int")

    given = labels.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("label_id"))
    given = given.agg(agreed(1 - F.col("quality")).alias("poor_label"), agreed(F.col("toxic")).alias("toxic_label"))
    return found.join(given, found["doc_id"] == given["label_id"], "left").drop("label_id")


def hashed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.xxhash64("text").alias("text_hash"), F.col("text").cast("string"))


def labellers(task: str, columns: list[str]) -> list[str]:
    return [c for c in columns if c.startswith(f"{task}_")]


def outcomes(seen: np.ndarray) -> np.ndarray:
    """Votes as outcomes: 0 yes, 1 no, 2 silent. Silence is an outcome like any other."""
    return np.where(np.isnan(seen), 2, np.where(seen == 1, 0, 1))


def accuracies(patterns: pd.DataFrame, names: list[str], steps: int = 200) -> tuple[float, np.ndarray]:
    """EM over vote patterns with counts: the share of yes, and P(outcome | truth) per heuristic.

    ``patterns`` has a column per labeller (NaN: no vote), the given labels last, and ``n``;
    there are at most 3 ** labellers rows. The share of yes and all rates are estimated
    from all documents. Heuristics start as better than chance, which settles which side is
    yes, and START also counts as a few documents, so that no rate becomes zero. Where a
    label is given it is the truth: heuristics that share a blind spot would otherwise
    outvote it. Without labels the votes alone decide.
    """
    seen, n = patterns[names].to_numpy(float), patterns["n"].to_numpy(float)
    cast = outcomes(seen[:, :-1])
    rate = np.repeat(START[:, None, :] / START.sum(axis=1)[:, None, None], cast.shape[1], axis=1)
    prior = 2 * SHARE
    for _ in range(steps):
        truth = posterior(seen, prior, rate)
        prior = float((truth @ n + 1) / (n.sum() + 1 / SHARE))
        for row, weight in enumerate(((1 - truth) * n, truth * n)):
            told = np.stack([weight @ (cast == o) for o in range(3)], axis=1) + START[row]
            rate[row] = told / told.sum(axis=1, keepdims=True)
    return prior, rate


def posterior(seen: np.ndarray, prior: float, rate: np.ndarray) -> np.ndarray:
    """Probability of yes given the votes: the given label (last column), or the heuristics, independent given the truth."""
    cast = outcomes(seen[:, :-1])
    odds = np.full(len(seen), np.log(prior / (1 - prior)))
    for j in range(cast.shape[1]):
        odds += np.log(rate[1, j] / rate[0, j])[cast[:, j]]
    return np.where(np.isnan(seen[:, -1]), 1 / (1 + np.exp(-odds)), seen[:, -1])


def learn_labellers(voted: DataFrame) -> dict[str, tuple[list[str], float, np.ndarray]]:
    """Accuracies per task from the vote patterns of all documents, counted by Spark."""
    learned = {}
    for task in TASKS:
        names = labellers(task, voted.columns)
        patterns = voted.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).toPandas()
        learned[task] = (names, *accuracies(patterns, names))
    return learned


def features(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hashed feature and value: distinct words, word beginnings, and the heuristic votes."""
    split = words(batch.column("text"), lower=True)
    of = np.repeat(np.arange(batch.num_rows), np.diff(split.of))
    short = np.minimum(split.start + PREFIX, split.end)
    start = np.zeros(len(of), dtype=np.uint64)
    for i in range(PREFIX):
        at = np.minimum(split.start + i, len(split.data) - 1)
        start = start * np.uint64(257) + np.where(split.start + i < short, split.data[at].astype(np.uint64) + np.uint64(1), 0).astype(np.uint64)
    hashed = [split.hash % np.uint64(FEATURES), (start * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(40)) % np.uint64(FEATURES)]
    key = np.unique(np.concatenate([of * FEATURES + h.astype(np.int64) for h in hashed])) if len(of) else np.empty(0, np.int64)
    rows, columns = key // FEATURES, key % FEATURES
    value = np.bincount(rows, minlength=batch.num_rows)[rows] ** -0.25 if len(rows) else np.empty(0)
    parts = [(rows, columns, value)]
    for j, vote in enumerate(votes(batch).T):
        for answer in (0, 1):
            at = np.flatnonzero(vote == answer)
            parts.append((at, np.full(len(at), FEATURES + 2 * j + answer), np.ones(len(at))))
    parts.append((np.arange(batch.num_rows), np.full(batch.num_rows, FEATURES + 2 * len(HEURISTICS)), np.ones(batch.num_rows)))
    return tuple(np.concatenate(p) for p in zip(*parts, strict=True))


SIZE = FEATURES + 2 * len(HEURISTICS) + 1


def train(docs: DataFrame, voted: DataFrame, learned: dict, sample: int = SAMPLE) -> np.ndarray:
    """Weights of one linear scorer per task, by logistic regression on posterior labels.

    Fitted on a sample of about ``sample`` documents by a hash of the text, half of them
    with given labels if there are enough: a documented bound, as one task holds it.
    Everything before and after covers all documents. Texts without any vote on a task do
    not teach it if others have labels; with no labels their silence does.
    """
    labelled = F.coalesce("poor_label", "toxic_label").isNotNull()
    n, n_labelled = voted.agg(F.count(F.lit(1)), F.count(F.when(labelled, 1))).first()
    rate = F.when(labelled, sample / 2 / max(1, n_labelled)).otherwise(sample / 2 / max(1, n - n_labelled))
    drawn = F.pmod(F.xxhash64("text_hash", "doc_id"), F.lit(1 << 40)) < rate * (1 << 40)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, truth, told, given, base = [], [], [], [], 0
        for batch in batches:
            for part in slices(batch, "text"):
                row, column, value = features(part)
                parts.append((row + base, column, value))
                cast = [votes_of(part, columns) for columns, _, _ in learned.values()]
                truth.append([posterior(seen, prior, rate) for seen, (_, prior, rate) in zip(cast, learned.values(), strict=True)])
                told.append([~np.isnan(seen).all(axis=1) for seen in cast])
                given.append([~np.isnan(seen[:, -1]) for seen in cast])
                base += part.num_rows
        if not parts:
            return
        row, column, value = (np.concatenate(p) for p in zip(*parts, strict=True))
        truth, told, given = (np.concatenate(p, axis=1) for p in (truth, told, given))
        told |= ~given.any(axis=1, keepdims=True)
        place = np.random.default_rng(0).permutation(base)  # batches must not follow the order of files
        order = np.argsort(place[row], kind="stable")
        row, column, value = place[row][order], column[order], value[order]
        truth[:, place], told[:, place] = truth.copy(), told.copy()
        for task, wanted, taught in zip(TASKS, truth, told, strict=True):
            share = wanted[taught].mean()
            balance = taught * np.where(wanted > 0.5, np.sqrt((1 - share) / max(1e-3, share)), 1.0)  # rare, so counted more
            weights, spread = np.zeros(SIZE), np.full(SIZE, 1e-6)
            for _ in range(EPOCHS):
                for first in range(0, base, BATCH):
                    mine = slice(*np.searchsorted(row, (first, first + BATCH)))
                    n, at = min(BATCH, base - first), row[mine] - first
                    guess = 1 / (1 + np.exp(-np.bincount(at, weights[column[mine]] * value[mine], n)))
                    off = (guess - wanted[first : first + n]) * balance[first : first + n] / n
                    slope = np.bincount(column[mine], off[at] * value[mine], SIZE)
                    spread += slope * slope
                    weights -= 0.3 * slope / np.sqrt(spread)
            at = np.flatnonzero(weights)
            columns = [pa.array([task] * len(at)), pa.array(at), pa.array(weights[at])]
            yield pa.RecordBatch.from_arrays(columns, names=["task", "feature", "weight"])

    rows = hashed(docs)
    columns = [c for t in TASKS for c in learned[t][0]]
    picked = voted.filter(drawn).dropDuplicates(["doc_id", "text_hash"]).select(F.col("doc_id").alias("i"), F.col("text_hash").alias("h"), *columns)
    same = rows["doc_id"].eqNullSafe(F.col("i")) & rows["text_hash"].eqNullSafe(F.col("h"))
    texts = rows.join(F.broadcast(picked), same).select("text", *columns)  # about ``sample`` narrow rows
    found = texts.repartition(1).mapInArrow(fit, "task string, feature long, weight double").toPandas()
    weights = np.zeros((len(TASKS), SIZE))
    for i, task in enumerate(TASKS):
        mine = found[found["task"] == task]
        weights[i, mine["feature"].to_numpy(int)] = mine["weight"]
    return weights


def votes_of(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(float) for c in names], axis=1)


def classify(docs: DataFrame, labels: DataFrame | None = None, sample: int = SAMPLE) -> DataFrame:
    """Score every document: doc_id, quality, toxicity (both 0 to 1) and whether to keep it.

    Heuristic labellers vote on all documents; EM over all vote patterns estimates the share
    of yes and what each labeller does in either case. Hand labels, where there are any, are
    taken as the truth of their documents; without them the votes alone decide. The
    posterior labels train linear scorers on hashed words, which judge every whole text. ``keep`` asks for quality of at least one
    half and toxicity below it. A null or empty text is poor (not kept). Repeated rows and
    null ids are scored each on their own, an empty table gives no rows, and columns other
    than those read may have any name.
    """
    voted = store(vote_table(docs, labels), "quality")
    weights = train(docs, voted, learn_labellers(voted), sample)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                row, column, value = features(part)
                poor, toxic = (1 / (1 + np.exp(-np.bincount(row, w[column] * value, part.num_rows))) for w in weights)
                empty = np.diff(words(part.column("text"), hashes=False).of) == 0
                poor, toxic = np.where(empty, 1.0, poor), np.where(empty, 0.0, toxic)
                keep = (poor <= 0.5) & (toxic < 0.5)
                columns = [part.column("doc_id"), pa.array(1 - poor), pa.array(toxic), pa.array(keep)]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "quality", "toxicity", "keep"])

    return hashed(docs).mapInArrow(score, "doc_id long, quality double, toxicity double, keep boolean")
