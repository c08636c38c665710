"""Small documents with every awkward case, and plain Python counterparts."""

import random
import re

from pyspark.sql import functions as F

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
# names that the operators use inside
CLASHING = ["n", "key", "cls", "grp", "rows", "text_hash", "score", "unit", "part", "size", "mark", "sequence_id", "offset", "rank", "rest"]


def words_of(text):
    return WORD.findall(text or "")


def make(seed=0, n=60):
    """Random texts over few words, so that passages repeat; near and exact copies."""
    draw = random.Random(seed)
    vocabulary = [f"W{i}" if i % 5 else f"mot{i}é," for i in range(400)]
    passage = [draw.choice(vocabulary) for _ in range(35)]
    docs = []
    for i in range(n):
        text = [draw.choice(vocabulary) for _ in range(draw.choice([1, 3, 4, 7, 30, 60, 120]))]
        if i % 4 == 1:
            at = draw.randrange(len(text) + 1)
            text[at:at] = passage[draw.randrange(10) :]
        if i % 7 == 3 and docs:
            text = words_of(docs[-1][1])[:]
            if text and i % 2:
                text[draw.randrange(len(text))] = "changed"
        docs.append([i * 3 + 1, draw.choice([" ", "\n", "\t "]).join(text), draw.choice(["en", "fr", None]), draw.choice(["b", "a", "ä", None]), 0])
    docs += [[900, None, None, "a", None], [901, "", "en", None, 0], [902, " \n\t ", "en", "b", 4], [903, "!!! 123 ...", "en", "b", 11]]
    docs += [[None, "a text without an id but with words enough to make some shingles here", "en", "a", 1]] * 2
    docs += [[904, "W1 " * 50, "en", "b", 150], [905, " ".join(vocabulary) * 40, "en", "c", 1], [906, "x" * 30000, "en", "c", 1]]
    docs += [docs[5], docs[5], [docs[5][0], "another text under the same id", "fr", "a", 3]]
    return [tuple(d) for d in docs]


def frame(spark, rows, clash=True):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    return docs.select("*", *(F.lit("other").alias(c) for c in CLASHING)) if clash else docs


def shingles(text, length):
    w = words_of((text or "").translate(LOWER))
    if len(w) < length:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[i : i + length]) for i in range(len(w) - length + 1))


def plain(rows):
    return sorted(map(tuple, rows), key=repr)
