"""The pipeline, stage by stage, against brute force."""

from small import CLASHING, SCHEMA, make, shingles, words_of
from test_documents import repeats

import corpus_pipeline
from strata.llm.common import store
from strata.llm.packing import CAPACITY

from pyspark.sql import functions as F


def prose():
    """Enough text to learn a language from, with the awkward documents of all tests."""
    filler = "the house and the garden were with them that day and all of it was said once more "
    more = [(1000 + i, f"{filler * (1 + i % 3)}{i} {i * i} {i * 7}", "en", "b", 1) for i in range(30)]
    return [d for d in make() if d[0] is not None] + more


def test_stages_do_what_they_say(spark, path):
    spark.createDataFrame(prose(), SCHEMA).repartition(3).write.parquet(path("documents.parquet"))
    docs, seen = spark.read.parquet(path("documents.parquet")), {}
    for name, stage in corpus_pipeline.STAGES:
        docs = store(stage(spark, docs, str(path(""))), "test")
        seen[name] = docs
    before = spark.read.parquet(path("documents.parquet"))
    columns = before.columns
    assert all(seen[n].columns == columns for n in list(seen)[:-1])

    kept = [tuple(r) for r in seen["language_id"].collect()]
    gone = before.exceptAll(seen["language_id"]).collect()
    assert gone and all(not any(c.isalpha() for c in r["text"] or "") for r in gone)

    one = [tuple(r) for r in seen["near_duplicates"].collect()]
    sets = [shingles(d[1], 5) for d in kept]
    part = list(range(len(kept)))
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]) and part[i] != part[j]:
                part = [part[j] if p == part[i] else p for p in part]
    best = {}
    for d, p in zip(kept, part):
        best[p] = min(best.get(p, d[0]), d[0])
    assert len(one) == len(best) < len(kept) and sorted(d[0] for d in one) == sorted(best.values())

    keyed = seen["near_duplicates"].select("doc_id", F.xxhash64("text").alias("h"), "text").collect()
    want = repeats([tuple(r) for r in keyed], 20)
    whole = {r["text"] for r in keyed}
    cut = seen["substring_dedup"].collect()
    assert sorted((r["doc_id"], " ".join(words_of(r["text"]))) for r in cut) == sorted((k[0], want[tuple(k)]) for k in keyed)
    assert all(r["text"] in whole or r["n_chars"] == len(r["text"]) for r in cut)

    words = sum(len(words_of(r["text"])) for r in cut)
    mixed = sum(len(words_of(r["text"])) for r in seen["mixing"].collect())
    assert abs(mixed - 1.5 * words) <= len({r["source"] for r in cut})

    packed = seen["packing"].groupBy("sequence_id").agg(F.sum("length").alias("n"), F.max(F.col("offset") + F.col("length")).alias("end"))
    assert packed.filter(f"n <> end OR n > {CAPACITY}").count() == 0
    assert seen["packing"].agg(F.sum("doc_tokens")).first()[0] >= mixed


def test_stages_take_empty_tables_and_other_columns(spark):
    empty = spark.createDataFrame([], SCHEMA)
    few = spark.createDataFrame([*make()[:6], (None, None, None, None, None)], SCHEMA).select("*", *(F.lit(1).alias(c) for c in CLASHING))
    for docs in (empty, few):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, "")
            out.collect()
            assert name == "packing" or out.columns == docs.columns
