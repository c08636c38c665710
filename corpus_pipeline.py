"""A training corpus in five stages: language, near duplicates, repeated passages, mixture, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet
and read again as the next stage's ``docs``. All but the last return the columns of
documents. Ids may be null or repeated and other columns may have any name.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import jaccard, languages, mixing, packing, substrings
from strata.llm.common import hash_of, named, remainder, store


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a language (null, empty, no letters) or none that makes up half of them.

    The languages are learned from the documents' own ``lang``, as in op8. With nothing to
    learn from there is no language, and no document stays.
    """
    model = languages.learn(docs.filter(remainder(F.col("doc_id"), 5) != 0))
    return languages.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group linked by five-word shingles at a similarity of 0.8.

    The one with the smallest id stays (nulls last; then the smallest text hash). Documents
    without words are in no group and all stay; of equal rows in a group one stays.
    """
    joined = jaccard.join(docs)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    best = joined.filter("n_shingles > 0").groupBy("part").agg(first.alias("best")).select("best.id", "best.hash")
    best = store(best, "pipeline").select(F.struct(F.col("id").alias("i"), F.col("hash").alias("h")).alias("_kept"))
    # structs are equal with nulls inside; of the very type of _kept, the rows are grouped where they were joined
    own = F.struct(F.col("doc_id").cast("long").alias("i"), F.xxhash64("text").alias("h")).cast(best.schema["_kept"].dataType)
    rest = hash_of(docs, [c for c in docs.columns if c != "text"])  # of several rows always the same one
    rows = docs.select(own.alias("_own"), F.struct(*map(named, docs.columns)).alias("_row"), rest.alias("_rest"))
    wordless = F.coalesce(~F.col("_row.text").rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    one = rows.filter(~wordless).join(best, F.col("_own") == F.col("_kept"), "left_semi").groupBy("_own").agg(F.min_by("_row", "_rest").alias("_row"))
    kept = one.select("_row").unionAll(rows.filter(wordless).select("_row"))
    return kept.select(*(F.col("_row")[c].alias(c) for c in docs.columns))


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Remove words in passages of 20 words or more that also begin earlier; n_chars follows the text.

    A text that loses nothing stays as it is, white space included; one that loses all its
    words stays as an empty text.
    """
    cut = substrings.deduplicate(docs, as_is=True)
    chars = F.when(F.col("n_removed") == 0, F.col("n_chars")).otherwise(F.length("text").cast("long"))
    return cut.select(*(chars.alias(c) if c == "n_chars" else named(c) for c in docs.columns))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take documents as often as the source weights say; n_chars follows a cut text."""
    mixed = mixing.mixed_documents(docs)
    return mixed.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else named(c) for c in docs.columns))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every document in sequences of at most 2048 tokens: one row per piece, with its ids.

    ``packing.sequences`` reads the sequences themselves from the result.
    """
    return packing.pack(packing.pieces(docs, keep_ids=True, packed=True))


STAGES = [
    ("language_id", language),
    ("near_duplicates", near_duplicates),
    ("substring_dedup", repeated_passages),
    ("mixing", mixture),
    ("packing", sequences),
]

ORACLE_SQL = None  # learned languages and drawn copies have no SQL; tests compare with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
