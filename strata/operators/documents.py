"""Documents: text extraction, overlapping chunks and their synchronised index."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.scalars import stable_id
from strata.operators.changes import DELETE, INSERT, POSTIMAGE, delete_matching, semi_keys, upserts

# Chunk size and overlap in words.
CHUNK_SIZE = 500
CHUNK_OVERLAP = 100
BLANKS = " \t\n\x0b\f\r"

# What is removed from a page, then the entities that are decoded.
BLOCKS = r"(?is)<(script|style)\b.*?</\1\s*>"
COMMENTS = r"(?s)<!--.*?-->"
TAGS = r"(?s)<[^>]*>"
ENTITIES = [
    ("&nbsp;", " "),
    ("&lt;", "<"),
    ("&gt;", ">"),
    ("&quot;", '"'),
    ("&#39;", "'"),
    ("&amp;", "&"),
]


def page_text(html: Column | str) -> Column:
    """Visible text of a page, whitespace collapsed."""
    text = F.col(html) if isinstance(html, str) else html
    for pattern in (BLOCKS, COMMENTS, TAGS):
        text = F.regexp_replace(text, pattern, " ")
    for entity, character in ENTITIES:
        text = F.replace(text, F.lit(entity), F.lit(character))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def chunk_text(
    df: DataFrame,
    id_col: str,
    text_col: str,
    size: int = CHUNK_SIZE,
    overlap: int = CHUNK_OVERLAP,
) -> DataFrame:
    """Overlapping word windows of whole texts: (chunk_id, path, position, content).

    A window opens every ``size - overlap`` words until one reaches the end; a
    blank text has none. Each text splits where it lies, without a shuffle, and only
    finished windows are carried into the rows it expands to.
    """
    stride = size - overlap
    inner = F.btrim(F.col(text_col), F.lit(BLANKS))
    last = F.ceil(F.greatest(F.size("_words") - size, F.lit(0)) / stride).cast("int")
    windows = F.transform(
        F.sequence(F.lit(0), last),
        lambda i: F.array_join(F.slice("_words", i * stride + 1, size), " "),
    )
    return (
        df.select(F.col(id_col).alias("path"), inner.alias("_text"))
        .filter("_text <> ''")
        .select("path", F.split("_text", r"\s+").alias("_words"))
        .select("path", F.posexplode(windows).alias("position", "content"))
        .select(stable_id("path", "position").alias("chunk_id"), "path", "position", "content")
    )


def chunk_stats(chunks: DataFrame) -> DataFrame:
    """Chunks and the documents they come from."""
    return chunks.agg(F.count(F.lit(1)).alias("chunks"), F.count_distinct("path").alias("docs"))


def chunk_changes(index: DataFrame, chunks: DataFrame) -> DataFrame:
    """What an index has to do: (chunk_id, _change_type).

    Only identifiers and digests are joined; the texts stay where they are.
    """
    digest = F.md5("content")
    return (
        index.select("chunk_id", digest.alias("_old"))
        .join(chunks.select("chunk_id", digest.alias("_new")), ["chunk_id"], "full_outer")
        .filter(~F.col("_old").eqNullSafe(F.col("_new")))
        .select(
            "chunk_id",
            F.when(F.col("_old").isNull(), INSERT)
            .when(F.col("_new").isNull(), DELETE)
            .otherwise(POSTIMAGE)
            .alias("_change_type"),
        )
    )


def sync_chunks(
    index: DataFrame,
    chunks: DataFrame,
    changes: DataFrame,
    embed: Callable[[DataFrame], DataFrame] = lambda fresh: fresh,
) -> DataFrame:
    """Bring an index up to date; only new and changed chunks pass through ``embed``."""
    key = ["chunk_id"]
    fresh = embed(semi_keys(chunks, upserts(changes), key, unique=True))
    return delete_matching(index, changes, key, unique=True).unionByName(fresh)


def similar_topk(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    query: Sequence[float],
    k: int = 3,
    columns: Sequence[str] = (),
) -> DataFrame:
    """The ``k`` vectors most similar to the query by cosine, exact over the whole table.

    The query is a plan constant, so this is one scan with a top-k per task. ``columns``
    come along, such as a path and its text. A vector of another length than the query
    stops the job; null vectors come last, with no score.
    """
    length = sum(q * q for q in query) ** 0.5
    if not length:
        raise ValueError("a zero vector has no direction")
    vector = F.col(vector_col).cast("array<double>")
    fits = F.coalesce(F.size(vector) == len(query), F.lit(True)) | vector.isNull()
    vector = F.when(fits, vector).otherwise(F.raise_error(F.lit(f"a vector has not the query's length {len(query)}")))
    unit = F.array(*[F.lit(float(q / length)) for q in query])

    def total(products: Column) -> Column:
        return F.aggregate(products, F.lit(0.0), lambda held, x: held + x)

    dot = total(F.zip_with(vector, unit, lambda x, q: x * q))
    norm = F.sqrt(total(F.transform(vector, lambda x: x * x)))
    return (
        vectors.withColumn("score", dot / F.nullif(norm, F.lit(0.0)))
        .orderBy(F.desc_nulls_last("score"), F.col(id_col))
        .limit(k)
        .select(id_col, *columns, "score")
    )

