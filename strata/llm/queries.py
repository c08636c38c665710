"""The registered queries of the operators: contract columns from the operators' own results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import alignment, html_text, jaccard, languages, merkle, mixing, neighbours, packing, quality, simhash, substrings, suffix_tree, vafile
from strata.llm.common import remainder, table


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(packing.pieces(table(spark, sf_dir, "documents")))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


def op3_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.taken(mixing.mixture(table(spark, sf_dir, "documents")))


def op6_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substrings.deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    return kept.select("doc_id", "n_words", "n_removed", digest)


def op7_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = jaccard.join(table(spark, sf_dir, "documents"), length=4, percent=85)
    return joined.select("doc_id", "n_shingles", "component_id")


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 5) == 0
    found = languages.identify(docs, languages.learn(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 10) == 0
    scored = suffix_tree.score(table(spark, sf_dir, "documents"), ~held_out)
    columns = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
    return scored.select("doc_id", held_out.alias("held_out"), *columns)


def op10_vafile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vafile.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, 5)


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.groups(table(spark, sf_dir, "documents"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near(table(spark, sf_dir, "documents"))


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.proofs(merkle.manifest(table(spark, sf_dir, "documents")))


QUERIES = {f.__name__: f for f in (op1_packing, op2_neighbours, op3_html_text, op4_quality, op5_mixing, op6_substrings, op7_jaccard, op8_languages, op9_suffix_tree, op10_vafile, op11_alignment, op12_simhash, op13_merkle)}

ORACLE = {
    "op2_neighbours": """
        WITH v AS (
            SELECT vec_id, embedding::DOUBLE[] AS vec FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.vec, c.vec) AS score
            FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 20
    """,
    "op10_vafile": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS vec FROM embeddings
            WHERE vec_id IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.vec, c.vec) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank,
               vec_id, score
        FROM s QUALIFY rank <= 5
    """,
    "op13_merkle": """
        WITH RECURSIVE ids AS (
            SELECT DISTINCT doc_id, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT) AS bytes
            FROM documents WHERE doc_id IS NOT NULL
        ), crcs AS (
            SELECT doc_id, xor(list_reduce(bytes, lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
                lambda a, z: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END, xor(crc, b)), 4294967295), 4294967295) AS crc
            FROM ids
        ), cells AS (
            SELECT d.doc_id, coalesce('=' || source, '') AS src,
                   coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
                   || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
                   coalesce(crc % 5 = 0, false) AS tampered
            FROM documents d LEFT JOIN crcs c ON d.doc_id = c.doc_id
        ), leaves AS (
            SELECT doc_id, src, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN tampered THEN sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) END AS altered
            FROM cells
        ), placed AS (
            SELECT *, row_number() OVER (PARTITION BY src ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY src) AS n FROM leaves
        ), nodes(src, lvl, idx, n, digest) AS (
            SELECT src, 0, idx, n, leaf FROM placed
            UNION ALL
            SELECT src, lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx))
            FROM nodes WHERE n > 1 GROUP BY src, lvl, n, idx // 16
        ), subroots AS (
            SELECT src, digest AS subroot, row_number() OVER (ORDER BY src) - 1 AS idx, count(*) OVER () AS n FROM nodes WHERE n = 1
        ), upper_nodes(lvl, idx, n, digest) AS (
            SELECT 0, idx, n, subroot FROM subroots
            UNION ALL
            SELECT lvl + 1, idx // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY idx)) FROM upper_nodes WHERE n > 1 GROUP BY lvl, n, idx // 16
        ), sides AS (
            SELECT a.src, a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
                   coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
            FROM nodes a JOIN nodes b ON a.src = b.src AND a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY a.src, a.lvl, a.idx
        ), upper_sides AS (
            SELECT a.lvl, a.idx, coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx < a.idx), '') AS l,
                   coalesce(string_agg(b.digest, '' ORDER BY b.idx) FILTER (b.idx > a.idx), '') AS r
            FROM upper_nodes a JOIN upper_nodes b ON a.lvl = b.lvl AND a.idx // 16 = b.idx // 16 WHERE a.n > 1 GROUP BY a.lvl, a.idx
        ), climb(src, idx, lvl, pos, now, proof) AS (
            SELECT src, idx, 0, idx, coalesce(altered, leaf), '' FROM placed
            UNION ALL
            SELECT c.src, c.idx, c.lvl + 1, c.pos // 16, sha256(s.l || c.now || s.r), c.proof || s.l || s.r
            FROM climb c JOIN sides s ON c.src = s.src AND c.lvl = s.lvl AND c.pos = s.idx
        ), upper_climb(src, idx, lvl, pos, now, proof) AS (
            SELECT c.src, c.idx, 0, u.idx, c.now, c.proof
            FROM (SELECT * FROM climb QUALIFY row_number() OVER (PARTITION BY src, idx ORDER BY lvl DESC) = 1) c JOIN subroots u ON c.src = u.src
            UNION ALL
            SELECT c.src, c.idx, c.lvl + 1, c.pos // 16, sha256(s.l || c.now || s.r), c.proof || s.l || s.r
            FROM upper_climb c JOIN upper_sides s ON c.lvl = s.lvl AND c.pos = s.idx
        ), folded AS (
            SELECT * FROM upper_climb QUALIFY row_number() OVER (PARTITION BY src, idx ORDER BY lvl DESC) = 1
        )
        SELECT p.doc_id, p.leaf, u.subroot, r.digest AS root, sha256(f.proof) AS proof_sha256, f.now AS folded_root, f.now = r.digest AS verified
        FROM placed p JOIN folded f ON p.src = f.src AND p.idx = f.idx JOIN subroots u ON p.src = u.src CROSS JOIN (SELECT digest FROM upper_nodes WHERE n = 1) r
    """,
}
