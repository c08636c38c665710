"""Merkle manifest of a dataset: a leaf per row, a tree per source and a tree over the sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import store

FAN = 16
FAN_BITS = 4
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows give the same input."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_of(values: dict[str, Column]) -> Column:
    return digest_of(*(field(v) for v in values.values()))


def leaves(docs: DataFrame) -> DataFrame:
    """(grp, doc_id, digest, altered, row) of every row; ``altered`` is the leaf of a tampered row.

    ``grp`` is the source with a mark before it, which keeps its order and sorts a null first.
    """
    values = {c: F.col(c).cast("long" if c in ("doc_id", "n_chars") else "string") for c in COLUMNS}
    chosen = F.crc32(values["doc_id"].cast("string").cast("binary")) % 5 == 0
    altered = F.when(chosen, leaf_of(values | {"text": F.translate(values["text"], UPPER, LOWER)}))
    grp = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit(""))
    found = docs.select(grp.alias("grp"), values["doc_id"].alias("doc_id"), leaf_of(values).alias("digest"), altered.alias("altered"))
    return store(found.withColumn("row", F.monotonically_increasing_id()), "merkle")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Add each row's place ``idx`` in its ``grp`` by ``order``, which no two rows may share, and the group's size ``n``.

    Rows are dealt by ranges of the order, so a group of any size lies in many tasks; only
    a row per task and group is summed up in a window.
    """
    by = ["grp", *order]
    ranged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("at", F.monotonically_increasing_id())
    ranged = store(ranged, "merkle").withColumn("part", F.shiftright("at", 33))
    spans = ranged.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("rows"))
    of_group = Window.partitionBy("grp")
    before = F.sum("rows").over(of_group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.select("grp", "part", "first", F.coalesce(before, F.lit(0)).alias("before"), F.sum("rows").over(of_group).alias("n"))
    idx = F.col("before") + F.col("at") - F.col("first")
    return ranged.join(spans, ["grp", "part"]).withColumn("idx", idx).drop("at", "part", "first", "before")


def siblings(nodes: DataFrame) -> DataFrame:
    """Add to each node its run of 16, its slot there, and the digests to its left and right joined in order.

    Lag and lead columns of fixed offsets, masked by the slot and by the length of the run.
    """
    run, slot = F.shiftright("idx", FAN_BITS), F.col("idx") % FAN
    rows = nodes.withColumns({"run": run, "slot": slot, "length": F.least(F.lit(FAN), F.col("n") - run * FAN)})
    in_run = Window.partitionBy("grp", "run").orderBy("idx")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(in_run)) for k in range(FAN - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("length"), F.lead("digest", k).over(in_run)) for k in range(1, FAN)]
    return rows.withColumns({"left": F.concat_ws("", *left), "right": F.concat_ws("", *right)}).drop("length")


def parents(nodes: DataFrame) -> DataFrame:
    """(grp, idx, n, digest) of the level above: the first child of each run hashes the run."""
    first = siblings(nodes.select("grp", "idx", "n", "digest")).filter("slot = 0")
    above = F.shiftright(F.col("n") + (FAN - 1), FAN_BITS)
    return first.select("grp", F.col("run").alias("idx"), above.alias("n"), digest_of(F.col("digest"), F.col("right")).alias("digest"))


def levels(nodes: DataFrame) -> list[DataFrame]:
    """All levels from ``nodes`` (grp, idx, n, digest, ...) up; a group ends where it has one node."""
    found, most = [nodes], nodes.agg(F.max("n")).first()[0] or 0
    while most > 1:
        found.append(store(parents(found[-1].filter("n > 1")), "merkle"))
        most = -(-most // FAN)
    return found


def tops(tree: list[DataFrame]) -> DataFrame:
    """(grp, digest): the one node in which each group ends."""
    found = tree[0].filter("n = 1").select("grp", "digest")
    for level in tree[1:]:
        found = found.unionAll(level.filter("n = 1").select("grp", "digest"))
    return found


def paths(tree: list[DataFrame], above: DataFrame) -> DataFrame:
    """The lowest level with what ``above`` (grp, path, ...) has for the group and the path from each node up.

    A path is the digests to the left and right, level by level. It is put together from
    the top down, so the upper part is held once per run and not once per row.
    """
    held, extra = None, [c for c in above.columns if c not in ("grp", "path")]
    for depth, level in reversed([*enumerate(tree)]):
        found = level.filter("n = 1").join(above, "grp").select(*level.columns, "path", *extra)
        if held is not None:
            upper = held.select("grp", F.col("idx").alias("run"), F.col("path").alias("rest"), *extra)
            here = F.array(F.struct("left", "right"))
            below = siblings(level.filter("n > 1")).join(upper, ["grp", "run"])
            found = found.unionAll(below.select(*level.columns, F.concat(here, "rest").alias("path"), *extra))
        held = store(found, "merkle") if depth > 1 else found
    return held


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and the digests on its path give."""
    return F.aggregate(path, leaf, lambda now, p: digest_of(p["left"], now, p["right"]))


def manifest(docs: DataFrame) -> DataFrame:
    """Leaf, subroot, root and path of every row, and the leaf of its tampered version.

    Returns doc_id, leaf, altered (null where nothing was tampered with), subroot, root and
    path, an array of (left, right). Rows of one source ascend by ``doc_id``, a null id
    first, and rows of one id by their leaf; a null source is a source of its own, an empty
    one another. Repeated rows are leaves of their own, side by side, and have proofs of
    their own. A null id is never tampered with. An empty table gives no rows. Only the
    columns of COLUMNS are read, so others may have any name; a text of any length is
    hashed where it lies and does not travel.
    """
    rows = numbered(leaves(docs), "doc_id", "digest", "row").drop("row")
    tree = levels(rows)
    sources = tops(tree).select(F.lit("").alias("grp"), F.col("grp").alias("of"), "digest")
    source_tree = levels(numbered(sources, "of"))
    nowhere = F.array().cast("array<struct<left:string,right:string>>")
    root = tops(source_tree).select("grp", nowhere.alias("path"), F.col("digest").alias("root"))
    above = paths(source_tree, root).select(F.col("of").alias("grp"), "path", F.col("digest").alias("subroot"), "root")
    return paths(tree, store(above, "merkle")).select("doc_id", F.col("digest").alias("leaf"), "altered", "subroot", "root", "path")


def proofs(rows: DataFrame) -> DataFrame:
    """The manifest with its proofs hashed and folded: what a reader checks of each row."""
    proof = F.sha2(F.array_join(F.transform("path", lambda p: F.concat(p["left"], p["right"])), ""), 256)
    rows = rows.withColumns({"proof_sha256": proof, "folded_root": folded(F.coalesce("altered", "leaf"), F.col("path"))})
    return rows.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))
