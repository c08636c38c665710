import random

import pytest
from pyspark.sql import functions as F

from strata.functions import scalars as fx
from strata.operators import documents, grids, policy
from strata.operators.partitions import dispatch

RISK = [(1, "Active", 1499.0), (2, "Maintenance", 2500.0), (3, None, None)]


def governed(spark, groups):
    df = spark.createDataFrame(RISK, "id int, site_status string, cost double")
    seen = policy.apply_policy(
        df,
        masks={"cost": policy.mask_total_cost("cost", groups)},
        row_filter=policy.filter_by_site_status("site_status", groups),
    )
    return [(r["id"], r["cost"]) for r in seen.orderBy("id").collect()]


def test_policy_by_group(spark):
    assert governed(spark, set()) == [(1, 1000.0)]
    assert governed(spark, {"finance"}) == [(1, 1499.0)]
    assert governed(spark, {"mining_ops"}) == [(1, 1000.0), (2, 3000.0), (3, None)]


def test_policy_as_view_and_sql_functions(spark):
    policy.register_policy_functions(spark)
    df = spark.createDataFrame(RISK, "id int, site_status string, cost double")
    policy.publish_view(policy.apply_policy(df, {"cost": policy.mask_total_cost("cost", ())}), "governed_risk")
    assert spark.table("governed_risk").agg(F.sum("cost")).first()[0] == 4000.0
    row = spark.sql(
        "SELECT mask_total_cost(1499D, true) a, mask_total_cost(1499D, false) b,"
        " filter_by_site_status(NULL, false) c, filter_by_site_status('Maintenance', true) d"
    ).first()
    assert tuple(row) == (1499.0, 1000.0, False, True)


def python_chunks(text, size, overlap):
    words = text.split()
    starts, at = [], 0
    while words:
        starts.append(" ".join(words[at : at + size]))
        if at + size >= len(words):
            break
        at += size - overlap
    return starts


@pytest.mark.parametrize("size,overlap", [(500, 100), (5, 2), (3, 0)])
def test_chunks_equal_the_model(spark, size, overlap):
    rng = random.Random(size)
    texts = ["", " \n\t ", "one", "  padded  words\n"] + [
        rng.choice([" ", "\n"]).join(f"w{rng.randrange(50)}" for _ in range(n))
        for n in (size - 1, size, size + 1, 2 * size - overlap, 7 * size + 3)
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "doc int, text string")
    chunks = documents.chunk_text(df, "doc", "text", size, overlap)
    got = {}
    for r in chunks.orderBy("path", "position").collect():
        got.setdefault(r["path"], []).append(r["content"])
    assert got == {i: c for i, t in enumerate(texts) if (c := python_chunks(t, size, overlap))}
    assert chunks.select("chunk_id").distinct().count() == chunks.count()


def test_index_sync_embeds_only_what_changed(spark):
    old = spark.createDataFrame([("a", "one"), ("b", "two"), ("c", "three")], "chunk_id string, content string")
    new = spark.createDataFrame([("a", "one"), ("b", "TWO"), ("d", "four")], "chunk_id string, content string")
    todo = documents.chunk_changes(old, new)
    assert sorted(tuple(r) for r in todo.collect()) == [
        ("b", "update_postimage"), ("c", "delete"), ("d", "insert"),
    ]
    index = old.withColumn("vector", F.array(F.lit(0.0)))
    embed = lambda fresh: fresh.withColumn("vector", F.array(F.lit(1.0)))
    synced = documents.sync_chunks(index, new, todo, embed)
    assert sorted((r["chunk_id"], r["content"], r["vector"][0]) for r in synced.collect()) == [
        ("a", "one", 0.0), ("b", "TWO", 1.0), ("d", "four", 1.0),
    ]


def test_similarity_equals_brute_force(spark):
    rng = random.Random(1)
    vectors = [(i, [rng.uniform(-1, 1) for _ in range(8)]) for i in range(200)]
    vectors += [(900, vectors[0][1]), (901, [0.0] * 8)]
    query = [rng.uniform(-1, 1) for _ in range(8)]

    def cosine(v):
        length = sum(x * x for x in v) ** 0.5
        return sum(a * b for a, b in zip(v, query)) / length if length else float("-inf")

    want = [i for i, _ in sorted(vectors, key=lambda r: (-cosine(r[1]), r[0]))][:7]
    df = spark.createDataFrame(vectors, "id int, v array<double>")
    assert [r["id"] for r in documents.similar_topk(df, "id", "v", query, 7).collect()] == want
    with pytest.raises(ValueError):
        documents.similar_topk(df, "id", "v", [0.0] * 8)


def test_page_text(spark):
    html = (
        "<!DOCTYPE html><head><style>p{}</style><SCRIPT type='x'>var t='</p>';\n</SCRIPT ></head>"
        "<!-- <b>no</b> --><p>Fish &amp; chips&nbsp;&lt;5&gt;</p>\n<p>&amp;lt; stays</p>"
    )
    df = spark.createDataFrame([(html,)], "html string")
    assert df.select(documents.page_text("html")).first()[0] == "Fish & chips <5> &lt; stays"


def test_scalars(spark):
    df = spark.createDataFrame([("  John O'Brien--Élan ", 10.0, 0)], "name string, a double, b int")
    row = df.select(fx.slugify("name"), fx.safe_ratio(F.col("a"), F.col("b"))).first()
    assert row[0] == "john_o_brien_lan" and row[1] is None
    events = spark.createDataFrame([('{"k": 5}',), ('{"k": "x"}',), ("broken",)], "p string")
    assert [r[0] for r in events.select(fx.json_path("p", "$.k", "int")).collect()] == [5, None, None]
    assert [r[0] for r in events.select(fx.variant_path("p", "$.k", "int")).collect()] == [5, None, None]
    pages = spark.createDataFrame([('{"document": {"pages": [1, 2, 3]}}',)], "p string")
    assert pages.select(fx.json_size("p", "$.document.pages")).first()[0] == 3


def test_dispatch_runs_one_task_per_id(spark):
    def work(batches):
        for pdf in batches:
            yield pdf

    assert sorted(r["id"] for r in dispatch(spark, 8, work, "id long").collect()) == list(range(8))
    assert dispatch(spark, 8, work, "id long").rdd.getNumPartitions() == 8


def test_peer_rule(spark):
    members = spark.createDataFrame([("a",), ("b",), ("c",)], "m string")
    assert [r["readers"] for r in grids.peer_access(members, "m").collect()] == [2, 2, 2]
    pair = spark.createDataFrame([("a", "a"), ("a", "b")], "o string, v string")
    assert [r[0] for r in pair.select(grids.may_read("o", "v")).collect()] == [False, True]


def test_vectors_of_another_length_stop_the_search(spark):
    df = spark.createDataFrame([(1, [1.0, 0.0, 5.0], "a"), (2, [1.0, 0.0], "b"), (3, None, "c")], "id long, v array<double>, path string")
    found = documents.similar_topk(df.filter("id > 1"), "id", "v", [1.0, 0.0], 2, columns=["path"]).collect()
    assert [(r["id"], r["path"], r["score"]) for r in found] == [(2, "b", 1.0), (3, "c", None)]
    with pytest.raises(Exception, match="length"):
        documents.similar_topk(df, "id", "v", [1.0, 0.0]).collect()
