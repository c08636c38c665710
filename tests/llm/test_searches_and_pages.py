"""Vector searches against brute force, and page texts."""

import os

import numpy as np
import pytest

from pyspark.sql import functions as F
from strata.llm import neighbours, vafile
from strata.llm.html_text import extract, page_text
from strata.llm.neighbours import Int8


def vectors(spark, seed=3, n=400, dims=12):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims)).astype(np.float32)
    x[50:120] = x[50]  # one vector many times
    x[7] *= 1e-3
    x[8] *= 1e4
    rows = [(i, [float(v) for v in x[i]], 0) for i in range(n)]
    rows[20] = (20, None, 0)
    rows[21] = (21, [0.0] * dims, 0)
    rows[40] = (40, [1.0, None] + [0.0] * (dims - 2), 0)
    rows[41] = (41, [float("nan")] + [0.0] * (dims - 1), 0)
    rows[42] = (42, [float("inf")] + [0.0] * (dims - 1), 0)
    rows += [rows[100], rows[3], (None, rows[4][1], 0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(4)
    return df.select("*", F.lit(1).alias("tile"), F.lit(2).alias("rank"), F.lit(3).alias("score")), {i: v for i, v, _ in rows if i is not None}


def usable(v, zero):
    return v is not None and None not in v and all(np.isfinite(v)) and (zero or any(v))


@pytest.mark.parametrize("blocks", [{}, {"query_block": 5, "candidate_block": 60}])
def test_neighbours_are_exact(spark, blocks):
    df, held = vectors(spark)
    held = {i: np.array(v, dtype=np.float32).astype(float) for i, v in held.items() if usable(v, False)}
    want = []
    for q in (i for i in held if i % 20 == 0):
        scores = sorted(((float(np.add.accumulate(held[q] * held[j])[-1]), j) for j in held if j != q), key=lambda e: (-e[0], e[1]))
        want += [(q, r + 1, j, s) for r, (s, j) in enumerate(scores[:20])]
    got = neighbours.nearest(df, F.col("vec_id") % 20 == 0, 20, **blocks)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert neighbours.nearest(df.limit(0), F.col("vec_id") % 20 == 0, 20).count() == 0
    few = df.filter("vec_id in (0, 1, 2)")
    assert [r["rank"] for r in neighbours.nearest(few, F.col("vec_id") % 20 == 0, 20).orderBy("rank").collect()] == [1, 2]


def test_int8_bounds_hold():
    rng = np.random.default_rng(0)
    x, y = rng.normal(size=(50, 64)) * rng.uniform(0, 100, (50, 1)), rng.normal(size=(80, 64))
    near, off = Int8(x).products(Int8(y), slice(0, 50), slice(0, 80))
    assert (np.abs(x @ y.T - near) <= off).all()
    assert off.max() < 0.1 * np.abs(near).max()


@pytest.mark.parametrize("blocks", [{}, {"query_block": 5, "candidate_block": 60}])
@pytest.mark.parametrize("scale", [1.0, 1e9])
def test_vector_files_are_exact(spark, blocks, scale):
    df, held = vectors(spark)
    df = df.withColumn("embedding", F.transform("embedding", lambda x: (x * scale).cast("float")))
    held = {i: [float(np.float32(c)) * scale for c in v] if usable(v, True) else None for i, v in held.items()}
    held = {i: [int(np.floor(256 * float(np.float32(c)))) for c in v] for i, v in held.items() if v}
    want = []
    for q in (i for i in held if i % 50 == 0):
        exact = ((sum(a * b for a, b in zip(held[q], held[j])), j) for j in held if j != q)
        scores = sorted(((max(min(s, 2**63 - 1), -(2**63)), j) for s, j in exact), key=lambda e: (-e[0], e[1]))
        want += [(q, r + 1, j, s) for r, (s, j) in enumerate(scores[:5])]
    got = vafile.top_k(df, F.col("vec_id") % 50 == 0, 5, **blocks)
    assert sorted(map(tuple, got.collect())) == sorted(want)
    assert vafile.top_k(df.limit(0), F.col("vec_id") % 50 == 0, 5).count() == 0


def test_page_layout():
    html = (
        "<html><head><title>x</title><style>p{}</style></head><body><nav hidden>no</nav><h1>Hi &amp; you</h1><p>a <b>b</b>\n c<p>d<br>e"
        "<ul><li>x<li>y<ul><li>z<li>w</ul><li>v</ul><ol start=3><li>q<li>r</ol>tail"
        "<table><tr><th>N<th>Val<tr><td>long name<td>1<tr><td colspan=2>zz</table><script>var t='</p>'</script>"
        "<span style='display: none'>h</span><pre>  k\n    l</pre>end"
    )
    assert page_text(html) == (
        "Hi & you\n\na b c\n\nd\ne\n\n- x\n- y\n  - z\n  - w\n- v\n\n3. q\n4. r\n\ntail\n\n"
        "N         | Val\nlong name | 1\nzz        |\n\n  k\n    l\n\nend"
    )


def test_broken_pages():
    assert page_text(None) is None and page_text("") == "" and page_text("<!-- only -->") == ""
    assert page_text("</p></li></table><td>x<tr>y") == "xy" or "x" in page_text("</p></li></table><td>x<tr>y")
    assert page_text("<div>" * 50_000 + "deep") == "deep"
    assert "deep" in page_text("<table><tr><td>" * 500 + "deep")
    assert page_text("a < b &lt; c & d") == "a < b < c & d"


def test_every_page_gives_a_row(spark):
    rows = [(1, "u", "<p>a<p>b"), (1, "u", "<p>a<p>b"), (None, None, None), (2, None, "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").select("*", F.lit(1).alias("text"))
    got = sorted(map(tuple, extract(pages).collect()), key=repr)
    assert got == sorted([(1, "u", "a\n\nb"), (1, "u", "a\n\nb"), (None, None, None), (2, None, "")], key=repr)
    assert extract(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["op2_neighbours", "op10_vafile"])
def test_searches_match_sql(spark, name):
    from compare import check, connect

    from strata.llm.queries import ORACLE, QUERIES

    data = f"{os.environ.get('STRATA_TESTDATA', '/root/testdata')}/sf0.001"
    assert check(QUERIES[name](spark, data), connect(data), ORACLE[name]) is None
