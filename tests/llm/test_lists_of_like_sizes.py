"""Near duplicates on a table so large that the sketch tells no rare shingle from a common one."""

import numpy as np
import pytest
from small import frame, plain
from test_documents import linked

from strata.llm import jaccard


@pytest.fixture
def no_rarity(monkeypatch):
    monkeypatch.setattr(jaccard, "rarity", lambda scanned: np.zeros(jaccard.SKETCH, dtype=np.uint8))


def rows_of_many_sizes():
    """A passage in sets of 70 sizes, no two of like size similar; and near copies of some."""
    passage, rows = [f"p{i}" for i in range(60)], []
    for i in range(70):
        own = [f"own{i}-{j}" for j in range(int(40 * 1.05**i))]
        rows.append((i, " ".join(passage + own), None, None, None))
        if i % 10 == 3:
            rows.append((100 + i, " ".join(passage + own[: len(own) * 19 // 20]), None, None, None))
            rows.append((200 + i, " ".join(["new", *passage, *own, "more"]), None, None, None))
    return rows


def test_a_common_passage_makes_no_crowd_of_sets_of_all_sizes(spark, monkeypatch, no_rarity):
    members, links = [], jaccard.crowd_links
    monkeypatch.setattr(jaccard, "crowd_links", lambda crowd, *rest: members.append(crowd.count()) or links(crowd, *rest))
    rows = rows_of_many_sizes()
    got = jaccard.join(frame(spark, rows, False), 4, 85)
    assert plain(got.select("doc_id", "n_shingles", "component_id").collect()) == plain(linked(rows, 4, 85))
    assert members == [0]


@pytest.mark.parametrize("percent", [50, 85])
def test_sizes_at_the_edge_of_a_band_meet(spark, monkeypatch, no_rarity, percent):
    """Subsets and supersets at exactly the similarity, on lists alone."""
    monkeypatch.setattr(jaccard, "boundary", lambda sizes, percent: 0)
    starts, rows = [int(s) for s in jaccard.bands(percent) if 20 <= s <= 700][::3], []
    for s in starts:
        for size in (s - 1, s, s + 1, s * 100 // percent, s * 100 // percent + 1):
            rows.append((len(rows), " ".join(f"s{s}w{i}" for i in range(size)), None, None, None))
    got = jaccard.join(frame(spark, rows, False), 1, percent)
    assert plain(got.select("doc_id", "n_shingles", "component_id").collect()) == plain(linked(rows, 1, percent))


def test_long_lists_go_on_over_batches(spark, monkeypatch, no_rarity):
    rows = rows_of_many_sizes()
    want = plain(linked(rows, 4, 85))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        got = jaccard.join(frame(spark, rows, False), 4, 85, long_list=7)
        assert plain(got.select("doc_id", "n_shingles", "component_id").collect()) == want
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
