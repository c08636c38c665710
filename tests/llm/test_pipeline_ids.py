"""The pipeline's result holds the sequences themselves."""

from small import frame

import corpus_pipeline
from strata.llm.packing import CAPACITY, END_ID, sequences


def test_sequences_can_be_read_from_the_last_stage(spark):
    docs = frame(spark, [(1, "the house and the garden", "en", "a", 1), (1, "the house", "en", "a", 1)], False)
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, "")
    rows = packed.collect()
    assert all(len(r["ids"]) == r["length"] and r["ids"][-1] == END_ID for r in rows)
    (one,) = sequences(packed).collect()
    assert one["n_ids"] == sum(r["length"] for r in rows) and len(one["ids"]) in (one["n_ids"], CAPACITY)
