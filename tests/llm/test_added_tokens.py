"""Token ids against the tokenizer file as it is, added tokens included."""

import public_tokenizers
from small import frame
from tokenizers import Tokenizer

from strata.llm import packing


def test_added_tokens_have_their_own_ids(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>  \n", "<|endoftext| > plain", "  two  <|endoftext|>\t\tend  ", "no token"]
    rows = [(i, t, None, None, None) for i, t in enumerate(texts)]
    got = {p["doc_id"]: p["ids"] for p in packing.pieces(frame(spark, rows, False), keep_ids=True).collect()}
    assert got[0] == [64, 220, 50256, 275, 1]
    for i, text in enumerate(texts):
        assert got[i] == [*tokenizer.encode(text, add_special_tokens=False).ids, 1]
