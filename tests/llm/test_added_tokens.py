"""Packed ids against ``tokenizers`` as the contract calls it, on texts that hold the added token literally."""

import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from daymark.llm import packing, queries

TEXTS = ["a doc <|endoftext|> next", "<|endoftext|>", "<|endoftext|><|endoftext|> x", "word <|endoftext|>", "two  spaces \n<|endoftext|>  three more words",
         "<|endoftext|", "<|<|endoftext|>|>", "one two three<|endoftext|>four five six", "no literal in this one"]


def test_packed_ids_with_the_added_token(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = packing.pack_documents(spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string"), *queries.tokenizer_files()).collect()
    got = {r["doc_id"]: (r["start"], r["length"], r["doc_tokens"], r["ids_crc32"]) for r in rows}
    for i, text in enumerate(TEXTS):
        ids = tokenizer.encode(text, add_special_tokens=False).ids + [0]
        assert got[i] == (0, len(ids), len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), text
