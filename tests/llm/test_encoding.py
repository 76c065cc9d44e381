"""The ranks' ids are those of ``tokenizers``."""

import sys

import public_tokenizers
from tokenizers import Tokenizer

from tidemark.llm.encoding import encode


def reference():
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_every_code_point():
    xs = [f"ab{c}{c} 1{c}9 .{c}? {c}x  {c}  " for c in map(chr, range(sys.maxunicode + 1)) if not 0xD800 <= ord(c) < 0xE000]
    for i in range(0, len(xs), 50_000):
        part = xs[i : i + 50_000]
        assert [e.ids for e in reference().encode_batch_fast(part, add_special_tokens=False)] == [encode(x).tolist() for x in part]


def test_odd_texts(spark, sf):
    texts = [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    texts += ["", "<|endoftext|>", "a<|endoftext|>b <|endoftext|><|endoftext", "<|endoftext |>", " " * 5000, "\n" * 3000, "don't we'll", "a" * 9000, "日本語 テキスト", "é‍"]
    t = reference()
    assert all(encode(x).tolist() == t.encode(x, add_special_tokens=False).ids for x in texts)
    assert encode("a<|endoftext|>b").tolist() == [64, 50256, 65]
    assert encode(None).tolist() == []
    assert len(encode(" " * 2_000_000)) > 0
