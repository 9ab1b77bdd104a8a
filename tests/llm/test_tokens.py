"""Token counts against another library with the same vocabulary."""

import pytest

from reckon.llm.tokens import sized


def test_counts_match_the_other_library(spark):
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file("/opt/tokenizers/byte_bpe_50k.json")
    t.encode_special_tokens = True
    texts = [None, "", "Hello  world", "it's 12345\n\n x", "Grüße… ¿qué?", "<|endoftext|>", "\u0000\t", "日本語テキスト", " " * 50_000, "a" * 300_000, "word " * 50_000]
    rows = sized(spark.createDataFrame([(i, x, 7) for i, x in enumerate(texts)], "id int, text string, n_tokens_ int"), text="text", carry=["id"]).collect()
    assert [r.n_tokens for r in sorted(rows)] == [len(t.encode(x, add_special_tokens=False).ids) if x else 0 for x in texts]


def test_empty_table(spark):
    assert sized(spark.createDataFrame([], "id int, text string"), text="text", carry=["id"]).count() == 0
