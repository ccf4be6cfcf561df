"""Counts over distinct words equal those of the encoder on whole texts."""

import pytest
from pyspark.sql import functions as F

from bitextloom.functions import Tokenizer, byte_tokenizer, token_count
from bitextloom.operators import token_counts, word_table

TEXTS = (
    None, "", " ", "abc ab  x\n", "the thumb the", "stop <|end|>", "日本 語　x", "a b c\u0085d", "don't DON'T ſs 'ſ",
    "12345 6\t\r\n\n  end ", "é é \U0001f642\U0001f642", "x" * 5000, "٣٤٥ Ⅻ ǅ ʰ", "\x00 \x1c\x1f z", "a_b  c__", "ab " * 3000,
)


def public_tokenizer():
    tokenizers = pytest.importorskip("public_tokenizers")
    return Tokenizer(name="public", rank_file=tokenizers.path("byte_bpe_50k.tiktoken"), pattern=tokenizers.PATTERN, special_names=("<|end|>",))


def both(df, tokenizer):
    fast = token_counts(df, ("row_id",), tokenizer)
    plain = df.select("row_id", token_count(F.col("text"), tokenizer).alias("n_tokens"))
    return sorted(map(tuple, fast.collect())), sorted(map(tuple, plain.collect()))


@pytest.mark.parametrize("broadcast", [True, False])
def test_awkward_texts(texts, monkeypatch, broadcast):
    if not broadcast:
        monkeypatch.setattr("bitextloom.operators.word_tokens.BROADCAST_WORDS", 3)
    for tokenizer in (byte_tokenizer(), byte_tokenizer([b"th", b"ab", b"abc"]), public_tokenizer()):
        fast, plain = both(texts(*TEXTS), tokenizer)
        assert fast == plain and len(fast) == len(TEXTS)


def test_a_whole_table_and_repeated_keys(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select(F.col("doc_id").alias("row_id"), "text")
    fast, plain = both(docs.union(docs), public_tokenizer())
    assert fast == plain and len(fast) == 2 * docs.count()
    assert token_counts(docs.limit(0), ("row_id",), byte_tokenizer()).count() == 0


def test_the_encoder_sees_each_word_once(texts):
    words = word_table(texts(*["a b a b"] * 50, "b c"), "text", byte_tokenizer())
    assert sorted(r["_word"] for r in words.collect()) == [" ", "a", "b", "c"]
    plan = token_counts(texts("a b"), ("row_id",), byte_tokenizer())._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "BroadcastHashJoin" in plan


def test_a_refused_word_fails_its_text(texts):
    class Refusing(Tokenizer):
        def load(self):
            class Encoding:
                @staticmethod
                def encode_ordinary(word):
                    if word == "bad":
                        raise ValueError(word)
                    return [0] * len(word)

            return Encoding

    tokenizer = Refusing(name="refusing", merges=())
    counts = token_counts(texts("good", "so bad", None), ("row_id",), tokenizer).collect()
    assert sorted(map(tuple, counts)) == [(0, 4), (1, -1), (2, None)]


def test_a_frequent_word_is_not_shuffled(texts, monkeypatch):
    """Beyond the limit of the broadcast the frequent words still are broadcast, and the others alone are joined by shuffle."""
    from bitextloom.operators.word_tokens import frequent_from

    monkeypatch.setattr("bitextloom.operators.word_tokens.BROADCAST_WORDS", 3)
    values = [f"the w{i} the the v{i}" for i in range(40)]
    assert frequent_from(word_table(texts(*values), "text", byte_tokenizer())) == 2
    fast, plain = both(texts(*values, None, "", "the the", "w1 w1"), byte_tokenizer([b"th"]))
    assert fast == plain and len(fast) == 44
    plan = token_counts(texts(*values), ("row_id",), byte_tokenizer())._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "_rare" in plan
