import pytest
from pyspark.sql import functions as F

from bitextloom.functions import (
    Limits,
    Tokenizer,
    byte_tokenizer,
    estimate_request_tokens,
    estimate_tokens,
    has_special_token,
    parse_retry_after,
    prompt_base_tokens,
    rate_limit_wait,
    resolve_limits,
    retry_delay,
    shard_name,
    shard_number,
    special_token_names,
    text_class,
    token_count,
)
from bitextloom.functions.retry import rate_limited, wait_from_message


def column(df, value):
    return [row[0] for row in df.select(value).collect()]


def test_estimate_tokens_counts_utf8_bytes(texts):
    df = texts(None, "", "a", "abc", "abcdef", "é" * 3, "日本語" * 2)
    assert column(df, estimate_tokens(F.col("text"))) == [0, 0, 1, 1, 2, 2, 6]


def test_request_tokens_start_from_the_prompt(texts):
    assert prompt_base_tokens() == 234
    assert column(texts("x", ""), estimate_request_tokens(F.col("text"))) == [4331, 4330]


MESSAGES = {
    "please try again in 250ms": 0.25,
    "TRY AGAIN IN 1.5s": 1.5,
    "try again in 1m2s": None,
    "try again in 2s, or try again in 30ms": 0.03,
    "try again in 1.2.3s": None,
    "no hint": None,
}


def test_retry_after_messages(spark):
    df = spark.createDataFrame([(m,) for m in MESSAGES], "m string")
    assert column(df, parse_retry_after(F.col("m"))) == list(MESSAGES.values())
    waits = column(df, rate_limit_wait(F.col("m")))
    assert waits == [wait or 1.0 for wait in MESSAGES.values()]
    assert waits == [wait_from_message(m) for m in MESSAGES]


def test_zero_wait_means_one_second(spark):
    df = spark.createDataFrame([("try again in 0ms",), ("try again in 0s",)], "m string")
    assert column(df, rate_limit_wait(F.col("m"))) == [1.0, 1.0]
    assert wait_from_message("try again in 0ms") == 1.0


def test_rate_limit_messages():
    assert rate_limited("Rate Limit reached") and rate_limited("code 429")
    assert not rate_limited("timeout") and not rate_limited(ValueError("timeout"))
    assert rate_limited(type("RateLimitError", (Exception,), {})("slow down"))


def test_retry_delay_ends_after_three_tries(spark):
    assert column(spark.range(4), retry_delay(F.col("id"))) == [0.5, 1.0, None, None]


@pytest.mark.parametrize(
    "arguments, expected",
    [
        ({"tier": "3"}, Limits(5000, 4_000_000)),
        ({"tier": "9"}, Limits(500, 200_000)),
        ({"tier": "1", "rpm": 7, "env_rpm": "9"}, Limits(7, 200_000)),
        ({"tier": "1", "env_rpm": "9", "env_tpm": "many"}, Limits(9, 200_000)),
        ({"tier": "2", "rpm": 0, "env_rpm": "9"}, Limits(5000, 2_000_000)),
        ({"tier": "2", "rpm": -5}, Limits(1, 2_000_000)),
    ],
)
def test_resolve_limits(arguments, expected):
    assert resolve_limits(**arguments) == expected


def test_special_token_names_and_pattern(spark):
    names = special_token_names()
    assert len(names) == len(set(names)) == 10 + 2 + 1 + 3 + 1075
    for name in ("<|reserved_200013|>", "<|reserved_201087|>", "<|endofprompt|>"):
        assert name in names
    near = ["<|reserved_200012|>", "<|reserved_201088|>", "<|End|>", "<|end|", "< |end|>", "<|reserved_20001|>"]
    df = spark.createDataFrame([(f"a {name} b",) for name in names + near] + [(None,)], "t string")
    assert column(df, has_special_token(F.col("t"))) == [True] * len(names) + [False] * (len(near) + 1)


def test_text_classes_are_exclusive(texts):
    df = texts(None, "", "<|end|>", "fine")
    assert column(df, text_class(F.col("text"))) == ["missing", "empty", "special", "ok"]


def test_token_count(texts):
    df = texts(None, "", "abc", "日本", "the thumb", "stop <|end|>")
    assert column(df, token_count(F.col("text"), byte_tokenizer())) == [None, 0, 3, 6, 9, -1]
    assert column(df, token_count(F.col("text"), byte_tokenizer([b"th"]))) == [None, 0, 3, 6, 7, -1]
    assert byte_tokenizer([b"the", b"th"]).longest_token_bytes() == 3


def test_token_count_from_a_rank_file(spark, texts, tmp_path):
    import base64

    ranks = [bytes([b]) for b in range(256)] + [b"ab", b"abc"]
    lines = [f"{base64.b64encode(token).decode()} {rank}" for rank, token in enumerate(ranks)]
    file = tmp_path / "tiny.ranks"
    file.write_text("\n".join(lines) + "\n")
    tokenizer = Tokenizer(name="tiny", rank_file=str(file), pattern=r"\S+|\s+")
    assert column(texts("abc ab x"), token_count(F.col("text"), tokenizer)) == [5]
    spark.sparkContext.addFile(str(file))
    shipped = Tokenizer(name="tiny", rank_file="tiny.ranks", pattern=r"\S+|\s+", special_names=("<s>",))
    assert column(texts("abcab", "a<s>", "<|end|>"), token_count(F.col("text"), shipped)) == [2, -1, 7]


def test_shard_names(spark):
    df = spark.createDataFrame([("p", 3), ("p", 123456)], "p string, n int")
    assert column(df, shard_name(F.col("p"), F.col("n"))) == ["p-00003.parquet", "p-123456.parquet"]
    names = ["p-00007.parquet", "p-x.parquet", "q-00009.parquet", "p-1.json", "p-q-3.parquet"]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    assert column(df, shard_number(F.col("n"), "p")) == [7, None, None, None, None]
