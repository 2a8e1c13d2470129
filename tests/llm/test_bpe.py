import random

import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tallyforge.llm import bpe


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.vocabulary_path(), bpe.split_pattern())


@pytest.fixture(scope="module")
def reference(encoder):
    return tiktoken.Encoding("own", pat_str=bpe.split_pattern(), mergeable_ranks=encoder.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.text(max_size=60))
def test_any_text_is_encoded_as_by_the_merges_and_decoded_back(encoder, reference, text):
    text = text.encode("utf-8", "ignore").decode()
    ids = encoder.encode(text)
    assert ids == reference.encode_ordinary(text)
    assert encoder.decode(ids) == text


def test_random_letters(encoder, reference):
    rng = random.Random(3)
    for _ in range(500):
        text = "".join(rng.choice(rng.choice(["ab", "abcde", "aeiouqzt", " \n-=", "theandingr"])) for _ in range(rng.choice([5, 40, 200])))
        assert encoder.encode(text) == reference.encode_ordinary(text)


@pytest.mark.parametrize("text", ["a" * 300_000, "ab" * 100_000, "=" * 200_000, "é" * 50_000, "qzx" * 60_000, " " * 100_000])
def test_very_long_pieces(encoder, text):
    ids = encoder.encode(text)
    assert encoder.decode(ids) == text


def test_table(spark, encoder):
    rows = [(1, "Hello world", "x"), (2, None, None), (3, "", ""), (4, "  ", "y"), (4, "<|endoftext|> 한국어 🙂", "y"), (None, "a", "y")]
    df = spark.createDataFrame(rows, "doc_id int, text string, ids string")
    got = sorted(((r[0], list(r[1])) for r in bpe.encoded(df).collect()), key=repr)
    assert got == sorted(((i, encoder.encode(t)) for i, t, _ in rows), key=repr)
    sizes = {(r[0], r[1]) for r in bpe.counted(df).collect()}
    assert sizes == {(i, len(encoder.encode(t))) for i, t, _ in rows}
    assert bpe.encoded(df.limit(0)).count() == 0


def test_cache_is_bounded(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE", 10)
    encoder.cache.clear()
    encoder.encode(" ".join(f"w{i}" for i in range(100)))
    assert len(encoder.cache) <= 10
