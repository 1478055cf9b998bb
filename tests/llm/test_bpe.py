import hashlib
import random

import public_tokenizers
import pytest
import tiktoken
from cases import SCHEMA, documents, frame

from celltide.llm import bpe


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.read_ranks())


@pytest.fixture(scope="module")
def reference(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(codec.tokens)}, special_tokens={}
    )


def random_texts():
    r = random.Random(11)
    spaces = [" ", "  ", "\n", "\t", "\r\n", " ", " ", "\x1c", "\x1f", "\x85", "​", " ", "\x00"]
    parts = ["the", "Hello", "'s", "'LL", "12", "４", "é", "日本", "\U0001f600", "é", "---", "___", "½", "١", "ſ", "�", "▁", "<unk>", "<s>"]
    for _ in range(400):
        yield "".join(r.choice(parts + spaces) for _ in range(r.randrange(30)))
    for _ in range(200):
        yield "".join(chr(r.choice([r.randrange(32, 127), r.randrange(0x80, 0x800), r.randrange(0x4E00, 0x5000), r.randrange(0x1F300, 0x1F700)])) for _ in range(50))


def test_every_code_point_below_the_surrogates(codec, reference):
    for start in range(0, 0xD800, 64):
        text = " a".join(map(chr, range(start, start + 64)))
        assert codec.encode(text).tolist() == reference.encode_ordinary(text), hex(start)


def test_ids_equal_tiktoken_and_round_trip(codec, reference):
    for text in [*random_texts(), *(t or "" for _, t, *_ in documents())]:
        ids = codec.encode(text)
        assert ids.tolist() == reference.encode_ordinary(text), repr(text)
        assert codec.decode(ids) == text.encode()


def test_very_long_text_goes_in_parts(codec, reference, monkeypatch):
    monkeypatch.setattr(bpe, "_CHARS_AT_ONCE", 1000)
    monkeypatch.setattr(bpe, "_PIECES_AT_ONCE", 7)
    text = next(t for _, t, *_ in documents() if t and len(t) > 100_000)
    assert codec.encode(text).tolist() == reference.encode_ordinary(text)


def test_every_token_has_its_rank_as_id(codec):
    assert [int(codec._merges.ranks[t]) for t in codec.tokens] == list(range(len(codec.tokens)))


def test_model_needs_all_bytes():
    with pytest.raises(ValueError):
        bpe.model_bytes([b"a", b"b"])


def test_columns_round_trip_and_digests(spark, codec, reference):
    df = frame(spark).withColumnRenamed("lang", "N_Tokens").withColumnRenamed("source", "decoded")
    rows = bpe.decode(bpe.encode(df, codec), codec).collect()
    assert len(rows) == len(documents())
    for r in rows:
        want = reference.encode_ordinary(r.text or "")
        assert r.ids == want and r.n_tokens == len(want) and bytes(r.decoded) == (r.text or "").encode()
    digests = bpe.digests(df, codec).collect()
    expect = sorted(
        (str(i), len(x := reference.encode_ordinary(t or "")), hashlib.sha256(",".join(map(str, x)).encode()).hexdigest(),
         hashlib.sha256((t or "").encode()).hexdigest()) for i, t, *_ in documents()
    )
    assert sorted((str(r[0]), *r[1:]) for r in digests) == expect


def test_empty_table_and_null_ids(spark, codec):
    empty = spark.createDataFrame([], SCHEMA)
    assert bpe.encode(empty, codec).collect() == [] and bpe.digests(empty, codec).collect() == []
    nulls = spark.createDataFrame([(None,), ([],)], "ids array<int>")
    assert [r.decoded for r in bpe.decode(nulls, codec).collect()] == [None, b""]
