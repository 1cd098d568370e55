import base64
import hashlib

import public_tokenizers
import pytest
import tiktoken

from cartograph.llm.bpe import Codec, byte_characters, decode, encode, ids_digest, read_ranks, serialise
from tests.llm.helpers import CLASHES, EDGE, documents

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(PATH, "rb"))}
    return tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return Codec(serialise(read_ranks(PATH)), PATTERN)


def ids_of(codec, text):
    return memoryview(codec.encode(text)).cast("i").tolist()


def test_bytes_have_their_own_characters():
    assert len(set(byte_characters())) == 256


def test_every_token_is_its_own_id(codec):
    assert codec.whole == {}


def test_split_and_merges_agree_over_unicode(codec, reference):
    for low in range(0, 0x30000, 1024):
        text = "".join(f"a{chr(c)}b {chr(c)}1 ,{chr(c)}" for c in range(low, low + 1024) if not 0xD800 <= c < 0xE000)
        assert ids_of(codec, text) == reference.encode_ordinary(text), hex(low)


def test_cache_keeps_its_bound(codec, reference, monkeypatch):
    import cartograph.llm.bpe as bpe
    monkeypatch.setattr(bpe, "CACHE", 8)
    text = " ".join(f"w{i % 37}x" for i in range(500))
    assert ids_of(codec, text) == reference.encode_ordinary(text)
    assert len(codec.known) <= 8


def test_long_text_in_pieces(codec, reference, monkeypatch):
    import cartograph.llm.bpe as bpe
    monkeypatch.setattr(bpe, "AT_ONCE", 50)
    text = "some words   and\n\nlines, " * 40
    assert ids_of(codec, text) == reference.encode_ordinary(text)


def test_round_trip_over_edges(spark, reference):
    docs = documents(spark, clashes=True)
    got = decode(encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert set(got.columns) == {*docs.columns, "ids", "decoded"}
    rows = got.withColumn("digest", ids_digest()).collect()
    assert len(rows) == len(EDGE)
    for r in rows:
        want = reference.encode_ordinary(r.text or "")
        assert r.ids == want and bytes(r.decoded) == (r.text or "").encode()
        assert r.digest == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        assert all(r[c] == "clash" for c in CLASHES if c not in ("ids", "decoded"))


def test_empty_table(spark):
    got = decode(encode(documents(spark, []), PATH, PATTERN), PATH, PATTERN)
    assert got.count() == 0 and got.schema["ids"].dataType.simpleString() == "array<int>"


def test_null_ids_decode_to_nothing(spark):
    got = decode(spark.createDataFrame([(None,), ([],)], "ids array<int>"), PATH, PATTERN)
    assert {bytes(r.decoded) for r in got.collect()} == {b""}
