import random
from base64 import b64encode
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from marquee.llm import bpe
from marquee.llm.bpe import Codec, decode_ids, encode_texts, merge, read_vocabulary
from marquee.llm.registered import QUERIES

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
SCHEMA = "doc_id long, text string, Token_IDS string, lang string"


@pytest.fixture(scope="module")
def codec():
    return Codec(read_vocabulary(PATH), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def other(codec):
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.ranks, special_tokens={}
    )


def test_random_texts(codec, other):
    r = random.Random(1)
    signs = ["a", "B", "the", " ", "  ", "\n", "\t", " ", "　", "'s", "'", "7", "½", "ß", "́", "漢", "字", "🙂", "\x1c", "\x85", "<|endoftext|>", "՘", "\U00010940"]
    for _ in range(3000):
        text = "".join(r.choice(signs) * r.choice([1, 1, 1, 2, 9]) for _ in range(r.randrange(30)))
        ids = codec.encode(text)
        assert ids.tolist() == other.encode_ordinary(text)
        assert codec.decode(ids) == text.encode()


def test_every_code_point(codec, other):
    """Letters, numbers and white space are those of the library, whatever Unicode is current."""
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(f"a{c}1{c}" for c in points)
    assert codec.encode(text).tolist() == other.encode_ordinary(text)


def test_long_pieces_and_chunks(codec, other, monkeypatch):
    r = random.Random(2)
    long = "".join(r.choice("abcdeé") for _ in range(60000))
    for text in (long, "a" * 50000, " " * 50000, "=" * 30000 + "x", " \n" * 20000):
        assert codec.encode(text).tolist() == other.encode_ordinary(text)
    monkeypatch.setattr(bpe, "CHUNK_CHARS", 5)
    monkeypatch.setattr(bpe, "REMEMBERED", 3)
    text = "it's  two\n\n words \t and 12 more,  at the end   " * 50
    assert codec.encode(text).tolist() == other.encode_ordinary(text)


def test_leftmost_of_equal_ranks_and_whole_tokens():
    ranks = {bytes([i]): i for i in range(256)} | {b"aa": 256, b"aaa": 257, b"xyz": 258}
    assert merge(b"aaaa", ranks) == [256, 256]
    other = tiktoken.Encoding("own", pat_str=r"\w+", mergeable_ranks=ranks, special_tokens={})
    for text in ("aaaaa", "aaa", "baaab", "xyz", "xyzx", "q"):
        lines = b"\n".join(b64encode(t) + b" %d" % i for t, i in ranks.items())
        assert Codec(lines, r"\w+").encode(text).tolist() == other.encode_ordinary(text)
    with pytest.raises(ValueError):
        Codec(b"YQ== 0", r"\w+")


def test_edges(spark, codec):
    rows = [(1, None, "x", None), (2, "", None, "en"), (None, "null id", "", ""), (3, "again", "", ""), (3, "again", "", "")]
    rows += [(4, "long text " * 200000, "", "")]
    df = spark.createDataFrame(rows, SCHEMA)
    ids = encode_texts(df, PATH, public_tokenizers.PATTERN)
    assert ids.columns == ["doc_id", "text", "lang", "token_ids"]
    back = decode_ids(ids, PATH, public_tokenizers.PATTERN).collect()
    assert len(back) == len(rows)
    for row in back:
        assert bytes(row.decoded).decode() == (row.text or "")
        assert row.token_ids == codec.encode(row.text or "").tolist()
    nothing = encode_texts(df.limit(0), PATH, public_tokenizers.PATTERN)
    assert decode_ids(nothing, PATH, public_tokenizers.PATTERN).collect() == []


def test_query(spark, sf_dir, other):
    got = {r.doc_id: r for r in QUERIES["op11_byte_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    assert len(got) == len(docs)
    for doc in docs:
        ids = other.encode_ordinary(doc.text or "")
        row = got[doc.doc_id]
        assert row.n_tokens == len(ids) and row.ids_sha256 == sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert row.decoded_sha256 == sha256((doc.text or "").encode()).hexdigest()
