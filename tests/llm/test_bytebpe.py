import base64
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from flowlab.llm import bytebpe
from flowlab.llm.queries import QUERIES

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
ODD = [
    "",
    None,
    "Hello,  the wörld's <|endoftext|> x 123abc456 a\n\n b c don't 'S",
    "a\x1cb \x1f c\x85d　e  f\t\t x",
    " \n \n  x",
    "   ",
    "日本語 テスト٣٤ ½ ﬁ \U0001F469‍\U0001F4BB \x00",
    "word " * 30_000,
    "a" * 200_000,
    " " * 150_000 + "x",
    "x1" * 90_000,
    "日本" * 60_000,
]


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


def expected(library, text):
    ids = library.encode_ordinary(text or "")
    return (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(library.decode_bytes(ids)).hexdigest(),
    )


def test_odd_texts_equal_the_library(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (3, ODD[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted(tuple(r) for r in bytebpe.digests(docs, PATH, PATTERN).fillna(-1, ["doc_id"]).collect())
    assert got == sorted((-1 if i is None else i, *expected(library, t)) for i, t, _ in rows)


@pytest.mark.parametrize("size", [1, 2, 3, 7, 50])
def test_cuts_change_no_id(library, size):
    draw = random.Random(size)
    signs = "ab Z09 \n\t\r'.,sdtlm-é日　\x85\x1c "
    for _ in range(400):
        text = "".join(draw.choice(signs) for _ in range(draw.randint(0, 60)))
        chunks = list(bytebpe.safe_chunks(text, size))
        assert "".join(chunks) == text
        assert [i for c in chunks for i in library.encode_ordinary(c)] == library.encode_ordinary(text)


def test_long_texts_are_cut():
    assert len(list(bytebpe.safe_chunks("some words " * 50_000))) > 5
    assert list(bytebpe.safe_chunks("")) == []


def test_query_equals_the_library(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op13_bytebpe"](spark, sf_dir).collect()}
    assert got == {i: expected(library, t) for i, t in docs.items()}


def test_encode_and_decode_as_columns(spark, library):
    docs = spark.createDataFrame([("k 1", "The thémes 日"), ("k2", None)], "`my id` string, `a text` string")
    encoded = bytebpe.encode(docs, PATH, PATTERN, "a text", "my id")
    ids = {r["my id"]: r.ids for r in encoded.collect()}
    assert ids == {"k 1": library.encode_ordinary("The thémes 日"), "k2": []}
    raw = {r["my id"]: bytes(r.raw) for r in bytebpe.decode(encoded, PATH, PATTERN, key="my id").collect()}
    assert raw == {"k 1": "The thémes 日".encode(), "k2": b""}
    cut = spark.createDataFrame([(1, ids["k 1"][:-1])], "doc_id long, ids array<int>")
    assert bytes(bytebpe.decode(cut, PATH, PATTERN).first().raw) == library.decode_bytes(ids["k 1"][:-1])


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bytebpe.digests(docs, PATH, PATTERN).count() == 0
    assert bytebpe.encode(docs, PATH, PATTERN).count() == 0
