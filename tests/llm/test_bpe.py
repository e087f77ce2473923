import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlab.llm import bpe
from flowlab.llm.queries import QUERIES

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "",
    None,
    "Hello,  the wörld's <|endoftext|> x<|startoftext|>y 123 a\nb c İ é ΑΣ ΣΑΣ",
    "a\x1cb \x1f c\x85d　e f",
    "aaaaaaa aaaaaaaaaa''''''ssss 'S 'RE don't",
    "<|endoftext|><|endoftext|> <|ENDOFTEXT|> <| endoftext|>",
    "日本語 テスト٣٤ ½ é ﬁ ſ K Å ǅ ẞ",
    "​﻿ \U0001F600\U0001F469‍\U0001F4BB \x00 a\x00b",
    "word " * 30_000,
]


@pytest.fixture(scope="module")
def library():
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


def expected(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    back = library.decode(ids, skip_special_tokens=False)
    return (
        len(ids),
        hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
        hashlib.sha256(back.encode()).hexdigest(),
    )


def test_odd_texts_equal_the_library(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(None, "a b", "x"), (3, ODD[3], "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    got = sorted(tuple(r) for r in bpe.digests(docs, PATH).fillna(-1, ["doc_id"]).collect())
    assert got == sorted((-1 if i is None else i, *expected(library, t)) for i, t, _ in rows)


def test_query_equals_the_library(spark, sf_dir, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_bpe"](spark, sf_dir).collect()}
    assert got == {i: expected(library, t) for i, t in docs.items()}


def test_encode_and_decode_as_columns(spark, library):
    docs = spark.createDataFrame([(1, "The theme's"), (2, None)], "doc_id long, text string")
    encoded = bpe.encode(docs, PATH)
    ids = {r.doc_id: r.ids for r in encoded.collect()}
    assert ids[1] == library.encode("The theme's", add_special_tokens=False).ids and ids[2] == []
    text = {r.doc_id: r.text for r in bpe.decode(encoded, PATH).collect()}
    assert text == {1: library.decode(ids[1], skip_special_tokens=False), 2: ""}


def test_small_cache_gives_the_same(library, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_CHUNKS", 3)
    monkeypatch.setattr(bpe, "GROUP_CHUNKS", 2)
    model = bpe.WordBpe(PATH)
    for text in ["one two three four", "two five six", "one one seven"]:
        ids = np.frombuffer(model.encode_batch([text])[0], "<u4").tolist()
        assert ids == library.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(docs, PATH).count() == 0
    assert bpe.encode(docs, PATH).where(F.size("ids") > 0).count() == 0


def test_key_name_with_a_blank(spark):
    docs = spark.createDataFrame([(1, "one two"), (None, None)], "`the id` long, text string")
    got = {r["the id"]: r.n_tokens for r in bpe.digests(docs, PATH, key="the id").collect()}
    assert got[1] > 0 and got[None] == 0
    back = bpe.decode(bpe.encode(docs, PATH, key="the id"), PATH, key="the id")
    assert back.count() == 2


def test_workers_give_back_memory_when_a_task_ends(monkeypatch):
    from flowlab.llm import common

    ended = []
    monkeypatch.setattr(common, "release_memory", lambda: ended.append(True))
    assert list(common.frugal(iter)([1, 2])) == [1, 2] and ended == [True]
