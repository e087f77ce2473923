import numpy as np
import public_tokenizers
import pytest

from flowlab.llm import tokencount
from flowlab.llm.queries import QUERIES

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def model():
    return tokencount.encoding(PATH)


def test_pattern_is_that_of_the_vocabulary():
    assert tokencount.PATTERN == public_tokenizers.PATTERN


def test_query_counts_every_document(spark, sf_dir, model):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    got = QUERIES["op1_token_counts"](spark, sf_dir).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {r.doc_id: len(model.encode_ordinary(r.text or "")) for r in docs}
    assert len(got) == len(docs)


@pytest.mark.parametrize("block_bytes", [2, 6, 64, 1 << 20])
def test_blocks_of_any_size_agree(spark, model, block_bytes):
    texts = ["", None, "a", "<|endoftext|> and more", "word " * 300, "\n\n", "é" * 50, "x\ny", "7\n"]
    rows = [(i, t, "p") for i, t in enumerate(texts)] + [(None, "no id", "p"), (3, texts[3], "p"), (-5, "minus", "p")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, file string").repartition(3)
    got = sorted((str(r.doc_id), r.n_tokens) for r in tokencount.count_documents(docs, PATH, block_bytes=block_bytes).collect())
    assert got == sorted((str(i), len(model.encode_ordinary(t or ""))) for i, t, _ in rows)


@pytest.mark.parametrize("block_bytes", [2, 64, 1 << 20])
def test_ids_of_any_length_and_form(spark, model, block_bytes):
    url = "https://example.org/" + "/".join(f"part-{i}?q={i * i}" for i in range(40))
    ids = [url, "a\nb", "a\\nb", "\\N", "\\", "\n", "", None, " x \n\n ", "x" * 3_000, url]
    rows = [(k, t) for k in ids for t in ("some text\nof lines", "")]
    docs = spark.createDataFrame(rows, "`doc id` string, `a text` string").repartition(2)
    found = tokencount.count_documents(docs, PATH, "a text", "doc id", block_bytes)
    got = sorted((str(r["doc id"]), r["doc id"] is None, r.n_tokens) for r in found.collect())
    assert got == sorted((str(k), k is None, len(model.encode_ordinary(t))) for k, t in rows)


@pytest.mark.parametrize("block_bytes", [2, 10, 4096])
def test_scan_of_files_from_elsewhere(spark, tmp_path, block_bytes):
    draw = np.random.default_rng(1)
    expected = []
    for name, n in (("a.bin", 1_000), ("b.bin", 1), ("c.bin", 0), ("d.bin", 57)):
        numbers = draw.integers(0, 50_000, n).astype("<u2")
        numbers[draw.random(n) < 0.1] = tokencount.END
        numbers.tofile(tmp_path / name)
        start, ordinal = 0, 0
        for i in [*np.flatnonzero(numbers == tokencount.END).tolist(), n]:
            if i < n or i > start:
                expected.append((name, ordinal, start, i - start, i < n))
            start, ordinal = i + 1, ordinal + 1
    got = tokencount.scan(spark, f"file://{tmp_path}", block_bytes).collect()
    assert sorted((r.file.rsplit("/", 1)[1], r.document, r.start, r.n_tokens, r.complete) for r in got) == sorted(expected)


def test_a_cut_number_is_an_error(spark, tmp_path):
    (tmp_path / "odd.bin").write_bytes(b"abc")
    with pytest.raises(Exception, match="whole numbers"):
        tokencount.scan(spark, f"file://{tmp_path}").collect()


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert tokencount.count_documents(docs, PATH).count() == 0
