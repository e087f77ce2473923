import hashlib
import os
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlab.llm import alignment
from flowlab.llm.queries import QUERIES

os.environ["TOKENIZERS_PARALLELISM"] = "false"
FILES = (
    public_tokenizers.path("byte_bpe_50k.json"),
    public_tokenizers.PATTERN,
    public_tokenizers.path("piece_bpe_32k.model"),
)
ODD = [
    "",
    None,
    " ",
    "  two  blanks ",
    "The cat's hat, 123 times <|endoftext|> <s> </s> <unk> <0x41>",
    "a▁b",
    "日本語 テスト ½ ﬁ \U0001F469‍\U0001F4BB",
    "tab\tand\nline\r\n\n end",
    "\x00\x01 a\x00b",
    "aaaaaaaaaaaaaaaaaaaaaaaaaaa" * 40,
    "indistinguishable antidisestablishmentarianism " * 200,
    "x",
]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(FILES[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=FILES[2])


def plain_groups(libraries, text):
    """Groups of (A ids, B ids) by walking both lists of whole-text tokens."""
    a, b = libraries
    if not text:
        return []
    letters = {v: k for k, v in alignment._bytes_of_letters().items()}
    byte = {c: n for n, c in letters.items()}
    left = [(i, bytes(byte[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
    right = []
    for i in b.encode(text):
        name = b.id_to_piece(i)
        raw = bytes([int(name[3:5], 16)]) if name.startswith("<0x") and len(name) == 6 else name.replace("▁", " ").encode()
        right.append((i, raw))
    whole = (" " + text).encode()
    if b"".join(r for _, r in left) != whole or b"".join(r for _, r in right) != whole:
        return []
    ends = []
    for tokens in (left, right):
        at, own = 0, []
        for _, raw in tokens:
            at += len(raw)
            own.append(at)
        ends.append(own)
    groups, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        own = ([], [])
        while i < len(left) and ends[0][i] <= end:
            own[0].append(left[i][0])
            i += 1
        while j < len(right) and ends[1][j] <= end:
            own[1].append(right[j][0])
            j += 1
        groups.append(own)
    return groups


def plain(libraries, docs):
    groups = [(key, plain_groups(libraries, text)) for key, text in docs]
    held = Counter()
    for _, own in groups:
        held.update({(x, y) for a, b in own for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    out = []
    for key, own in groups:
        links = [(x, y) for a, b in own for x in a for y in b]
        form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own)
        out.append(
            (
                key,
                sum(len(a) for a, _ in own),
                sum(len(b) for _, b in own),
                len(own),
                len(links),
                sum(held[p] == most[p[0]] for p in links),
                sum(held[p] for p in links),
                hashlib.sha256(form.encode()).hexdigest() if own else "",
            )
        )
    return sorted(out, key=repr)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("limit", [alignment.BROADCAST_PAIRS, 0])
def test_odd_texts(spark, libraries, monkeypatch, limit):
    monkeypatch.setattr(alignment, "BROADCAST_PAIRS", limit)
    rows = [(i, t, 1, "x") for i, t in enumerate(ODD)] + [(None, ODD[4], 1, "y"), (4, ODD[4], 1, "y"), (50, None, 1, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, text_key int, part string")
    got = alignment.align_documents(docs, *FILES, digest=True)
    assert rows_of(got) == plain(libraries, [(r[0], r[1]) for r in rows])


def test_texts_of_many_copies_are_split(spark, libraries):
    rows = [(i, "the same text") for i in range(700)] + [(1000 + i, f"text {i} the same") for i in range(300)]
    docs = spark.createDataFrame(rows, "`my id` long, `a text` string")
    got = alignment.align_documents(docs, *FILES, text="a text", key="my id", digest=True)
    assert rows_of(got) == plain(libraries, rows)


def test_pieces_of_long_texts_change_nothing(libraries, monkeypatch):
    model = alignment.Aligner(*FILES)
    assert model.divisible
    text = "some  words, 日本語 and\n lines " * 30
    whole = [tuple(map(str, x)) for x in model.align([text])]
    monkeypatch.setattr(alignment, "PIECE_CHARS", 7)
    assert len(model.pieces(text)) > 20 and "".join(model.pieces(text)) == " " + text
    assert [tuple(map(str, x)) for x in model.align([text])] == whole


def test_large_groups_count_alike(monkeypatch):
    model = alignment.Aligner(*FILES)
    texts = [t for t in ODD if t]
    one = [[list(map(int, v)) for v in x[5:]] for x in model.align(texts)]
    monkeypatch.setattr(alignment, "SMALL_GROUP", 1)
    assert [[list(map(int, v)) for v in x[5:]] for x in model.align(texts)] == one


def test_every_code_point_splits_as_in_the_tokenizer_file(libraries):
    model = alignment.Aligner(*FILES)
    points = [chr(c) for c in range(0x110000) if not 0xD800 <= c <= 0xDFFF]
    for start in range(0, len(points), 20_000):
        text = "x".join(f" a{c}1 {c}{c}." for c in points[start : start + 20_000])
        assert model.bytewise.encode_ordinary(text) == libraries[0].encode(text, add_special_tokens=False).ids


def test_query_equals_plain_alignment(spark, sf_dir, libraries):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = QUERIES["op12_alignment"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert rows_of(got) == plain(libraries, docs)


def test_groups_as_text_and_empty_table(spark, libraries):
    docs = spark.createDataFrame([(1, "The cats"), (2, "")], "doc_id long, text string")
    got = {r.doc_id: r.groups for r in alignment.align_documents(docs, *FILES).collect()}
    own = plain_groups(libraries, "The cats")
    assert got == {1: ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in own), 2: ""}
    assert alignment.align_documents(docs.where(F.lit(False)), *FILES).count() == 0
