import math
import zlib
from collections import Counter

import numpy as np
import pytest

from flowlab.llm import ppm
from flowlab.llm.queries import QUERIES


def tokens(text):
    return [*(text or "").encode().lower().split(), b""]


def check_base(texts, got, held):
    """Everything but ``score`` against plain counting; keys are row ids."""
    c = Counter()
    for i, t in texts.items():
        if not held(i):
            c.update(tokens(t))
    n, v = sum(c.values()), len(c)
    assert set(got) == set(texts)
    for i, t in texts.items():
        w, r = tokens(t), got[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held(i), len(w), sum(x in c for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w), rel=1e-9)
        assert math.isfinite(r.score) and r.score < 0


def fold(i):
    return zlib.crc32(str(i).encode()) % 5 == 1


def test_query_counts_and_beats_the_base(spark):
    sf_dir = "/root/testdata/sf0.1"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op2_ppm"](spark, sf_dir).collect()}
    check_base(texts, got, fold)
    out = [r for r in got.values() if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)


def test_scores_do_not_depend_on_the_blocks(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    one = {r.doc_id: r.score for r in ppm.score(docs).collect()}
    monkeypatch.setattr(ppm, "SUBTREE_SHARE", 1e-4)  # longer prefixes deal the words
    many = {r.doc_id: r.score for r in ppm.score(docs.repartition(7)).collect()}
    # the short contexts count in how many blocks a word occurs
    assert set(one) == set(many)
    assert np.allclose([one[i] for i in one], [many[i] for i in one], rtol=0.1)


def all_words(length, letters=b"ab"):
    words = [b""]
    for n in range(1, length + 1):
        words += [bytes(letters[i >> k & 1] for k in range(n)) for i in range(2**n)]
    return words


def test_probabilities_add_up_to_at_most_one():
    counted = Counter({b"ab": 5, b"abba": 2, b"a": 1, b"": 3, b"bbb": 1})
    words = sorted(set(all_words(9)) | set(counted))
    codes = Counter()
    for w in counted:
        path = b"    " + w
        for d in range(len(w) + 1):
            for k in range(ppm.ORDER + 1):
                context = int.from_bytes(path[4 + d - k : 4 + d], "big") if k else 0
                codes[(k, context, w[d] if d < len(w) else ppm.END)] += 1
    short = ppm.Short([(*key, n) for key, n in codes.items()])
    counts = np.array([counted[w] for w in words])
    score, plain, chain = np.zeros(len(words)), np.zeros(len(words)), np.zeros(len(words), bool)
    ppm.walk(words, counts, 0, None, score, plain, chain, short)
    for p in (10.0**score, 10.0**plain):
        assert 0.2 < p.sum() <= 1 + 1e-6
    # in two parts, as the tasks do it
    depth = 2
    heads = Counter()
    for w, n in zip(words, counts.tolist()):
        heads[w[:depth]] += n
    top = ppm.Top(list(heads.items()), depth, short)
    again = np.array([top.paths[w[:depth]][0] for w in words])
    low = np.array([top.paths[w[:depth]][1] for w in words])
    inner = np.flatnonzero([len(w) >= depth for w in words])
    part, part_low = again[inner], low[inner]
    chains = np.array([top.paths[words[i][:depth]][2] for i in inner])
    ppm.walk([words[i] for i in inner], counts[inner], depth, None, part, part_low, chains, short)
    again[inner], low[inner] = part, part_low
    assert np.allclose(again, score) and np.allclose(low, plain)


def test_adaptive_part_learns_repeats():
    score = np.log10(np.array([0.01, 0.02, 0.03]))
    n = np.array([1, 2, 0])
    repeated = np.array([0, 1, 0, 1, 0, 1, 0, 1] * 20)
    length, known, base, total = ppm.document_scores([repeated, np.array([2])], score, n)
    assert length.tolist() == [160, 1] and known.tolist() == [160, 0]
    assert total[0] > score[repeated].sum() / 2 and total[1] <= score[2] + 1e-9
    assert base[1] == pytest.approx(math.log10(0.5))


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "One ONE one\x0bé", "x"), (3, "One ONE one\x0bé", "x"), (None, "word " * 30_000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = ppm.score(docs).collect()
    assert sorted((r.doc_id or 0, r.n_tokens) for r in got) == [(0, 30_001), (1, 1), (2, 1), (3, 5), (3, 5)]
    assert len({r.score for r in got if r.doc_id == 3}) == 1
    from pyspark.sql import functions as F

    none = ppm.score(docs, held_out=F.lit(True)).collect()
    assert all(r.train_tokens == 0 and r.n_known == 0 and math.isfinite(r.score) for r in none)
    assert ppm.score(docs.limit(0)).count() == 0


def test_scores_are_the_same_for_one_block_and_for_many(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(60)
    one = {r.doc_id: r.score for r in ppm.score(docs.coalesce(1)).collect()}
    many = {r.doc_id: r.score for r in ppm.score(docs.repartition(7)).collect()}
    assert set(one) == set(many)
    assert np.allclose([one[i] for i in one], [many[i] for i in one], rtol=1e-6)


def test_rare_contexts_spell_new_words(spark, monkeypatch):
    """Contexts with less than 1/50,000 of the symbols count like the others."""
    draw = np.random.default_rng(5)
    words = [bytes(draw.choice(list(b"abcdefghijklmnop"), 9)).decode() for _ in range(12_000)]
    words += ["qzxwv" + a + b for a in "abc" for b in "de"]
    texts = {i: " ".join(words[i::40]) for i in range(40)} | {40: "qzxwvce rqzxwvad"}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(3)
    monkeypatch.setattr(ppm, "COMMON_SPELLINGS", 3_000, raising=False)
    got = {r.doc_id: r for r in ppm.score(docs, held_out=docs.doc_id == 40).collect()}

    known = sorted(set(tokens(" ".join(words))))
    codes = Counter()
    for w in known:
        path = b"    " + w
        for d in range(len(w) + 1):
            for k in range(ppm.ORDER + 1):
                context = int.from_bytes(path[4 + d - k : 4 + d], "big") if k else 0
                codes[(k, context, w[d] if d < len(w) else ppm.END)] += 1
    counted = Counter(w for i in range(40) for w in tokens(texts[i]))
    every = sorted({*known, *tokens(texts[40])})
    n = np.array([counted[w] for w in every])
    score, plain, chain = np.zeros(len(every)), np.zeros(len(every)), np.zeros(len(every), bool)
    ppm.walk(every, n, 0, None, score, plain, chain, ppm.Short([(*key, c) for key, c in codes.items()]))
    unseen = min(max((n == 1).sum() / n.sum(), 1e-6), 0.5)
    blend = np.log10((1 - unseen) * 10.0**score + unseen * 10.0**plain)
    for i in (0, 40):
        at = np.array([every.index(w) for w in tokens(texts[i])])
        expected = ppm.document_scores([at], blend, n)[3][0]
        assert got[i].score == pytest.approx(expected, rel=1e-5)
