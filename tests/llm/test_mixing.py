import math
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm import mixing
from flowlab.llm.queries import QUERIES


def plain_targets(totals):
    """Reshare step by step, as the rule says."""
    order = sorted(totals, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    whole = 1.5 * sum(totals.values())
    capped = set()
    while True:
        rest = whole - sum(2 * totals[s] for s in capped)
        open_ = [s for s in order if s not in capped]
        share = {s: rest * weight[s] / sum(weight[o] for o in open_) for s in open_}
        above = {s for s in open_ if share[s] > 2 * totals[s]}
        if not above:
            return share | {s: 2.0 * totals[s] for s in capped}
        capped |= above


def check(rows, got):
    """``rows``: (id, text, source) with distinct ids."""
    size = {i: len((t or "").encode().split()) for i, t, _ in rows}
    source = {i: s for i, _, s in rows}
    totals = Counter()
    for i in size:
        totals[source[i]] += size[i]
    target = plain_targets(totals)
    taken = Counter()
    assert set(got) == set(size)
    for i, r in got.items():
        assert r.size == size[i] and r.source_size == totals[source[i]]
        assert r.target == pytest.approx(target[source[i]], rel=1e-12)
        assert 0 <= r.taken <= 2 * r.size
        taken[source[i]] += r.taken
    for s in totals:
        assert abs(taken[s] - target[s]) <= 0.5 + 1e-6


def test_query_meets_targets_and_reruns_agree(spark, sf_dir):
    rows = [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    first = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, sf_dir).collect()}
    check(rows, first)
    again = mixing.taken(spark.read.parquet(f"{sf_dir}/documents.parquet").repartition(5, "n_chars"))
    assert {r.doc_id: r.taken for r in again.collect()} == {i: r.taken for i, r in first.items()}


def test_odd_sources_and_texts(spark):
    rows = [(i, f"w{i} " * (i % 90), ["a", "é", "\U0001F600", "￿", None][i % 5 if i % 7 else 4]) for i in range(200)]
    rows += [(300, None, "empty"), (301, " \t ", "blank"), (302, "\n one\x0btwo ", "tiny"), (303, "long " * 70_000, "long")]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, source string, _size int")
    got = {r.doc_id: r for r in mixing.taken(docs, block_words=16, shards=5).collect()}
    check(rows, got)


def test_shards_split_the_blocks_exactly(spark):
    docs = spark.createDataFrame([(i, f"w{i} " * (1 + i % 60), "abc"[i % 3]) for i in range(300)], "doc_id long, text string, source string")
    _, pieces = mixing.mix(docs, block_words=32, shards=6)
    rows = pieces.collect()
    blocks = {(r._source, r._draw): r.shard for r in rows}
    assert len({(r._source, r._draw, r.shard) for r in rows}) == len(blocks)  # a block lies in one shard
    drawn = Counter(s for s, _ in blocks)
    for s in drawn:
        assert {d for x, d in blocks if x == s} == set(range(drawn[s]))  # disjoint, none missing
    counts = np.array([drawn[s] for s in sorted(drawn)])
    for shard in range(6):
        quota = mixing.quotas_of(shard, counts, 6, mixing.SEED)
        assert [sum(1 for (x, _), k in blocks.items() if x == s and k == shard) for s in sorted(drawn)] == quota.tolist()
    total = [sum(1 for k in blocks.values() if k == shard) for shard in range(6)]
    assert max(total) - min(total) <= 3


def test_permutation_is_a_bijection(spark):
    for n in (1, 2, 3, 97, 1_000):
        places = spark.range(n).select(mixing._permuted(F.col("id"), F.lit(n).cast("long"), 11).alias("p"))
        assert sorted(r.p for r in places.collect()) == list(range(n))


def test_mixed_rows_hold_the_taken_words(spark):
    texts = {i: " ".join(f"d{i}w{j}" for j in range(10 + 37 * i % 400)) for i in range(40)}
    docs = spark.createDataFrame([(t, i, "ab"[i % 2], 5) for i, t in texts.items()], "text string, doc_id long, source string, n_chars long")
    mixed = mixing.mixed_documents(docs, block_words=16)
    assert mixed.columns == docs.columns
    words = defaultdict(Counter)
    for r in mixed.collect():
        words[r.doc_id].update(r.text.split())
    for r in mixing.taken(docs, block_words=16).collect():
        assert words[r.doc_id].total() == r.taken
        assert set(words[r.doc_id]) <= set(texts[r.doc_id].split()) and max(words[r.doc_id].values(), default=0) <= 2


def test_empty_table_and_repeated_rows(spark):
    docs = spark.createDataFrame([(1, "a b c", "s"), (1, "a b c", "s"), (None, "x", None)], "doc_id long, text string, source string")
    assert mixing.taken(docs).count() == 3
    assert mixing.taken(docs.limit(0)).count() == 0
    assert mixing.mixed_documents(docs.limit(0)).count() == 0


def test_a_wrong_tree_changes_the_registered_rows(spark, sf_dir, monkeypatch):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    right = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, sf_dir).collect()}
    for r in right.values():
        assert sum(s.words for s in r.shards) == r.taken
        assert [s.shard for s in r.shards] == sorted({s.shard for s in r.shards})
    assert {s.shard for r in right.values() for s in r.shards} == set(range(mixing.LEAST_SHARDS))
    order = [r.text for r in mixing.mixed_documents(docs).collect()]
    tree = mixing.shard_borders
    monkeypatch.setattr(mixing, "shard_borders", lambda spark, drawn, shards, seed: tree(spark, drawn, shards, seed + 1))
    wrong = {r.doc_id: r for r in QUERIES["op7_mixing"](spark, sf_dir).collect()}
    assert {i: r.shards for i, r in wrong.items()} != {i: r.shards for i, r in right.items()}
    assert order != [r.text for r in mixing.mixed_documents(docs).collect()]


def test_mixed_rows_come_shard_by_shard_and_keep_white_space(spark):
    texts = {i: " \n".join(f"d{i}w{j}" for j in range(5 + 37 * i % 300)) + "\n" for i in range(60)}
    docs = spark.createDataFrame([(t, i, "abc"[i % 3]) for i, t in texts.items()], "text string, doc_id long, source string")
    rows = mixing.mixed_documents(docs, block_words=16, shards=6).collect()
    assert all(r.text in texts[r.doc_id] for r in rows)
    _, pieces = mixing.mix(docs, block_words=16, shards=6)
    want = sorted(pieces.collect(), key=lambda r: (r.shard, r.place, r._source, r._draw, r._at))
    assert [(r.doc_id, r.text.split()) for r in rows] == [(r._key, texts[r._key].split()[r.word_from : r.word_to]) for r in want]


def test_shards_grow_with_the_blocks():
    assert mixing.shards_for(100, 3) == mixing.LEAST_SHARDS
    assert mixing.shards_for(14_000_000, 3) == -(-14_000_000 // mixing.SHARD_BLOCKS)
    assert mixing.spans_of(" \ta\n b  c ", [0, 1, 0], [1, 3, 3]) == [" \ta\n ", "b  c ", " \ta\n b  c "]


@pytest.mark.parametrize("size", [1, 2, 3, 7, 64, 1_000, 166_667, 333_334])
def test_permutation_is_a_bijection_without_runs(size):
    rank = mixing.permuted(np.arange(size), np.full(size, size), mixing.SEED)
    assert np.array_equal(np.sort(rank), np.arange(size))
    if size >= 1_000:
        assert (np.abs(np.diff(rank)) == 1).mean() < 0.01
        assert abs(np.corrcoef(rank, np.arange(size))[0, 1]) < 0.1


def test_permutation_of_huge_and_mixed_sizes():
    size = np.array([9 * 10**12, 5, 5, 5, 5, 5, 9 * 10**12])
    rank = mixing.permuted(np.array([3, 0, 1, 2, 3, 4, 4]), size, mixing.SEED)
    assert sorted(rank[1:6]) == [0, 1, 2, 3, 4] and 0 <= rank[0] != rank[6] < 9 * 10**12
    assert len(mixing.permuted(np.array([], np.int64), np.array([], np.int64), 1)) == 0


@pytest.mark.parametrize("drawn", [[2 * 10**9, 3 * 10**9], [10**13, 7, 0, 4 * 10**12, 1]])
def test_totals_beyond_numpy_are_split_exactly(drawn):
    counts, shards = np.array(drawn, dtype=np.int64), 24
    quotas = np.array([mixing.quotas_of(s, counts, shards, mixing.SEED) for s in range(shards)])
    assert (quotas >= 0).all() and quotas.sum(axis=0).tolist() == drawn
    assert np.ptp(quotas.sum(axis=1)) <= 2 * shards  # shards of one size, up to rounding
    share = quotas[:, 0] / quotas.sum(axis=1)
    assert np.allclose(share, drawn[0] / sum(drawn), atol=1e-3)


def test_large_draws_have_the_right_spread():
    random = np.random.default_rng(0)
    x = np.array([mixing._drawn(random, 4 * 10**9, 10**10, 10**9) for _ in range(4_000)])
    assert abs(x.mean() - 4e8) < 2_000 and abs(x.std() / math.sqrt(1e9 * 0.4 * 0.6 * 0.9) - 1) < 0.05
