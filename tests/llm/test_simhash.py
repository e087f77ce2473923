import random
from collections import Counter

import numpy as np
import pytest
import xxhash

from flowlab.llm import simhash
from flowlab.llm.queries import QUERIES


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    ones = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s, 42)
        ones.update(b for b in range(64) if h >> b & 1)
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(shingles))


def plain_components(fps):
    """Smallest index reachable over links of at most 4 bits."""
    values = np.array(fps, dtype=np.uint64)
    root = list(range(len(values)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(values)):
        for j in np.flatnonzero(np.bitwise_count(values[:i] ^ values[i]) <= 4):
            a, b = top(i), top(int(j))
            root[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(values))]


def check(rows, got):
    """``rows`` (id, text) with distinct ids in ascending order."""
    fps = [plain_fingerprint(t) for _, t in rows]
    roots = plain_components(fps)
    expected = {i: (f"{f:016x}", rows[r][0]) for (i, _), f, r in zip(rows, fps, roots)}
    assert got == expected


def test_query_equals_brute_force(spark, sf_dir):
    rows = sorted((r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect())
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op6_simhash"](spark, sf_dir).collect()}
    check(rows, got)


@pytest.mark.parametrize("cell", [3, 2_048])
def test_groups_of_copies_and_chains(spark, cell):
    draw = random.Random(5)
    base = [f"w{draw.randrange(5000)}" for _ in range(300)]
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "one two"), (4, "ONE two"), (5, "été\x0bnoir a b c")]
    for i in range(6, 120):  # near copies, each one word away from another
        base = list(base) if i % 3 else [f"w{draw.randrange(5000)}" for _ in range(300)]
        base[draw.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(base)))
    rows += [(200 + i, rows[10][1]) for i in range(40)] + [(300, "long " * 50_000)]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, fp int")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs, cell=cell).collect()}
    check(rows, got)


def test_every_close_pair_shares_a_key():
    draw = random.Random(1)
    masks = simhash.block_masks()
    assert len(masks) == 35
    for _ in range(2_000):
        flips = 0
        for b in draw.sample(range(64), draw.randrange(5)):
            flips |= 1 << b
        assert any(flips & m == 0 for m in masks)


def test_forest_connects_like_all_links():
    draw = np.random.default_rng(2)
    fps = (draw.integers(0, 2**12, 300, dtype=np.uint64) << np.uint64(52)).view(np.int64)
    pairs = simhash.forest(fps, 1)
    values = np.unique(fps)
    index = {int(v): i for i, v in enumerate(values)}
    label = list(range(len(values)))
    for a, b in pairs.tolist():
        x, y = label[index[a]], label[index[b]]
        label = [min(x, y) if v in (x, y) else v for v in label]
    near = np.bitwise_count((values[:, None] ^ values[None, :]).view(np.uint64)) <= 1
    for i, j in zip(*np.nonzero(near)):
        assert label[i] == label[j]
    assert len(pairs) == len(values) - len(set(label))


def test_one_of_each_group_stays(spark):
    rows = [(1, "a b c d e"), (2, "a b c d e"), (3, "other words here now"), (3, "x"), (3, "A b c d e"), (None, "null id"), (None, "a b c d e")]
    docs = spark.createDataFrame([(i, t, "s", 7) for i, t in rows], "doc_id long, text string, source string, _kept int")
    got = simhash.one_of_each(docs)
    assert got.columns == docs.columns
    kept = [tuple(r)[:2] for r in got.collect()]
    assert sorted(kept, key=repr) == sorted([(1, "a b c d e"), (3, "other words here now"), (3, "x"), (None, "null id")], key=repr)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).count() == 0
    assert simhash.one_of_each(docs).count() == 0


def test_clashing_names_and_map_columns(spark):
    rows = [(1, "a b c d e", {"x": 1}, "p"), (1, "a b c d e", {"y": 2}, "q"), (2, "a b c d e", None, "r"), (3, "other words here now", None, None)]
    docs = spark.createDataFrame(rows, "`the id` long, _text string, fp map<string,int>, __kept_id string")
    got = simhash.one_of_each(docs, "_text", "the id")
    assert got.columns == docs.columns
    assert sorted((r["the id"], r["__kept_id"] in ("p", "q", None)) for r in got.collect()) == [(1, True), (3, True)]
    own = docs.drop("fp").withColumnRenamed("the id", "fp")
    found = simhash.near_duplicates(own, "_text", "fp")
    assert found.columns == ["fp", "fingerprint", "component_id"]
    assert sorted((r.fp, r.component_id) for r in found.collect()) == [(1, 1), (1, 1), (2, 1), (3, 3)]
