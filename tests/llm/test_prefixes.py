import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from flowlab.llm import prefixes
from flowlab.llm.queries import QUERIES

COLUMNS = "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256".split()


def plain_trie(paths):
    """Nodes of {conv_id: list of (role, text)} by a plain walk."""
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(paths):
        path = tuple(paths[c])
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
        ends[path].append(c)
    children = defaultdict(int)
    for node in members:
        if node:
            children[node[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for node, own in members.items():
        weight = (len(own) - 1) * len(node[-1][1].encode()) if node else 0
        for d in range(len(node) + 1):
            leaves[node[:d]] += children[node] == 0
            saved[node[:d]] += weight
    out = []
    for node, own in members.items():
        parent = members[node[:-1]][0] if node else None
        digest = hashlib.sha256(",".join(map(str, ends[node])).encode()).hexdigest()
        out.append((own[0], len(node), parent, len(own), children[node], leaves[node], saved[node], digest))
    return sorted(out, key=repr)


def plain_heads(rows):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(v)] for c, v in own.items()}
    out = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + own[c][h:]
    return out


def rows_of(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=repr)


def check(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert rows_of(prefixes.trie_of_shared_heads(df)) == plain_trie(plain_heads(rows))


def test_query_equals_plain_walk(spark, sf_dir):
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert rows_of(QUERIES["op11_prefixes"](spark, sf_dir)) == plain_trie(plain_heads(rows))


@pytest.mark.parametrize("seed", [1, 2])
def test_random_conversations(spark, seed, monkeypatch):
    monkeypatch.setattr(prefixes, "CHUNK", 3)
    monkeypatch.setattr(prefixes, "PACKED", 2)
    draw = random.Random(seed)
    rows = []
    for c in draw.sample(range(300), 120):
        for turn in range(draw.choice([1, 2, 3, 5, 8, 9, 17, 60])):
            rows.append((c, turn, "user" if turn % 2 == 0 else "assistant", draw.choice(["a", "a", "a", "bé", ""])))
    draw.shuffle(rows)
    check(spark, rows)


def test_nulls_ties_and_conversations_without_turns(spark):
    # two ids whose heads are longer than they are, and whose base is absent
    short = [c for c in range(1, 200) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 3][:2]
    rows = [(c, 0, "user", "hidden") for c in short]
    rows += [(300, None, None, "first"), (300, 1, "user", None), (300, 0, "", ""), (301, 0, "user", "x"), (None, 0, "user", "lost")]
    rows += [(305, t, "user", "same") for t in (0, 0, 1, 1, 1)] + [(310, t, "user", "same") for t in (0, 0, 1, 1, 1)]
    rows += [(-7, 0, "user", "below"), (-5, 0, "user", "zero"), (-5, 1, "assistant", "x" * 100_000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    expected = plain_heads(rows)
    # the sign of the remainder follows the id
    expected[-7] = [("user", "zero"), ("assistant", "x" * 100_000)][: zlib.crc32(b"-7") % 9] + [("user", "below")][zlib.crc32(b"-7") % 9 :]
    assert any(not v for v in expected.values())
    assert rows_of(prefixes.trie_of_shared_heads(df)) == plain_trie(expected)


def test_one_conversation_many_times_and_a_long_one(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(0, 2000, 5) for t in range(3)]
    rows += [(5000, t, "user", str(t % 7)) for t in range(200)]
    check(spark, rows)


def test_other_columns_and_names(spark):
    df = spark.createDataFrame(
        [(1, 0, "user", "hi", 5, {"a": 1}), (2, 0, "user", "hi", 6, None)],
        "`conv id` long, pos long, who string, `a text` string, k1 int, t1 map<string,int>",
    )
    turns = prefixes.turns_of(df, "conv id", "pos", "who", "a text")
    convs = spark.createDataFrame([(1, 1), (2, 1), (3, 0)], "conv_id long, n_turns long")
    paths = {1: [("user", "hi")], 2: [("user", "hi")], 3: []}
    assert rows_of(prefixes.prefix_trie(turns, convs)) == plain_trie(paths)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefixes.trie_of_shared_heads(df).count() == 0
