import random

from flowlab.llm import rules
from flowlab.llm.queries import QUERIES, SQL
from tests.compare import connect, difference


def plain(text):
    words = (text or "").encode().split()
    seen, inside = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i : i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            inside |= {i + s for i in at for s in range(3)}
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    return (
        len(words),
        sum(len(w.decode()) for w in words),
        sum((text or "").count(c) for c in "#*$%&|<>"),
        len(lines) - len(set(lines)),
        len(inside),
    )


def test_query_equals_sql(spark, sf_dir):
    assert difference(spark, connect(sf_dir), sf_dir, QUERIES["op5_rules"], SQL["op5_rules"]) is None


def test_counts_of_odd_texts(spark):
    draw = random.Random(3)
    texts = [None, "", " \n\t\x0b", "a b", "a b c", "a b a b a", "x x x x", "a\n\nb\na \na", "é ü\x0b|<ñ\x0c#", "a b c\x85d"]
    texts += [" ".join(draw.choice("abc") for _ in range(n)) for n in (30, 300, 20_000)]
    texts.append("word " * 100_000)
    rows = [(i, t, "w") for i, t in enumerate(texts)] + [(None, "a b c a b c", "w")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _words string")
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    got = {r.doc_id: tuple(r[n] for n in names) for r in rules.judge(docs).collect()}
    assert got == {i: plain(t) for i, t, _ in rows}


def test_equal_hashes_of_different_windows(spark, monkeypatch):
    # a hash of one bit: nearly every text takes the exact way
    text = "a b c d e f a b c x y z q a b"
    docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
    real = rules.F.expr
    weak = lambda s: real(s.replace("xxhash64(get(_words, i), get(_words, i + 1), get(_words, i + 2))", "(ascii(get(_words, i)) % 2L)"))
    monkeypatch.setattr(rules.F, "expr", weak)
    row = rules.counts(docs).first()
    assert row.n_repeat_words == plain(text)[4]


def test_thresholds(spark):
    good = "The cat and the dog went to a house by the sea, " * 1
    clean = " ".join(f"{good}{w}{i}" for i, w in enumerate("one two three four five six seven eight nine ten".split()))
    rows = [
        (1, clean),
        (2, clean.replace(" ", " ### ")),
        (3, " ".join(f"zq{i}x" for i in range(80))),
        (4, "few words"),
        (5, clean.upper()),
    ]
    docs = spark.createDataFrame([(i, t, True) for i, t in rows], "doc_id long, text string, kept boolean")
    verdict = {r.doc_id: r.kept for r in rules.judge(docs).collect()}
    loose = {r.doc_id: r.kept for r in rules.judge(docs, rules=[]).collect()}
    assert verdict == {1: loose[1], 2: False, 3: False, 4: False, 5: False}
    assert loose[3] and not loose[4]
    passed = rules.passing(docs)
    assert passed.columns == docs.columns
    assert {r.doc_id for r in passed.collect()} == {i for i, k in verdict.items() if k}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert rules.judge(docs).count() == 0
