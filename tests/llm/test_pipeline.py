import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from __spark_entry__ import queries
from flowlab.llm import mil
from flowlab.llm.common import stored
from tests.llm import test_mixing, test_rules, test_simhash


def texts(df):
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_every_stage_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    seen = [docs]
    for name, stage in corpus_pipeline.STAGES:
        seen.append(stored(stage(spark, seen[-1], sf_dir), f"test-{name}"))
        if name != "encoding":
            assert seen[-1].schema.simpleString() == docs.schema.simpleString()
    start, good, clean, unique, mixed, encoded = seen

    model = mil.fit(start, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rows = [(r.doc_id, r.text) for r in start.collect()]
    scores = model.score([(t or "").encode() for _, t in rows])
    assert texts(good) == Counter(r for r, s in zip(rows, scores) if s >= mil.THRESHOLD)
    assert 0 < sum(texts(good).values()) < len(rows)

    rest = texts(clean)
    for i, t in texts(good):
        count = test_rules.plain(t)
        if count[0] < 50 or 100 * count[4] > 50 * count[0]:
            assert (i, t) not in rest
    assert set(rest) <= set(texts(good)) and clean.count() > 0.8 * good.count()

    rows = sorted(rest)
    roots = test_simhash.plain_components([test_simhash.plain_fingerprint(t) for _, t in rows])
    assert texts(unique) == Counter(r for k, r in enumerate(rows) if roots[k] == k)

    size = {r.doc_id: (len(r.text.split()), r.source) for r in unique.collect()}
    totals, taken = Counter(), Counter()
    for n, s in size.values():
        totals[s] += n
    for r in mixed.collect():
        taken[r.source] += len(r.text.encode().split())
    target = test_mixing.plain_targets(totals)
    assert all(abs(taken[s] - target[s]) <= 1 for s in totals)

    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    library.no_truncation()
    library.no_padding()
    expected = Counter()
    for (i, t), n in texts(mixed).items():
        ids = library.encode(t, add_special_tokens=False).ids
        expected[(i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest())] += n
    assert Counter((r.doc_id, r.n_tokens, r.ids_sha256) for r in encoded.collect()) == expected


def test_the_query_runs_the_stages(spark, sf_dir):
    got = queries()["pipeline"](spark, sf_dir)
    assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"] and got.count() > 0


def test_stages_on_an_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_texts_reach_python_a_few_megabytes_at_a_time(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        spark.conf.unset("spark.sql.execution.arrow.maxBytesPerBatch")
        stage(spark, docs, sf_dir)
        if name == "quality_rules":  # no Python
            continue
        long = spark.range(0, 3_000, 1, 1).select(F.repeat(F.lit("ab "), 5_000).alias("text"))
        sizes = long.mapInArrow(lambda bs: (pa.RecordBatch.from_pydict({"n": [b.nbytes]}) for b in bs), "n long")
        found = [r.n for r in sizes.collect()]
        assert sum(found) > 40_000_000 and max(found) < 8_000_000
