import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from flowlab.llm import mil
from flowlab.llm.queries import QUERIES

LARGER = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    got = QUERIES["op4_mil"](spark, LARGER).toPandas()
    docs = spark.read.parquet(f"{LARGER}/documents.parquet")
    assert len(got) == docs.count()
    fold = [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]
    assert (got.held_out == fold).all() and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.3)).all()
    labels = spark.read.parquet(f"{LARGER}/labels.parquet").toPandas()
    both = got[got.held_out].merge(labels, on="doc_id")
    right = both.predicted == both.quality
    assert right.mean() > 0.97
    assert right[both.quality == 1].mean() > 0.97 and right[both.quality == 0].mean() > 0.9


def test_held_out_labels_do_not_matter(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    fold = mil.split_remainder("doc_id") == 0
    turned = labels.withColumn("quality", F.when(fold, 1 - F.col("quality")).otherwise(F.col("quality")))
    score = lambda l: {r.doc_id: r.score for r in mil.classify(docs, l).collect()}
    assert score(labels) == score(turned)


def test_gradient_is_the_slope_of_the_loss():
    draw = np.random.default_rng(0)
    model, numbers = mil.Model(), np.array([3, 1, 4])
    x, y, weight = draw.normal(size=(8, mil.WIDTH)), np.array([1.0, 0.0, 1.0]), np.array([1.0, 2.0, 1.0])

    def loss():
        s = model._forward(x, numbers)["s"]
        return -((y * np.log(s) + (1 - y) * np.log(1 - s)) * weight).sum() / weight.sum()

    grad = model._gradient(x, numbers, y, weight, decay=0)
    for name, g in grad.items():
        flat = model.p[name].reshape(-1)
        for i in range(0, flat.size, max(1, flat.size // 5)):
            old = flat[i]
            flat[i] = old + 1e-5
            up = loss()
            flat[i] = old - 1e-5
            down = loss()
            flat[i] = old
            assert g.reshape(-1)[i] == pytest.approx((up - down) / 2e-5, abs=1e-6)


def test_passages_cover_whole_texts():
    for text in (b"", b"a", b"x" * 5_000, b"ab cd " * 3_000, b" " * 4_000):
        cuts = mil.passage_cuts(np.frombuffer(text, np.uint8))
        sizes = np.diff(cuts)
        assert cuts[0] == 0 and cuts[-1] == len(text) and (sizes <= 2 * mil.PASSAGE_BYTES).all()
    x, numbers = mil.passage_features([b"one", None, b"two words " * 400])
    alone = [mil.passage_features([t])[0] for t in (b"one", None, b"two words " * 400)]
    assert np.allclose(x, np.concatenate(alone)) and numbers.sum() == len(x)


def test_odd_rows(spark):
    rows = [(None, None, "x"), (None, "a b", "x"), (7, "", "y"), (7, "", "y"), (8, "word " * 60_000, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = mil.classify(docs, none).collect()
    assert len(got) == 5 and {r.score for r in got} == {0.5}
    labels = spark.createDataFrame([(8, 1, 0), (7, None, 0), (None, 0, 0), (9, 0, 0)], "doc_id long, quality int, toxic int")
    got = mil.classify(docs, labels).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    assert mil.accepted(docs, none).columns == docs.columns
    assert mil.classify(docs.limit(0), labels).count() == 0


def test_text_ids_and_clashing_names(spark):
    good, bad = "The river rose slowly and people spoke of it. " * 5, "buy now $$$ click click click win win " * 5
    docs = spark.createDataFrame([(f"d-{i}", good if i % 2 else bad, i, "x") for i in range(60)], "doc_id string, text string, __score int, __text string")
    labels = spark.createDataFrame([(f"d-{i}", i % 2) for i in range(60)], "doc_id string, quality int")
    got = mil.classify(docs, labels).collect()
    assert len(got) == 60 and all(r.predicted == int(r.doc_id[2:]) % 2 for r in got)
    kept = mil.accepted(docs, labels)
    assert kept.columns == docs.columns
    assert sorted(r["__score"] for r in kept.collect()) == list(range(1, 60, 2))
    numbers = docs.withColumn("doc_id", F.col("__score").cast("long"))
    assert mil.classify(numbers, labels.withColumn("doc_id", F.substring("doc_id", 3, 9))).count() == 60


def test_features_do_not_depend_on_what_is_computed_together(monkeypatch):
    rng = np.random.default_rng(3)
    texts = [bytes(rng.integers(32, 127, n).astype(np.uint8)) for n in (0, 5, 9_000, 700, 40_000)] + [None, b""]
    whole, numbers = mil.passage_features(texts)
    for size in (1, 1_000, 7_777):
        monkeypatch.setattr(mil, "AT_ONCE", size)
        x, n = mil.passage_features(texts)
        assert (x == whole).all() and (n == numbers).all()
