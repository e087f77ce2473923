"""The distributed building blocks against their single-task counterparts."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from flowlab.operators import metrics as M
from flowlab.operators import preparing, sampling, scale


def rows_equal(a, b):
    return a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


@pytest.fixture(scope="module")
def skewed(spark):
    """Two thirds of the rows in one class, some without a class."""
    return spark.range(3000).selectExpr(
        "id * 7 % 3001 as row_id",
        "case when id % 3 < 2 then 'big' when id % 30 = 2 then null else concat('c', id % 5) end as label",
        "cast(id % 17 as double) as few", "pmod(hash(id), 100000) / 7.0 as many",
        "case when id % 4 = 0 then null else cast(id as double) end as holes",
    ).cache()


@pytest.mark.parametrize("target", [50, 700, 10**6])
@pytest.mark.parametrize("within", [[], ["label"]])
def test_number_rows(spark, skewed, target, within):
    got = scale.number_rows(skewed.select("row_id", "label"), "row_id", within=within,
                            target_rows=target, total="n").select("row_id", "label", "rn", "n")
    w = Window.partitionBy(*within)
    want = skewed.select("row_id", "label", F.row_number().over(w.orderBy("row_id")).cast("long").alias("rn"),
                         F.count("*").over(w).alias("n"))
    assert rows_equal(got, want)


def test_number_rows_with_prefix(skewed):
    df = skewed.select("row_id", "label")
    got = scale.number_rows(df, "row_id", prefix=["label"], target_rows=100)
    want = df.withColumn("rn", F.row_number().over(Window.orderBy("label", "row_id")).cast("long"))
    assert rows_equal(got.select(*want.columns), want)


def test_number_by_hash(skewed):
    df = skewed.select("row_id", "label")
    got = scale.number_by_hash(df, ["row_id"], 7, within=["label"])
    order = Window.partitionBy("label").orderBy(scale.seeded_hash(7, "row_id"))
    want = df.withColumn("rn", F.row_number().over(order).cast("long"))
    assert rows_equal(got.select(*want.columns), want)


@pytest.mark.parametrize("n", [0, 1, 40, 5000])
def test_sample_per_class(skewed, n):
    df = skewed.select("row_id", "label")
    got = sampling.sample_per_class(df, n)
    order = Window.partitionBy("label").orderBy(scale.seeded_hash(42, "row_id"))
    want = df.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= n).drop("_r")
    assert rows_equal(got, want)


def test_split_is_stratified_and_not_shuffled(skewed):
    got = sampling.stratified_split(skewed.select("row_id", "label"))
    assert got.count() == skewed.count()
    for r in got.groupBy("label").pivot("split", ["test", "val", "train"]).count().collect():
        total = sum(r[s] or 0 for s in ("test", "val", "train"))
        assert abs((r["test"] or 0) - 0.2 * total) <= 1 and abs((r["val"] or 0) - 0.1 * total) <= 1
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning" not in plan and "rangepartitioning" not in plan


def test_folds(skewed):
    got = sampling.stratified_folds(skewed.select("row_id", "label"), 4)
    counts = got.groupBy("label").pivot("fold", [0, 1, 2, 3]).count().collect()
    for r in counts:
        sizes = [r[str(i)] or 0 for i in range(4)]
        assert max(sizes) - min(sizes) <= 1


@pytest.mark.parametrize("by", [None, "label"])
def test_quantiles_in_brackets_equal_the_builtin(skewed, by):
    cols, ps = ["few", "many", "holes"], [0.0, 0.25, 0.5, 0.95, 1.0]
    exact = scale.exact_quantiles(skewed, cols, ps, by)
    counts = {}
    narrow = scale.exact_quantiles(skewed, cols, ps, by, small=0, accuracy=200, counts=counts)
    pairs = [(exact, narrow)] if by is None else [(exact[k], narrow[k]) for k in exact]
    for a, b in pairs:
        for c in cols:
            assert b[c] == pytest.approx(a[c], rel=1e-12)
    assert counts[None] == 3000 and counts["holes"] == 2250


@pytest.mark.parametrize("small", [0, 200_000])
def test_quantiles_with_infinities_and_nan(spark, small):
    inf, nan = float("inf"), float("nan")
    rows = [(float(i), -inf if i < 100 else inf if i > 800 else float(i), nan if i % 3 == 0 else float(i)) for i in range(1000)]
    df = spark.createDataFrame(rows, "a double, b double, c double")
    got = scale.exact_quantiles(df, ["a", "b", "c"], [0.0, 0.05, 0.5, 0.95, 1.0], small=small, accuracy=50)
    assert got["a"] == pytest.approx([0.0, 49.95, 499.5, 949.05, 999.0])
    assert got["b"] == [-inf, -inf, 499.5, inf, inf]
    assert got["c"][0] == 1.0 and got["c"][4] == 998.0 and got["c"][2] == pytest.approx(499.5, abs=1)


def test_quantiles_of_nothing(skewed):
    empty = skewed.where("row_id < 0")
    assert scale.exact_quantiles(empty, ["few"], [0.5]) == {"few": [None]}


def test_hot_groups(spark):
    df = spark.range(9000).selectExpr("case when id % 3 = 0 then -1 else id end as k")
    assert len(scale.hot_groups(df, ["k"], 2000)) == 1
    assert scale.hot_groups(df, ["k"], 3000) == []


def test_auc_in_score_buckets(spark):
    rng = random.Random(5)
    rows = [(rng.random() < 0.4, round(0.999 + rng.random() / 1000, 5)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "pos boolean, s double")
    pos = [s for p, s in rows if p]
    neg = [s for p, s in rows if not p]
    want = sum((a > b) + 0.5 * (a == b) for a in pos for b in neg) / (len(pos) * len(neg))
    for target in (100, 10**6):
        got = M.auc_binary(df, F.col("pos"), "s", target_rows=target).first()["auc"]
        assert got == pytest.approx(want, abs=1e-12)


def test_auc_needs_both_classes(spark):
    df = spark.createDataFrame([(1, 0.3), (1, 0.6)], "y_true int, s double")
    assert M.auc_ovr(df, {1: "s"}).first()[0] is None


def test_checked_broadcast(spark):
    small = spark.range(10).toDF("k")
    big = spark.range(1000).selectExpr("id % 10 as k")
    joined = big.join(scale.checked_broadcast(small), "k")
    assert "BroadcastHashJoin" in joined._jdf.queryExecution().executedPlan().toString()
    assert scale.checked_broadcast(small, limit=5).sameSemantics(small)


def test_class_joins_do_not_shuffle_the_rows(skewed):
    from flowlab.operators import cleaning as C
    from flowlab.operators import preparing as R
    from flowlab.operators import profiling as P

    for df in (C.min_support(skewed, 100), R.attach_weights(skewed)):
        assert "Exchange hashpartitioning" not in df._jdf.queryExecution().executedPlan().toString()
    plan = P.histogram(skewed, "many")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # the final, pre-aggregated count


def test_a_long_profile_derives_its_columns_once(spark):
    """The prepared table reads the cleaned and split rows, not their derivation."""
    df = spark.range(300).select(
        F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("label"),
        (F.col("id") % 50).cast("double").alias("fwd_packet_count"), (F.col("id") * 7.0).alias("total_fwd_bytes"),
        F.lit(1).alias("unused"),
    )
    cols = ["fwd_packet_count", "total_fwd_bytes"]
    model, table = preparing.fit_preprocessor(df, cols, profile="cic")
    plan = table._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "log1p" not in plan and "md5" not in plan
    again = preparing.transform(df, model).select("row_id", *cols).collect()
    assert sorted(table.select("row_id", *cols).collect()) == sorted(again)
    assert {r["split"]: r["count"] for r in table.groupBy("split").count().collect()} == {"train": 210, "val": 30, "test": 60}
