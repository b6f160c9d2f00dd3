import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from corpuslens.plans import ranks
from corpuslens.plans.skew import lookup_join


@pytest.fixture(scope="module")
def scores(spark):
    rng = random.Random(1)
    rows = [(i, rng.choice([5000, rng.randrange(5000, 10001)]), rng.randrange(2)) for i in range(3000)]
    return spark.createDataFrame(rows, "id bigint, v int, label int").repartition(5).persist()


@pytest.mark.parametrize("k", [1, 7, 10, 25, 100])
@pytest.mark.parametrize("n", [3, 24, 25, 26, 3000])
def test_tiles_of_histogram_equal_ntile(scores, k, n):
    rows = scores.where(F.col("id") < n)
    spans = ranks.with_span(rows.groupBy("v", "label").agg(F.count("*").alias("n")), ["v", "label"])
    pieces = ranks.cut_into_tiles(spans, k).groupBy("bucket").agg(
        F.sum("take").alias("n"), F.sum(F.col("take") * F.col("label")).alias("ones"), F.max("v").alias("top")
    )
    tiled = rows.withColumn("bucket", F.ntile(k).over(Window.orderBy("v", "label", "id")))
    naive = tiled.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("label").alias("ones"), F.max("v").alias("top"))
    assert sorted(map(tuple, pieces.collect())) == sorted(map(tuple, naive.collect()))
    sizes = [r["n"] for r in naive.collect()]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1


def test_global_rank_equals_row_number(scores):
    got = ranks.global_rank(scores, ["v", "id"])
    naive = scores.withColumn("rn", F.row_number().over(Window.orderBy("v", "id")))
    assert sorted(map(tuple, got.select("id", "rn").collect())) == sorted(map(tuple, naive.select("id", "rn").collect()))


def test_global_rank_of_nothing(scores):
    assert ranks.global_rank(scores.where("id < 0"), ["v", "id"]).count() == 0


def test_cume_dist_equals_window(scores):
    got = ranks.cume_dist(scores, "v").select("v", "c_dist")
    naive = scores.select("v", F.cume_dist().over(Window.orderBy("v")).alias("c_dist")).distinct()
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, naive.collect()))


def test_auc_equals_pairs(scores):
    rows = scores.where("id < 400").collect()
    pairs = [
        1.0 if p.v > n.v else 0.5 if p.v == n.v else 0.0
        for p in rows if p.label == 1 for n in rows if n.label == 0
    ]
    got = ranks.auc(scores.where("id < 400"), "v", "label").first()[0]
    assert got == pytest.approx(sum(pairs) / len(pairs), abs=1e-12)
    flipped = ranks.auc(scores.where("id < 400").withColumn("v", -F.col("v")), "v", "label").first()[0]
    assert got + flipped == pytest.approx(1.0)


def test_auc_of_one_class_is_null(scores):
    assert ranks.auc(scores.where("label = 1"), "v", "label").first()[0] is None
    assert ranks.auc(scores.where("id < 0"), "v", "label").first()[0] is None


def test_smallest_per_group_with_a_hot_group(spark):
    rng = random.Random(2)
    rows = [(f"t{i}", 1 if rng.random() < 0.7 else rng.randrange(2, 6)) for i in range(4000)]
    quota = {1: 900, 2: 10, 3: 0, 4: 5000, 5: 1}
    df = spark.createDataFrame([(t, g, quota[g]) for t, g in rows], "id string, g int, quota bigint")
    df = df.withColumn("code", F.sha1("id"))
    got = ranks.smallest_per_group(df, ["g"], "quota", "code", "id", bin_chars=2)
    rn = F.row_number().over(Window.partitionBy("g").orderBy("code", "id"))
    naive = df.withColumn("rn", rn).where("rn <= quota")
    assert sorted(r.id for r in got.collect()) == sorted(r.id for r in naive.collect())


@pytest.mark.parametrize("how", ["inner", "left", "left_anti", "left_semi"])
def test_lookup_join_with_hot_and_null_keys(spark, how):
    rng = random.Random(7)
    rows = [(i, None if i % 50 == 0 else 1 if rng.random() < 0.4 else rng.randrange(2, 90)) for i in range(2000)]
    df = spark.createDataFrame(rows, "id bigint, k int").repartition(5)
    lookup = spark.createDataFrame([(k, f"v{k}") for k in range(1, 60)], "k int, v string")
    got = lookup_join(df, lookup, ["k"], ["id"], how, hot=0.5)
    naive = df.join(lookup, "k", how)
    assert sorted(map(str, got.select(*naive.columns).collect())) == sorted(map(str, naive.collect()))


def test_auc_of_scores_with_many_values_needs_no_window_over_all(spark):
    from corpuslens.plans.ranks import auc, running_totals

    rng = random.Random(12)
    rows = [(rng.choice([rng.random(), 0.25, 0.5, None]), rng.randrange(2)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "score double, label int").repartition(6)
    key = [(-1.0 if s is None else s, y) for s, y in rows]
    pos, neg = [s for s, y in key if y], [s for s, y in key if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg)
    assert abs(auc(df, "score", "label").first()[0] - won / len(pos) / len(neg)) < 1e-12
    assert auc(df.where("label = 1"), "score", "label").first()[0] is None

    counted = df.groupBy("score").count()
    got = {r["score"]: r["count_before"] for r in running_totals(counted, ["score"], ["count"]).collect()}
    order = sorted(got, key=lambda s: (s is not None, s))
    counts, total = {r["score"]: r["count"] for r in counted.collect()}, 0
    for score in order:
        assert got[score] == total
        total += counts[score]
