"""Edge cases of single operators on tiny frames."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from corpuslens.operators import corpus, distributions, evaluate, feedback, ingest, queues, reports, vectors
from corpuslens.schemas import KEYS, TABLES

DAY = datetime.date
NOON = datetime.datetime(2019, 2, 3, 12)


def dataset(spark):
    dates = [DAY(2018, 1, 1), DAY(2018, 6, 30), DAY(2018, 7, 1), DAY(2018, 12, 31), DAY(2019, 1, 1), DAY(2019, 3, 1)]
    return spark.createDataFrame([("d1", "converged_filtered", *dates)], TABLES["ds_metadata"])


def report_rows(spark, scored, stype=0, when=NOON):
    rows = [
        ("m1", "d1", "model_rpt_gt", i, "a b", stype, when, label, int(raw >= 0.5), Decimal(str(raw)), None, None, None, None)
        for i, (label, raw) in enumerate(scored)
    ]
    return evaluate.with_confusion_flags(spark.createDataFrame(rows, TABLES["model_analysis_rpts"]))


def test_mcc_with_an_empty_margin_is_null(spark):
    only_positive = report_rows(spark, [(1, 0.9), (1, 0.8)])
    row = evaluate.current_mcc(only_positive, dataset(spark)).first()
    assert row.mcc is None and row.tp_ratio == 1.0
    nothing = evaluate.current_mcc(only_positive, dataset(spark), stype=1).first()
    assert nothing.asDict() == dict.fromkeys(("mcc", "tp_ratio", "tn_ratio", "fp_ratio", "fn_ratio"))


def test_mcc_of_large_counts_does_not_overflow(spark):
    rows = report_rows(spark, [(1, 0.9), (0, 0.1), (1, 0.2), (0, 0.8)])
    many = rows.withColumn("x", F.explode(F.sequence(F.lit(1), F.lit(100_000)))).drop("x")
    row = evaluate.current_mcc(many, dataset(spark)).first()
    assert row.mcc == 0.0 and row.tp_ratio == 0.25


def test_ppv_without_positive_predictions_is_zero(spark):
    rows = report_rows(spark, [(0, 0.1 + i / 100) for i in range(30)])
    got = evaluate.accuracy_lookup(rows, dataset(spark), "nontweet").collect()
    assert len(got) == 25 and {r.ppv for r in got} == {0.0} and {r.npv for r in got} == {1.0}
    assert {(r.ppr, r.npr, r.auc, r.mcc) for r in got} == {(0.0, 1.0, None, None)}


def test_fewer_rows_than_buckets(spark):
    rows = report_rows(spark, [(1, 0.9), (0, 0.3), (1, 0.6)])
    assert evaluate.accuracy_summary(rows, dataset(spark), "all").count() == 3


def test_last_test_day_ends_at_midnight(spark):
    late = report_rows(spark, [(1, 0.9)], when=datetime.datetime(2019, 3, 1, 6))
    midnight = report_rows(spark, [(1, 0.9)], when=datetime.datetime(2019, 3, 1))
    assert evaluate.current_mcc(late, dataset(spark)).first().tp_ratio is None
    assert evaluate.current_mcc(midnight, dataset(spark)).first().tp_ratio == 1.0


def test_global_accuracy_needs_both_kinds(spark):
    assert evaluate.global_accuracy(report_rows(spark, [(1, 0.9), (0, 0.2)]), dataset(spark)).count() == 0


def test_extreme_bucket_through_one_hot_score(spark):
    """All rows tie on the score, so buckets are cut by statement id alone."""
    rows = report_rows(spark, [(1, 0.7)] * 103)
    got = reports.extreme_ppv(rows, dataset(spark), 0, 25).collect()
    assert sorted(r.statement_id for r in got) == [0, 1, 2, 3, 4] and {r.conf_percentile for r in got} == {"0-4%"}


def test_published_unlabelled_rows_count_as_wrong_unless_left_out(spark):
    reports_frame = report_rows(spark, [(1, 0.9)])
    rows = [
        (i, "m1", 1, "t", i, 1, Decimal("0.9"), Decimal("0.9"), NOON, label, None)
        for i, label in enumerate([1, None, 1, None])
    ]
    published = spark.createDataFrame(rows, TABLES["infsvc_stmts_published"])
    assert {r.acc for r in evaluate.published_accuracy(published, reports_frame).collect()} == {0.5}
    assert {r.acc for r in evaluate.published_accuracy(published, reports_frame, labelled_only=True).collect()} == {1.0}


def test_nothing_analysed_gives_no_queue(spark):
    statements = spark.createDataFrame([("t", 0, "x", None, 9)], TABLES["fbase_statements"])
    transcripts = spark.createDataFrame([("t", DAY(2019, 1, 1), "s", "u", None)], TABLES["fbase_transcripts"])
    none = statements.select("tid", "sid").limit(0)
    assert queues.statements_to_analyse(statements, transcripts, none, none).count() == 0
    done = statements.select("tid", F.lit(5).alias("sid"))
    assert queues.statements_to_analyse(statements, transcripts, done, none).count() == 0  # not a known statement


def test_tweet_source_ignores_case_accents_and_trailing_blanks(spark):
    df = spark.createDataFrame([("Twitter",), ("TWITTER  ",), ("Twïtter",), (" Twitter",), ("Speech",)], "s string")
    assert [r[0] for r in df.select(corpus.is_tweet_source(F.col("s"))).collect()] == [1, 1, 1, 0, 0]


def test_duplicates_are_counted_not_multiplied(spark):
    claims = spark.createDataFrame([(i, "Same text") for i in range(50)], "sid bigint, statement_text string")
    tweets = spark.createDataFrame([(i, "same TEXT", 9) for i in range(40)], "thread_id bigint, statement_text string, wc int")
    statements = spark.createDataFrame([("t", 1, "other", 9)], "tid string, sid int, statement_text string, wc int")
    rows = corpus.exact_duplicates(statements, tweets, claims).collect()
    assert len(rows) == 40 and {(r.tid, r.n_claims) for r in rows} == {("none", 50)}


def test_sample_sizes_equal_quotas(spark):
    rng = random.Random(3)
    claims = spark.createDataFrame([(i, rng.randrange(7, 12)) for i in range(100)], "sid bigint, wc int")
    truths = spark.createDataFrame(
        [(f"t{i}", "x", 0, NOON, 7 if rng.random() < 0.8 else rng.randrange(8, 13)) for i in range(2000)],
        TABLES["all_truth_statements_tmp"],
    )
    quota = {r.wc: r.xformed_wc_cnt * 2000 for r in corpus.target_distribution(claims, truths).collect()}
    held = {r.swc: r["count"] for r in truths.groupBy("swc").count().collect()}
    sampled = corpus.converged_sample(claims, truths).join(truths.select("truth_id", "swc"), "truth_id")
    got = {r.swc: r["count"] for r in sampled.groupBy("swc").count().collect()}
    assert got == {wc: min(held[wc], int(q + 0.5)) for wc, q in quota.items() if int(q + 0.5)}
    again = corpus.converged_sample(claims, truths.repartition(7))
    assert sorted(r.truth_id for r in again.collect()) == sorted(r.truth_id for r in sampled.collect())


def test_close_pairs_equal_all_pairs(spark):
    rng = random.Random(6)
    base = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(60)]
    moved = [[x + rng.gauss(0, 0.05) for x in v] for v in base] + base[:5]
    claims = [(i, v) for i, v in enumerate(base)] + [(100 + i, base[0]) for i in range(30)]
    truths = list(enumerate(moved))
    schema = "id bigint, vector array<double>"
    frames = spark.createDataFrame(claims, schema), spark.createDataFrame(truths, schema)
    found = vectors.close_pairs(*frames, 0.2, size=8, most=4)

    def dist(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b)) ** 0.5

    naive = {(i, j) for i, a in enumerate(base) for j, b in truths if dist(a, b) < 0.2}
    assert {(r.falsehood_id, r.truth_id) for r in found.collect()} == naive
    assert {r.n_falsehoods for r in found.where("falsehood_id = 0").collect()} == {31}
    firsts = vectors.representatives(spark.createDataFrame(claims, schema)).where("id >= 100")
    assert {r.representative for r in firsts.collect()} == {0}
    every = vectors.with_copies(found, *(vectors.representatives(f) for f in frames))
    whole = {(i, j) for i, a in claims for j, b in truths if dist(a, b) < 0.2}
    assert sorted((r.falsehood_id, r.truth_id) for r in every.collect()) == sorted(whole)


def test_candidates_stay_few_as_vectors_grow(spark):
    """A cloud four times as large and as dense has four times the candidates, not sixteen times."""
    rng = random.Random(9)

    def candidates(n):
        rows = [(i, [rng.gauss(0, 1) for _ in range(12)]) for i in range(n)]
        frame = spark.createDataFrame(rows, "id bigint, vector array<double>")
        truths, claims = vectors.partitioned(*2 * [frame.selectExpr("id", "vector as p")], 12, 0.02, 16, ways=4)
        assert truths.count() == n and truths.groupBy("cell").count().agg({"count": "max"}).first()[0] <= 16
        return claims.join(truths.withColumnRenamed("id", "truth"), "cell").count() / n

    small, large = candidates(500), candidates(2000)
    assert large < 1.7 * small


def test_cells_that_cannot_be_cut(spark):
    """Vectors that differ only where no direction looks stay in one cell and still meet."""
    rows = [(i, [0.0, 0.0, i * 1e-3]) for i in range(40)]
    frame = spark.createDataFrame(rows, "id bigint, vector array<double>")
    same = frame.selectExpr("id", "slice(vector, 1, 2) as p")
    truths, claims = vectors.partitioned(same, same, 2, 0.01, 4)
    assert truths.select("cell").distinct().count() == 1 and claims.count() == 40
    found = vectors.close_pairs(frame, frame, 0.0015, size=3, dims=2, most=4)
    assert found.count() == 40 + 2 * 39


def test_late_labels(spark):
    rows = [(i, "m1", 1, "t", i, 0, Decimal("0.1"), Decimal("0.9"), NOON, label, None) for i, label in enumerate([None, 0, 1, None])]
    published = spark.createDataFrame(rows, TABLES["infsvc_stmts_published"])
    matched = spark.createDataFrame([("t", 0, DAY(2020, 1, 1)), ("t", 0, DAY(2020, 1, 2)), ("t", 1, DAY(2020, 1, 1))],
                                    "tid string, sid int, s_date date")
    checked = spark.createDataFrame([("t", 1), ("t", 2)], "tid string, sid int")
    got = feedback.with_late_labels(published, matched, checked, ["tid", "sid"], F.lit("2020-02-01").cast("timestamp"))
    assert got.columns == published.columns
    assert [(r.sid, r.actual_label, r.score_date is not None) for r in got.orderBy("sid").collect()] == [
        (0, 1, True), (1, 1, True), (2, 0, True), (3, None, False),
    ]


def test_split_by_share_never_divides_a_day(spark):
    days = [DAY(2020, 1, 1)] * 8 + [DAY(2020, 1, 2)] + [DAY(2020, 1, 3)] * 3
    rows = corpus.split_by_share(spark.createDataFrame([(d,) for d in days], "s_date date"), 0.7, 0.1).collect()
    assert {(r.split, r.start_date, r.n) for r in rows} == {
        ("train", DAY(2020, 1, 1), 8), ("val", DAY(2020, 1, 2), 1), ("test", DAY(2020, 1, 3), 3),
    }


@pytest.mark.parametrize("n_truths, n_false, chunk", [(5, 3, 2), (3, 5, 100), (4, 4, 1), (0, 2, 10), (2, 0, 10), (0, 0, 5)])
def test_positional_join(spark, n_truths, n_false, chunk):
    schema = "s_date date, wc int"
    left = [(DAY(2020, 1, 1 + i % 2), 7 + i % 3) for i in range(n_truths)]
    right = [(DAY(2020, 1, 1), 20 + i) for i in range(n_false)]
    rows = distributions.positional_join(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), chunk)
    a, b = [w for _, w in sorted(left)], [w for _, w in sorted(right)]
    want = [(i, a[i] if i < len(a) else None, b[i] if i < len(b) else None) for i in range(max(len(a), len(b)))]
    assert sorted(map(tuple, rows.collect())) == want


def claim(sid, text, topic="jobs", hashed=None, day=DAY(2020, 1, 1)):
    return (sid, 1, text, 0, topic, "src", 0, day, hashed or text, 1)


def test_reject_reasons(spark):
    columns = "sid bigint, iid int, statement_text string, repeats int, topic string, source string, pinnochios int, s_date date, statement_hash string, wc int"
    batch = spark.createDataFrame(
        [claim(1, "a"), claim(2, "a"), claim(3, "b"), claim(4, "x" * 2001, hashed="c"), claim(5, "c"), claim(6, "d", topic=None)],
        columns,
    )
    target = spark.createDataFrame([claim(90, "b")], columns)
    rules = ingest.broken_rules(TABLES["wp_statements"])
    got = ingest.with_reject_reason(batch, target, KEYS["wp_statements"], ["sid"], rules)
    assert {r.sid: r.reject_reason for r in got.collect()} == {
        1: None, 2: "duplicate_in_batch", 3: "exists", 4: None, 5: "duplicate_in_batch", 6: "null:topic",
    }
    parents = spark.createDataFrame([(2,)], "iid int")
    orphaned = ingest.with_reject_reason(batch, target, KEYS["wp_statements"], ["sid"], rules, parents, ["iid"])
    assert {r.reject_reason for r in orphaned.where("sid in (1, 2, 3, 5)").collect()} == {"no_parent"}


def test_high_water_mark(spark):
    target = spark.createDataFrame([(1, 5), (2, 9)], "iid int, id bigint")
    batch = spark.createDataFrame([(i,) for i in range(4, 12)], "id bigint")
    mark = ingest.high_water_mark(target, "id", F.lit(0).cast("bigint"), F.col("iid") == 1)
    assert tuple(mark.first()) == (5, False)
    assert ingest.newer_rows(batch, mark, "id").count() == 7
    assert ingest.newer_rows(batch, mark, "id", inclusive=False).count() == 6
    empty = ingest.high_water_mark(target.limit(0), "id", F.lit(0).cast("bigint"))
    assert tuple(empty.first()) == (0, True) and ingest.newer_rows(batch, empty, "id").count() == 8


def test_surrogate_keys_follow_the_largest(spark):
    rows = spark.createDataFrame([(f"h{i}",) for i in range(50)], "h string").repartition(6)
    target = spark.createDataFrame([(7,)], "sid bigint")
    got = ingest.with_surrogate_key(rows, target, "sid", ["h"])
    assert sorted(r.sid for r in got.collect()) == list(range(8, 58))
    first = ingest.with_surrogate_key(rows, target.limit(0), "sid", ["h"])
    assert sorted(r.sid for r in first.collect()) == list(range(1, 51))
    assert ingest.seeded_dimension(spark, "iid", "name", ["A B"]).collect()[0].iid == 1


def test_snapshot_does_not_follow_its_tables(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    kept = ingest.snapshot(spark.read.parquet(path), str(tmp_path / "snap"))
    spark.range(5).write.mode("append").parquet(path)
    assert kept.count() == 3 and spark.read.parquet(path).count() == 8


def test_load_with_rejects(spark, tmp_path):
    columns = "k int, seq int, v string"
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, None)], columns)
    rules = [F.when(F.col("v").isNull(), F.lit("null:v"))]
    assert ingest.load_with_rejects(rows, table, bad, ["k"], ["seq"], rules) == (1, 2)
    assert ingest.load_with_rejects(rows, table, bad, ["k"], ["seq"], rules) == (0, 3)
    assert [tuple(r) for r in spark.read.parquet(table).collect()] == [(1, 1, "a")]
    reasons = sorted(r.reject_reason for r in spark.read.parquet(bad).collect())
    assert reasons == ["duplicate_in_batch", "exists", "exists", "null:v", "null:v"]


def test_load_with_rejects_again_after_a_failure(spark, tmp_path):
    columns = "k int, seq int, v string"
    table, bad = str(tmp_path / "t"), str(tmp_path / "bad")
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (2, 3, "c")], columns)
    assert ingest.load_with_rejects(rows, table, bad, ["k"], ["seq"], batch_id="b1") == (2, 1)
    assert ingest.load_with_rejects(rows, table, bad, ["k"], ["seq"], batch_id="b1") == (0, 1)
    assert spark.read.parquet(table).count() == 2
    assert [(r.seq, r.reject_reason) for r in spark.read.parquet(bad).collect()] == [(2, "duplicate_in_batch")]


def test_history_append_is_idempotent(spark, tmp_path):
    rows = report_rows(spark, [(i % 2, 0.1 + 0.02 * (i % 40)) for i in range(200)])
    both = rows.unionByName(rows.withColumn("stype", F.lit(1)).withColumn("statement_id", F.col("statement_id") + 1000))
    history = evaluate.local_perf_summary(both, dataset(spark))
    path, key = str(tmp_path / "history"), KEYS["local_model_perf_summary_hist"]
    assert ingest.append_keyed(history, path, key, key) == 35
    assert ingest.append_keyed(history, path, key, key) == 0
    one_row = evaluate.global_perf_summary(both, dataset(spark))
    assert set(one_row.columns) == {f.name for f in TABLES["model_metadata"]}
