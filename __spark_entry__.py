"""Entry points for checks: the flagship query, all queries, and the same results in plain SQL."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens import oracle
from corpuslens.fixtures import INDEX_URL, SPEAKER, Inputs
from corpuslens.functions import text
from corpuslens.operators import corpus, distributions, evaluate, feedback, feeds, ingest, queues, reports, threads, vectors
from corpuslens.plans.ranks import auc
from corpuslens.plans.slices import NONTWEET, TWEET, test_rows
from corpuslens.schemas import KEYS, TABLES
from corpuslens.session import materialise, shared_folder
from corpuslens.sources import claims, metadata, transcripts, tweets
from corpuslens.sources.html import Field, Step, extract
from corpuslens.streaming.ingest import feed_sink, keyed_sink
from corpuslens.streaming.threads import thread_stream

try:  # the text operators and their pipeline are an optional part
    import corpus_pipeline
    from corpuslens.llm import queries as llm
except ModuleNotFoundError as missing:
    if missing.name not in ("corpus_pipeline", "corpuslens.llm"):
        raise
    llm = None

Query = Callable[[SparkSession, str], DataFrame]

STYPE = {"all": None, "nontweet": NONTWEET, "tweet": TWEET}
TILES = {"all": 25, "nontweet": 25, "tweet": 10}
SCORE_DATE = "2020-06-01 00:00:00"
PARTS = 32  # folders of a table laid out by key; a real one takes more
THREAD_LATENCY, THREAD_NOW, THREAD_DELAY = 6 * 3600, datetime(2024, 1, 30, 12), "8 hours"


def _evaluation() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    q = {}
    numbers = {"all": (2, 5, 10, 13), "tweet": (3, 7, 9, 11), "nontweet": (4, 6, 8, 12)}
    for kind, (a, b, c, d) in numbers.items():
        q[f"e{a:02}_{kind}_current_mcc"] = (
            lambda i, k=kind: evaluate.current_mcc(i.model_analysis_rpts, i.ds_metadata, STYPE[k]), oracle.mcc(kind))
        q[f"e{b:02}_auc_{kind}"] = (
            lambda i, k=kind: evaluate.current_auc(i.model_analysis_rpts, i.ds_metadata, STYPE[k]), oracle.auc(kind))
        q[f"e{c:02}_{kind}_accuracy_lookup"] = (
            lambda i, k=kind: evaluate.accuracy_lookup(i.model_analysis_rpts, i.ds_metadata, k), oracle.lookup(kind))
        q[f"e{d:02}_{kind}_accuracy_summary"] = (
            lambda i, k=kind: evaluate.accuracy_summary(i.model_analysis_rpts, i.ds_metadata, k), oracle.summary(kind))
    q["e01_confusion_flags"] = (
        lambda i: evaluate.with_confusion_flags(i.model_analysis_rpts.drop("tp", "fp", "tn", "fn"))
        .select("model_version", "report_type", "statement_id", "tp", "fp", "tn", "fn"),
        oracle.with_tables("select model_version, report_type, statement_id, tp, fp, tn, fn from {model_analysis_rpts}"))
    def double_scores(i):
        """Scores of full precision, one of its own for every row."""
        rows = test_rows(i.model_analysis_rpts, i.ds_metadata, None)
        scored = rows.withColumn("score", F.col("raw_pred").cast("double") + F.col("statement_id") / 1e9)
        return auc(scored, "score", "label").withColumn("est_auc", F.round("est_auc", 9))

    q["e05_auc_double_scores"] = (double_scores, oracle.auc_of_doubles())
    q["e14_global_accuracy"] = (
        lambda i: evaluate.global_accuracy(i.model_analysis_rpts, i.ds_metadata), oracle.global_accuracy(False))
    q["e15_global_perf_summary"] = (
        lambda i: evaluate.global_perf_summary(i.model_analysis_rpts, i.ds_metadata), oracle.global_accuracy(True))
    q["e16_local_perf_summary"] = (
        lambda i: evaluate.local_perf_summary(i.model_analysis_rpts, i.ds_metadata), oracle.local_summary())
    for first, name in ((17, "stmts"), (19, "tweets")):
        table = f"infsvc_{name}_published"
        q[f"e{first}_auc_published_{name}"] = (
            lambda i, t=table: evaluate.published_auc(getattr(i, t), i.model_analysis_rpts), oracle.published_auc(table))
        q[f"e{first + 1}_published_{name}_accuracy"] = (
            lambda i, t=table: evaluate.published_accuracy(getattr(i, t), i.model_analysis_rpts),
            oracle.published_accuracy(table))
    return q


def _reports() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    q = {}
    order = {"all": 0, "tweet": 1, "nontweet": 2}
    chart = ("week", "true positives", "true negatives", "false positives", "false negatives")
    for kind, n in order.items():
        q[f"r{1 + n:02}_ground_truth_{kind}"] = (
            lambda i, k=kind: reports.ground_truth_report(i.model_analysis_rpts, STYPE[k]), oracle.weekly(kind, False))
        q[f"r{4 + n:02}_test_matrix_{kind}"] = (
            lambda i, k=kind: reports.test_matrix(i.model_analysis_rpts, i.ds_metadata, STYPE[k]),
            oracle.weekly(kind, True))
        q[f"n07_weekly_frame_test_{kind}"] = (
            lambda i, k=kind: distributions.weekly_frame(
                reports.test_matrix(i.model_analysis_rpts, i.ds_metadata, STYPE[k])),
            oracle.weekly(kind, True, chart))
        q[f"n07_weekly_frame_{kind}"] = (
            lambda i, k=kind: distributions.weekly_frame(reports.ground_truth_report(i.model_analysis_rpts, STYPE[k])),
            oracle.weekly(kind, False, chart))
    for kind, n in {"all": 7, "nontweet": 8, "tweet": 9}.items():
        def matrix(i, k=kind):
            return reports.confidence_matrix(i.model_analysis_rpts, i.ds_metadata, STYPE[k], TILES[k])

        q[f"r{n:02}_confidence_matrix_{kind}"] = (matrix, oracle.confidence_matrix(kind))
        q[f"n08_confidence_frame_{kind}"] = (
            lambda i, m=matrix: distributions.confidence_frame(m(i)), oracle.confidence_frame(kind))
    for n, side, kind in ((10, "max", "nontweet"), (11, "max", "tweet"), (12, "min", "nontweet"), (13, "min", "tweet")):
        q[f"r{n}_{side}_ppv_{kind}s"] = (
            lambda i, s=side, k=kind: reports.extreme_ppv(
                i.model_analysis_rpts, i.ds_metadata, STYPE[k], TILES[k], s == "max"),
            oracle.extreme(kind, side))
    q["r14_explained_statements"] = (
        lambda i: reports.explained_statements(i.model_analysis_rpts, i.ds_metadata), oracle.explained())
    return q


def _corpus() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def truth_args(i):
        return i.fbase_statements, i.fbase_transcripts, i.dcbot_tweets, i.wp_statements

    def pairs(i):
        found = vectors.close_pairs(i.claim_vectors, i.truth_vectors, 0.023, size=64)
        return found.withColumn("l2dist", F.round("l2dist", 9))

    def candidates(i):
        found = vectors.close_pairs(i.claim_vectors, i.truth_vectors, 0.023, size=64)
        return vectors.with_copies(found, vectors.representatives(i.claim_vectors), vectors.representatives(i.truth_vectors))

    return {
        "d01_falsehoods": (lambda i: corpus.falsehoods(i.wp_statements), oracle.FALSEHOODS),
        "d02_truths": (lambda i: corpus.truths(*truth_args(i)), oracle.TRUTHS),
        "d03_falsehoods_tiny": (lambda i: corpus.falsehoods_tiny(i.wp_statements), oracle.FALSEHOODS_TINY),
        "d04_truths_tiny": (lambda i: corpus.truths_tiny(*truth_args(i)), oracle.TRUTHS_TINY),
        "d05_all_truths": (lambda i: corpus.all_truths(*truth_args(i)), oracle.ALL_TRUTHS),
        "d06_truth_snapshot": (lambda i: i.truth_snapshot, oracle.ALL_TRUTHS),
        "d07_target_distribution": (
            lambda i: corpus.target_distribution(i.wp_statements, i.truth_snapshot), oracle.TARGET),
        "d08_matched_falsehoods": (lambda i: i.falsehood_rows, oracle.with_tables("select * from {fm}", **oracle.MATCHED)),
        "d09_matched_truths": (lambda i: i.truth_rows, oracle.with_tables("select * from {tm}", **oracle.MATCHED)),
        "d10_falsehood_date_driver": (lambda i: corpus.date_driver(i.falsehood_rows), oracle.DATE_DRIVER),
        "d11_falsehood_date_driver_tiny": (
            lambda i: corpus.date_driver(corpus.falsehoods_tiny(i.wp_statements)), oracle.DATE_DRIVER_TINY),
        "d12_exact_duplicates": (
            lambda i: corpus.exact_duplicates(i.fbase_statements, i.dcbot_tweets, i.wp_statements),
            oracle.EXACT_DUPLICATES),
        "d12_without_exact_duplicates": (
            lambda i: corpus.without_exact_duplicates(i.truth_snapshot, i.wp_statements), oracle.WITHOUT_DUPLICATES),
        "d13_near_duplicates_tuned": (
            lambda i: corpus.near_duplicates(i.false_truth_del_cands),
            oracle.near_duplicates("false_truth_del_cands", 0.02)),
        "d13_distance_tiles": (lambda i: corpus.distance_tiles(i.false_truth_del_cands), oracle.DISTANCE_TILES),
        "d14_near_duplicates_base": (
            lambda i: corpus.near_duplicates(i.base_false_truth_del_cands, 0.04),
            oracle.near_duplicates("base_false_truth_del_cands", 0.04)),
        "d15_latest_ds_summary": (
            lambda i: corpus.dataset_summary(i.falsehood_rows, i.truth_rows, i.ds_metadata), oracle.DATASET_SUMMARY),
        "d16_model_rpt_gt": (lambda i: corpus.ground_truth_set(i.truth_snapshot, i.wp_statements), oracle.GROUND_TRUTH),
        "d17_converged_sample": (lambda i: i.converged, oracle.CONVERGED),
        "d18_close_pairs": (pairs, oracle.CLOSE_PAIRS),
        "d18_candidates": (
            lambda i: candidates(i).withColumn("l2dist", F.round("l2dist", 9)), oracle.CLOSE_CANDIDATES),
        "d18_near_duplicates": (lambda i: corpus.near_duplicates(candidates(i)), oracle.CLOSE_NEAR_DUPLICATES),
        "d19_split_by_share": (lambda i: corpus.split_by_share(i.falsehood_rows), oracle.SPLIT),
    }


def _queues_and_feedback() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def scored_statements(i):
        return feedback.scored_false_statements(
            i.wp_statements, i.base_false_truth_del_cands, i.fbase_statements, i.model_metadata, i.ds_metadata)

    def scored_tweets(i):
        return feedback.scored_false_tweets(
            i.wp_statements, i.base_false_truth_del_cands, i.dcbot_tweets, i.model_metadata, i.ds_metadata)

    def statement_updates(i):
        return feedback.published_statement_updates(
            scored_statements(i), i.infsvc_stmts_published, i.model_metadata, i.wp_statements)

    def tweet_updates(i):
        return feedback.published_tweet_updates(
            scored_tweets(i), i.infsvc_tweets_published, i.model_metadata, i.wp_statements)

    def statement_others(i):
        return feedback.published_statement_nonlabel_updates(
            i.infsvc_stmts_published, i.fbase_statements, i.fbase_transcripts, i.wp_statements, i.model_metadata,
            i.ds_metadata)

    def tweet_others(i):
        return feedback.published_tweet_nonlabel_updates(
            i.infsvc_tweets_published, i.dcbot_tweets, i.wp_statements, i.model_metadata, i.ds_metadata)

    def labelled(published, updates, others, ids):
        late = F.lit(SCORE_DATE).cast("timestamp")
        rows = feedback.with_late_labels(published, updates, others, ids, late)
        return rows.select("dc_tid", *ids, "prediction", "actual_label", "score_date")

    def written_back(i, published, updates, others, ids):
        """The published table after its late labels were put into it, twice."""
        path, late = shared_folder(i.spark, "published"), F.lit(SCORE_DATE).cast("timestamp")
        feeds.laid_out(published, path, ["dc_tid"], PARTS)
        for _ in range(2):
            table = i.spark.read.schema(published.schema).parquet(path).drop("slot")
            due = feedback.with_late_labels(table, updates, others, ids, late)
            feeds.write_back(path, ["dc_tid"], due, i.spark, PARTS)
        return i.spark.read.schema(published.schema).parquet(path).select(
            "dc_tid", *ids, "prediction", "actual_label", "score_date")

    return {
        "k01_statements_to_analyse": (
            lambda i: queues.statements_to_analyse(
                i.fbase_statements, i.fbase_transcripts, i.stmts_analyzed_published, i.stmts_analyzed_notpublished),
            oracle.STATEMENTS_TO_ANALYSE),
        "k02_tweets_to_analyse": (
            lambda i: queues.tweets_to_analyse(
                i.dcbot_tweets, i.tweets_analyzed_published, i.tweets_analyzed_notpublished),
            oracle.TWEETS_TO_ANALYSE),
        "k03_statements_to_score": (
            lambda i: queues.statements_to_score(
                i.fbase_statements, i.fbase_transcripts, i.infsvc_stmts_published, i.model_metadata, i.ds_metadata),
            oracle.STATEMENTS_TO_SCORE),
        "k04_tweets_to_score": (
            lambda i: queues.tweets_to_score(
                i.dcbot_tweets, i.infsvc_tweets_published, i.model_metadata, i.ds_metadata),
            oracle.TWEETS_TO_SCORE),
        "l01_scored_false_statements": (scored_statements, oracle.SCORED_FALSE_STATEMENTS),
        "l02_scored_false_tweets": (scored_tweets, oracle.SCORED_FALSE_TWEETS),
        "l03_published_statement_updates": (
            statement_updates, oracle.with_tables(oracle.STATEMENT_UPDATES, **oracle.SCORED)),
        "l04_published_tweet_updates": (tweet_updates, oracle.with_tables(oracle.TWEET_UPDATES, **oracle.SCORED)),
        "l05_published_statement_nonlabel_updates": (statement_others, oracle.with_tables(oracle.STATEMENT_NONLABEL)),
        "l06_published_tweet_nonlabel_updates": (tweet_others, oracle.with_tables(oracle.TWEET_NONLABEL)),
        "l07_statement_write_back": (
            lambda i: written_back(
                i, i.infsvc_stmts_published, statement_updates(i), statement_others(i), ["tid", "sid"]),
            oracle.late_labels(
                "infsvc_stmts_published", ["tid", "sid"], oracle.STATEMENT_UPDATES, oracle.STATEMENT_NONLABEL)),
        "l07_tweet_write_back": (
            lambda i: written_back(i, i.infsvc_tweets_published, tweet_updates(i), tweet_others(i), ["thread_id"]),
            oracle.late_labels("infsvc_tweets_published", ["thread_id"], oracle.TWEET_UPDATES, oracle.TWEET_NONLABEL)),
        "l07_late_statement_labels": (
            lambda i: labelled(i.infsvc_stmts_published, statement_updates(i), statement_others(i), ["tid", "sid"]),
            oracle.late_labels(
                "infsvc_stmts_published", ["tid", "sid"], oracle.STATEMENT_UPDATES, oracle.STATEMENT_NONLABEL)),
        "l07_late_tweet_labels": (
            lambda i: labelled(i.infsvc_tweets_published, tweet_updates(i), tweet_others(i), ["thread_id"]),
            oracle.late_labels("infsvc_tweets_published", ["thread_id"], oracle.TWEET_UPDATES, oracle.TWEET_NONLABEL)),
    }


def _distributions() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def counts(i):
        return distributions.word_counts({
            "falsehoods": corpus.falsehood_set(i.wp_statements),
            "truths": corpus.truth_set(i.fbase_statements, i.fbase_transcripts, i.dcbot_tweets, i.wp_statements),
            "matched falsehoods": i.falsehood_rows,
            "matched truths": i.truth_rows,
        })

    def counted(rows):
        return rows.withColumn("wc", distributions.word_count(F.col("statement_text")))

    def sides(i):
        return counted(i.truth_rows), counted(i.falsehood_rows)

    def split_dates(i):
        newest = i.ds_metadata.where("ds_type = 'converged_filtered'").orderBy(F.desc("dsid")).limit(1)
        return newest.drop("dsid", "ds_type")

    def split_counts(i):
        return distributions.split_word_counts(i.truth_rows, i.falsehood_rows, split_dates(i))

    def nine(df, *columns):
        return df.withColumns({c: F.round(c, 9) for c in columns})

    return {
        "n01_word_counts": (counts, oracle.WORD_COUNTS),
        "n02_binned_density": (
            lambda i: distributions.binned_density(counts(i)).withColumn("density", F.round("density", 12)),
            oracle.BINNED),
        "n02_kernel_density": (lambda i: nine(distributions.kernel_density(counts(i)), "density"), oracle.KERNEL),
        "n03_positional_join": (lambda i: distributions.positional_join(*sides(i)), oracle.POSITIONAL),
        "n03_describe": (
            lambda i: nine(distributions.summary(counts(i), ["population"]), "mean", "std"), oracle.POPULATION_SUMMARY),
        "n04_joint_density": (lambda i: distributions.joint_density(*sides(i)), oracle.JOINT),
        "n05_split_word_counts": (split_counts, oracle.SPLIT_COUNTS),
        "n06_split_summary": (
            lambda i: nine(distributions.summary(split_counts(i), ["split", "class"]), "mean", "std"),
            oracle.SPLIT_SUMMARY),
        "n06_class_gap": (lambda i: nine(distributions.class_gap(split_counts(i)), "gap"), oracle.CLASS_GAP),
    }


def _sources() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def claim_counts(i):
        found = claims.claims(i.claim_pages)
        return found.groupBy("s_date", "pinnochios", "repeats").agg(F.count(F.lit(1)).alias("n"))

    def split_file(i):
        """The newest split, written to a JSON file as a user would keep it and read back."""
        path = shared_folder(i.spark, "split-dates")
        newest = i.ds_metadata.where("ds_type = 'converged_filtered'").orderBy(F.desc("dsid")).limit(1)
        newest.drop("dsid", "ds_type").coalesce(1).write.json(path)
        return metadata.split_dates(i.spark, path)

    def headings(i):
        """The raw test pages, which have a layout of their own."""
        found = extract(i.pages, Step("article"), [Field("heading", (Step("h1"),)), Field("paragraphs", (Step("p"),), "count")])
        return found.select("page_id", F.inline("rows"))

    return {
        "s01_transcript_index": (lambda i: transcripts.transcript_index(i.index_pages, INDEX_URL), oracle.INDEX),
        "s02_transcript_statements": (
            lambda i: transcripts.transcript_statements(i.transcript_pages, SPEAKER), oracle.TRANSCRIPT_STATEMENTS),
        "s03_claims": (lambda i: claims.claims(i.claim_pages), oracle.CLAIMS),
        "s03_claim_counts": (claim_counts, oracle.CLAIM_COUNTS),
        "s03_claim_rejects": (lambda i: claims.claim_rejects(i.claim_pages), oracle.CLAIM_REJECTS),
        "s03_page_headings": (headings, oracle.PAGE_HEADINGS),
        "s04_page_totals": (lambda i: claims.page_totals(i.claim_pages), oracle.PAGE_TOTALS),
        "s04_page_last_dates": (lambda i: claims.page_last_dates(i.claim_pages), oracle.PAGE_LAST_DATES),
        "s02_transcript_rejects": (
            lambda i: transcripts.transcript_rejects(i.broken_transcript_pages, SPEAKER), oracle.TRANSCRIPT_REJECTS),
        "s05_timeline_rejects": (lambda i: tweets.timeline_rejects(i.broken_lines), oracle.BROKEN_LINES),
        "s13_split_dates": (split_file, oracle.SPLIT_DATES),
        "x02_unescaped": (lambda i: i.marked_texts.select("doc_id", text.unescape("entities").alias("text")), oracle.UNESCAPED),
        "x03_clean_tweets": (
            lambda i: i.marked_texts.select("doc_id", text.clean_tweet(F.col("tweet")).alias("text")).withColumns(
                {"more": text.more_follows(F.col("text")), "cont": text.continues(F.col("text"))}),
            oracle.CLEAN_TWEETS),
        "x04_clean_claims": (
            lambda i: i.marked_texts.select("doc_id", text.clean_claim(F.col("claim")).alias("text")), oracle.CLEAN_CLAIMS),
        "x09_without_addresses": (
            lambda i: i.marked_texts.select("doc_id", text.remove_urls(F.col("urls")).alias("text")), oracle.WITHOUT_URLS),
        "s05_timeline": (lambda i: tweets.timeline(i.timeline_lines), oracle.TIMELINE),
        "w01_threads": (
            lambda i: threads.build_threads(i.messages, THREAD_LATENCY, THREAD_NOW),
            oracle.threads(THREAD_LATENCY, str(THREAD_NOW), True)),
        "w01_threads_corrected": (
            lambda i: threads.build_threads(i.messages, THREAD_LATENCY, THREAD_NOW, compat=False),
            oracle.threads(THREAD_LATENCY, str(THREAD_NOW), False)),
    }


def _streams() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def finish(writer) -> None:
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    def stream_threads(i):
        out, state = shared_folder(i.spark, "threads"), shared_folder(i.spark, "threads-state")
        rows = thread_stream(i.message_stream, THREAD_LATENCY, THREAD_DELAY)
        finish(rows.writeStream.format("parquet").option("path", out).option("checkpointLocation", state))
        return ingest.read_or_empty(i.spark, out, rows.schema)

    def stream_claims(i):
        out, state = shared_folder(i.spark, "claims"), shared_folder(i.spark, "claims-state")
        rows = i.stream_of("wp_statements").select("sid", *KEYS["wp_statements"])
        finish(keyed_sink(rows, out, state, KEYS["wp_statements"], ["sid"]))
        return ingest.read_or_empty(i.spark, out, rows.schema)

    def stream_feed(i):
        root, state = shared_folder(i.spark, "stream-feed"), shared_folder(i.spark, "stream-feed-state")
        rows = i.stream_of("wp_statements").select("sid", *KEYS["wp_statements"])
        finish(feed_sink(rows, root, state, KEYS["wp_statements"], ["sid"], PARTS))
        return feeds.loaded(i.spark, root, rows.schema)

    return {
        "s09_stream_append": (stream_claims, oracle.STREAM_APPEND),
        "s09_stream_feed": (stream_feed, oracle.STREAM_APPEND),
        "w01_thread_stream": (stream_threads, oracle.thread_stream(THREAD_LATENCY, THREAD_DELAY)),
    }


def _loading() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    def marks(i):
        day, zero = F.lit(ingest.BEGINNING_OF_TIME).cast("date"), F.lit(0).cast("bigint")
        feeds = {
            "claims": ingest.high_water_mark(i.wp_statements, "s_date", day, F.col("iid") == 1),
            "transcripts": ingest.high_water_mark(i.fbase_transcripts, "t_date", day),
            "tweets": ingest.high_water_mark(i.dcbot_tweets, "end_thread_tweet_id", zero),
        }
        rows = [m.select(F.lit(n).alias("feed"), F.col("latest").cast("string"), "initial_load") for n, m in feeds.items()]
        return rows[0].union(rows[1]).union(rows[2])

    def newer(i):
        mark = ingest.high_water_mark(i.loaded_messages, "tweet_id", F.lit(0).cast("bigint"))
        return ingest.newer_rows(i.raw_tweets, mark, "tweet_id", inclusive=False).select("tweet_id", "user_id")

    def newer_claims(i):
        day = F.lit(ingest.BEGINNING_OF_TIME).cast("date")
        mark = ingest.high_water_mark(i.loaded_claims, "s_date", day, F.col("iid") == 1)
        return ingest.newer_rows(i.wp_statements, mark, "s_date", inclusive=True).select("sid", "s_date")

    def snapshot(i):
        view = corpus.near_duplicates(i.base_false_truth_del_cands, 0.04)
        return ingest.snapshot(view, shared_folder(i.spark, "snapshot"))

    def rejects(i):
        rules = ingest.broken_rules(TABLES["wp_statements"])
        found = ingest.with_reject_reason(i.wp_statements, i.loaded_claims, KEYS["wp_statements"], ["sid"], rules)
        return found.select("sid", "reject_reason")

    def paged(i):
        """The index as its source lists it, newest page first, and the entries that an earlier run has loaded."""
        entries = transcripts.transcript_index(i.listed_index_pages, INDEX_URL, keep=("page",))
        newest = i.events.agg(F.max(F.floor(F.col("event_id") / 20))).scalar()
        entries = entries.withColumn("page", newest - F.col("page"))
        old = F.col("tid").cast("bigint") <= i.events.agg(F.floor(F.avg("event_id"))).scalar()
        listed = materialise(entries.repartitionByRange("page").sortWithinPartitions("page"))
        return listed, listed.where(old).drop("page")

    def new_transcripts(i):
        listed, known = paged(i)
        return feeds.newer_pages(listed, known, ["tid"]).drop("page")

    def transcript_feed(i):
        root, (listed, known) = shared_folder(i.spark, "transcript-feed"), paged(i)
        feeds.load(known, root, "first", KEYS["fbase_transcripts"], ["tid"], slots=PARTS)
        for _ in range(2):
            there = feeds.loaded(i.spark, root, known.schema)
            feeds.load(feeds.newer_pages(listed, there, ["tid"]).drop("page"), root, "second", KEYS["fbase_transcripts"], ["tid"], slots=PARTS)
        return feeds.loaded(i.spark, root, known.schema)

    def claim_feed(i):
        """The lower half of the pages, then all of them, the last twice."""
        root = shared_folder(i.spark, "claim-feed")
        rows = claims.claim_rows(i.claim_pages).where("reject_reason is null").drop("reject_reason")
        rows = materialise(rows.withColumn("statement_hash", text.text_hash(F.col("statement_text"))))
        early = rows.where(F.col("page_id") <= i.documents.agg(F.avg("doc_id")).scalar())
        for name, batch in (("early", early), ("all", rows), ("all", rows)):
            feeds.load(batch, root, name, KEYS["wp_statements"], ["page_id", "pos"], slots=PARTS)
        return feeds.loaded(i.spark, root, rows.schema).select(*KEYS["wp_statements"], "statement_text", "repeats")

    def rowset(i):
        return ingest.tweet_rowset(threads.build_threads(i.messages, THREAD_LATENCY, THREAD_NOW, compat=False))

    def tweet_feed(i):
        """Threads that ended before a day, then all."""
        root, rows = shared_folder(i.spark, "tweet-feed"), materialise(rowset(i))
        early = rows.where(F.col("t_end_date") < F.lit("2024-01-20").cast("timestamp"))
        for name, batch in (("early", early), ("all", rows), ("all", rows)):
            feeds.load(batch, root, name, KEYS["dcbot_tweets"], ["end_thread_tweet_id"], slots=PARTS)
        return feeds.loaded(i.spark, root, rows.schema).select(*KEYS["dcbot_tweets"], "end_thread_tweet_id")

    def english(i):
        return i.wp_statements.where(F.col("topic") == "en").select(F.col("sid").alias("falsehood_id"))

    return {
        "s06_high_water_mark": (marks, oracle.HIGH_WATER),
        "s07_newer_rows": (newer, oracle.NEWER),
        "s08_unknown_ids": (
            lambda i: ingest.unknown_ids(i.fbase_statements, i.stmts_analyzed_published, ["tid", "sid"])
            .select("tid", "sid"),
            oracle.UNKNOWN),
        "s09_rows_to_insert": (
            lambda i: ingest.rows_to_insert(
                i.wp_statements.select("sid", *KEYS["wp_statements"]), i.loaded_claims, KEYS["wp_statements"], ["sid"]),
            oracle.TO_INSERT),
        "s10_reject_reasons": (rejects, oracle.REJECTS),
        "s07_newer_claims": (newer_claims, oracle.NEWER_CLAIMS),
        "s11_claim_rowset": (lambda i: ingest.claim_rowset(i.wp_statements), oracle.CLAIM_ROWSET),
        "s11_transcript_rowset": (lambda i: ingest.transcript_rowset(i.fbase_transcripts), oracle.TRANSCRIPT_ROWSET),
        "s11_statement_rowset": (lambda i: ingest.statement_rowset(i.fbase_statements), oracle.STATEMENT_ROWSET),
        "s07_newer_transcripts": (new_transcripts, oracle.NEW_ENTRIES),
        "s10_claim_feed": (claim_feed, oracle.CLAIM_FEED),
        "s10_transcript_feed": (transcript_feed, oracle.TRANSCRIPT_FEED),
        "s10_tweet_feed": (tweet_feed, oracle.tweet_feed(THREAD_LATENCY, str(THREAD_NOW))),
        "s11_tweet_rowset": (rowset, oracle.tweet_rowset(THREAD_LATENCY, str(THREAD_NOW))),
        "s12_sql_frame": (
            lambda i: ingest.sql_frame(
                i.spark, "select source, count(*) n, max(wc) longest from {claims} group by source",
                claims=i.wp_statements),
            oracle.SQL_FRAME),
        "s14_surrogate_keys": (
            lambda i: ingest.with_surrogate_key(
                ingest.unknown_ids(i.wp_statements.select("sid", "s_date"), i.loaded_claims, ["sid"])
                .select(F.col("sid").alias("source_sid"), "s_date"),
                i.loaded_claims, "sid", ["s_date", "source_sid"])
            .select("sid", "source_sid"),
            oracle.SURROGATE),
        "s15_generated_word_count": (
            lambda i: ingest.with_word_count(i.wp_statements.drop("wc")).select("sid", "wc"), oracle.GENERATED),
        "s17_snapshot": (snapshot, oracle.near_duplicates("base_false_truth_del_cands", 0.04)),
        "s16_key_violations": (
            lambda i: ingest.key_violations(i.wp_statements, ["statement_hash"]), oracle.KEY_VIOLATIONS),
        "s16_null_violations": (
            lambda i: ingest.null_violations(i.infsvc_tweets_published, ["dc_tid", "thread_id", "actual_label"]),
            oracle.NULL_VIOLATIONS),
        "s16_orphans": (
            lambda i: ingest.orphans(i.base_false_truth_del_cands, english(i), ["falsehood_id"])
            .select("falsehood_id", "truth_id"),
            oracle.ORPHANS),
        "s16_cascade_delete": (
            lambda i: ingest.cascade_delete(
                i.fbase_statements, i.fbase_transcripts.where("t_date < date '2018-01-01'"), ["tid"])
            .select("tid", "sid"),
            oracle.CASCADE),
    }


def _all() -> dict[str, tuple[Callable[[Inputs], DataFrame], str | None]]:
    found = {**_sources(), **_streams(), **_loading(), **_corpus(), **_evaluation(), **_reports(), **_queues_and_feedback(), **_distributions()}
    return dict(sorted(found.items()))


def entry(spark: SparkSession) -> DataFrame:
    """Calibration by confidence bucket with the global metrics of the latest model."""
    i = Inputs(spark, "/root/testdata/sf0.001")
    return evaluate.accuracy_lookup(i.model_analysis_rpts, i.ds_metadata, "all")


def queries() -> dict[str, Query]:
    found = {name: (lambda spark, sf_dir, b=build: b(Inputs(spark, sf_dir))) for name, (build, _) in _all().items()}
    return found if llm is None else {**found, **llm.QUERIES, "pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    found = {name: sql for name, (_, sql) in _all().items() if sql is not None}
    if llm is None:
        return found
    whole = {} if corpus_pipeline.ORACLE_SQL is None else {"pipeline": corpus_pipeline.ORACLE_SQL}
    return {**found, **llm.ORACLES, **whole}
