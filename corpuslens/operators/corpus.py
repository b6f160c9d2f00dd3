"""Corpus curation: labelled sets, word-count matching, duplicate removal, date splits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpuslens.functions.scores import flag
from corpuslens.functions.text import composite_id, match_hash
from corpuslens.plans.ranks import cume_dist, cut_into_tiles, running_totals, smallest_per_group
from corpuslens.plans.skew import lookup_join
from corpuslens.plans.slices import CONVERGED, newest_dataset
from corpuslens.session import materialise

WORDS = (7, 107)
FIRST_DAY = "2017-01-19"
FALSE_SHARE = (0.03, 0.995)
TRUE_SHARE = (0.13, 0.995)


def is_tweet_source(source: Column) -> Column:
    """1 for the tweet source; compared without case, accents or trailing blanks."""
    return flag(F.collate(source, "UNICODE_CI_AI_RTRIM") == F.collate(F.lit("Twitter"), "UNICODE_CI_AI_RTRIM"))


def in_words(wc: str = "wc", words: tuple[int, int] = WORDS) -> Column:
    return F.col(wc).between(*words)


def last_claim_date(claims: DataFrame, words: tuple[int, int] | None = WORDS) -> Column:
    """Scalar: date of the last claim, among those of accepted length unless ``words`` is None."""
    rows = claims if words is None else claims.where(in_words(words=words))
    return rows.agg(F.max("s_date")).scalar()


def trim_by_word_count(df: DataFrame, share: tuple[float, float], wc: str = "swc") -> DataFrame:
    """Keep rows whose word count lies between the ends of the given cumulative share."""
    inside = cume_dist(df, wc).where(F.col("c_dist").between(*share))
    bounds = inside.agg(F.struct(F.min(wc).alias("low"), F.max(wc).alias("high"))).scalar()
    return df.where(F.col(wc).between(bounds["low"], bounds["high"]))


def _claim_rows(claims: DataFrame) -> DataFrame:
    return claims.select(
        F.col("sid"),
        F.col("statement_text"),
        is_tweet_source(F.col("source")).alias("s_type"),
        F.col("s_date"),
        F.col("wc").alias("swc"),
    )


def falsehood_set(claims: DataFrame, share: tuple[float, float] = FALSE_SHARE) -> DataFrame:
    """Claims without the shortest and longest, in no order."""
    return trim_by_word_count(_claim_rows(claims), share).withColumn("label", F.lit("False"))


def falsehoods(claims: DataFrame, share: tuple[float, float] = FALSE_SHARE) -> DataFrame:
    """``falsehood_set`` by date and text; the id splits copies between sort tasks."""
    kept = falsehood_set(claims, share)
    return kept.orderBy("s_date", "statement_text", "sid").select("statement_text", "s_type", "s_date", "label")


def falsehoods_tiny(claims: DataFrame, rows: int = 1000, share: tuple[float, float] = FALSE_SHARE) -> DataFrame:
    """The first claims by date and text, for quick trials."""
    return falsehoods(claims, share).limit(rows)


def _truth_rows(
    statements: DataFrame, transcripts: DataFrame, tweets: DataFrame, first_day: str | None, until: Column
) -> DataFrame:
    """Transcript statements, then non-retweet tweets that ended before a date."""
    spoken = statements.join(transcripts, "tid")
    if first_day:
        spoken = spoken.where(F.col("t_date") >= F.lit(first_day).cast("date"))
    spoken = spoken.select(
        composite_id(F.col("tid"), F.col("sid")).alias("truth_id"),
        "statement_text",
        F.lit(0).alias("s_type"),
        F.col("t_date").cast("timestamp").alias("s_date"),
        F.col("wc").alias("swc"),
    )
    written = tweets.where((F.col("retweet") == 0) & (F.col("t_end_date") < until.cast("timestamp"))).select(
        composite_id(F.col("thread_id"), F.col("end_thread_tweet_id")).alias("truth_id"),
        "statement_text",
        F.lit(1).alias("s_type"),
        F.col("t_end_date").alias("s_date"),
        F.col("wc").alias("swc"),
    )
    return spoken.unionByName(written)


def truth_set(
    statements: DataFrame,
    transcripts: DataFrame,
    tweets: DataFrame,
    claims: DataFrame,
    share: tuple[float, float] = TRUE_SHARE,
) -> DataFrame:
    """Transcript statements and tweets without the shortest and longest, in no order."""
    rows = _truth_rows(statements, transcripts, tweets, None, last_claim_date(claims))
    return trim_by_word_count(rows, share).withColumn("label", F.lit("True"))


def truths(
    statements: DataFrame,
    transcripts: DataFrame,
    tweets: DataFrame,
    claims: DataFrame,
    share: tuple[float, float] = TRUE_SHARE,
) -> DataFrame:
    """``truth_set`` by date and text."""
    kept = truth_set(statements, transcripts, tweets, claims, share)
    return kept.orderBy("s_date", "statement_text", "truth_id").select("statement_text", "s_type", "s_date", "label")


def truths_tiny(
    statements: DataFrame,
    transcripts: DataFrame,
    tweets: DataFrame,
    claims: DataFrame,
    rows: int = 10000,
    first_day: str = FIRST_DAY,
) -> DataFrame:
    """Some truths for quick trials; the earliest by date, text and id, so a rerun gives the same."""
    found = _truth_rows(statements, transcripts, tweets, first_day, last_claim_date(claims))
    first = found.orderBy("s_date", "statement_text", "truth_id").limit(rows)
    return first.select("statement_text", "s_type", F.lit("True").alias("label"), "s_date")


def all_truths(
    statements: DataFrame,
    transcripts: DataFrame,
    tweets: DataFrame,
    claims: DataFrame,
    words: tuple[int, int] = WORDS,
    first_day: str = FIRST_DAY,
) -> DataFrame:
    """Truths of accepted length dated from the first day to the last accepted claim, with their id."""
    start, end = F.lit(first_day).cast("date"), last_claim_date(claims, words)
    spoken = (
        statements.where(in_words(words=words))
        .join(transcripts.where(F.col("t_date").between(start, end)), "tid")
        .select(
            composite_id(F.col("tid"), F.col("sid")).alias("truth_id"),
            F.col("statement_text").alias("stext"),
            F.lit(0).alias("stype"),
            F.col("t_date").cast("timestamp").alias("sdate"),
            F.col("wc").alias("swc"),
        )
    )
    ended = F.col("t_end_date").between(start.cast("timestamp"), end.cast("timestamp"))
    written = tweets.where((F.col("retweet") == 0) & in_words(words=words) & ended).select(
        composite_id(F.col("thread_id"), F.col("end_thread_tweet_id")).alias("truth_id"),
        F.col("statement_text").alias("stext"),
        F.lit(1).alias("stype"),
        F.col("t_end_date").alias("sdate"),
        F.col("wc").alias("swc"),
    )
    return spoken.unionByName(written)


def truth_snapshot(
    statements: DataFrame, transcripts: DataFrame, tweets: DataFrame, claims: DataFrame
) -> DataFrame:
    """``all_truths`` as it is now, stored; later changes of its tables do not show."""
    return materialise(all_truths(statements, transcripts, tweets, claims))


def _quotas(claims: DataFrame, truth_snapshot: DataFrame, words: tuple[int, int]) -> DataFrame:
    """Per word count in both classes: share among claims, and the wanted number of truths."""
    everything = Window.partitionBy()  # one row per accepted word count
    source = claims.where(in_words(words=words)).groupBy("wc").agg(F.count(F.lit(1)).alias("n"))
    share = F.col("n") / F.sum("n").over(everything).cast("double")
    target = truth_snapshot.where(in_words("swc", words)).groupBy(F.col("swc").alias("wc")).agg(
        F.count(F.lit(1)).alias("n")
    )
    size = F.sum("n").over(everything).cast("double")
    both = source.select("wc", share.alias("share")).join(target.select("wc", size.alias("size")), "wc")
    return both.select("wc", "share", F.round(F.col("size") * F.col("share")).alias("wanted"))


def target_distribution(claims: DataFrame, truth_snapshot: DataFrame, words: tuple[int, int] = WORDS) -> DataFrame:
    """Per word count in both classes: its share among claims, and the size of the matched truth set."""
    size = F.sum("wanted").over(Window.partitionBy()).alias("xformed_dist_size")
    return _quotas(claims, truth_snapshot, words).select("wc", F.col("share").alias("xformed_wc_cnt"), size)


def converged_sample(
    claims: DataFrame, truth_snapshot: DataFrame, words: tuple[int, int] = WORDS, seed: int = 2718
) -> DataFrame:
    """Truths drawn so that their word counts are spread like those of the claims.

    Per word count, ``round(truths * share of claims)`` truths are wanted and the ones with
    the smallest seeded hash are taken; all of them when there are fewer.
    """
    quotas = _quotas(claims, truth_snapshot, words).select(
        F.col("wc").alias("swc"), F.col("wanted").cast("bigint").alias("quota")
    )
    kept = truth_snapshot.where(in_words("swc", words))
    code = F.sha1(F.concat_ws("-", F.col("truth_id"), F.lit(str(seed))))
    coded = kept.join(F.broadcast(quotas), "swc").withColumn("code", code)  # one row per accepted word count
    return smallest_per_group(coded, ["swc"], "quota", "code", "truth_id").select(
        "truth_id", F.col("stext").alias("statement_text"), "stype", F.col("sdate").cast("date").alias("sdate")
    )


def matched_falsehoods(claims: DataFrame, words: tuple[int, int] = WORDS) -> DataFrame:
    """Claims of accepted length, by date."""
    return claims.where(in_words(words=words)).select(
        "statement_text",
        is_tweet_source(F.col("source")).alias("s_type"),
        F.lit("False").alias("label"),
        "s_date",
    )


def matched_truths(converged: DataFrame) -> DataFrame:
    """The sampled truths under the column names of ``matched_falsehoods``."""
    return converged.select(
        "statement_text",
        F.col("stype").alias("s_type"),
        F.lit("True").alias("label"),
        F.col("sdate").alias("s_date"),
    )


def date_driver(falsehood_rows: DataFrame) -> DataFrame:
    """Per claim, the share of claims up to its date; ties share one value."""
    shares = cume_dist(falsehood_rows, "s_date").select("s_date", "c_dist")
    return falsehood_rows.select("s_date").join(F.broadcast(shares), "s_date")  # one row per calendar day


def date_shares(falsehood_rows: DataFrame) -> DataFrame:
    """``date_driver`` with one row per date and its number of claims."""
    return cume_dist(falsehood_rows, "s_date")


def split_by_share(falsehood_rows: DataFrame, train: float = 0.8, val: float = 0.1) -> DataFrame:
    """First and last date and size of the train, val and test parts by cumulative share of claims.

    A date is never divided: it belongs to the part its cumulative share falls in.
    """
    c = F.round("c_dist", 9)
    part = F.when(c <= train, "train").when(c <= round(train + val, 9), "val").otherwise("test")
    return (
        date_shares(falsehood_rows)
        .groupBy(part.alias("split"))
        .agg(F.min("s_date").alias("start_date"), F.max("s_date").alias("end_date"), F.sum("n").alias("n"))
    )


def _hashes_in_both(truth_hashes: DataFrame, claims: DataFrame) -> DataFrame:
    """(h, n_claims) of the texts, ignoring case, that both classes hold; each side is counted first."""
    per_claim = claims.groupBy(match_hash(F.col("statement_text")).alias("h")).agg(F.count(F.lit(1)).alias("n_claims"))
    return per_claim.join(truth_hashes.select("h").distinct(), "h")


def exact_duplicates(
    statements: DataFrame, tweets: DataFrame, claims: DataFrame, words: tuple[int, int] = WORDS
) -> DataFrame:
    """Truths whose text, ignoring case, is also a claim's, with the number of such claims.

    A truth with ``n_claims`` matches stands for that many matching pairs. Claims are counted per hash
    before the join, so a text that both classes hold many times does not multiply.
    """
    spoken = statements.where(in_words(words=words)).select(
        "tid", F.col("sid").cast("bigint").alias("sid"), match_hash(F.col("statement_text")).alias("h")
    )
    written = tweets.where(in_words(words=words)).select(
        F.lit("none").alias("tid"),
        F.col("thread_id").cast("bigint").alias("sid"),
        match_hash(F.col("statement_text")).alias("h"),
    )
    rows = spoken.unionByName(written)
    return lookup_join(rows, _hashes_in_both(rows, claims), ["h"], ["tid", "sid"]).select("tid", "sid", "n_claims")


def without_exact_duplicates(truth_snapshot: DataFrame, claims: DataFrame) -> DataFrame:
    """The truth snapshot less the texts that are also claims."""
    hashed = truth_snapshot.withColumn("h", match_hash(F.col("stext")))
    both = _hashes_in_both(hashed, claims).select("h")
    return lookup_join(hashed, both, ["h"], ["truth_id"], "left_anti").drop("h")


def near_duplicates(candidates: DataFrame, max_dist: float = 0.02) -> DataFrame:
    """Truth ids with a claim closer than ``max_dist``; 0.04 for candidates of the base model."""
    return candidates.where(F.col("l2dist") < max_dist).select("truth_id").distinct()


def distance_tiles(candidates: DataFrame, k: int = 100) -> DataFrame:
    """Size and distance range of each of ``k`` equal tiles of the candidate pairs, to choose a threshold.

    Pairs that tie in distance are interchangeable, so the tiles are cut out of the counts per distance; no pair is
    ranked or stored.
    """
    counted = candidates.groupBy("l2dist").agg(F.count(F.lit(1)).alias("n"))
    spans = running_totals(counted, ["l2dist"], ["n"]).withColumns(
        {"lo": F.col("n_before"), "hi": F.col("n_before") + F.col("n"), "total": counted.agg(F.sum("n")).scalar()})
    return cut_into_tiles(spans, k).groupBy(F.col("bucket").cast("int").alias("bucket")).agg(
        F.sum("take").alias("n"), F.min("l2dist").alias("min_l2dist"), F.max("l2dist").alias("max_l2dist")
    )


def dataset_summary(
    falsehood_rows: DataFrame, truth_rows: DataFrame, ds_metadata: DataFrame, ds_type: str = CONVERGED
) -> DataFrame:
    """Truths and falsehoods in the train, val and test dates of the newest data set; one row."""
    ds = newest_dataset(ds_metadata, ds_type)
    labelled = truth_rows.select("s_date", F.lit("truths").alias("side")).unionByName(
        falsehood_rows.select("s_date", F.lit("falsehoods").alias("side"))
    )
    counts = [
        F.count_if(
            (F.col("side") == side) & F.col("s_date").between(ds[f"{part}_start_date"], ds[f"{part}_end_date"])
        ).alias(f"{part}_{side}")
        for part in ("train", "val", "test")
        for side in ("truths", "falsehoods")
    ]
    return labelled.agg(*counts)


def ground_truth_set(truth_snapshot: DataFrame, claims: DataFrame, words: tuple[int, int] = WORDS) -> DataFrame:
    """Both classes over the dates of the accepted claims, by date."""
    accepted = claims.where(in_words(words=words))
    span = accepted.agg(F.struct(F.min("s_date").alias("a"), F.max("s_date").alias("b"))).scalar()
    dated = F.col("sdate").between(span["a"].cast("timestamp"), span["b"].cast("timestamp"))
    true_rows = truth_snapshot.where(dated).select(
        "sdate", "stext", "stype", F.lit("True").alias("label"), F.col("truth_id").alias("id")
    )
    false_rows = accepted.select(
        F.col("s_date").cast("timestamp").alias("sdate"),
        F.col("statement_text").alias("stext"),
        is_tweet_source(F.col("source")).alias("stype"),
        F.lit("False").alias("label"),
        F.col("sid").cast("string").alias("id"),
    )
    # the id lets one busy day be sorted by several tasks
    return true_rows.unionByName(false_rows).orderBy("sdate", "id").select("sdate", "stext", "stype", "label")
