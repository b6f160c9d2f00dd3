"""The engine's input tables, derived from the test tables, for queries, tests and bench.

One SQL text per table runs both here and in the oracle; ``{name}`` stands for another table.
Every table is linear in the test tables, and roles (claim or message, published or not) follow
columns such as source, date and sentiment.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpuslens.functions.text import clean_tweet, more_follows
from corpuslens.operators import corpus
from corpuslens.session import materialise
from corpuslens.sources.tweets import timeline

RAW = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

SPEAKER = "user"

MARKED_TEXTS = """select doc_id,
    concat('no ', doc_id, ' &amp; &lt;', coalesce(lang, 'xx'), '&gt; &#39;it&#x27;s&#39; caf&eacute; &notanentity; &amp;amp;') entities,
    concat(case when doc_id % 2 = 0 then '...' else '' end, ' @who', doc_id, ' said #', coalesce(lang, 'xx'), '_', doc_id, ' that ', doc_id,
      ' [as heard] https://t.co/a', doc_id, ' is &amp; stays\n so -- really \u2014 yes', case when doc_id % 3 = 0 then ' ....' else '' end) tweet,
    concat('\u201cNo', unhex('C2A0') , ' ', doc_id, ' [sic] at www.', coalesce(lang, 'xx'), '.example.org/x_(', doc_id, ') is #1 \u2013 ok\u201d ') claim,
    case doc_id % 8 when 0 then concat('see http://example.com/', doc_id, '?a=1&b=(2) now')
      when 1 then concat('go to shop.co.uk, item ', doc_id) when 2 then concat('mail me', doc_id, '@example.com today')
      when 3 then concat('(https://en.example.org/wiki/A_(', doc_id, ')) here') when 4 then concat('version 1.', doc_id, ' of it')
      when 5 then concat('HTTPS://EXAMPLE.NET/', doc_id, '. End') when 6 then concat('at example.com/', doc_id, '/x!')
      else concat('none in ', doc_id) end urls
  from {documents}"""
INDEX_URL = "https://example.org/transcript/"

SQL = {
    "wp_statements": """
        select doc_id sid, 1 iid, text statement_text, cast(doc_id % 7 as int) repeats, lang topic,
          case when doc_id % 5 = 0 then 'Twitter' else source end source, cast(doc_id % 5 as int) pinnochios,
          date '2017-01-20' + cast(doc_id * 7 % 1200 as int) s_date, sha1(text) statement_hash,
          cast(length(text) - length(replace(text, ' ', '')) + 1 as int) wc
        from {documents} where cast(substring(source, 4) as int) < 7""",
    "loaded_claims": "select * from {wp_statements} where sid % 3 = 0",  # what an earlier load brought
    "dcbot_tweets": """
        select doc_id thread_id, 1000000000000000000 + doc_id end_thread_tweet_id, text statement_text,
          cast(date '2017-01-10' + cast(doc_id * 7 % 1200 as int) as timestamp) t_start_date,
          cast(date '2017-01-10' + cast(doc_id * 7 % 1200 as int) as timestamp) + interval '1' hour t_end_date,
          case when doc_id % 11 = 0 then 1 else 0 end retweet, sha1(text) statement_hash,
          cast(length(text) - length(replace(text, ' ', '')) + 1 as int) wc
        from {documents} where cast(substring(source, 4) as int) >= 7""",
    "fbase_transcripts": """
        select distinct concat('conv-', cast(conv_id as varchar(20))) tid,
          date '2017-01-01' + cast(conv_id * 29 % 1300 as int) t_date, 'Speech' transcript_type,
          concat('https://example.org/t/', cast(conv_id as varchar(20))) transcript_url,
          cast(conv_id % 100 / 100.0 as decimal(5,2)) transcript_sent
        from {conversations}""",
    "fbase_statements": """
        select concat('conv-', cast(conv_id as varchar(20))) tid, cast(turn as int) sid, text statement_text,
          cast((conv_id + turn) % 100 / 100.0 as decimal(5,2)) sentiment,
          cast(length(text) - length(replace(text, ' ', '')) + 1 as int) wc
        from {conversations} where role = 'user'""",
    "ds_metadata": """
        select * from (values
          ('20190101', 'converged_filtered', date '2017-01-20', date '2017-12-31', date '2018-01-01',
           date '2018-03-31', date '2018-04-01', date '2018-06-30'),
          ('20200101', 'converged_filtered', date '2017-01-20', date '2018-09-30', date '2018-10-01',
           date '2018-12-31', date '2019-01-01', date '2019-07-31'),
          ('20210101', 'other', date '2020-01-01', date '2020-01-01', date '2020-01-01', date '2020-01-01',
           date '2020-01-01', date '2020-01-01'))
        t(dsid, ds_type, train_start_date, train_end_date, val_start_date, val_end_date, test_start_date,
          test_end_date)""",
    "model_metadata": """
        select * from (values ('20190201', '20190101'), ('20200201', '20200101')) t(model_version, dsid)""",
    "model_analysis_rpts": """
        select *, case when label = 1 and prediction = 1 then 1 else 0 end tp,
          case when label = 0 and prediction = 1 then 1 else 0 end fp,
          case when label = 0 and prediction = 0 then 1 else 0 end tn,
          case when label = 1 and prediction = 0 then 1 else 0 end fn
        from (
          select case when o_orderkey % 10 = 0 then '20190201' else '20200201' end model_version, '20200101' dsid,
            case when o_orderkey % 17 = 0 then 'model_rpt_other' else 'model_rpt_gt' end report_type,
            o_orderkey statement_id, repeat('w ', cast(7 + o_orderkey % 101 as int)) statement_text,
            cast(o_custkey % 2 as int) stype, sdate, label,
            case when raw_pred >= 0.5 then 1 else 0 end prediction, raw_pred
          from (
            select o_orderkey, o_custkey, case when o_orderstatus = 'F' then 1 else 0 end label,
              cast(date '2017-01-20' + cast(o_orderkey % 1200 as int) as timestamp)
                + cast(o_orderkey % 4 as int) * interval '6' hour sdate,
              cast((o_custkey * 7919 + o_orderkey * 31) % 10001 / 10000.0 as decimal(5,4)) raw_pred
            from {orders}) b) c""",
    "infsvc_stmts_published": """
        select cast(substring(tid, 6) as bigint) * 1000 + sid dc_tid, '20200201' model_version, 1 iid, tid, sid,
          case when wc % 2 = 0 then 1 else 0 end prediction,
          cast((wc * 37 + sid) % 10001 / 10000.0 as decimal(5,4)) raw_pred,
          cast((wc * 53 + sid) % 10001 / 10000.0 as decimal(5,4)) raw_confidence,
          timestamp '2019-08-01 00:00:00' p_date,
          case when wc % 4 = 0 then null when wc % 3 = 1 then 1 else 0 end actual_label,
          cast(null as timestamp) score_date
        from {fbase_statements} where sentiment < 0.6""",
    "infsvc_tweets_published": """
        select thread_id dc_tid, '20200201' model_version, 1 iid, thread_id,
          case when thread_id % 2 = 0 then 1 else 0 end prediction,
          cast(thread_id * 37 % 10001 / 10000.0 as decimal(5,4)) raw_pred,
          cast(thread_id * 53 % 10001 / 10000.0 as decimal(5,4)) raw_confidence,
          t_end_date p_date,
          case when thread_id % 4 = 0 then null when thread_id % 2 = 1 then 1 else 0 end actual_label,
          cast(null as timestamp) score_date
        from {dcbot_tweets} where t_end_date < timestamp '2020-01-01 00:00:00'""",
    "stmts_analyzed_published": """
        select s.tid, s.sid from {fbase_statements} s join {fbase_transcripts} t on s.tid = t.tid
        where t.t_date <= date '2019-01-01' and s.sentiment < 0.3""",
    "stmts_analyzed_notpublished": """
        select s.tid, s.sid from {fbase_statements} s join {fbase_transcripts} t on s.tid = t.tid
        where t.t_date <= date '2019-01-01' and s.sentiment >= 0.3 and s.sentiment < 0.6""",
    "tweets_analyzed_published": """
        select thread_id from {dcbot_tweets}
        where retweet = 0 and thread_id <= (select floor(avg(thread_id)) from {dcbot_tweets})""",
    "tweets_analyzed_notpublished": """
        select thread_id from {dcbot_tweets}
        where retweet = 1 and thread_id <= (select floor(avg(thread_id)) from {dcbot_tweets})""",
    "raw_tweets": """
        select event_id tweet_id, user_id, cast(ts as timestamp) created_at, event_type = 'error' is_rt,
          case event_type when 'click' then concat('part ', cast(event_id as varchar(20)), '...')
            when 'view' then concat('...part ', cast(event_id as varchar(20)))
            when 'purchase' then concat('...part ', cast(event_id as varchar(20)), '...')
            else concat('part ', cast(event_id as varchar(20))) end full_text
        from {events}""",
    # Each claim meets 20 message ids and 10 transcript positions, all joined on unique keys.
    "base_false_truth_del_cands": """
        select o.sid falsehood_id,
          concat(cast(t.thread_id as varchar(20)), '***', cast(t.end_thread_tweet_id as varchar(20))) truth_id,
          cast((o.sid * 31 + t.thread_id * 17) % 1000 / 10000.0 as decimal(22,15)) l2dist
        from {claim_offsets} o join {dcbot_tweets} t on t.thread_id = o.sid + o.off
        union all
        select o.sid, concat(f.tid, '***', cast(f.sid as varchar(20))),
          cast((o.sid * 13 + f.sid * 7) % 1000 / 10000.0 as decimal(22,15))
        from {claim_offsets} o join {fbase_statements} f
          on f.tid = concat('conv-', cast((o.sid + o.off) % (select count(*) from {fbase_transcripts}) as varchar(20)))
          and f.sid = o.off % 8
        where o.off <= 10""",
    "false_truth_del_cands": """
        select falsehood_id, truth_id, l2dist from {base_false_truth_del_cands}
        where falsehood_id in (select sid from {wp_statements} where topic = 'en')""",
}

OFFSETS = {
    "spark": "select sid, off from {wp_statements} lateral view explode(sequence(1, 20)) x as off",
    "duckdb": "select sid, unnest(range(1, 21)) off from {wp_statements}",
}


def references(sql: str) -> list[str]:
    return list(dict.fromkeys(re.findall(r"\{(\w+)\}", sql)))


class Inputs:
    """Lazily built input tables of one test data folder, as attributes."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir
        self._built: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_") or (name not in RAW and name not in SQL and name != "claim_offsets"):
            raise AttributeError(name)
        if name not in self._built:
            self._built[name] = self._build(name)
        return self._built[name]

    def _build(self, name: str) -> DataFrame:
        if name in RAW:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        sql = OFFSETS["spark"] if name == "claim_offsets" else SQL[name]
        return self.spark.sql(sql, **{ref: getattr(self, ref) for ref in references(sql)})

    def _spread(self, df: DataFrame) -> DataFrame:
        """A scan dealt evenly over all cores, for work that is heavy per row."""
        return df.repartition(self.spark.sparkContext.defaultParallelism)

    @cached_property
    def truth_snapshot(self) -> DataFrame:
        return corpus.truth_snapshot(
            self.fbase_statements, self.fbase_transcripts, self.dcbot_tweets, self.wp_statements
        )

    @cached_property
    def converged(self) -> DataFrame:
        """The table of sampled truths; their id is kept for checks."""
        return materialise(corpus.converged_sample(self.wp_statements, self.truth_snapshot))

    @cached_property
    def falsehood_rows(self) -> DataFrame:
        return corpus.matched_falsehoods(self.wp_statements)

    @cached_property
    def truth_rows(self) -> DataFrame:
        return corpus.matched_truths(self.converged)

    @cached_property
    def index_pages(self) -> DataFrame:
        return self.listed_index_pages.select("value")

    @cached_property
    def listed_index_pages(self) -> DataFrame:
        """Transcript index pages as JSON: 20 events each, scores as numbers, strings, zero or unknown; page 0 has the oldest."""
        score = F.expr(
            "case event_type when 'view' then parse_json(cast(cast(value as decimal(5,2)) as string)) "
            "when 'click' then to_variant_object(cast(null as array<int>)) "
            "when 'purchase' then parse_json('0') when 'error' then parse_json('\"0\"') "
            "else parse_json('\"Unknown\"') end"
        )
        entry = F.struct(
            F.col("event_id").cast("string").alias("id"),
            F.date_format("ts", "yyyy-MM-dd").alias("date"),
            F.col("event_type").alias("type"),
            F.concat(F.lit("e-"), F.col("event_id").cast("string")).alias("slug"),
            F.struct(score.alias("score")).alias("sentiment"),
        )
        page = F.floor(F.col("event_id") / 20).alias("page")
        pages = self.events.groupBy(page).agg(F.collect_list(entry).alias("data"))  # 20 entries a page
        return pages.select("page", F.to_json(F.struct("data")).alias("value"))

    @cached_property
    def timeline_lines(self) -> DataFrame:
        """The raw messages as JSON lines; reposts repeat their text in ``retweeted_status``."""
        t = self._spread(self.raw_tweets)
        repeated = F.when(F.col("is_rt"), F.struct("full_text"))
        own = F.when(~F.col("is_rt"), F.col("full_text")).otherwise("RT")
        line = F.struct(
            F.col("tweet_id").alias("id"), "user_id", "created_at", own.alias("full_text"),
            repeated.alias("retweeted_status"),
        )
        return t.select(F.to_json(line).alias("value"))

    @cached_property
    def marked_texts(self) -> DataFrame:
        """(doc_id, entities, tweet, claim, urls): texts built around each document's id and language with marks to be cleaned."""
        return self.spark.sql(MARKED_TEXTS, documents=self.documents)

    @cached_property
    def broken_lines(self) -> DataFrame:
        """The timeline's lines, purchases without an id and views with a time that can't be read."""
        line = F.when(F.col("value").contains("...part") & F.col("value").rlike(r'\.\.\."'), F.regexp_replace("value", r'"id":\d+,', ""))
        bad = line.when(F.col("value").contains("...part"), F.regexp_replace("value", r'"created_at":"[^"]*"', '"created_at":"soon"'))
        return self.timeline_lines.select(bad.otherwise(F.col("value")).alias("value"))

    @cached_property
    def broken_transcript_pages(self) -> DataFrame:
        """The transcript pages; scores of -0.3 aren't numbers and those of -0.6 are left out."""
        html = F.replace("html", F.lit("title='score -0.3'"), F.lit("title='none yet'"))
        return self.transcript_pages.withColumn("html", F.regexp_replace(
            html, r"<div class='sentiment-block'><div title='score -0\.6'></div></div>", ""))

    def _page_of_lines(self, block) -> DataFrame:
        """One HTML page per document with one block per line of its text."""
        escaped = F.col("text")
        for mark, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
            escaped = F.replace(escaped, F.lit(mark), F.lit(entity))
        blocks = F.array_join(F.transform(F.split(escaped, "\n"), block), "\n")
        head = F.lit("<html><body><h1>Total <span class='franklin-bold red'> 1,0")
        number = F.lpad((F.col("doc_id") % 100).cast("string"), 2, "0")
        script = F.lit("</span></h1><script>var t='<div class=\"claim-row\">';</script>")
        html = F.concat(head, number, script, blocks, F.lit("</body></html>"))
        return self._spread(self.documents).select("doc_id", html.alias("html"))

    @cached_property
    def transcript_pages(self) -> DataFrame:
        """Documents as transcripts: every third line by another speaker, every fourth unscored."""

        def block(line, i):
            speaker = F.when(i % 3 == 2, "host").otherwise(SPEAKER)
            score = F.when(i % 4 == 3, "Unknown").otherwise(F.concat(F.lit("score -0."), (i % 10).cast("string")))
            return F.concat(
                F.lit("<div class='media topic-media-row mediahover x'><div class='speaker-label'>"), speaker,
                F.lit("</div><div class='transcript-text-block'> "), line,
                F.lit("</div><div class='sentiment-block'><div title='"), score, F.lit("'></div></div></div>"),
            )

        return self._page_of_lines(block).select(F.concat(F.lit("doc-"), "doc_id").alias("tid"), "html")

    @cached_property
    def claim_pages(self) -> DataFrame:
        """Documents as claim pages: every fifth claim has no date, some carry a repeat count."""

        def block(line, i):
            day = F.date_format(F.date_add(F.lit("2018-01-01").cast("date"), (i * 7 % 700).cast("int")), "MMM d, yyyy")
            date = F.when(i % 5 == 4, "").otherwise(F.concat(F.lit("<div class='dateline'>"), day, F.lit("</div>")))
            kind = F.when(i % 2 == 0, "has-apos").otherwise("no-apos")
            said = F.concat(F.lit("<span class='repeated-total'>Repeated "), i.cast("string"), F.lit(" times</span>"))
            repeats = F.when(i % 3 == 1, said).otherwise("")
            details = "<p>Topic: <span>Jobs</span></p><p>Source: <span>Remarks</span></p>"
            marks = F.repeat(F.lit("<span class='pinocchio'></span>"), (i % 5).cast("int"))
            return F.concat(
                F.lit("<div class='claim-row'>"), date, F.lit("<p class='pg-bodyCopy "), kind, F.lit("'>“"), line,
                F.lit("”</p><div class='rail left'>"), repeats,
                F.lit(f"<div class='details not-expanded'>{details}</div></div><div class='pinocchios'>"), marks,
                F.lit("</div></div>"),
            )

        return self._page_of_lines(block).withColumnRenamed("doc_id", "page_id")

    @cached_property
    def messages(self) -> DataFrame:
        """The table of cleaned messages: author, tweet_id, text, ts, is_rt, more."""
        return materialise(timeline(self.timeline_lines))

    def stream_of(self, name: str) -> DataFrame:
        """A derived table of one test table as a stream of that table's file, or of all files of its folder."""
        (raw,) = references(SQL[name])
        files = self.spark.readStream.schema(getattr(self, raw).schema)
        source = files.parquet(f"{self.sf_dir}/{raw}.parque[t]")  # a plain path is taken for a folder, a pattern for either
        return self.spark.sql(SQL[name], **{raw: source})

    @cached_property
    def message_stream(self) -> DataFrame:
        """``messages`` as a stream, with times to the millisecond as in the JSON lines."""
        raw = self.stream_of("raw_tweets")
        text, ts = clean_tweet(F.col("full_text")), F.date_trunc("millisecond", "created_at")
        return raw.select(
            F.col("user_id").alias("author"), "tweet_id", text.alias("text"), ts.alias("ts"), "is_rt"
        ).withColumn("more", more_follows(F.col("text")))

    @cached_property
    def loaded_messages(self) -> DataFrame:
        """The part of the timeline that an earlier run has loaded."""
        return self.raw_tweets.where(F.col("created_at") < F.lit("2024-01-20").cast("timestamp"))

    @cached_property
    def claim_vectors(self) -> DataFrame:
        """The embeddings rounded to two decimals, standing for restated claims."""
        rounded = F.transform("embedding", lambda x: F.round(x.cast("double"), 2))
        return self.embeddings.select(F.col("vec_id").alias("id"), rounded.alias("vector"))

    @cached_property
    def truth_vectors(self) -> DataFrame:
        exact = F.transform("embedding", lambda x: x.cast("double"))
        return self.embeddings.select(F.col("vec_id").alias("id"), exact.alias("vector"))
