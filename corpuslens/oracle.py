"""Plain SQL for the same results, written in the direct form the operators replace.

Pairs for AUC, windows over all rows for ranks and buckets, row numbers for samples: right by
inspection, and only for checking at small scale.
"""

from __future__ import annotations

import re

from corpuslens.fixtures import INDEX_URL, OFFSETS, SPEAKER, SQL, references

KINDS = {"all": ("", 25), "nontweet": ("and stype = 0", 25), "tweet": ("and stype = 1", 10)}
LATEST = "(select max(model_version) from model_analysis_rpts where report_type = 'model_rpt_gt')"
NEWEST = "(select * from ds_metadata where ds_type = 'converged_filtered' order by dsid desc limit 1)"
LAST_CLAIM = "(select max(s_date) from wp_statements where wc between 7 and 107)"
SHARES = ("tp_ratio", "tn_ratio", "fp_ratio", "fn_ratio")
RATIOS = ", ".join(f"cast(sum({s[:2]}) as double) / count(*) {s}" for s in SHARES)


def with_tables(body: str, **ctes: str) -> str:
    """Prefix a query with the input tables it names (``{name}``) and its own sub-queries."""
    parts: dict[str, str] = {}

    def named(sql: str) -> list[str]:
        """Other tables a text refers to, in braces or by plain name."""
        plain = [t for t in SQL if re.search(rf"(?<!{{)\b{t}\b", sql)]
        return references(sql) + plain

    def need(name: str) -> None:
        sql = OFFSETS["duckdb"] if name == "claim_offsets" else SQL.get(name)
        if name in parts or sql is None:
            return
        add(name, sql)

    def add(name: str, sql: str) -> None:
        for ref in named(sql):
            if ref != name:
                add_own(ref) if ref in ctes else need(ref)
        parts[name] = sql.format(**{r: r for r in references(sql)})

    def add_own(name: str) -> None:
        if name not in parts:
            add(name, ctes[name])

    for ref in named(body):
        add_own(ref) if ref in ctes else need(ref)
    text = body.format(**{r: r for r in references(body)})
    if not parts:
        return text
    return "with " + ",\n".join(f"{n} as ({s})" for n, s in parts.items()) + "\n" + text


def half_up(x: str, digits: int) -> str:
    return f"cast(round(cast({x} as decimal(30,12)), {digits}) as double)"


def _tests(kind: str, dated: bool = True) -> str:
    stype, _ = KINDS[kind]
    dates = f"and sdate between (select test_start_date from {NEWEST}) and (select test_end_date from {NEWEST})"
    return f"""select *, case when label = prediction then 1 else 0 end correct,
        case when raw_pred >= 0.5 then raw_pred else cast(1 - raw_pred as decimal(5,4)) end confidence,
        length(statement_text) - length(replace(statement_text, ' ', '')) + 1 words
      from {{model_analysis_rpts}} where report_type = 'model_rpt_gt' and model_version = {LATEST}
        {dates if dated else ''} {stype}"""


def _sums(rows: str) -> str:
    return f"""select cast(sum(tp) as double) tp, cast(sum(tn) as double) tn, cast(sum(fp) as double) fp,
        cast(sum(fn) as double) fn, cast(sum(correct) as double) / count(*) acc from {rows}"""


MCC = "(tp * tn - fp * fn) / nullif(sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)), 0)"


def mcc(kind: str) -> str:
    shares = ", ".join(f"{s[:2]} / nullif(tp + fp + tn + fn, 0) {s}" for s in SHARES)
    return with_tables(f"select {MCC} mcc, {shares} from {{s}}", f=_tests(kind), s=_sums("{f}"))


def _pairs(rows: str, label: str) -> str:
    return f"""select avg(case when p.raw_pred > n.raw_pred then 1.0 when p.raw_pred = n.raw_pred then 0.5 else 0.0 end)
        est_auc from (select raw_pred from {rows} where {label} = 1) p, (select raw_pred from {rows} where {label} = 0) n"""


def auc(kind: str) -> str:
    return with_tables("select est_auc from {a}", f=_tests(kind), a=_pairs("{f}", "label"))


def auc_of_doubles() -> str:
    """By the ranks of the positives, as no two scores are equal."""
    return with_tables("""select round((s - p * (p + 1) / 2.0) / (cast(p as double) * n), 9) est_auc from (
        select sum(label) p, sum(1 - label) n, cast(sum(label * rn) as double) s from (
          select label, row_number() over (order by cast(raw_pred as double) + statement_id / 1e9) rn from {f}) x) y""", f=_tests("all"))


def _tiles(kind: str, ties: str = "raw_pred, label, prediction, statement_id") -> str:
    return f"select *, ntile({KINDS[kind][1]}) over (order by confidence, {ties}) bucket from {{f}}"


def _bucket_columns() -> dict[str, str]:
    ppr = half_up("sum(tp + fp) / cast(count(*) as double)", 3)
    return {
        "max_confidence": "max(confidence)",
        "bucket_acc": half_up("avg(correct)", 4),
        "ppv": f"coalesce({half_up('sum(tp) / nullif(cast(sum(tp + fp) as double), 0)', 3)}, 0.0)",
        "npv": f"coalesce({half_up('sum(tn) / nullif(cast(sum(tn + fn) as double), 0)', 3)}, 0.0)",
        "ppr": ppr,
        "npr": half_up(f"1 - {ppr}", 3),
        **{s: half_up(f"sum({s[:2]}) / cast(count(*) as double)", 3) for s in SHARES},
    }


def lookup(kind: str) -> str:
    cols = ", ".join(f"{sql} {name}" for name, sql in _bucket_columns().items())
    return with_tables(
        f"""select {LATEST} model_version, {cols}, (select {half_up('acc', 2)} from {{s}}) acc,
          (select {half_up('est_auc', 2)} from {{a}}) auc, (select {half_up(MCC, 2)} from {{s}}) mcc,
          (select test_start_date from {NEWEST}) test_start_date, (select test_end_date from {NEWEST}) test_end_date
        from {{b}} group by bucket""",
        f=_tests(kind), s=_sums("{f}"), a=_pairs("{f}", "label"), b=_tiles(kind),
    )


def _globals(prefix: str, s: str, a: str) -> list[str]:
    shares = [f"(select {half_up(f'{c[:2]} / (tp + fp + tn + fn)', 2)} from {{{s}}}) {prefix}{c}" for c in SHARES]
    return [
        f"(select {half_up('acc', 2)} from {{{s}}}) {prefix}acc",
        f"(select {half_up('est_auc', 2)} from {{{a}}}) {prefix}auc",
        f"(select {half_up(MCC, 2)} from {{{s}}}) {prefix}mcc",
        *shares,
    ]


def summary(kind: str) -> str:
    return with_tables(
        f"""select max(confidence) max_confidence, {LATEST} model_version, avg(correct) bucket_acc,
          {', '.join(_globals('', 's', 'a'))},
          (select test_start_date from {NEWEST}) test_start_date, (select test_end_date from {NEWEST}) test_end_date
        from {{b}} group by bucket""",
        f=_tests(kind), s=_sums("{f}"), a=_pairs("{f}", "label"), b=_tiles(kind),
    )


def global_accuracy(named: bool) -> str:
    ctes, cols = {}, []
    for kind in KINDS:
        ctes |= {f"f_{kind}": _tests(kind), f"s_{kind}": _sums(f"{{f_{kind}}}"), f"a_{kind}": _pairs(f"{{f_{kind}}}", "label")}
        cols += _globals(f"{kind}_", f"s_{kind}", f"a_{kind}")
    if named:
        cols = [f"{LATEST} model_version", f"(select dsid from {NEWEST}) dsid", *cols]
    return with_tables(f"select {', '.join(cols)}", **ctes)


def local_summary() -> str:
    cols = ", ".join(f"{sql} {name}" for name, sql in _bucket_columns().items())
    parts = [
        f"select {LATEST} model_version, (select dsid from {NEWEST}) dsid, {code} stmt_type, cast(bucket as int) bucket_num, "
        f"{cols} from {{b_{kind}}} group by bucket"
        for kind, code in (("nontweet", 0), ("tweet", 1))
    ]
    ctes = {}
    for kind in ("nontweet", "tweet"):
        ctes |= {f"f_{kind}": _tests(kind), f"b_{kind}": _tiles(kind).replace("{f}", f"{{f_{kind}}}")}
    return with_tables(" union ".join(parts), **ctes)


def _published(table: str) -> str:
    return f"""select *, case when actual_label = prediction then 1 else 0 end correct from {{{table}}}
        where model_version = (select max(model_version) from {{model_analysis_rpts}} where report_type = 'model_rpt_gt')"""


def published_auc(table: str) -> str:
    return with_tables("select est_auc from {a}", p=_published(table), a=_pairs("{p}", "actual_label"))


def published_accuracy(table: str) -> str:
    return with_tables(
        f"""select max(raw_confidence) max_confidence, {LATEST} model_version, avg(correct) bucket_acc,
          (select {half_up('est_auc', 2)} from {{a}}) auc, (select {half_up('avg(correct)', 2)} from {{p}}) acc
        from {{b}} group by bucket""",
        p=_published(table), a=_pairs("{p}", "actual_label"),
        b="select *, ntile(10) over (order by raw_confidence, correct, dc_tid) bucket from {p}",
    )


def weekly(kind: str, dated: bool, names: tuple[str, ...] = ("yweeks", *SHARES)) -> str:
    ratios = ", ".join(f"cast(sum({s[:2]}) as double) / count(*) \"{n}\"" for s, n in zip(SHARES, names[1:]))
    week = "cast(sdate as date) - cast(dayofweek(sdate) as int)"
    return with_tables(f'select {week} "{names[0]}", {ratios} from {{f}} group by {week}', f=_tests(kind, dated))


def confidence_matrix(kind: str) -> str:
    k = KINDS[kind][1]
    n = "cast(count(*) as double)"
    conf = f"cast(sum(confidence) as double) / {n}"
    shares = ", ".join(f"{half_up(f'sum({s[:2]}) / {n}', 3)} {s}" for s in SHARES)
    return with_tables(
        f"""select cast(bucket as int) confidence_bucket, {half_up(f'bucket / {k}.0', 3)} max_conf_percentile,
          {half_up(f'sum(words) / {n}', 0)} avg_wc, {shares}, {half_up(f'sum(correct) / {n}', 3)} acc,
          {half_up(conf, 3)} confidence, {half_up(f'sum(correct) / {n} - {conf}', 3)} acc_conf_delta
        from {{b}} group by bucket""",
        f=_tests(kind), b=_tiles(kind, "raw_pred, label, prediction, words, statement_id"),
    )


def confidence_frame(kind: str) -> str:
    names = ", ".join(
        f'{s} "{n}"' for s, n in zip(SHARES, ("true positives", "true negatives", "false positives", "false negatives"))
    )
    return f'select confidence_bucket "confidence bucket", {names} from ({confidence_matrix(kind)}) m'


def _extreme_ctes(kind: str, side: str) -> dict[str, str]:
    n = "cast(count(*) as double)"
    ppr = half_up(f"sum(tp + fp) / {n}", 4)
    return {
        "f": _tests(kind),
        "b": _tiles(kind),
        "st": f"""select bucket, {half_up('avg(correct)', 4)} bucket_acc,
            coalesce({half_up('sum(tp) / nullif(cast(sum(tp + fp) as double), 0)', 4)}, 0.0) pos_pred_acc,
            coalesce({half_up('sum(tn) / nullif(cast(sum(tn + fn) as double), 0)', 4)}, 0.0) neg_pred_acc,
            {ppr} pos_pred_ratio, {half_up(f'1 - {ppr}', 4)} neg_pred_ratio from {{b}} group by bucket""",
        "x": f"select * from {{st}} where pos_pred_acc = (select {side}(pos_pred_acc) from {{st}}) order by bucket limit 1",
    }


def extreme(kind: str, side: str) -> str:
    step = 100 // KINDS[kind][1]
    return with_tables(
        f"""select bucket_acc, concat(cast((b.bucket - 1) * {step} as varchar), '-', cast(b.bucket * {step} as varchar), '%')
          conf_percentile, pos_pred_acc, neg_pred_acc, pos_pred_ratio, neg_pred_ratio, statement_id, statement_text,
          tp, tn, fp, fn from {{b}} b join {{x}} x on b.bucket = x.bucket""",
        **_extreme_ctes(kind, side),
    )


def explained() -> str:
    parts = []
    for side in ("max", "min"):
        for kind, code in (("nontweet", 0), ("tweet", 1)):
            order = "sha1(concat(cast(statement_id as varchar), '-2718')), statement_id"
            parts.append(
                f"select * from (select '{side}_ppv_{kind}s' bucket_type, e.*, {code} stype from ({extreme(kind, side)}) e "
                f"order by {order} limit 100) t"
            )
    return " union ".join(parts)


# --- corpus ---------------------------------------------------------------------------------------

CLAIM_ROWS = """select sid, statement_text, case when source = 'Twitter' then 1 else 0 end s_type, s_date, wc swc
    from {wp_statements}"""
TRUTH_ROWS = f"""select concat(s.tid, '***', cast(s.sid as varchar)) truth_id, s.statement_text, 0 s_type,
      cast(t.t_date as timestamp) s_date, s.wc swc, true spoken
    from {{fbase_statements}} s join {{fbase_transcripts}} t on s.tid = t.tid
    union all
    select concat(cast(thread_id as varchar), '***', cast(end_thread_tweet_id as varchar)), statement_text, 1, t_end_date,
      wc, false
    from {{dcbot_tweets}} where retweet = 0
      and t_end_date < (select max(s_date) from {{wp_statements}} where wc between 7 and 107)"""


def _trimmed(rows: str, share: tuple[float, float], columns: str) -> str:
    return f"""select {columns} from {{{rows}}}, (select min(swc) low, max(swc) high from
        (select swc, cume_dist() over (order by swc) c from {{{rows}}}) where c between {share[0]} and {share[1]}) bounds
      where swc between low and high"""


FALSE_COLUMNS = "statement_text, s_type, s_date, 'False' as label"
FALSEHOODS = with_tables(_trimmed("c", (0.03, 0.995), FALSE_COLUMNS), c=CLAIM_ROWS)
TRUTHS = with_tables(_trimmed("t", (0.13, 0.995), "statement_text, s_type, s_date, 'True' as label"), t=TRUTH_ROWS)
FALSEHOODS_TINY = f"select * from ({FALSEHOODS}) f order by s_date, statement_text limit 1000"
TRUTHS_TINY = with_tables(
    """select statement_text, s_type, 'True' as label, s_date from {t}
      where not spoken or s_date >= date '2017-01-19' order by s_date, statement_text, truth_id limit 10000""",
    t=TRUTH_ROWS,
)
SNAPSHOT = f"""select truth_id, statement_text stext, s_type stype, s_date sdate, swc from (
      select concat(s.tid, '***', cast(s.sid as varchar)) truth_id, s.statement_text, 0 s_type,
        cast(t.t_date as timestamp) s_date, s.wc swc
      from {{fbase_statements}} s join {{fbase_transcripts}} t on s.tid = t.tid
      union all
      select concat(cast(thread_id as varchar), '***', cast(end_thread_tweet_id as varchar)), statement_text, 1,
        t_end_date, wc
      from {{dcbot_tweets}} where retweet = 0) a
    where swc between 7 and 107 and s_date between date '2017-01-19'
      and (select max(s_date) from {{wp_statements}} where wc between 7 and 107)"""
ALL_TRUTHS = with_tables("select * from {snap}", snap=SNAPSHOT)
DIST = """select c.wc, c.n / c.tot p, t.tot from
      (select wc, cast(count(*) as double) n, cast(sum(count(*)) over () as double) tot from {wp_statements}
       where wc between 7 and 107 group by wc) c
      join (select swc, cast(sum(count(*)) over () as double) tot from {snap} group by swc) t on c.wc = t.swc"""
TARGET = with_tables(
    "select wc, p xformed_wc_cnt, (select sum(round(tot * p)) from {d}) xformed_dist_size from {d}", snap=SNAPSHOT, d=DIST
)
SAMPLE = """select truth_id, stext statement_text, stype, cast(sdate as date) sdate from (
      select s.*, round(d.tot * d.p) quota, row_number() over (partition by swc
        order by sha1(concat(truth_id, '-2718')), truth_id) rn
      from {snap} s join {d} d on s.swc = d.wc) x where rn <= quota"""
SAMPLE_CTES = {"snap": SNAPSHOT, "d": DIST, "smp": SAMPLE}
CONVERGED = with_tables("select * from {smp}", **SAMPLE_CTES)
FALSE_MATCHED = """select statement_text, case when source = 'Twitter' then 1 else 0 end s_type, 'False' as label, s_date
    from {wp_statements} where wc between 7 and 107"""
TRUE_MATCHED = "select statement_text, stype s_type, 'True' as label, sdate s_date from {smp}"
MATCHED = {**SAMPLE_CTES, "fm": FALSE_MATCHED, "tm": TRUE_MATCHED}
DATE_DRIVER = with_tables("select s_date, cume_dist() over (order by s_date) c_dist from {fm}", **MATCHED)
DATE_DRIVER_TINY = f"select s_date, cume_dist() over (order by s_date) c_dist from ({FALSEHOODS_TINY}) t"
SPLIT = f"""select case when round(c_dist, 9) <= 0.8 then 'train' when round(c_dist, 9) <= 0.9 then 'val' else 'test' end split,
    min(s_date) start_date, max(s_date) end_date, count(*) n from ({DATE_DRIVER}) d group by 1"""
EXACT_DUPLICATES = with_tables(
    """select t.tid, t.sid, count(*) n_claims from (
        select tid, cast(sid as bigint) sid, statement_text from {fbase_statements} where wc between 7 and 107
        union all select 'none', thread_id, statement_text from {dcbot_tweets} where wc between 7 and 107) t
      join {wp_statements} w on sha1(lower(t.statement_text)) = sha1(lower(w.statement_text)) group by t.tid, t.sid"""
)
WITHOUT_DUPLICATES = with_tables(
    """select * from {snap} where sha1(lower(stext)) not in (select sha1(lower(statement_text)) from {wp_statements})""",
    snap=SNAPSHOT,
)


def near_duplicates(table: str, limit: float) -> str:
    return with_tables(f"select distinct truth_id from {{{table}}} where l2dist < {limit}")


DISTANCE_TILES = with_tables(
    """select cast(bucket as int) bucket, count(*) n, min(l2dist) min_l2dist, max(l2dist) max_l2dist from (
        select l2dist, ntile(100) over (order by l2dist, falsehood_id, truth_id) bucket from {false_truth_del_cands}) t
      group by bucket"""
)
DATASET_SUMMARY = with_tables(
    "select "
    + ", ".join(
        f"(select count(*) from {{{side}}}, {NEWEST} d where s_date between d.{p}_start_date and d.{p}_end_date) {p}_{name}"
        for p in ("train", "val", "test")
        for side, name in (("tm", "truths"), ("fm", "falsehoods"))
    ),
    **MATCHED,
)
GROUND_TRUTH = with_tables(
    """select sdate, stext, stype, 'True' as label from {snap} where sdate between
        (select min(s_date) from {wp_statements} where wc between 7 and 107) and
        (select max(s_date) from {wp_statements} where wc between 7 and 107)
      union all select cast(s_date as timestamp), statement_text, s_type, label from {fm}""",
    snap=SNAPSHOT, fm=FALSE_MATCHED,
)
CLOSE_PAIRS = """with v as (select vec_id id, list_transform(embedding, lambda x: cast(x as double)) t,
      list_transform(embedding, lambda x: round(cast(x as double), 2)) c from embeddings)
    select min(a.id) falsehood_id, min(b.id) truth_id, count(distinct a.id) n_falsehoods, count(distinct b.id) n_truths,
      round(list_distance(a.c, b.t), 9) l2dist
    from v a, v b where list_distance(a.c, b.t) < 0.023 group by a.c, b.t"""

CLOSE_CANDIDATES = """with v as (select vec_id id, list_transform(embedding, lambda x: cast(x as double)) t,
      list_transform(embedding, lambda x: round(cast(x as double), 2)) c from embeddings)
    select a.id falsehood_id, b.id truth_id, round(list_distance(a.c, b.t), 9) l2dist
    from v a, v b where list_distance(a.c, b.t) < 0.023"""
CLOSE_NEAR_DUPLICATES = f"select distinct truth_id from ({CLOSE_CANDIDATES}) where l2dist < 0.02"

# --- queues and feedback --------------------------------------------------------------------------

TEST_END = """(select test_end_date from {model_metadata} m join {ds_metadata} d on m.dsid = d.dsid
    where m.model_version = (select max(model_version) from {model_metadata}))"""
ANALYSED = "select tid, sid from {stmts_analyzed_published} union all select tid, sid from {stmts_analyzed_notpublished}"
STATEMENTS_TO_ANALYSE = with_tables(
    """select s.tid, s.sid, s.statement_text, 0 stype from {fbase_statements} s join {fbase_transcripts} t on s.tid = t.tid
      where s.wc between 7 and 107 and t.t_date >= (select max(t_date) from {an} a join {fbase_transcripts} x on a.tid = x.tid)
        and not exists (select 1 from {an} a where a.tid = s.tid and a.sid = s.sid)""",
    an=ANALYSED,
)
TWEETS_TO_ANALYSE = with_tables(
    """select thread_id, end_thread_tweet_id tweet_id, statement_text, 1 stype from {dcbot_tweets}
      where retweet = 0 and wc between 7 and 107 and thread_id > (select max(thread_id) from (
        select thread_id from {tweets_analyzed_published} union all select thread_id from {tweets_analyzed_notpublished}) a)"""
)
STATEMENTS_TO_SCORE = with_tables(
    f"""select s.tid, s.sid, s.statement_text, 0 ctxt_type, t.t_date, t.transcript_url url
      from {{fbase_statements}} s join {{fbase_transcripts}} t on s.tid = t.tid
      left join {{infsvc_stmts_published}} p on p.tid = s.tid and p.sid = s.sid
      where p.tid is null and s.wc between 7 and 107 and t.t_date > {TEST_END} + 1"""
)
TWEETS_TO_SCORE = with_tables(
    f"""select t.thread_id, t.end_thread_tweet_id, t.statement_text, 1 ctxt_type, t.t_end_date,
        concat('https://twitter.com/a/status/', cast(t.end_thread_tweet_id as varchar)) url
      from {{dcbot_tweets}} t left join {{infsvc_tweets_published}} p on p.thread_id = t.thread_id
      where p.thread_id is null and t.retweet = 0 and t.wc between 7 and 107 and t.t_end_date > {TEST_END} + 1"""
)
SCORED_STATEMENTS = f"""select * from (select c.l2dist min_l2dist, w.sid thread_id, w.s_date, f.tid, cast(f.sid as bigint) sid,
        w.statement_text falsehood_text, f.statement_text truth_text,
        row_number() over (partition by w.sid order by c.l2dist, f.tid, f.sid) rn
      from {{wp_statements}} w join {{base_false_truth_del_cands}} c on c.falsehood_id = w.sid
      join {{fbase_statements}} f on c.truth_id = concat(f.tid, '***', cast(f.sid as varchar))
      where c.l2dist < 0.04 and w.s_date > {TEST_END}) x where rn = 1"""
SCORED_TWEETS = f"""select * from (select c.l2dist min_l2dist, w.sid f_thread_id, w.s_date, t.thread_id,
        w.statement_text falsehood_text, t.statement_text truth_text,
        row_number() over (partition by w.sid order by c.l2dist, t.thread_id) rn
      from {{wp_statements}} w join {{base_false_truth_del_cands}} c on c.falsehood_id = w.sid
      join {{dcbot_tweets}} t on c.truth_id = concat(cast(t.thread_id as varchar), '***', cast(t.end_thread_tweet_id as varchar))
      where c.l2dist < 0.04 and w.s_date > {TEST_END}) x where rn = 1"""
SCORED = {"ls": SCORED_STATEMENTS, "lt": SCORED_TWEETS}
SCORED_FALSE_STATEMENTS = with_tables(
    "select min_l2dist, thread_id, s_date, tid, sid, falsehood_text, truth_text from {ls}", **SCORED
)
SCORED_FALSE_TWEETS = with_tables(
    "select min_l2dist, f_thread_id, s_date, thread_id, falsehood_text, truth_text from {lt}", **SCORED
)
CURRENT = "p.model_version = (select max(model_version) from {model_metadata})"
STATEMENT_UPDATES = (
    f"select p.tid, p.sid, l.s_date, p.model_version from {{ls}} l join {{infsvc_stmts_published}} p "
    f"on l.tid = p.tid and l.sid = p.sid where {CURRENT}"
)
TWEET_UPDATES = (
    f"select p.thread_id, l.s_date, p.model_version from {{lt}} l join {{infsvc_tweets_published}} p "
    f"on l.thread_id = p.thread_id where {CURRENT}"
)
STATEMENT_NONLABEL = f"""select p.tid, p.sid, t.t_date from {{infsvc_stmts_published}} p
    join {{fbase_statements}} s on s.tid = p.tid and s.sid = p.sid join {{fbase_transcripts}} t on t.tid = p.tid
    where t.t_date > {TEST_END} and t.t_date <= (select max(s_date) from {{wp_statements}})"""
TWEET_NONLABEL = f"""select p.thread_id, t.t_end_date from {{infsvc_tweets_published}} p
    join {{dcbot_tweets}} t on t.thread_id = p.thread_id
    where t.t_end_date > {TEST_END} and t.t_end_date <= (select max(s_date) from {{wp_statements}})"""


def late_labels(table: str, ids: list[str], updates: str, others: str) -> str:
    def held(cte: str) -> str:
        return f"exists (select 1 from {{{cte}}} u where " + " and ".join(f"u.{i} = p.{i}" for i in ids) + ")"

    return with_tables(
        f"""select p.dc_tid, {', '.join(f'p.{i}' for i in ids)}, p.prediction,
          case when {held('up')} then 1 when {held('other')} then 0 else p.actual_label end actual_label,
          case when {held('up')} or {held('other')} then timestamp '2020-06-01 00:00:00' else p.score_date end score_date
        from {{{table}}} p""",
        up=updates, other=others, **SCORED,
    )


# --- distributions --------------------------------------------------------------------------------

WORDS = "cast(length(statement_text) - length(replace(statement_text, ' ', '')) + 1 as int)"
POPULATIONS = " union all ".join(
    f"select '{name}' population, {WORDS} wc from {{{cte}}}"
    for name, cte in (
        ("falsehoods", "fh"), ("truths", "th"), ("matched falsehoods", "fm"), ("matched truths", "tm"),
    )
)
POPULATION_CTES = {
    **MATCHED,
    "c": CLAIM_ROWS, "t": TRUTH_ROWS,
    "fh": _trimmed("c", (0.03, 0.995), "statement_text"), "th": _trimmed("t", (0.13, 0.995), "statement_text"),
    "pop": POPULATIONS,
}
WORD_COUNTS = with_tables("select population, wc, count(*) n from {pop} group by population, wc", **POPULATION_CTES)
BINNED = with_tables(
    """select population, cast(floor(wc / 5) * 5 as bigint) bin,
        round(count(*) / cast(sum(count(*)) over (partition by population) as double) / 5, 12) density
      from {pop} group by population, cast(floor(wc / 5) * 5 as bigint)""",
    **POPULATION_CTES,
)
KERNEL = with_tables(
    """select population, cast(x as int) x, round(sum(exp(-0.5 * ((x - wc) / h) * ((x - wc) / h)) / (n * h * sqrt(2 * pi()))), 9) density
      from {pop} join (select population, cast(count(*) as double) n, stddev_samp(wc) * pow(count(*), -0.2) h
        from {pop} group by population) b using (population), (select unnest(range(0, 121, 5)) x) g
      group by population, x""",
    **POPULATION_CTES,
)
QUARTILES = """count(*) "count", round(avg(wc), 9) mean, round(stddev_samp(wc), 9) std, min(wc) "min",
    quantile_cont(wc, 0.25) p25, quantile_cont(wc, 0.5) p50, quantile_cont(wc, 0.75) p75, max(wc) "max\""""
POPULATION_SUMMARY = with_tables(f"select population, {QUARTILES} from {{pop}} group by population", **POPULATION_CTES)
NUMBERED = """select t.i, truths, falsehoods from
      (select row_number() over (order by s_date, wc) - 1 i, wc truths from
        (select s_date, cast(length(statement_text) - length(replace(statement_text, ' ', '')) + 1 as int) wc from {tm}) a) t
      full join (select row_number() over (order by s_date, wc) - 1 i, wc falsehoods from
        (select s_date, cast(length(statement_text) - length(replace(statement_text, ' ', '')) + 1 as int) wc from {fm}) b) f
      on t.i = f.i"""
POSITIONAL = with_tables(
    "select coalesce(t.i, f.i) i, truths, falsehoods" + NUMBERED.split("falsehoods", 1)[1], **MATCHED
)
JOINT = f"""select cast(floor(truths / 10) * 10 as bigint) bin_x, cast(floor(falsehoods / 10) * 10 as bigint) bin_y,
    count(*) n from ({POSITIONAL}) p where truths is not null and falsehoods is not null group by 1, 2"""
SPLIT_ROWS = " union all ".join(
    f"select '{p}' split, '{name}' class, {WORDS} wc from {{{cte}}}, {NEWEST} d "
    f"where s_date between d.{p}_start_date and d.{p}_end_date"
    for p in ("train", "val", "test")
    for cte, name in (("tm", "truths"), ("fm", "falsehoods"))
)
SPLIT_CTES = {**MATCHED, "sr": SPLIT_ROWS}
SPLIT_COUNTS = with_tables("select split, class, wc, count(*) n from {sr} group by split, class, wc", **SPLIT_CTES)
SPLIT_SUMMARY = with_tables(f"select split, class, {QUARTILES} from {{sr}} group by split, class", **SPLIT_CTES)
CLASS_GAP = f"""select split, round(sum(abs(t / nullif(tt, 0) - f / nullif(ft, 0))) / 2, 9) gap from (
      select *, sum(t) over (partition by split) tt, sum(f) over (partition by split) ft from (
        select split, wc, cast(sum(case when class = 'truths' then n else 0 end) as double) t,
          cast(sum(case when class = 'falsehoods' then n else 0 end) as double) f from ({SPLIT_COUNTS}) c group by split, wc) a) b
    group by split"""

# --- sources and loading --------------------------------------------------------------------------

INDEX = f"""select cast(event_id as varchar) tid, cast(ts as date) t_date, event_type transcript_type,
      '{INDEX_URL}e-' || cast(event_id as varchar) transcript_url,
      cast(case when event_type = 'view' then value else 0 end as decimal(5,2)) transcript_sent
    from events where event_type = 'error' or (event_type = 'view' and cast(value as decimal(5,2)) <> 0)"""
LINES = """select doc_id, unnest(string_split(text, chr(10))) line,
      generate_subscripts(string_split(text, chr(10)), 1) - 1 i from documents"""


def cleaned(line: str, quotes: bool = False) -> str:
    """The transcript cleaning for texts without non-ASCII blanks or mis-decoded marks; with ``quotes`` the claims' for texts without addresses."""
    space = "[\\t\\n\\v\\f\\r\\x1c-\\x1f ]"
    other = "[^\\t\\n\\v\\f\\r\\x1c-\\x1f ]"
    x = f"replace({line}, chr(9), '')" if quotes else f"replace({line}, '\"', '')"
    for pattern in ("\\[.*?\\]", f"#{other}+", f"@{other}+", "–|—|--", f"^{space}+|{space}+$"):
        x = f"regexp_replace({x}, '{pattern}', '', 'g')"
    return x


TRANSCRIPT_STATEMENTS = f"""select concat('doc-', cast(doc_id as varchar)) tid,
      cast(row_number() over (partition by doc_id order by i) - 1 as int) sid, {cleaned('line')} statement_text,
      cast(-(i % 10) / 10.0 as decimal(18,2)) sentiment
    from ({LINES}) l where i % 3 <> 2 and i % 4 <> 3"""
CLAIM_COUNTS = f"""select cast(date '2018-01-01' + cast(i * 7 % 700 as int) as date) s_date, cast(i % 5 as int) pinnochios,
      cast(case when i % 3 = 1 then i else 0 end as bigint) repeats, count(*) n
    from ({LINES}) l where i % 5 <> 4 group by 1, 2, 3"""
CLAIMS = f"""select 1 iid, {cleaned('line', quotes=True)} statement_text,
      cast(case when i % 3 = 1 then i else 0 end as bigint) repeats, 'Jobs' topic, 'Remarks' source, cast(i % 5 as int) pinnochios,
      cast(date '2018-01-01' + cast(i * 7 % 700 as int) as date) s_date
    from ({LINES}) l where i % 5 <> 4"""
CLAIM_FEED = f"""select statement_hash, iid, s_date, statement_text, repeats from (
      select *, row_number() over (partition by statement_hash, iid, s_date order by doc_id, i) rn from (
        select doc_id, i, 1 iid, {cleaned('line', quotes=True)} statement_text, sha1({cleaned('line', quotes=True)}) statement_hash,
          cast(case when i % 3 = 1 then i else 0 end as bigint) repeats,
          cast(date '2018-01-01' + cast(i * 7 % 700 as int) as date) s_date
        from ({LINES}) l where i % 5 <> 4) c) r where rn = 1"""
TRANSCRIPT_REJECTS = f"""select concat('doc-', cast(doc_id as varchar)) tid, cast(i as int) pos,
      case when i % 10 = 6 then 'no_sentiment' else 'bad_sentiment' end reason
    from ({LINES}) l where i % 3 <> 2 and ((i % 10 = 3 and i % 4 <> 3) or (i % 10 = 6 and i % 4 <> 3))"""
UNESCAPED = """select doc_id, 'no ' || doc_id || ' & <' || coalesce(lang, 'xx') || '> ''it''s'' caf\u00e9 \u00acanentity; &amp;' "text" from documents"""
CLEAN_TWEETS = """select doc_id, case when doc_id % 2 = 0 then '...  said  that ' else 'said  that ' end || doc_id
      || '   is & stays so  really  yes' || case when doc_id % 3 = 0 then ' ....' else '' end "text",
      (doc_id % 3 = 0)::int "more", (doc_id % 2 = 0)::int cont from documents"""
CLEAN_CLAIMS = """select doc_id, 'No  ' || doc_id || '  at  is   ok' "text" from documents"""
WITHOUT_URLS = """select doc_id, case doc_id % 8 when 0 then 'see  now' when 1 then 'go to , item ' || doc_id
      when 2 then 'mail me' || doc_id || '@example.com today' when 3 then '() here' when 4 then 'version 1.' || doc_id || ' of it'
      when 5 then '. End' when 6 then 'at !' else 'none in ' || doc_id end "text" from documents"""
CLAIM_REJECTS = f"select doc_id page_id, cast(i as int) pos, 'no_date' reject_reason from ({LINES}) l where i % 5 = 4"
ARTICLE = "regexp_extract(html, '<article>(.*)</article>', 1, 's')"
PAGE_HEADINGS = f"""select page_id, replace(replace(replace(regexp_extract({ARTICLE}, '<h1>(.*?)</h1>', 1, 's'),
        '&lt;', '<'), '&gt;', '>'), '&amp;', '&') heading,
      cast(len(regexp_extract_all({ARTICLE}, '<p>')) as varchar) paragraphs
    from pages where html like '%<article>%</article>%'"""
PAGE_TOTALS = "select doc_id page_id, cast(1000 + doc_id % 100 as bigint) total_claims from documents"
PAGE_LAST_DATES = f"""select doc_id page_id, case when max(i) % 5 = 4 then null
      else cast(date '2018-01-01' + cast(max(i) * 7 % 700 as int) as date) end last_date from ({LINES}) l group by doc_id"""
TIMELINE = """select user_id author, event_id tweet_id, case when event_type = 'error' then concat('part ', event_id) else
      case event_type when 'click' then concat('part ', event_id, '...') when 'view' then concat('...part ', event_id)
        when 'purchase' then concat('...part ', event_id, '...') else concat('part ', event_id) end end "text",
      date_trunc('millisecond', ts) ts, event_type = 'error' is_rt,
      case when event_type in ('click', 'purchase') then 1 else 0 end "more",
      case when event_type in ('view', 'purchase') then 1 else 0 end cont from events"""

BROKEN_LINES = """select case when event_type <> 'purchase' then user_id else user_id end author,
      case when event_type <> 'purchase' then event_id end tweet_id,
      case when event_type = 'purchase' then strftime(date_trunc('millisecond', ts), '%Y-%m-%dT%H:%M:%S.%gZ') else 'soon' end created_at,
      case when event_type = 'purchase' then 'no_id' else 'bad_time' end reject_reason
    from events where event_type in ('purchase', 'view')"""
PAGED = f"""select tid, t_date, transcript_type, transcript_url, transcript_sent, cast(tid as bigint) id,
      (select max(event_id // 20) from events) - cast(tid as bigint) // 20 page,
      cast(tid as bigint) <= (select floor(avg(event_id)) from events) known from ({INDEX}) x"""
NEW_ENTRIES = f"""with p as ({PAGED}) select tid, t_date, transcript_type, transcript_url, transcript_sent from p
    where not known and page <= (select min(page) from (select page from p group by page having bool_or(known)) q)"""
TRANSCRIPT_FEED = f"""with p as ({PAGED}) select tid, t_date, transcript_type, transcript_url, transcript_sent from p
    where known or page <= (select min(page) from (select page from p group by page having bool_or(known)) q)"""
SPLIT_DATES = with_tables(f"select {', '.join(f'{p}_{e}_date' for p in ('train', 'val', 'test') for e in ('start', 'end'))} from {NEWEST} d")

HIGH_WATER = with_tables(
    """select 'claims' feed, cast(coalesce(max(s_date), date '1900-01-01') as varchar) latest, max(s_date) is null initial_load
      from {wp_statements} where iid = 1
    union all select 'transcripts', cast(coalesce(max(t_date), date '1900-01-01') as varchar), max(t_date) is null
      from {fbase_transcripts}
    union all select 'tweets', cast(coalesce(max(end_thread_tweet_id), 0) as varchar), max(end_thread_tweet_id) is null
      from {dcbot_tweets}"""
)
NEWER = with_tables(
    """select tweet_id, user_id from {raw_tweets} where tweet_id >
      (select max(tweet_id) from {raw_tweets} where created_at < timestamp '2024-01-20 00:00:00')"""
)
UNKNOWN = with_tables(
    """select s.tid, s.sid from {fbase_statements} s left join {stmts_analyzed_published} p
      on s.tid = p.tid and s.sid = p.sid where p.tid is null"""
)
TO_INSERT = with_tables(
    """select sid, statement_hash, iid, s_date from (
          select *, row_number() over (partition by statement_hash, iid, s_date order by sid) rn from {wp_statements}) w
        where rn = 1 and (statement_hash, iid, s_date) not in (select (statement_hash, iid, s_date) from {loaded_claims})"""
)
STREAM_APPEND = with_tables(
    "select min(sid) sid, statement_hash, iid, s_date from {wp_statements} group by statement_hash, iid, s_date"
)
REJECTS = with_tables(
    """select sid, case
        when (statement_hash, iid, s_date) in (select (statement_hash, iid, s_date) from {loaded_claims}) then 'exists'
        when row_number() over (partition by statement_hash, iid, s_date order by sid) > 1 then 'duplicate_in_batch'
        end reject_reason
      from {wp_statements}"""
)
CLAIM_ROWSET = with_tables(
    """select iid, statement_text, repeats, topic, source, pinnochios, s_date, sha1(statement_text) statement_hash
      from {wp_statements}"""
)
TRANSCRIPT_ROWSET = with_tables(
    "select tid, t_date, transcript_type, transcript_url, transcript_sent from {fbase_transcripts}"
)
STATEMENT_ROWSET = with_tables("select tid, sid, statement_text, sentiment from {fbase_statements}")
NEWER_CLAIMS = with_tables(
    "select sid, s_date from {wp_statements} where s_date >= (select max(s_date) from {loaded_claims} where iid = 1)"
)
GENERATED = with_tables(
    """select sid, cast(length(statement_text) - length(replace(statement_text, ' ', '')) + 1 as int) wc
      from {wp_statements}"""
)
SURROGATE = with_tables(
    """select (select max(sid) from {loaded_claims}) + row_number() over (order by s_date, sid) sid, sid source_sid
      from {wp_statements} where sid % 3 <> 0"""
)
KEY_VIOLATIONS = with_tables(
    "select statement_hash, count(*) n from {wp_statements} group by statement_hash having count(*) > 1"
)
NULL_VIOLATIONS = with_tables(
    "select 'actual_label' column_name, count(*) n from {infsvc_tweets_published} where actual_label is null"
)
ORPHANS = with_tables(
    """select falsehood_id, truth_id from {base_false_truth_del_cands}
      where falsehood_id not in (select sid from {wp_statements} where topic = 'en')"""
)
CASCADE = with_tables(
    """select tid, sid from {fbase_statements}
      where tid not in (select tid from {fbase_transcripts} where t_date < date '2018-01-01')"""
)
SQL_FRAME = with_tables("select source, count(*) n, max(wc) longest from {wp_statements} group by source")


def _thread_steps(latency: int, now: str, compat: bool, messages: str = TIMELINE) -> str:
    """The sequential rules, one message of every author per step of a recursive query."""
    old = f"timestamp '{now}' - interval {latency} second"
    near = f"(s.t_open is not null and o.ts - s.t_open < interval {latency} second)"
    young = f"(not {near} and o.\"more\" = 1 and o.ts > {old})"
    opens = f"(not {near} and o.\"more\" = 1 and o.ts <= {old})"
    goes_on = f"({near} and o.\"more\" = 1)"
    lead = "' ' || " if compat else ""
    x_id, x_end = ("s.first_id", "s.t_open") if compat else ("s.last_id", "s.t_last")
    return f"""with recursive m as ({messages}), own as (
        select author, tweet_id, ts, "more", regexp_replace("text", '^\\.{{2,}}', '') "text",
          regexp_replace(regexp_replace("text", '^\\.{{2,}}', ''), '\\.{{2,}}$', '') piece,
          row_number() over (partition by author order by tweet_id) rn
        from m where not is_rt),
      s as (
        select author, cast(0 as bigint) rn, cast(null as timestamp) t_open, cast(null as bigint) first_id,
          cast(null as bigint) last_id, cast(null as timestamp) t_last, '' txt, cast(null as bigint) x_id, '' x_txt,
          cast(null as timestamp) x_start, cast(null as timestamp) x_end, cast(null as bigint) d_id, '' d_txt,
          cast(null as timestamp) d_start, cast(null as timestamp) d_end, cast(null as bigint) stop_id
        from (select distinct author from own) a
        union all
        select s.author, o.rn,
          case when {goes_on} then s.t_open when {opens} then o.ts end,
          case when {goes_on} then s.first_id when {opens} then o.tweet_id end,
          case when {goes_on} or {opens} then o.tweet_id end,
          case when {goes_on} or {opens} then o.ts end,
          case when {goes_on} then s.txt || ' ' || o.piece when {opens} then {lead}o.piece else '' end,
          case when s.t_open is not null and not {near} then {x_id} end, s.txt, s.t_open, {x_end},
          case when o."more" = 0 then o.tweet_id end,
          case when {near} then s.txt || ' ' || o.piece else o."text" end,
          case when {near} then s.t_open else o.ts end, o.ts,
          case when {young} then o.tweet_id end
        from s join own o on o.author = s.author and o.rn = s.rn + 1 where s.stop_id is null)"""


def threads(latency: int, now: str, compat: bool) -> str:
    return _thread_steps(latency, now, compat) + """
      select author, x_id end_id, x_txt "text", x_start t_start, x_end t_end, false is_rt from s where x_id is not null
      union all select author, d_id, d_txt, d_start, d_end, false from s where d_id is not null
      union all select m.author, tweet_id, "text", ts, ts, true from m
        left join (select author, min(stop_id) stop_id from s group by author) e on e.author = m.author
        where is_rt and (e.stop_id is null or tweet_id < e.stop_id)"""


def tweet_rowset(latency: int, now: str) -> str:
    return f"""select end_id end_thread_tweet_id, "text" statement_text, t_start t_start_date, t_end t_end_date,
        cast(is_rt as int) retweet, sha1("text") statement_hash from ({threads(latency, now, False)}) t"""


def tweet_feed(latency: int, now: str) -> str:
    return f"""select statement_hash, t_end_date, end_thread_tweet_id from (
        select *, row_number() over (partition by statement_hash, t_end_date order by end_thread_tweet_id) rn
        from ({tweet_rowset(latency, now)}) r) f where rn = 1"""


def thread_stream(latency: int, delay: str) -> str:
    """What a stream has given out once the watermark stands ``delay`` before the last message.

    Messages behind the watermark are taken in order, nothing is held back, and threads of full age are closed.
    """
    mark = f"(select max(ts) from ({TIMELINE}) t) - interval '{delay}'"
    steps = _thread_steps(latency, "2100-01-01 00:00:00", False, f"select * from ({TIMELINE}) t where ts < {mark}")
    return steps + f"""
      select author, x_id end_id, x_txt "text", x_start t_start, x_end t_end, false is_rt, false late from s
        where x_id is not null
      union all select author, d_id, d_txt, d_start, d_end, false, false from s where d_id is not null
      union all select author, last_id, txt, t_open, t_last, false, false from
          (select *, row_number() over (partition by author order by rn desc) back from s) z
        where back = 1 and t_open + interval {latency} second <= {mark}
      union all select author, tweet_id, "text", ts, ts, true, false from m where is_rt"""
