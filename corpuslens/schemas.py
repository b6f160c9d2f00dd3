"""Table schemas. Surrogate and statement ids are longs, so they outlast two billion rows."""

from __future__ import annotations

from pyspark.sql import types as T


_TYPES = {
    "int": T.IntegerType(), "bigint": T.LongType(), "string": T.StringType(), "date": T.DateType(),
    "timestamp": T.TimestampType(), "decimal(5,2)": T.DecimalType(5, 2), "decimal(5,4)": T.DecimalType(5, 4),
    "decimal(22,15)": T.DecimalType(22, 15),
}


def _table(columns: str) -> T.StructType:
    """Schema from "name type" pairs; ``!`` marks columns that must not be NULL."""
    fields = []
    for column in columns.split("; "):
        name, kind = column.split()
        fields.append(T.StructField(name, _TYPES[kind.rstrip("!")], not kind.endswith("!")))
    return T.StructType(fields)


TABLES = {
    "issuers": _table("iid int!; name string!"),
    "wp_statements": _table(
        "sid bigint!; iid int!; statement_text string!; repeats int!; topic string!; source string!; "
        "pinnochios int!; s_date date!; statement_hash string!; wc int"
    ),
    "fbase_transcripts": _table(
        "tid string!; t_date date!; transcript_type string!; transcript_url string!; transcript_sent decimal(5,2)"
    ),
    "fbase_statements": _table("tid string!; sid int!; statement_text string!; sentiment decimal(5,2); wc int"),
    "dcbot_tweets": _table(
        "thread_id bigint!; end_thread_tweet_id bigint!; statement_text string!; t_start_date timestamp!; "
        "t_end_date timestamp!; retweet int!; statement_hash string!; wc int"
    ),
    "pt_converged_truths": _table("statement_text string!; stype int!; sdate date!"),
    "all_truth_statements_tmp": _table("truth_id string; stext string; stype int; sdate timestamp; swc int"),
    "ds_metadata": _table(
        "dsid string!; ds_type string!; train_start_date date!; train_end_date date!; val_start_date date!; "
        "val_end_date date!; test_start_date date!; test_end_date date!"
    ),
    "model_analysis_rpts": _table(
        "model_version string!; dsid string!; report_type string!; statement_id bigint!; statement_text string!; "
        "stype int!; sdate timestamp!; label int!; prediction int!; raw_pred decimal(5,4)!; "
        "tp int; fp int; tn int; fn int"
    ),
    "false_truth_del_cands": _table("falsehood_id bigint!; truth_id string!; l2dist decimal(22,15)!"),
    "base_false_truth_del_cands": _table("falsehood_id bigint!; truth_id string!; l2dist decimal(22,15)!"),
    "model_metadata": _table(
        "model_version string!; dsid string!; "
        + "; ".join(
            f"{kind}_{metric} decimal(5,2)!"
            for kind in ("nontweet", "tweet", "all")
            for metric in ("acc", "auc", "mcc", "tp_ratio", "tn_ratio", "fp_ratio", "fn_ratio")
        )
    ),
    "local_model_perf_summary_hist": _table(
        "model_version string!; dsid string!; stmt_type int!; bucket_num int!; max_confidence decimal(5,4)!; "
        + "; ".join(
            f"{metric} decimal(5,4)!"
            for metric in ("bucket_acc", "ppv", "npv", "ppr", "npr", "tp_ratio", "tn_ratio", "fp_ratio", "fn_ratio")
        )
    ),
    "infsvc_stmts_published": _table(
        "dc_tid bigint!; model_version string!; iid int!; tid string!; sid int!; prediction int!; "
        "raw_pred decimal(5,4)!; raw_confidence decimal(5,4)!; p_date timestamp!; actual_label int; "
        "score_date timestamp"
    ),
    "infsvc_tweets_published": _table(
        "dc_tid bigint!; model_version string!; iid int!; thread_id bigint!; prediction int!; "
        "raw_pred decimal(5,4)!; raw_confidence decimal(5,4)!; p_date timestamp!; actual_label int; "
        "score_date timestamp"
    ),
    "stmts_analyzed_published": _table(
        "dc_tid bigint!; tid string!; sid int!; arc_report_name string!; media_id bigint!; t_date timestamp!"
    ),
    "tweets_analyzed_published": _table(
        "dc_tid bigint!; thread_id bigint!; arc_report_name string!; media_id bigint!; t_date timestamp!"
    ),
    "stmts_analyzed_notpublished": _table("tid string!; sid int!; arc_report_name string!; t_date timestamp!"),
    "tweets_analyzed_notpublished": _table("thread_id bigint!; arc_report_name string!; t_date timestamp!"),
}

# Keys by which an append skips rows that are already there.
KEYS = {
    "issuers": ("iid",),
    "wp_statements": ("statement_hash", "iid", "s_date"),
    "fbase_transcripts": ("tid",),
    "fbase_statements": ("tid", "sid"),
    "dcbot_tweets": ("statement_hash", "t_end_date"),
    "ds_metadata": ("dsid",),
    "model_analysis_rpts": ("model_version", "dsid", "report_type", "statement_id"),
    "model_metadata": ("model_version",),
    "local_model_perf_summary_hist": ("model_version", "dsid", "stmt_type", "bucket_num"),
    "infsvc_stmts_published": ("dc_tid",),
    "infsvc_tweets_published": ("dc_tid",),
    "stmts_analyzed_published": ("dc_tid",),
    "tweets_analyzed_published": ("dc_tid",),
}
