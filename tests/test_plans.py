"""Shape of physical plans: what may not appear at scale."""

import re

import pytest

import __spark_entry__ as entry

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: plan_of(build(spark, SF_DIR)) for name, build in entry.queries().items()}


def test_no_cartesian_product(plans):
    assert [n for n, p in plans.items() if "CartesianProduct" in p] == []


def test_no_nested_loop_join(plans):
    assert [n for n, p in plans.items() if "BroadcastNestedLoopJoin" in p] == []


def test_no_row_at_a_time_python(plans):
    assert [n for n, p in plans.items() if "BatchEvalPython" in p] == []


def test_single_partition_only_above_aggregates(plans):
    """A window over one partition must sit on an aggregate (a histogram)."""
    for name, plan in plans.items():
        lines = plan.splitlines()
        for i, line in enumerate(lines):
            if "Exchange SinglePartition" not in line:
                continue
            below = " ".join(lines[i + 1 : i + 12])
            assert re.search(r"HashAggregate|SortAggregate|ObjectHashAggregate|Limit", below), (name, line)


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(entry.queries()["e02_all_current_mcc"](spark, SF_DIR))
    assert "o_totalprice" not in plan and "o_orderpriority" not in plan


def test_no_row_format_checkpoint(plans):
    """What is stored is a table: ``Scan ExistingRDD`` would read every column."""
    assert [n for n, p in plans.items() if "Scan ExistingRDD" in p and not n.startswith(("op", "pipeline"))] == []


def test_snapshot_reads_one_column(spark):
    plan = plan_of(entry.queries()["d07_target_distribution"](spark, SF_DIR))
    scans = [line for line in plan.splitlines() if "FileScan parquet" in line and "/table-" in line]
    assert scans and not any("statement_text" in line for line in scans)


def test_no_text_sort_under_word_counts(spark):
    assert "rangepartitioning" not in plan_of(entry.queries()["n01_word_counts"](spark, SF_DIR))


def test_late_labels_cut_pairs_first(spark):
    plan = plan_of(entry.queries()["l01_scored_false_statements"](spark, SF_DIR))
    assert "LeftSemi" in plan
