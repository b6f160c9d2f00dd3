"""Report slices: which model, which data set, which dates, which week."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GROUND_TRUTH = "model_rpt_gt"
CONVERGED = "converged_filtered"
TWEET, NONTWEET = 1, 0


def latest_version(reports: DataFrame, report_type: str = GROUND_TRUTH) -> Column:
    """Scalar: the largest model version (by string order) with a report of this type."""
    return reports.where(F.col("report_type") == report_type).agg(F.max("model_version")).scalar()


def newest_dataset(ds_metadata: DataFrame, ds_type: str = CONVERGED) -> Column:
    """Scalar struct: the metadata row with the largest dsid of this type."""
    row = F.struct(*ds_metadata.columns)
    return ds_metadata.where(F.col("ds_type") == ds_type).agg(F.max_by(row, "dsid")).scalar()


def of_kind(df: DataFrame, stype: int | None) -> DataFrame:
    return df if stype is None else df.where(F.col("stype") == stype)


def latest_reports(reports: DataFrame, stype: int | None = None, report_type: str = GROUND_TRUTH) -> DataFrame:
    """Report rows of the latest model, over the whole period."""
    rows = reports.where(
        (F.col("report_type") == report_type) & (F.col("model_version") == latest_version(reports, report_type))
    )
    return of_kind(rows, stype)


def test_rows(
    reports: DataFrame,
    ds_metadata: DataFrame,
    stype: int | None = None,
    report_type: str = GROUND_TRUTH,
    ds_type: str = CONVERGED,
) -> DataFrame:
    """Report rows of the latest model inside the test dates of the newest data set.

    A date bound means midnight, so later hours of the last day are outside.
    """
    ds = newest_dataset(ds_metadata, ds_type)
    sdate = F.col("sdate")
    inside = (sdate >= ds["test_start_date"].cast("timestamp")) & (sdate <= ds["test_end_date"].cast("timestamp"))
    return latest_reports(reports, stype, report_type).where(inside)


def week_start(day: Column) -> Column:
    """The Sunday on or before a date."""
    day = day.cast("date")
    return F.date_sub(day, F.dayofweek(day) - 1)
