"""Flags, confidence and rounding for classifier scores."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flag(condition: Column) -> Column:
    """1 when true, 0 when false or NULL."""
    return F.when(condition, 1).otherwise(0)


def confusion_flags(label: str = "label", prediction: str = "prediction") -> dict[str, Column]:
    """The four generated columns; 1 is the falsehood class."""
    actual, said = F.col(label), F.col(prediction)
    return {
        "tp": flag((actual == 1) & (said == 1)),
        "fp": flag((actual == 0) & (said == 1)),
        "tn": flag((actual == 0) & (said == 0)),
        "fn": flag((actual == 1) & (said == 0)),
    }


def is_correct(label: str = "label", prediction: str = "prediction") -> Column:
    return flag(F.col(label) == F.col(prediction))


def confidence(raw_pred: str = "raw_pred") -> Column:
    """Distance of the score from the far end, always at least one half."""
    raw = F.col(raw_pred)
    return F.when(raw >= 0.5, raw).otherwise((1 - raw).cast("decimal(5,4)")).cast("decimal(5,4)")


def rounded(x: Column, digits: int) -> Column:
    """Half-up rounding in decimal arithmetic, so 0.0005 does not depend on its binary form."""
    return F.round(x.cast("decimal(30,12)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """Double division, NULL when the whole is zero."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def mcc(tp: Column, tn: Column, fp: Column, fn: Column) -> Column:
    """Matthews correlation; in double because four counts multiplied overflow a long."""
    tp, tn, fp, fn = (c.cast("double") for c in (tp, tn, fp, fn))
    return F.try_divide(tp * tn - fp * fn, F.sqrt((tp + fp) * (tp + fn) * (tn + fp) * (tn + fn)))
