"""Predicates on the ``TIMEID`` key, written so that they reach the scan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from cardlens.schemas import MONTH_COLUMN


def _has_month(df: DataFrame) -> bool:
    """Whether the table has month partitions, read as text; as numbers they do not order like keys."""
    return (MONTH_COLUMN, "string") in df.dtypes


def in_month(df: DataFrame, yyyymm: str) -> Column:
    """Rows of one month: a prefix test the scan understands, and the partition where there is one."""
    match = F.col("TIMEID").startswith(yyyymm)
    return (F.col(MONTH_COLUMN) == yyyymm) & match if _has_month(df) else match


def in_range(df: DataFrame, start: str, end: str) -> Column:
    """Inclusive string range. The month partitions of the range follow from its bounds' prefixes."""
    match = F.col("TIMEID").between(start, end)
    return F.col(MONTH_COLUMN).between(start[:6], end[:6]) & match if _has_month(df) else match
