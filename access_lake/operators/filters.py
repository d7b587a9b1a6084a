"""Row filters and projections of staging and marts (FLT-1..8, PRJ-3..4)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_lake.functions.text import eq_ci


def keep_status(df: DataFrame, col: str, value: str) -> DataFrame:
    """Case-insensitive status filter (FLT-1)."""
    return df.filter(eq_ci(col, value))


def require_not_null(df: DataFrame, *cols: str) -> DataFrame:
    """NOT NULL filters; blanks pass (FLT-2). Pushed to the Parquet scan."""
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return df.filter(cond)


def positive(df: DataFrame, col: str) -> DataFrame:
    """Strictly positive values (FLT-3)."""
    return df.filter(F.col(col) > 0)


def drill_down(df: DataFrame, area_col: str, value: str) -> DataFrame:
    """Rows of one area, compared lower-cased (FLT-5)."""
    return df.filter(F.lower(F.col(area_col)) == value.lower())


def non_blank(df: DataFrame, col: str) -> DataFrame:
    """Non-empty text (FLT-6); NULL is dropped too."""
    return df.filter(F.col(col) != "")


def having(grouped: DataFrame, cond: Column | str) -> DataFrame:
    """A filter on aggregated rows (FLT-8)."""
    return grouped.filter(cond)


def keep(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column subset, e.g. dropping helper columns (PRJ-3)."""
    return df.select(*cols)


def with_all(df: DataFrame, **new_cols: Column) -> DataFrame:
    """Every column plus computed ones (PRJ-4)."""
    return df.select("*", *[c.alias(n) for n, c in new_cols.items()])
