"""Latest row per key (WIN-1, FLT-7)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from access_lake.functions.text import ColumnLike, col


def total_order(df: DataFrame, first: Sequence[Column], exclude: Sequence[str] = ()) -> list[Column]:
    """``first`` followed by every other orderable column ascending, NULLs
    last, so ties never make the result depend on the plan."""
    skip = set(exclude)
    rest = [F.asc_nulls_last(f.name) for f in df.schema.fields
            if f.name not in skip and f.dataType.typeName() not in ("map", "struct", "array", "variant")]
    return list(first) + rest


def latest_per_key(df: DataFrame, keys: Sequence[ColumnLike], order: Sequence[Column],
                   tiebreak: Sequence[Column] | None = None) -> DataFrame:
    """Keep the first row per key under ``order`` (e.g. newest
    ``ingested_at``).

    ``row_number() … = 1`` plans as a partial ``WindowGroupLimit`` before
    the shuffle and a final one after it, so each map task ships at most one
    row per key: a key holding a third of all rows costs no more than any
    other key. ``tiebreak`` defaults to every remaining column, which makes
    the survivor deterministic when ``order`` ties.
    """
    key_cols = [col(k) for k in keys]
    key_names = [k for k in keys if isinstance(k, str)]
    if tiebreak is None:
        tiebreak = total_order(df, [], exclude=key_names)
    w = Window.partitionBy(*key_cols).orderBy(*order, *tiebreak)
    return (df.withColumn("_rn", F.row_number().over(w))
              .filter(F.col("_rn") == 1)
              .drop("_rn"))
