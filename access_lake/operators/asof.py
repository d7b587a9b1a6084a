"""The state of a history at many times at once (SCD-5, SCD-7).

Asking for one time is a filter; asking for a table of times (month ends,
census loads) is an interval join: version ``[valid_from, valid_to)`` meets
every time inside it. Written as a range condition it would run as a nested
loop over all versions and times. Here time is cut into buckets of equal
width, about one asked time each; a version is filed under the buckets that
it overlaps, a time under its own, and an equality join on the bucket with
the range as a residual condition gives the pairs.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_lake.functions.text import ColumnLike, col


def _seconds(a: Column, b: Column) -> Column:
    """Whole seconds from ``a`` to ``b``, without any time zone."""
    return (b - a).cast("interval second").cast("bigint")


def as_of_many(history: DataFrame, times: DataFrame, at: str = "at") -> DataFrame:
    """(``at``, the history's columns): the versions valid at each distinct
    non-null time of ``times``.

    Three scalars of the times (first, last, how many) set the bucket width,
    so that buckets and times are about equally many and a version is filed
    under about as many buckets as it has result rows. Versions outside the
    asked span are filtered before the join. The output is as large as the
    answer (versions times the times they cover); aggregate it by area for
    counts (:func:`counts_as_of`), which combines map-side.
    """
    asked = times.select(F.col(at).cast("timestamp_ntz").alias(at)).filter(F.col(at).isNotNull()).distinct()
    span = asked.agg(F.min(at).alias("lo"), F.max(at).alias("hi"), F.count(F.lit(1)).alias("n"),
                     _seconds(F.min(at), F.max(at)).alias("seconds")).first()
    if not span["n"]:
        return history.limit(0).select(F.lit(None).cast("timestamp_ntz").alias(at), *history.columns)
    width = max(1, -(-(span["seconds"] + 1) // span["n"]))
    lo, hi = (F.lit(str(span[c])).cast("timestamp_ntz") for c in ("lo", "hi"))

    def bucket(c: Column) -> Column:
        return F.floor(_seconds(lo, c) / F.lit(width)).cast("int")

    from_, to = F.col("valid_from"), F.col("valid_to")
    covering = history.filter((from_ <= hi) & (to.isNull() | (to > lo)))
    filed = covering.withColumn("_bucket", F.explode(F.sequence(bucket(F.greatest(from_, lo)), bucket(F.least(F.coalesce(to, hi), hi)))))
    asked = asked.withColumn("_bucket", bucket(F.col(at)))
    inside = (F.col(at) >= from_) & (to.isNull() | (F.col(at) < to))
    return filed.join(asked, "_bucket").filter(inside).select(at, *history.columns)


def counts_as_of(history: DataFrame, times: DataFrame, by: Sequence[ColumnLike], at: str = "at", out: str = "open_count") -> DataFrame:
    """Open versions per time and group, for all groups in one pass."""
    keys = [col(c) for c in by]
    return as_of_many(history, times, at).groupBy(at, *keys).agg(F.count(F.lit(1)).alias(out))
