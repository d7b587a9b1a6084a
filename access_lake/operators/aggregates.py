"""Grouped counts, pivots, weighted sums and totals (AGG-1..11).

All are plain ``groupBy().agg()``: Spark plans a partial aggregate before
the shuffle and a final one after it, so a hot area is combined map-side.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.numeric import count_if
from access_lake.functions.text import ColumnLike, col
from access_lake.operators.filters import having

# default output names of the flag counts
SERVICE_COUNT_NAMES = {
    "maternity_count": "has_maternity",
    "art_count": "has_art",
    "tb_count": "has_tb",
    "emergency_count": "has_emergency",
}
TYPE_COUNT_NAMES = {
    "hospital_count": "Hospital",
    "health_centre_count": "Health Centre",
    "dispensary_count": "Dispensary",
    "clinic_count": "Clinic",
}


def flag_counts(flags: Mapping[str, str]) -> list[Column]:
    """``sum(case when flag then 1 else 0 end)`` per output name."""
    return [count_if(F.col(flag)).alias(out) for out, flag in flags.items()]


def pivot_counts(type_col: ColumnLike, labels: Mapping[str, str],
                 count_col: ColumnLike | None = None) -> list[Column]:
    """One column per type label (AGG-3). With ``count_col`` the partial
    counts are summed, otherwise rows are counted."""
    t = col(type_col)
    if count_col is None:
        return [count_if(t == label).alias(out) for out, label in labels.items()]
    return [F.sum(F.when(t == label, col(count_col)).otherwise(F.lit(0))).cast("bigint").alias(out)
            for out, label in labels.items()]


def weight_of(type_col: ColumnLike, weights: Mapping[str, int] = fixed.TYPE_WEIGHTS,
              default: int = fixed.TYPE_WEIGHT_DEFAULT) -> Column:
    t = col(type_col)
    out = None
    for label, w in weights.items():
        out = F.when(t == label, F.lit(w)) if out is None else out.when(t == label, F.lit(w))
    return out.otherwise(F.lit(default)) if out is not None else F.lit(default)


def weighted_sum(type_col: ColumnLike, count_col: ColumnLike | None = None,
                 weights: Mapping[str, int] = fixed.TYPE_WEIGHTS,
                 default: int = fixed.TYPE_WEIGHT_DEFAULT, out: str = "weighted_score") -> Column:
    """``sum(n * weight(type))`` (AGG-4); n = 1 per row when no count column."""
    n = F.lit(1) if count_col is None else col(count_col)
    return F.sum(n * weight_of(type_col, weights, default)).cast("bigint").alias(out)


def type_service_counts(df: DataFrame, area: str = "county_name", type_col: str = "facility_type",
                        flags: Mapping[str, str] = SERVICE_COUNT_NAMES) -> DataFrame:
    """Counts per (area, type): total and one per flag (AGG-1)."""
    return df.groupBy(area, type_col).agg(
        F.count(F.lit(1)).alias("facility_count"), *flag_counts(flags))


def roll_up(partial: DataFrame, area: str = "county_name", type_col: str = "facility_type",
            flags: Sequence[str] = tuple(SERVICE_COUNT_NAMES),
            labels: Mapping[str, str] = TYPE_COUNT_NAMES) -> DataFrame:
    """Second level of AGG-1: sums of the partial counts per area, the type
    pivot and the weighted score (AGG-2..4)."""
    return partial.groupBy(area).agg(
        F.sum("facility_count").cast("bigint").alias("total_facilities"),
        *[F.sum(f).cast("bigint").alias(f) for f in flags],
        *pivot_counts(type_col, labels, "facility_count"),
        weighted_sum(type_col, "facility_count"))


def service_counts(df: DataFrame, area: str = "county_name",
                   flags: Mapping[str, str] | None = None) -> DataFrame:
    """Total and per-flag counts per area (AGG-5)."""
    flags = flags or {**SERVICE_COUNT_NAMES, "outpatient_count": "has_outpatient"}
    return df.groupBy(area).agg(F.count(F.lit(1)).alias("total_facilities"), *flag_counts(flags))


def total_rows(df: DataFrame, area: str = "county_name", sub: str = "sub_county_name") -> DataFrame:
    """Rows that hold an area's total: blank sub-area or sub-area equal to
    the area; NULL sub-area is dropped (FLT-4)."""
    return df.filter((F.col(sub) == "") | (F.lower(F.col(sub)) == F.lower(F.col(area))))


def population_totals(df: DataFrame, area: str = "county_name", sub: str = "sub_county_name",
                      value: str = "population", out: str = "total_population") -> DataFrame:
    """Population per area over its total rows (AGG-6)."""
    return total_rows(df, area, sub).groupBy(area).agg(F.sum(value).cast("bigint").alias(out))


def subarea_counts(df: DataFrame, sub: str = "sub_county_name", type_col: str = "facility_type",
                   flags: Mapping[str, str] = SERVICE_COUNT_NAMES,
                   labels: Mapping[str, str] = TYPE_COUNT_NAMES) -> DataFrame:
    """Counts per sub-area: total, flags and types in one pass (AGG-7)."""
    return df.groupBy(sub).agg(F.count(F.lit(1)).alias("total_facilities"),
                               *flag_counts(flags), *pivot_counts(type_col, labels))


def duplicate_keys(df: DataFrame, key: str | Sequence[str], out: str = "n") -> DataFrame:
    """Keys present more than once, with their count (AGG-8, DQ-5)."""
    keys = [key] if isinstance(key, str) else list(key)
    return having(df.groupBy(*keys).agg(F.count(F.lit(1)).alias(out)), F.col(out) > 1)


def avg_by(df: DataFrame, area: str, metrics: Sequence[str] | str,
           names: Sequence[str] | None = None) -> DataFrame:
    """Average of mart metrics per area (AGG-10)."""
    metrics = [metrics] if isinstance(metrics, str) else list(metrics)
    names = list(names) if names else [f"avg_{m}" for m in metrics]
    return df.groupBy(area).agg(*[F.avg(m).alias(n) for m, n in zip(metrics, names)])


def pivot_types(df: DataFrame, area: str = "county_name", type_col: str = "facility_type",
                labels: Mapping[str, str] = TYPE_COUNT_NAMES) -> DataFrame:
    """One count column per type label and area (AGG-3): conditional sums,
    so the output columns are fixed even when a type is absent."""
    return df.groupBy(area).agg(*pivot_counts(type_col, labels))


def weighted_score(df: DataFrame, area: str = "county_name", type_col: str = "facility_type",
                   weights: Mapping[str, int] = fixed.TYPE_WEIGHTS,
                   default: int = fixed.TYPE_WEIGHT_DEFAULT) -> DataFrame:
    """Capacity-weighted facility count per area (AGG-4)."""
    return df.groupBy(area).agg(weighted_sum(type_col, None, weights, default))


def row_count_not(df: DataFrame, n: int, out: str = "row_count") -> DataFrame:
    """Global count with HAVING ``!= n`` (AGG-9): one row when it differs."""
    return having(df.agg(F.count(F.lit(1)).alias(out)), F.col(out) != n)
