"""Ranks and ordered reports (WIN-2..5, SRT-1..4)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.functions.text import ColumnLike, col
from access_lake.session import work_dir

# input bytes per range of a global row number, and its least rows
RANGE_BYTES = 256 << 20
RANGE_ROWS = 100_000


def rank_by(df: DataFrame, order: Sequence[Column], out: str,
            partition_by: Sequence[ColumnLike] = ()) -> DataFrame:
    """``row_number()`` under a total order, as bigint (WIN-2..4).

    Without ``partition_by`` the window runs in one partition: used only on
    aggregated grain (one row per area), where the row count is the number
    of areas. Use :func:`global_row_number` at row grain.
    """
    w = Window.orderBy(*order)
    if partition_by:
        w = Window.partitionBy(*[col(p) for p in partition_by]).orderBy(*order)
    return df.withColumn(out, F.row_number().over(w).cast("bigint"))


def _ranges(n_rows: int, n_bytes: int, parallel: int) -> int:
    """Ranges for a counted size: one per ``RANGE_BYTES``, as many as run
    at a time, but none of fewer than ``RANGE_ROWS`` rows (plus one)."""
    return min(max(-(-n_bytes // RANGE_BYTES), parallel), n_rows // RANGE_ROWS + 1)


def global_row_number(df: DataFrame, order: Sequence[Column], out: str = "row_number",
                      num_partitions: int | None = None, staged: bool = True) -> DataFrame:
    """Row number over the whole table without a single-partition window
    (WIN-5).

    The input is written once to the shared folder, which counts its rows
    and bytes on the way, so however many joins it stands for run once and
    the number of ranges comes from a counted size, never from the plan's
    estimate. A plain table scan may skip that with ``staged=False``; its
    rows are then counted from the file footers.

    Rows are range-partitioned on ``order`` by quantiles of a sample of the
    (column-pruned) order key and sorted inside each range; the sorted
    layout, with each row's range and place, is written as Parquet, so a
    lost executor cannot re-sample different bounds. The counts of the
    ranges (at most rows / ``RANGE_ROWS`` + 1 of them) give each range its
    offset, and the number is offset + position. ``order`` must be a total
    order for the numbering to be unique.
    """
    spark = df.sparkSession
    parallel = spark.sparkContext.defaultParallelism
    if num_partitions:
        n = num_partitions
    elif staged:
        source, size = work_dir(spark, "row-number-input"), Observation("row_number_input")
        width = F.length(F.to_csv(F.struct(*[F.col(f"`{f.name}`") for f in df.schema.fields if _flat(f.dataType)])))
        df.observe(size, F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(width), F.lit(0)).alias("bytes")).write.parquet(source)
        df = spark.read.schema(df.schema).parquet(source)
        n = _ranges(size.get["n"], size.get["bytes"], parallel)
    else:
        rows = df.count()
        n = _ranges(rows, rows * 8 * len(df.columns), parallel)
    path = work_dir(spark, "row-number")
    (df.repartitionByRange(n, *order)
       .sortWithinPartitions(*order)
       .withColumn("_pid", F.spark_partition_id())
       .withColumn("_mid", F.monotonically_increasing_id())
       .write.parquet(path))
    laid = spark.read.parquet(path)
    counts = laid.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_pid",
        (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)))
        .alias("_off"))
    offsets = offsets.fillna(0, subset=["_off"])
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (laid.join(F.broadcast(offsets), "_pid")
                .withColumn(out, (F.col("_off") + local + 1).cast("bigint"))
                .drop("_pid", "_mid", "_off"))


def _flat(t: T.DataType) -> bool:
    return not isinstance(t, (T.ArrayType, T.MapType, T.StructType, T.BinaryType, T.VariantType))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """First ``k`` rows under ``order`` (SRT-4): plans as
    ``TakeOrderedAndProject``, a per-partition top-k then a merge."""
    return df.orderBy(*order).limit(k)


def ranked(df: DataFrame, rank_col: str = "underserved_rank") -> DataFrame:
    """Worst first by an existing rank (SRT-1)."""
    return df.orderBy(F.asc_nulls_last(rank_col))


def by_name(df: DataFrame, name_col: str = "county_name") -> DataFrame:
    """Alphabetical (SRT-2)."""
    return df.orderBy(F.asc_nulls_last(name_col))


def worst_first(df: DataFrame, metric: str, name_col: str | None = None) -> DataFrame:
    """Lowest metric first, NULLs last, then name (SRT-3)."""
    order = [F.asc_nulls_last(metric)] + ([F.asc_nulls_last(name_col)] if name_col else [])
    return df.orderBy(*order)
