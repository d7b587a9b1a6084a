"""Slowly changing dimension type 2 and history queries (SCD-1..10).

Version columns: ``valid_from``, ``valid_to`` (NULL = current),
``is_deleted`` (closed because the key left the source), ``scd_id`` =
md5(key|valid_from) and ``updated_at`` = ``valid_from``.

Scale notes. Windows run by key: a key holds at most one row per snapshot
date (snapshots are deduplicated per key and date first, with a two-phase
``WindowGroupLimit``), so a window partition is bounded by the number of
snapshot runs, not by the data. Every window looks one row back or ahead, so
the work is linear in a key's rows.
"""

from __future__ import annotations

from datetime import datetime
from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

VERSION_COLUMNS = ["valid_from", "valid_to", "is_deleted", "scd_id", "updated_at"]


def _scd_id(key: str, at: Column) -> Column:
    return F.md5(F.concat_ws("|", F.col(key).cast("string"), at.cast("string")))


def _differs(pairs: Sequence[tuple[Column, Column]]) -> Column:
    """Any pair differs, NULL-safe."""
    return reduce(lambda a, b: a | b, [~a.eqNullSafe(b) for a, b in pairs])


def snapshot_calendar(snapshots: DataFrame, at: str) -> DataFrame:
    """Distinct snapshot times with their ordinal and the next time. One
    row per snapshot run, so the single-partition window is over a small,
    bounded set."""
    w = Window.orderBy(at)
    return (snapshots.select(at).distinct()
                     .withColumn("_ord", F.row_number().over(w))
                     .withColumn("_next_at", F.lead(at).over(w)))


def scd2_from_snapshots(snapshots: DataFrame, key: str, at: str,
                        check_cols: Sequence[str], times: DataFrame | None = None) -> DataFrame:
    """Build the whole history from many full snapshots in one job (SCD-3).

    A version starts where a key first appears, reappears after missing a
    snapshot, or any check column changes; it ends at the next snapshot
    after its last row (NULL when that row is in the latest snapshot).
    Same semantics as applying :func:`scd2_apply` snapshot by snapshot.

    Input contract: at most one row per (key, snapshot time), as a full
    snapshot has (deduplicate with :func:`latest_per_key` first otherwise).
    ``times`` (column ``at``) may give the snapshot times from a cheaper
    source than the snapshots; without it they are read from the snapshots.
    """
    rows = snapshots.join(snapshot_calendar(snapshots if times is None else times, at), at)
    w = Window.partitionBy(key).orderBy(at)
    prev_ord, next_ord = F.lag("_ord").over(w), F.lead("_ord").over(w)
    changed = _differs([(F.lag(c).over(w), F.col(c)) for c in check_cols])
    rows = (rows.withColumn("_prev_ord", prev_ord)
                .withColumn("_next_ord", next_ord)
                .withColumn("_start", F.col("_prev_ord").isNull()
                            | (F.col("_prev_ord") != F.col("_ord") - 1) | changed))
    gap_after = F.col("_next_ord").isNull() | (F.col("_next_ord") != F.col("_ord") + 1)
    rows = rows.withColumn("_end", gap_after | F.coalesce(F.lead("_start").over(w), F.lit(True)))
    # of a version only its first and last row matter: where they differ,
    # the last one is the next row that is kept
    end = F.struct(F.col("_next_at").alias("valid_to"),
                   (F.col("_next_at").isNotNull() & gap_after).alias("is_deleted"))
    rows = rows.withColumn("_close", end).filter(F.col("_start") | F.col("_end"))
    rows = rows.withColumn("_close", F.when(F.col("_end"), F.col("_close")).otherwise(F.lead("_close").over(w)))
    data_cols = [c for c in snapshots.columns if c != at]
    return (rows.filter("_start")
                .select(*data_cols,
                        F.col(at).alias("valid_from"),
                        F.col("_close.valid_to").alias("valid_to"),
                        F.col("_close.is_deleted").alias("is_deleted"),
                        _scd_id(key, F.col(at)).alias("scd_id"),
                        F.col(at).alias("updated_at")))


def scd2_apply(history: DataFrame, snapshot: DataFrame, key: str,
               check_cols: Sequence[str], run_ts: str | datetime) -> DataFrame:
    """Apply one full snapshot to a history (SCD-1, SCD-2).

    New key → open a version; a change in any check column (NULL-safe) →
    close the open version and open a new one; key missing → close it as
    deleted; unchanged → keep. Closed versions pass through untouched, and
    the open versions meet the snapshot in one full outer join whose rows
    each yield up to two output rows, so the join runs once. The result is
    a new DataFrame: write it to a new location, then publish it. A history
    that already has versions from after ``run_ts`` is refused row by row
    (``raise_error``): closing them would end a version before its start.
    """
    ts = F.lit(str(run_ts)).cast("timestamp_ntz")
    data_cols = [c for c in history.columns if c not in VERSION_COLUMNS]
    late = F.raise_error(F.concat(F.lit(f"the history is newer than the run of {run_ts}: "),
                                  F.col("valid_from").cast("string"))).cast("timestamp_ntz")
    history = history.withColumn("valid_from", F.when(F.col("valid_from") > ts, late).otherwise(F.col("valid_from")))
    closed = history.filter(F.col("valid_to").isNotNull())
    open_ = history.filter(F.col("valid_to").isNull())
    h = open_.select(*[F.col(c).alias(f"h_{c}") for c in history.columns], F.lit(True).alias("_in_h"))
    s = snapshot.select(*[F.col(c).alias(f"s_{c}") for c in data_cols], F.lit(True).alias("_in_s"))
    j = h.join(s, F.col(f"h_{key}") == F.col(f"s_{key}"), "full_outer")
    in_h = F.coalesce(F.col("_in_h"), F.lit(False))
    in_s = F.coalesce(F.col("_in_s"), F.lit(False))
    changed = in_h & in_s & _differs([(F.col(f"h_{c}"), F.col(f"s_{c}")) for c in check_cols])
    fields = data_cols + VERSION_COLUMNS
    old = F.when(in_h, F.struct(
        *[F.col(f"h_{c}").alias(c) for c in data_cols],
        F.col("h_valid_from").alias("valid_from"),
        F.when(~in_s | changed, ts).alias("valid_to"),
        (~in_s).alias("is_deleted"),
        F.col("h_scd_id").alias("scd_id"),
        F.col("h_updated_at").alias("updated_at")))
    new = F.when(in_s & (~in_h | changed), F.struct(
        *[F.col(f"s_{c}").alias(c) for c in data_cols],
        ts.alias("valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("valid_to"),
        F.lit(False).alias("is_deleted"),
        F.md5(F.concat_ws("|", F.col(f"s_{key}").cast("string"), ts.cast("string"))).alias("scd_id"),
        ts.alias("updated_at")))
    touched = (j.select(F.explode(F.array(old, new)).alias("_v"))
                .filter(F.col("_v").isNotNull())
                .select(*[F.col(f"_v.{c}").alias(c) for c in fields]))
    return closed.select(*fields).unionByName(touched)


def current(history: DataFrame) -> DataFrame:
    """Open versions (SCD-4)."""
    return history.filter(F.col("valid_to").isNull())


def as_of(history: DataFrame, t: str | datetime) -> DataFrame:
    """Versions valid at ``t`` (SCD-5)."""
    ts = F.lit(str(t)).cast("timestamp_ntz")
    return history.filter((F.col("valid_from") <= ts)
                          & (F.col("valid_to").isNull() | (ts < F.col("valid_to"))))


def _with_previous(history: DataFrame, key: str, col: str) -> DataFrame:
    """Each version but a key's first, with the value of ``col`` in the
    key's version before it, also across a gap in which the key was away."""
    w = Window.partitionBy(key).orderBy("valid_from")
    return (history.withColumn(f"prev_{col}", F.lag(col).over(w))
                   .withColumn("_before", F.lag("valid_from").over(w))
                   .filter(F.col("_before").isNotNull()).drop("_before"))


def flag_transitions(history: DataFrame, key: str, flag: str, start: str, end: str) -> DataFrame:
    """Keys that gained or lost ``flag`` with a version starting in
    ``[start, end]`` (SCD-6). A NULL flag counts as false, so turning from
    NULL to false or back is neither."""
    s, e = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    j = _with_previous(history, key, flag)
    return (j.filter((F.col("valid_from") >= s) & (F.col("valid_from") <= e)
                     & (F.coalesce(F.col(f"prev_{flag}"), F.lit(False)) != F.coalesce(F.col(flag), F.lit(False))))
             .select(key, F.col("valid_from").alias("changed_at"), F.col(f"prev_{flag}"), F.col(flag),
                     F.when(F.col(flag), F.lit("gained")).otherwise(F.lit("lost")).alias("change")))


def type_transitions(history: DataFrame, key: str, col: str, from_value: str, to_value: str) -> DataFrame:
    """Versions where ``col`` went from ``from_value`` to ``to_value``, e.g.
    an upgrade from one facility type to another (SCD-10)."""
    j = _with_previous(history, key, col)
    return (j.filter((F.col(f"prev_{col}") == from_value) & (F.col(col) == to_value))
             .select(key, F.col("valid_from").alias("changed_at"), F.col(f"prev_{col}"), F.col(col)))


def first_seen(history: DataFrame, key: str) -> DataFrame:
    """First time each key appeared (SCD-9)."""
    return history.groupBy(key).agg(F.min("valid_from").alias("first_seen"))


def count_over_time(history: DataFrame, area_col: str, area_value: str) -> DataFrame:
    """Number of open versions in one area at every history change time
    (SCD-7): +1 at each version start, −1 at each end, summed per time and
    accumulated over the time axis. No range join: the per-time deltas are
    aggregated first, and the running sum runs over distinct change times."""
    in_area = history.filter(F.col(area_col) == area_value)
    deltas = (in_area.select(F.col("valid_from").alias("changed_at"), F.lit(1).alias("d"))
                     .unionByName(in_area.filter(F.col("valid_to").isNotNull())
                                         .select(F.col("valid_to").alias("changed_at"), F.lit(-1).alias("d")))
                     .groupBy("changed_at").agg(F.sum("d").alias("d")))
    spine = (history.select(F.col("valid_from").alias("changed_at"))
                    .unionByName(history.filter(F.col("valid_to").isNotNull())
                                        .select(F.col("valid_to").alias("changed_at")))
                    .distinct())
    w = Window.orderBy("changed_at").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (spine.join(deltas, "changed_at", "left")
                 .select("changed_at",
                         F.sum(F.coalesce("d", F.lit(0))).over(w).cast("bigint").alias("open_count")))


def net_change(history: DataFrame, area_col: str, start: str, end: str) -> DataFrame:
    """Per area: open versions at ``start`` and at ``end`` and the net
    change, largest gain first (SCD-8)."""
    a = as_of(history, start).groupBy(area_col).agg(F.count(F.lit(1)).alias("count_start"))
    b = as_of(history, end).groupBy(area_col).agg(F.count(F.lit(1)).alias("count_end"))
    j = a.join(b, area_col, "full_outer").fillna(0, subset=["count_start", "count_end"])
    return (j.withColumn("net_change", F.col("count_end") - F.col("count_start"))
             .orderBy(F.desc("net_change"), F.asc(area_col)))


def scd2_facilities(history: DataFrame | None, fac: DataFrame, run_ts: str | datetime,
                    key: str | None = None, check_cols: Sequence[str] | None = None) -> DataFrame:
    """The product's facility history step (MDL-8): the staging columns
    versioned on the facility id over the 12 check columns. With no history
    yet the snapshot opens one version per facility."""
    from access_lake.functions import fixed
    key = key or fixed.HISTORY_KEY
    check_cols = list(check_cols or fixed.HISTORY_CHECK_COLUMNS)
    if history is None:
        snap = fac.withColumn("_at", F.lit(str(run_ts)).cast("timestamp_ntz"))
        return scd2_from_snapshots(snap, key, "_at", check_cols)
    return scd2_apply(history, fac, key, check_cols, run_ts)
