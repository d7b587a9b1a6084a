"""A late snapshot: insertion into the middle of a version history (SCD-1).

Snapshots do not always arrive in order. A month that is loaded late lies
between two snapshots that the history already knows, so the versions before
and after it must be repaired: one may end earlier, one may start earlier,
one may be split. Each key has at most two versions next to the late time,
the one valid at the snapshot before and the one valid at the snapshot
after, so the repair meets only those with the late snapshot; every other
version passes through.
"""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_lake.operators.history import VERSION_COLUMNS, _differs, _scd_id


def _time(t: str | datetime | None) -> Column:
    return F.lit(None if t is None else str(t)).cast("timestamp_ntz")


def _valid_at(t: Column) -> Column:
    return (F.col("valid_from") <= t) & (F.col("valid_to").isNull() | (t < F.col("valid_to")))


def neighbours(times: Sequence[datetime], at: datetime) -> tuple[datetime | None, datetime | None]:
    """The snapshot times before and after ``at`` among the times that a
    history was built from (one per run, so a short list)."""
    return (max((t for t in times if t < at), default=None),
            min((t for t in times if t > at), default=None))


def scd2_insert(history: DataFrame, snapshot: DataFrame, following: DataFrame | None, key: str, check_cols: Sequence[str],
                at: str | datetime, previous_at: str | datetime | None, next_at: str | datetime | None) -> DataFrame:
    """The history as if the snapshot of time ``at`` had come in its order.

    ``previous_at`` and ``next_at`` are the times of the snapshots around it
    (see :func:`neighbours`; None at an end). ``following`` is the snapshot
    of ``next_at``: where the late snapshot splits a version, the second
    part starts with that snapshot's row, whose unchecked columns the
    history never held. A history that has a snapshot at ``at`` already
    comes out wrong; load that time again from the versions before it.

    The versions next to ``at`` (at most two a key) are grouped by key and
    meet both snapshots, one row a key each; all other versions pass
    through, so the shuffle is as large as the two neighbouring states.
    """
    data = [c for c in history.columns if c not in VERSION_COLUMNS]
    fields = data + VERSION_COLUMNS
    before, now, after = _time(previous_at), _time(at), _time(next_at)
    never = F.lit(False)
    is_p = _valid_at(before) if previous_at is not None else never
    is_q = _valid_at(after) if next_at is not None else never
    version = F.struct(*fields)
    touched = (history.filter(is_p | is_q).groupBy(F.col(key).alias("_key"))
                      .agg(F.first(F.when(is_p, version), ignorenulls=True).alias("p"),
                           F.first(F.when(is_q, version), ignorenulls=True).alias("q")))
    late = snapshot.select(F.col(key).alias("_key"), F.struct(*data).alias("s"))
    rows = touched.join(late, "_key", "full_outer")
    if following is not None and next_at is not None:
        rows = rows.join(following.select(F.col(key).alias("_key"), F.struct(*data).alias("f")), "_key", "left")
    else:
        rows = rows.withColumn("f", F.lit(None).cast(rows.schema["s"].dataType))

    has_p, has_q, has_s = (F.col(c).isNotNull() for c in "pqs")
    same = has_p & has_q & (F.col("p.valid_from") == F.col("q.valid_from"))  # one version spans the late time
    as_p = has_s & has_p & ~_differs([(F.col(f"s.{c}"), F.col(f"p.{c}")) for c in check_cols])
    as_q = has_s & has_q & ~same & ~_differs([(F.col(f"s.{c}"), F.col(f"q.{c}")) for c in check_cols])

    def built(row: str, valid_from: Column, valid_to: Column, is_deleted: Column) -> Column:
        return F.struct(*[F.col(f"{row}.{c}").alias(c) for c in data], valid_from.alias("valid_from"), valid_to.alias("valid_to"),
                        is_deleted.alias("is_deleted"), _scd_id(f"{row}.{key}", valid_from).alias("scd_id"), valid_from.alias("updated_at"))

    closed = F.struct(*[F.col(f"p.{c}").alias(c) for c in data], F.col("p.valid_from").alias("valid_from"), now.alias("valid_to"),
                      (~has_s).alias("is_deleted"), F.col("p.scd_id").alias("scd_id"), F.col("p.updated_at").alias("updated_at"))
    first = F.when(has_p, F.when(as_p, F.col("p")).otherwise(closed))
    # the late row's own version: until the next snapshot, or taking over the version that starts there
    gone = (~has_q) & F.lit(next_at is not None)
    own = F.when(as_q, built("s", now, F.col("q.valid_to"), F.col("q.is_deleted"))).otherwise(built("s", now, after, gone))
    second = F.when(has_s & ~as_p, own)
    split = built("f", after, F.col("p.valid_to"), F.col("p.is_deleted"))
    third = F.when(same, F.when(~as_p, split)).when(has_q & (~as_q | as_p), F.col("q"))
    repaired = (rows.select(F.explode(F.array(first, second, third)).alias("v")).filter(F.col("v").isNotNull())
                    .select(*[F.col(f"v.{c}").alias(c) for c in fields]))
    return history.filter(~(is_p | is_q)).select(*fields).unionByName(repaired)
