"""Area marts from changes (AGG-1..7, MDL-4..6).

A month changes few facilities, and every count of the area profile is a
sum over facilities, so it can be taken back: the profile of a month is the
last one, plus the counts of the versions that the month opened, minus those
of the versions that it closed. The facilities that did not change are not
read. Density, gaps and the ranking follow from the profile, one row an area.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_lake.operators.history_log import HistoryLog
from access_lake.plans.marts import area_profile

AREA = "county_name"


def profile_after(profile: DataFrame | None, opened: DataFrame, closed: DataFrame) -> DataFrame:
    """The area profile after a month's changes: ``opened`` and ``closed``
    hold the data columns of the versions that started and that ended.
    Areas without a facility left go, as in a full rebuild."""
    plus, minus = area_profile(opened), area_profile(closed)
    counts = [c for c in plus.columns if c != AREA]
    parts = plus.unionByName(minus.select(AREA, *[(-F.col(c)).alias(c) for c in counts]))
    if profile is not None:
        parts = profile.select(AREA, *counts).unionByName(parts)
    total = parts.groupBy(AREA).agg(*[F.sum(c).cast("bigint").alias(c) for c in counts])
    return total.filter(F.col("total_facilities") != 0)


def step(log: HistoryLog, profile: DataFrame | None, snapshot: DataFrame, run_ts: datetime) -> DataFrame:
    """Apply a month's snapshot to the history log and bring the profile
    along; write the result before the next step reads it."""
    log.apply(snapshot, run_ts)
    opened, closed = log.changed_rows(run_ts)
    return profile_after(profile, opened, closed)
