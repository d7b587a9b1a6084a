"""Name-key joins and join checks (JON-1..5)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.text import area_key, area_key_geo


def join_by_area(left: DataFrame, right: DataFrame, l_name: str = "county_name",
                 r_name: str = "county_name", how: str = "left", key=area_key) -> DataFrame:
    """Join on a normalised name key derived once per side (JON-1). Both
    sides are per-area aggregates here, so AQE turns the join into a
    broadcast at runtime without a hint."""
    lk = left.withColumn("_area_key", key(F.col(l_name)))
    rk = right.withColumn("_area_key", key(F.col(r_name)))
    if r_name in left.columns:
        rk = rk.drop(r_name)
    return lk.join(rk, "_area_key", how).drop("_area_key")


def join_ci(left: DataFrame, right: DataFrame, l_name: str, r_name: str | None = None,
            how: str = "left") -> DataFrame:
    """Join on ``lower(name)`` (JON-2, JON-3)."""
    r_name = r_name or l_name
    lk = left.withColumn("_ci_key", F.lower(F.col(l_name)))
    rk = right.withColumn("_ci_key", F.lower(F.col(r_name)))
    return lk.join(rk, "_ci_key", how).drop("_ci_key")


def join_boundary(geo: DataFrame, density: DataFrame,
                  aliases: Iterable[tuple[str, str]] = fixed.GEO_NAME_ALIASES,
                  density_cols: tuple[str, ...] = ("facilities_per_10k",)) -> DataFrame:
    """Boundary rows ⋈ density on the boundary-side key (JON-4): alias
    map, then dash/apostrophe normaliser, equal to ``lower`` of the density
    name. Inner: an unmatched area cannot be drawn. The density side is cut
    to the key and the needed columns before the join; the wide geometry
    column stays on its own side."""
    d = density.select(F.lower("county_name").alias("_k"), *density_cols)
    g = geo.withColumn("_k", area_key_geo(F.col("county_name"), aliases))
    return g.join(d, "_k", "inner").drop("_k")


def unmatched_keys(left: DataFrame, right: DataFrame, l_name: str = "county_name",
                   r_name: str = "county_name", key=area_key, out: str = "unmatched_key") -> DataFrame:
    """Left keys without a partner on the right (JON-5): a left-anti join,
    so unmatched areas are listed instead of silently becoming NULLs."""
    lk = left.select(F.col(l_name).alias(out), key(F.col(l_name)).alias("_k"))
    rk = right.select(key(F.col(r_name)).alias("_k"))
    return lk.join(rk, "_k", "left_anti").drop("_k")


def fan_out_keys(df: DataFrame, key: str = "county_name") -> DataFrame:
    """Keys that a join multiplied (JON-5): present more than once."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
