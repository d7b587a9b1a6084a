"""Chart datasets read from the marts (DSH-1..8, SRT-1..4)."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.numeric import severity_label
from access_lake.functions.text import feature_json
from access_lake.operators.joins import join_boundary
from access_lake.operators.aggregates import avg_by
from access_lake.operators.ranking import by_name, ranked, top_k, worst_first

RANKING_COLUMNS = ["underserved_rank", "county_name", "severity_score", "facilities_per_10k",
                   "total_population", "maternity_gap_flag", "art_gap_flag", "tb_gap_flag",
                   "no_emergency_flag", "facilities_needed_to_baseline"]


def dash_density(density: DataFrame) -> DataFrame:
    """Facilities per 10k by area, alphabetical (DSH-1, SRT-2)."""
    return by_name(avg_by(density, "county_name", "facilities_per_10k"))


def dash_ranking(underserved: DataFrame, labels=fixed.SEVERITY_LABELS) -> DataFrame:
    """The ranking table with a severity label, worst first (DSH-2, SRT-1)."""
    return ranked(underserved.select(*RANKING_COLUMNS,
                                     severity_label("severity_score", labels).alias("severity_label")))


def dash_maternity(gaps: DataFrame) -> DataFrame:
    """Maternity facilities per 100k by area (DSH-3)."""
    return avg_by(gaps, "county_name", "maternity_per_100k").orderBy("county_name")


def dash_services(gaps: DataFrame, long: bool = False) -> DataFrame:
    """Four services side by side; TB is a count, the others are rates
    (DSH-4). ``long=True`` gives one row per (area, metric)."""
    wide = avg_by(gaps, "county_name",
                  ["tb_count", "maternity_per_100k", "art_per_100k", "emergency_per_100k"])
    if not long:
        return wide.orderBy("county_name")
    cols = ["avg_tb_count", "avg_maternity_per_100k", "avg_art_per_100k", "avg_emergency_per_100k"]
    return wide.unpivot(["county_name"], cols, "metric", "value")


def dash_subarea_density(sub: DataFrame) -> DataFrame:
    """Sub-area density (DSH-5)."""
    return avg_by(sub, "sub_county_name", "facilities_per_10k").orderBy("sub_county_name")


def dash_subarea_services(sub: DataFrame) -> DataFrame:
    """Sub-area service table, least dense first (DSH-6, SRT-3)."""
    return (sub.select("sub_county_name", "total_facilities", "population_2024",
                       "facilities_per_10k", "maternity_count", "art_count", "emergency_count",
                       "subcounty_density_rank")
               .transform(lambda d: worst_first(d, "facilities_per_10k", "sub_county_name")))


def dash_area_count(density: DataFrame) -> DataFrame:
    """Number of areas mapped (DSH-7)."""
    return density.agg(F.count(F.lit(1)).alias("areas_mapped"))


def density_band(value: str, edges: Iterable[float], out: str = "density_band") -> F.Column:
    """Band index of a density over the given edges (1-based, 0 below the
    first edge, NULL for NULL)."""
    edges = list(edges)
    c = F.col(value)
    expr = F.lit(len(edges))
    for i in range(len(edges) - 1, -1, -1):
        expr = F.when(c < edges[i], F.lit(i)).otherwise(expr)
    return F.when(c.isNull(), F.lit(None).cast("int")).otherwise(expr).alias(out)


def dash_features(geo: DataFrame, density: DataFrame, aliases=fixed.GEO_NAME_ALIASES,
                  band_edges: Iterable[float] = (1.8, 2.7, 3.5, 4.4)) -> DataFrame:
    """One GeoJSON Feature per mapped area: boundary ⋈ density on the
    boundary-side key (alias map, then dash/apostrophe normaliser), inner
    join because unmatched areas cannot be drawn (DSH-8, JON-4, SCL-5).

    The geometry text is embedded as is; the properties are written with
    ``to_json`` so quotes in names are escaped. Geometry is the wide column,
    so it is joined last, after the density side is reduced to two columns.
    """
    j = join_boundary(geo.select("county_name", "geometry"), density, aliases)
    feature = feature_json("geometry", F.struct(F.col("county_name"), F.col("facilities_per_10k")))
    return j.select("county_name", "facilities_per_10k",
                    density_band("facilities_per_10k", band_edges),
                    feature.alias("feature"))


def top_underserved(underserved: DataFrame, k: int = 5) -> DataFrame:
    """The ``k`` most under-served areas (SRT-4)."""
    return top_k(underserved.select(*RANKING_COLUMNS), [F.asc("underserved_rank")], k)
