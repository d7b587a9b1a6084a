"""The four marts (MDL-4..7).

Each mart aggregates the deduplicated facilities once per area (partial +
final hash aggregate, one small shuffle), then joins per-area population.
Both join sides are per-area aggregates, so AQE broadcasts the smaller at
runtime; ranks run on aggregated grain only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.numeric import (band, baseline_gap, below, is_zero, rate_per, ratio,
                                           severity)
from access_lake.operators.aggregates import (SERVICE_COUNT_NAMES, TYPE_COUNT_NAMES, flag_counts,
                                              pivot_counts, population_totals, service_counts,
                                              subarea_counts, weighted_sum)
from access_lake.operators.filters import drill_down, non_blank, with_all
from access_lake.operators.joins import join_by_area, join_ci
from access_lake.operators.ranking import rank_by

DENSITY_COLUMNS = [
    "county_name", "total_facilities", "hospital_count", "health_centre_count",
    "dispensary_count", "clinic_count", "maternity_facilities", "art_facilities",
    "tb_facilities", "emergency_facilities", "weighted_score", "total_population",
    "facilities_per_10k", "weighted_density_per_10k", "density_rank",
]
GAPS_COLUMNS = [
    "county_name", "total_facilities", "total_population", "maternity_count",
    "art_count", "tb_count", "emergency_count", "outpatient_count",
    "maternity_per_100k", "art_per_100k", "tb_per_100k", "emergency_per_100k",
    "maternity_gap_flag", "art_gap_flag", "tb_gap_flag", "no_emergency_flag",
]
UNDERSERVED_COLUMNS = [
    "county_name", "total_facilities", "total_population", "facilities_per_10k",
    "weighted_density_per_10k", "density_rank", "hospital_count",
    "health_centre_count", "dispensary_count", "clinic_count", "maternity_count",
    "art_count", "tb_count", "emergency_count", "maternity_per_100k",
    "art_per_100k", "tb_per_100k", "emergency_per_100k", "maternity_gap_flag",
    "art_gap_flag", "tb_gap_flag", "no_emergency_flag", "severity_score",
    "facilities_needed_to_baseline", "underserved_rank",
]
SUBAREA_COLUMNS = [
    "sub_county_name", "total_facilities", "population_2019", "population_2024",
    "maternity_count", "art_count", "tb_count", "emergency_count",
    "hospital_count", "health_centre_count", "dispensary_count", "clinic_count",
    "facilities_per_10k", "no_maternity_flag", "no_art_flag", "no_emergency_flag",
    "subcounty_density_rank",
]


AREA_SERVICES = {**SERVICE_COUNT_NAMES, "outpatient_count": "has_outpatient"}


def area_profile(fac: DataFrame) -> DataFrame:
    """All counts per area that the area marts share, in one pass: total,
    types, services (AGG-5) and the weighted score.

    The product counts per (area, type) and then sums per area; both levels
    are folded into one ``groupBy(area)`` with the same results and one
    shuffle fewer. A mart on its own prunes what it does not use; where
    several marts are wanted, the profile can be written once (one row per
    area) and given to each.
    """
    return fac.groupBy("county_name").agg(
        F.count(F.lit(1)).alias("total_facilities"),
        *pivot_counts("facility_type", TYPE_COUNT_NAMES),
        *flag_counts(AREA_SERVICES), weighted_sum("facility_type"))


def mart_county_density(fac: DataFrame | None, pop: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Facility density per area (MDL-4), from the facilities or from their
    :func:`area_profile`."""
    profile = area_profile(fac) if profile is None else profile
    names = {"maternity_count": "maternity_facilities", "art_count": "art_facilities",
             "tb_count": "tb_facilities", "emergency_count": "emergency_facilities"}
    joined = join_by_area(profile, population_totals(pop), how="left").withColumnsRenamed(names)
    out = joined.select(
        *[c for c in DENSITY_COLUMNS[:12]],
        rate_per("total_facilities", "total_population", fixed.DENSITY_PER).alias("facilities_per_10k"),
        rate_per("weighted_score", "total_population", fixed.DENSITY_PER).alias("weighted_density_per_10k"),
        ratio("total_facilities", "total_population").alias("_ratio"))
    ranked = rank_by(out, [F.asc_nulls_last("_ratio"), F.asc_nulls_last("county_name"),
                           F.asc_nulls_last("total_population")], "density_rank")
    return ranked.select(*DENSITY_COLUMNS)


def mart_service_gaps(fac: DataFrame | None, pop: DataFrame, profile: DataFrame | None = None) -> DataFrame:
    """Service rates per 100,000 people and gap flags per area (MDL-5), from
    the facilities or from their :func:`area_profile`."""
    services = service_counts(fac) if profile is None else profile
    joined = join_by_area(services, population_totals(pop), how="left")
    per = fixed.SERVICE_PER
    return joined.select(
        "county_name", "total_facilities", "total_population", "maternity_count",
        "art_count", "tb_count", "emergency_count", "outpatient_count",
        rate_per("maternity_count", "total_population", per).alias("maternity_per_100k"),
        rate_per("art_count", "total_population", per).alias("art_per_100k"),
        rate_per("tb_count", "total_population", per).alias("tb_per_100k"),
        rate_per("emergency_count", "total_population", per).alias("emergency_per_100k"),
        below("maternity_count", fixed.MATERNITY_GAP_BELOW).alias("maternity_gap_flag"),
        below("art_count", fixed.ART_GAP_BELOW).alias("art_gap_flag"),
        below("tb_count", fixed.TB_GAP_BELOW).alias("tb_gap_flag"),
        is_zero("emergency_count").alias("no_emergency_flag"))


def mart_underserved(density: DataFrame, gaps: DataFrame,
                     per_10k: str = fixed.BASELINE_PER_10K) -> DataFrame:
    """Composite severity score and rank (MDL-6). Rank ties are broken by
    lower density, then name."""
    d = density.select("county_name", "total_facilities", "total_population",
                       "facilities_per_10k", "weighted_density_per_10k", "density_rank",
                       "hospital_count", "health_centre_count", "dispensary_count",
                       "clinic_count")
    g = gaps.select(F.col("county_name").alias("_g_name"), "maternity_count", "art_count",
                    "tb_count", "emergency_count", "maternity_per_100k", "art_per_100k",
                    "tb_per_100k", "emergency_per_100k", "maternity_gap_flag",
                    "art_gap_flag", "tb_gap_flag", "no_emergency_flag")
    scored = with_all(join_ci(d, g, "county_name", "_g_name", how="left").drop("_g_name"),
                      severity_score=severity(band("facilities_per_10k")),
                      facilities_needed_to_baseline=baseline_gap("total_population",
                                                                 "total_facilities", per_10k))
    ranked = rank_by(scored, [F.desc_nulls_last("severity_score"),
                              F.asc_nulls_last("facilities_per_10k"),
                              F.asc_nulls_last("county_name"),
                              F.asc_nulls_last("total_population")], "underserved_rank")
    return ranked.select(*UNDERSERVED_COLUMNS)


def mart_subarea(fac: DataFrame, seed: DataFrame, area: str) -> DataFrame:
    """Sub-area drill-down of one area against a sub-area population seed
    (MDL-7; the product fixes the area, here it is a parameter)."""
    counts = subarea_counts(non_blank(drill_down(fac, "county_name", area), "sub_county_name"))
    p = seed.select(F.col("sub_county_name").alias("_p_name"), "population_2019", "population_2024")
    joined = join_ci(counts, p, "sub_county_name", "_p_name", how="left").drop("_p_name")
    out = joined.select(
        "sub_county_name", "total_facilities", "population_2019", "population_2024",
        "maternity_count", "art_count", "tb_count", "emergency_count", "hospital_count",
        "health_centre_count", "dispensary_count", "clinic_count",
        rate_per("total_facilities", "population_2024", fixed.DENSITY_PER).alias("facilities_per_10k"),
        is_zero("maternity_count").alias("no_maternity_flag"),
        is_zero("art_count").alias("no_art_flag"),
        is_zero("emergency_count").alias("no_emergency_flag"),
        ratio("total_facilities", "population_2024").alias("_ratio"))
    ranked = rank_by(out, [F.asc_nulls_last("_ratio"), F.asc_nulls_last("sub_county_name"),
                           F.asc_nulls_last("population_2024")], "subcounty_density_rank")
    return ranked.select(*SUBAREA_COLUMNS)
