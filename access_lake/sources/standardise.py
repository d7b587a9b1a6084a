"""Bronze → conformed records (STD-1..18), as column expressions over
DataFrames read by :mod:`access_lake.sources.io`."""

from __future__ import annotations

from typing import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.functions import fixed
from access_lake.functions.numeric import has_gps, safe_float, safe_int, safe_int_commas, truthy, truthy_json
from access_lake.functions.text import (any_contains, as_array, clean_str, first_of, flatten_pipe,
                                        keyword_flags, normalise_header, title_case)

# registry field → standardised name (text fields, cleaned to '' and trimmed)
REGISTRY_TEXT_FIELDS = [
    ("code", "facility_code"), ("id", "facility_id"), ("name", "facility_name"),
    ("officialname", "official_name"), ("registration_number", "registration_number"),
    ("keph_level_name", "keph_level"), ("facility_type_name", "facility_type"),
    ("facility_type_category", "facility_type_category"), ("owner_name", "owner"),
    ("owner_type_name", "owner_type"), ("regulatory_body_name", "regulatory_body"),
    ("county_name", "county_name"), ("sub_county_name", "sub_county_name"),
    ("ward_name", "ward_name"), ("constituency_name", "constituency_name"),
]
REGISTRY_BOOL_FIELDS = ["open_whole_day", "open_weekends", "open_public_holidays", "open_late_night"]


def stamp(run_ts: str) -> Column:
    """Batch metadata: one ``ingested_at`` literal for every row (STD-15)."""
    return F.lit(run_ts).cast("timestamp_ntz").alias("ingested_at")


def standardise_registry(results: DataFrame, run_ts: str, source: str = "registry",
                         flags: Mapping[str, list[str]] = fixed.SERVICE_KEYWORDS) -> DataFrame:
    """Registry results → the 43-field facility record. ``service_names``
    and ``infrastructure_names`` are read as text (array or single string,
    STD-6)."""
    have = set(results.columns)

    def src(name: str, type_: str = "string") -> Column:
        # a field the payload lacks reads as missing, like dict.get()
        return F.col(name) if name in have else F.lit(None).cast(type_)

    def flag(name: str) -> Column:
        raw = name in have and isinstance(results.schema[name].dataType, T.VariantType)
        return truthy_json(name) if raw else truthy(src(name))

    # parsed once, below the many columns that use them
    parsed = results.withColumns({"_services": as_array(src("service_names")), "_infra": as_array(src("infrastructure_names")),
                                  "_lat": safe_float(src("lat")), "_lon": safe_float(src("long"))})
    services, infra, lat, lon = (F.col(c) for c in ("_services", "_infra", "_lat", "_lon"))
    cols: list[Column] = [clean_str(src(a)).alias(b) for a, b in REGISTRY_TEXT_FIELDS]
    cols += [lat.alias("latitude"), lon.alias("longitude"), has_gps(lat, lon).alias("has_gps"),
             clean_str(src("operation_status_name")).alias("operation_status"),
             clean_str(src("admission_status_name")).alias("admission_status")]
    cols += [flag(b).alias(b) for b in REGISTRY_BOOL_FIELDS]
    cols += [safe_int(src("beds")).alias("beds"), safe_int(src("cots")).alias("cots"),
             flatten_pipe(services).alias("service_names")]
    cols += keyword_flags(services, flags)
    cols += [flatten_pipe(infra).alias("infrastructure"),
             any_contains(infra, fixed.ELECTRICITY_KEYWORDS).alias("has_electricity"),
             any_contains(infra, fixed.WATER_KEYWORDS).alias("has_water"),
             flag("closed").alias("closed"),
             flag("is_published").alias("is_published"),
             F.lit(source).alias("source"),
             stamp(run_ts)]
    return parsed.select(*cols)


def normalise_headers(df: DataFrame) -> DataFrame:
    """Trim, lower-case, space and '-' → '_' on every column name (STD-11);
    metadata only."""
    return df.toDF(*[normalise_header(c) for c in df.columns])


def _present(df: DataFrame, names: list[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def drop_totals(df: DataFrame, name_col: str, words=fixed.CENSUS_TOTAL_WORDS) -> DataFrame:
    """Drop blank names and header/total rows (STD-13)."""
    low = F.lower(F.col(name_col))
    return df.filter((F.col(name_col) != "") & ~low.isin(*words))


def standardise_census(raw: DataFrame, run_ts: str, census_year: int = fixed.CENSUS_YEAR) -> DataFrame:
    """Census rows with drifting headers → population records.

    Column names are normalised, alias columns are tried in order (first
    non-empty wins, STD-12), total rows and zero populations are dropped,
    names are title-cased (STD-14)."""
    df = normalise_headers(raw)
    lit_null = F.lit(None).cast("string")

    def pick(names: list[str]) -> Column:
        have = _present(df, names)
        return first_of(have) if have else lit_null

    name = clean_str(pick(fixed.CENSUS_NAME_COLUMNS))
    pop = safe_int_commas(pick(fixed.CENSUS_POPULATION_COLUMNS))
    male = (safe_int_commas(F.col(fixed.CENSUS_MALE_COLUMN), type_="int")
            if fixed.CENSUS_MALE_COLUMN in df.columns else F.lit(0))
    female = (safe_int_commas(F.col(fixed.CENSUS_FEMALE_COLUMN), type_="int")
              if fixed.CENSUS_FEMALE_COLUMN in df.columns else F.lit(0))
    rows = df.select(name.alias("_name"), pop.alias("population"),
                     F.coalesce(pick(fixed.CENSUS_CODE_COLUMNS), F.lit("")).alias("county_code"),
                     male.alias("male"), female.alias("female"),
                     safe_int_commas(pick(fixed.CENSUS_HOUSEHOLD_COLUMNS), type_="int").alias("households"))
    kept = drop_totals(rows, "_name").filter(F.col("population") != 0)
    return kept.select(
        "county_code", title_case("_name").alias("county_name"), F.lit("").alias("sub_county"),
        "population", "male", "female", "households",
        F.lit(census_year).alias("census_year"), stamp(run_ts))


def drop_unnamed(df: DataFrame, name_col: str = "_name") -> DataFrame:
    """Drop features without an area name: blank or 'none' (STD-16)."""
    return df.filter((F.col(name_col) != "") & (F.lower(name_col) != fixed.FEATURE_UNNAMED))


def geometry_json(geometry: Column, parsed: bool = False) -> Column:
    """Geometry as JSON text (STD-18). Read as STRING it already is the raw
    text; ``parsed=True`` serialises a struct with ``to_json``. A NULL
    geometry becomes the text 'null', as ``json.dumps(None)`` does."""
    text = F.to_json(geometry) if parsed else geometry.cast("string")
    return F.coalesce(text, F.lit("null"))


def rollup_first_geometry(df: DataFrame, key: str = "_name", order: str = "pos",
                          area: str = fixed.FEATURE_AREA_PROPERTY) -> DataFrame:
    """Per area: code and geometry of the first feature in file order, sum
    of the feature areas, missing → 0.0 (STD-17, AGG-11). ``min_by`` is a
    partial aggregate, so an area with many features never gathers them
    in one place."""
    first = F.min_by(F.struct(clean_str(F.col(fixed.FEATURE_CODE_PROPERTY)).alias("code"),
                              geometry_json(F.col("geometry")).alias("geometry")),
                     F.col(order))
    return df.groupBy(key).agg(
        first.alias("_first"),
        F.sum(safe_float(area)).alias("area_sqkm"))


def standardise_features(features: DataFrame, run_ts: str) -> DataFrame:
    """Boundary features → one record per area (STD-14, STD-16..18):
    title-cased names, unnamed features dropped, first geometry per area
    kept and areas summed."""
    named = drop_unnamed(features.withColumn(
        "_name", title_case(clean_str(F.col(fixed.FEATURE_NAME_PROPERTY)))))
    rolled = rollup_first_geometry(named)
    return rolled.select(F.col("_first.code").alias("county_code"),
                         F.col("_name").alias("county_name"),
                         F.col("_first.geometry").alias("geometry"),
                         "area_sqkm", stamp(run_ts))
