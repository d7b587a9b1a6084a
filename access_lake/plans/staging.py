"""Staging views (MDL-1..3): typed, filtered, deduplicated."""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions.text import classify
from access_lake.operators.dedup import latest_per_key
from access_lake.operators.filters import keep, keep_status, positive, require_not_null

STG_FACILITY_COLUMNS = [
    "facility_id", "facility_code", "facility_name", "facility_type",
    "county_name", "sub_county_name", "ward_name", "latitude", "longitude",
    "operation_status", "has_maternity", "has_art", "has_tb", "has_emergency",
    "has_outpatient", "ingested_at",
]

_FACILITY_TYPES = {
    "facility_id": "string", "facility_code": "string", "facility_name": "string",
    "county_name": "string", "sub_county_name": "string", "ward_name": "string",
    "latitude": "double", "longitude": "double", "operation_status": "string",
    "has_maternity": "boolean", "has_art": "boolean", "has_tb": "boolean",
    "has_emergency": "boolean", "has_outpatient": "boolean",
    "ingested_at": "timestamp_ntz",
}


def typed(types: dict[str, str]) -> list[Column]:
    """Every listed column cast to its staging type (PRJ-1)."""
    return [F.col(name).cast(t).alias(name) for name, t in types.items()]


def stg_facilities(raw: DataFrame,
                   type_rules: Iterable[tuple[str, str]] = fixed.FACILITY_TYPE_RULES,
                   status: str = fixed.OPERATIONAL_STATUS) -> DataFrame:
    """Latest operational row per facility (MDL-1).

    The status and not-null filters run *before* the dedup window, as in
    the product: an older operational row survives when the newest row of
    its key is closed. Ties on ``ingested_at`` are broken by every other
    column so the survivor does not depend on the plan. The not-null filters
    reach a Parquet scan, the case-insensitive status filter runs above it;
    the window becomes a two-phase ``WindowGroupLimit``.
    """
    typed_cols = typed(_FACILITY_TYPES)
    valid = require_not_null(keep_status(raw, "operation_status", status), "facility_code", "county_name")
    cleaned = (valid
                  .select(*typed_cols[:3],
                          classify(F.col("facility_type").cast("string"), type_rules).alias("facility_type"),
                          *typed_cols[3:]))
    order = [F.desc_nulls_last("ingested_at")]
    tiebreak = [F.asc_nulls_last(c) for c in STG_FACILITY_COLUMNS
                if c not in ("facility_id", "ingested_at")]
    return keep(latest_per_key(cleaned, ["facility_id"], order, tiebreak), STG_FACILITY_COLUMNS)


def stg_population(raw: DataFrame) -> DataFrame:
    """Typed census rows with a positive population (MDL-2)."""
    return (positive(require_not_null(raw, "population", "county_name"), "population")
               .select(F.col("county_code").cast("string").alias("county_code"),
                       F.lower(F.col("county_name").cast("string")).alias("county_name"),
                       F.lower(F.col("sub_county").cast("string")).alias("sub_county_name"),
                       F.col("population").cast("bigint").alias("population"),
                       F.col("census_year").cast("int").alias("census_year"),
                       F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")))


def stg_geodata(raw: DataFrame) -> DataFrame:
    """Typed boundary rows with a name and a geometry (MDL-3)."""
    return (require_not_null(raw, "county_name", "geometry")
               .select(F.col("county_code").cast("string").alias("county_code"),
                       F.lower(F.col("county_name").cast("string")).alias("county_name"),
                       F.col("geometry").cast("string").alias("geometry"),
                       F.col("area_sqkm").cast("double").alias("area_sqkm"),
                       F.col("ingested_at").cast("timestamp_ntz").alias("ingested_at")))
