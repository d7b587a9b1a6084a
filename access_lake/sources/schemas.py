"""Read schemas (explicit: no inference pass over the data)."""

from pyspark.sql import types as T

S, D, L, I, B = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(), T.BooleanType()
NTZ = T.TimestampNTZType()
V = T.VariantType()  # a JSON value with its own type

REGISTRY_RESULT = T.StructType([
    T.StructField(n, S) for n in [
        "id", "code", "name", "officialname", "registration_number", "keph_level_name",
        "facility_type_name", "facility_type_category", "owner_name", "owner_type_name",
        "regulatory_body_name", "county_name", "sub_county_name", "ward_name",
        "constituency_name", "lat", "long", "beds", "cots", "operation_status_name",
        "admission_status_name"]
] + [T.StructField(n, V) for n in ["open_whole_day", "open_weekends", "open_public_holidays",
                                    "open_late_night"]]
  + [T.StructField("service_names", S), T.StructField("infrastructure_names", S),
     T.StructField("closed", V), T.StructField("is_published", V)])

REGISTRY_PAGE = T.StructType([
    T.StructField("count", L), T.StructField("total_pages", I),
    T.StructField("results", T.ArrayType(REGISTRY_RESULT)),
])

FEATURE_COLLECTION = T.StructType([
    T.StructField("features", T.ArrayType(T.StructType([
        T.StructField("properties", T.StructType([
            T.StructField("COUNTY_NAM", S), T.StructField("COUNTY_COD", S),
            T.StructField("CONST_CODE", S), T.StructField("Shape_Area", S),
            T.StructField("OBJECTID", L)])),
        # kept as raw JSON text
        T.StructField("geometry", S),
    ]))),
])

FACILITY_RECORD = T.StructType(
    [T.StructField(n, S) for n in [
        "facility_code", "facility_id", "facility_name", "official_name", "registration_number",
        "keph_level", "facility_type", "facility_type_category", "owner", "owner_type",
        "regulatory_body", "county_name", "sub_county_name", "ward_name", "constituency_name"]]
    + [T.StructField("latitude", D), T.StructField("longitude", D), T.StructField("has_gps", B),
       T.StructField("operation_status", S), T.StructField("admission_status", S)]
    + [T.StructField(n, B) for n in ["open_whole_day", "open_weekends", "open_public_holidays",
                                      "open_late_night"]]
    + [T.StructField("beds", I), T.StructField("cots", I), T.StructField("service_names", S)]
    + [T.StructField(n, B) for n in [
        "has_maternity", "has_art", "has_tb", "has_emergency", "has_outpatient",
        "has_family_planning", "has_immunisation", "has_lab", "has_pharmacy"]]
    + [T.StructField("infrastructure", S), T.StructField("has_electricity", B),
       T.StructField("has_water", B), T.StructField("closed", B), T.StructField("is_published", B),
       T.StructField("source", S), T.StructField("ingested_at", NTZ)])

POPULATION_RECORD = T.StructType([
    T.StructField("county_code", S), T.StructField("county_name", S),
    T.StructField("sub_county", S), T.StructField("population", L), T.StructField("male", I),
    T.StructField("female", I), T.StructField("households", I), T.StructField("census_year", I),
    T.StructField("ingested_at", NTZ)])

GEODATA_RECORD = T.StructType([
    T.StructField("county_code", S), T.StructField("county_name", S),
    T.StructField("geometry", S), T.StructField("area_sqkm", D), T.StructField("ingested_at", NTZ)])

SUBAREA_SEED = T.StructType([
    T.StructField("sub_county_name", S), T.StructField("population_2019", L),
    T.StructField("population_2024", L), T.StructField("census_year", I),
    T.StructField("projection_year", I), T.StructField("growth_rate", D)])

# landing partition columns stay text ('05', not 5)
PARTITIONS = [T.StructField("year", S), T.StructField("month", S), T.StructField("day", S)]

RECORDS = {"facilities": FACILITY_RECORD, "population": POPULATION_RECORD,
           "geodata": GEODATA_RECORD}


def with_partitions(schema: T.StructType) -> T.StructType:
    return T.StructType(list(schema.fields) + PARTITIONS)
