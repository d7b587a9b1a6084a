"""Registered queries: each takes ``(spark, sf_dir)`` and returns a
DataFrame over the driver's tables; ``ORACLE`` holds the DuckDB SQL of each
(absent only where SQL cannot express the operator)."""

from __future__ import annotations

from datetime import date as _date
from datetime import datetime as _dt
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from access_lake import oracle as O
from access_lake.functions import fixed
from access_lake.functions import numeric as N
from access_lake.functions import text as T
from access_lake.operators import aggregates as agg
from access_lake.operators import history as H
from access_lake.operators import joins as J
from access_lake.operators import quality as Q
from access_lake.operators.dedup import latest_per_key, total_order
from access_lake.plans import dashboards as D
from access_lake.plans import marts, staging
from access_lake.plans.quality_suite import run_checks
from access_lake.session import work_dir
from access_lake.sources import io as IO
from access_lake.sources import schemas as S
from access_lake.sources import standin
from access_lake.sources.standardise import (standardise_census, standardise_features,
                                             standardise_registry)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ------------------------------------------------------------ shared inputs
def stg_fac(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_facilities(standin.raw_facilities(spark, sf), standin.STANDIN_TYPE_RULES)


def stg_pop(spark: SparkSession, sf: str) -> DataFrame:
    return staging.stg_population(standin.raw_population(spark, sf))


def written(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder: computed once, read often."""
    path = work_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


# ------------------------------------------------------------ sources / staging
@register("raw_facilities", O.with_ctes(["raw_facilities"], "SELECT * FROM raw_facilities"))
def q_raw_facilities(spark, sf):
    return standin.raw_facilities(spark, sf)


@register("stg_facilities", O.with_ctes(["stg_facilities"], "SELECT * FROM stg_facilities"))
def q_stg_facilities(spark, sf):
    return stg_fac(spark, sf)


@register("stg_facilities_bucketed", O.with_ctes(["stg_facilities"], "SELECT * FROM stg_facilities"))
def q_stg_facilities_bucketed(spark, sf):
    """Staging over the raw table bucketed by facility id: the latest row
    per facility is found inside each bucket, without a shuffle (MDL-1,
    WIN-1)."""
    return staging.stg_facilities(_bucketed_raw(spark, sf), standin.STANDIN_TYPE_RULES)


def _bucketed_raw(spark, sf) -> DataFrame:
    from access_lake.sources import bucketed
    raw, path, buckets = standin.raw_facilities(spark, sf), work_dir(spark, "raw-bucketed"), _facility_buckets(spark, sf)
    bucketed.write_load(raw, path, "facility_id", buckets)
    return bucketed.read_loads(spark, path, raw.schema, "facility_id", buckets)


def _facility_buckets(spark, sf) -> int:
    """Buckets for all raw facility rows, by the row count that the Parquet
    footers of their line items give."""
    from access_lake.sources import bucketed
    return bucketed.buckets_for(standin.table(spark, sf, "lineitem").count())


@register("stg_population", O.with_ctes(["stg_population"], "SELECT * FROM stg_population"))
def q_stg_population(spark, sf):
    return stg_pop(spark, sf)


# ------------------------------------------------------------ aggregations
@register("population_totals", O.with_ctes(["pop_totals"], "SELECT * FROM pop_totals"))
def q_population_totals(spark, sf):
    return agg.population_totals(stg_pop(spark, sf))


@register("type_service_counts", O.with_ctes(["stg_facilities"], f"""
SELECT county_name, facility_type, count(*) AS facility_count,
       {O.cnt('has_maternity')} AS maternity_count, {O.cnt('has_art')} AS art_count,
       {O.cnt('has_tb')} AS tb_count, {O.cnt('has_emergency')} AS emergency_count
FROM stg_facilities GROUP BY county_name, facility_type"""))
def q_type_service_counts(spark, sf):
    return agg.type_service_counts(stg_fac(spark, sf))


@register("roll_up_types", O.with_ctes(["stg_facilities"], """
SELECT county_name, CAST(sum(facility_count) AS BIGINT) AS total_facilities,
       CAST(sum(maternity_count) AS BIGINT) AS maternity_count, CAST(sum(art_count) AS BIGINT) AS art_count,
       CAST(sum(tb_count) AS BIGINT) AS tb_count, CAST(sum(emergency_count) AS BIGINT) AS emergency_count,
       CAST(sum(CASE WHEN facility_type = 'Hospital' THEN facility_count ELSE 0 END) AS BIGINT) AS hospital_count,
       CAST(sum(CASE WHEN facility_type = 'Health Centre' THEN facility_count ELSE 0 END) AS BIGINT) AS health_centre_count,
       CAST(sum(CASE WHEN facility_type = 'Dispensary' THEN facility_count ELSE 0 END) AS BIGINT) AS dispensary_count,
       CAST(sum(CASE WHEN facility_type = 'Clinic' THEN facility_count ELSE 0 END) AS BIGINT) AS clinic_count,
       CAST(sum(facility_count * CASE facility_type WHEN 'Hospital' THEN 4 WHEN 'Health Centre' THEN 2 ELSE 1 END) AS BIGINT) AS weighted_score
FROM (SELECT county_name, facility_type, count(*) AS facility_count,
             sum(CASE WHEN has_maternity THEN 1 ELSE 0 END) AS maternity_count,
             sum(CASE WHEN has_art THEN 1 ELSE 0 END) AS art_count,
             sum(CASE WHEN has_tb THEN 1 ELSE 0 END) AS tb_count,
             sum(CASE WHEN has_emergency THEN 1 ELSE 0 END) AS emergency_count
      FROM stg_facilities GROUP BY county_name, facility_type) t
GROUP BY county_name"""))
def q_roll_up_types(spark, sf):
    return agg.roll_up(agg.type_service_counts(stg_fac(spark, sf)))


# ------------------------------------------------------------ marts
@register("mart_density", O.with_ctes(["density"], "SELECT * FROM density"))
def q_mart_density(spark, sf):
    return marts.mart_county_density(stg_fac(spark, sf), stg_pop(spark, sf))


@register("mart_gaps", O.with_ctes(["gaps"], "SELECT * FROM gaps"))
def q_mart_gaps(spark, sf):
    return marts.mart_service_gaps(stg_fac(spark, sf), stg_pop(spark, sf))


@register("mart_underserved", O.with_ctes(["underserved"], "SELECT * FROM underserved"))
def q_mart_underserved(spark, sf):
    """Both area marts from one written profile (one row per area), so the
    facilities are deduplicated and aggregated once."""
    pop, profile = stg_pop(spark, sf), written(spark, marts.area_profile(stg_fac(spark, sf)), "profile")
    return marts.mart_underserved(marts.mart_county_density(None, pop, profile),
                                  marts.mart_service_gaps(None, pop, profile))


@register("mart_subarea", O.with_ctes(["subarea"], "SELECT * FROM subarea"))
def q_mart_subarea(spark, sf):
    return marts.mart_subarea(stg_fac(spark, sf), standin.subarea_seed(spark, sf),
                              standin.STANDIN_DRILL_AREA)


# ------------------------------------------------------------ dedup contrast

LI_COLS = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
           "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]
LI_TIE = ", ".join(f"{c} ASC NULLS LAST" for c in LI_COLS
                   if c not in ("l_orderkey", "l_linenumber", "l_shipdate"))


@register("latest_per_key", f"""
SELECT {', '.join(LI_COLS)} FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                               ORDER BY l_shipdate DESC NULLS LAST, {LI_TIE}) AS rn
  FROM lineitem) t WHERE rn = 1""")
def q_latest_per_key(spark, sf):
    li = standin.table(spark, sf, "lineitem")
    return latest_per_key(li, ["l_orderkey", "l_linenumber"], [F.desc_nulls_last("l_shipdate")])


@register("filter_then_dedup", O.with_ctes(["stg_facilities"],
          "SELECT facility_id, operation_status, ingested_at FROM stg_facilities"))
def q_filter_then_dedup(spark, sf):
    return stg_fac(spark, sf).select("facility_id", "operation_status", "ingested_at")


@register("dedup_then_filter", O.with_ctes(["raw_facilities"], f"""
SELECT facility_id, operation_status, ingested_at FROM (
  SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY ingested_at DESC NULLS LAST,
                               {O.TIEBREAK.replace('facility_type ASC NULLS LAST, ', '')}, facility_type ASC NULLS LAST) AS rn
  FROM raw_facilities) t
WHERE rn = 1 AND lower(operation_status) = 'operational'
  AND facility_code IS NOT NULL AND county_name IS NOT NULL"""))
def q_dedup_then_filter(spark, sf):
    """The order the product does *not* use: dedup first, then filter.
    A key whose newest row is closed disappears here but survives in
    ``filter_then_dedup``."""
    raw = standin.raw_facilities(spark, sf)
    order = [F.desc_nulls_last("ingested_at")]
    tie = [F.asc_nulls_last(c) for c in staging.STG_FACILITY_COLUMNS
           if c not in ("facility_id", "ingested_at", "facility_type")] + [F.asc_nulls_last("facility_type")]
    latest = latest_per_key(raw, ["facility_id"], order, tie)
    return (latest.filter(T.eq_ci("operation_status", fixed.OPERATIONAL_STATUS)
                          & F.col("facility_code").isNotNull() & F.col("county_name").isNotNull())
                  .select("facility_id", "operation_status", "ingested_at"))


# ------------------------------------------------------------ scalar operators
TEXT_KEYWORDS = {
    "kw_the": ["the ", " the,"],
    "kw_eau": ["eau"],
    "kw_ment": ["ment", "ement"],
    "kw_license": ["license", "licence"],
    "kw_at": ["@"],
}


def _flags_sql(text: str, flags: dict[str, list[str]]) -> str:
    parts = []
    for name, kws in flags.items():
        conds = " OR ".join(f"contains({text}, '{k.replace(chr(39), chr(39) * 2)}')" for k in kws)
        parts.append(f"coalesce({conds}, false) AS {name}")
    return ",\n       ".join(parts)


@register("classify_type", f"""
SELECT p_partkey, p_name,
       {O.TYPE_CASE.replace('facility_type', 'p_name')} AS standin_type,
       CASE WHEN lower(p_name) LIKE '%hospital%' THEN 'Hospital'
            WHEN lower(p_name) LIKE '%health centre%' THEN 'Health Centre'
            WHEN lower(p_name) LIKE '%dispensary%' THEN 'Dispensary'
            WHEN lower(p_name) LIKE '%clinic%' THEN 'Clinic' ELSE 'Other' END AS product_type
FROM part""")
def q_classify_type(spark, sf):
    p = standin.table(spark, sf, "part")
    return p.select("p_partkey", "p_name",
                    T.classify("p_name", standin.STANDIN_TYPE_RULES).alias("standin_type"),
                    T.classify("p_name").alias("product_type"))


@register("keyword_flags", f"""
SELECT doc_id,
       {_flags_sql("lower(replace(text, chr(10), ' '))", {**fixed.SERVICE_KEYWORDS, **TEXT_KEYWORDS})}
FROM documents""")
def q_keyword_flags(spark, sf):
    """Service keyword flags over each document's lines, joined with one
    space (whole texts; product keywords plus stand-in keywords that occur
    in the synthetic prose)."""
    d = standin.table(spark, sf, "documents")
    lines = F.split(F.col("text"), "\n")
    return d.select("doc_id", *T.keyword_flags(lines, {**fixed.SERVICE_KEYWORDS, **TEXT_KEYWORDS}))


def _any_line_sql(kws: list[str]) -> str:
    conds = " OR ".join(f"contains(lower(x), '{k}')" for k in kws)
    return f"coalesce(len(list_filter(string_split(text, chr(10)), lambda x: {conds})) > 0, false)"


@register("any_contains", f"""
SELECT doc_id,
       {_any_line_sql(fixed.ELECTRICITY_KEYWORDS)} AS has_electricity,
       {_any_line_sql(fixed.WATER_KEYWORDS)} AS has_water,
       {_any_line_sql(['license', 'licence'])} AS any_license,
       {_any_line_sql(['eau'])} AS any_eau
FROM documents""")
def q_any_contains(spark, sf):
    d = standin.table(spark, sf, "documents")
    lines = F.split(F.col("text"), "\n")
    return d.select("doc_id",
                    T.any_contains(lines, fixed.ELECTRICITY_KEYWORDS).alias("has_electricity"),
                    T.any_contains(lines, fixed.WATER_KEYWORDS).alias("has_water"),
                    T.any_contains(lines, ["license", "licence"]).alias("any_license"),
                    T.any_contains(lines, ["eau"]).alias("any_eau"))


@register("title_case", f"""
SELECT doc_id, {O.title_sql('text')} AS title_text FROM documents""")
def q_title_case(spark, sf):
    d = standin.table(spark, sf, "documents")
    return d.select("doc_id", T.title_case("text").alias("title_text"))


@register("area_keys", O.with_ctes(["features"], f"""
SELECT CONST_CODE, COUNTY_NAM,
       {O.key_sql('COUNTY_NAM')} AS area_key,
       CASE lower(COUNTY_NAM)
            WHEN 'elegeyo-marakwet' THEN 'elgeyo marakwet'
            WHEN 'murang''a' THEN 'muranga'
            WHEN 'tharaka - nithi' THEN 'tharaka nithi'
            ELSE regexp_replace(regexp_replace(lower(COUNTY_NAM), '\\s*-\\s*', ' ', 'g'), '''', '', 'g')
       END AS area_key_geo
FROM features"""))
def q_area_keys(spark, sf):
    f = standin.raw_features(spark, sf)
    return f.select("CONST_CODE", "COUNTY_NAM", T.area_key("COUNTY_NAM").alias("area_key"),
                    T.area_key_geo("COUNTY_NAM").alias("area_key_geo"))


@register("safe_casts", f"""
SELECT event_id,
       coalesce(TRY_CAST(trim(' ' || CAST(value AS VARCHAR) || ' ') AS DOUBLE), CAST(0 AS DOUBLE)) AS f_value,
       coalesce(TRY_CAST(trim(event_type) AS DOUBLE), CAST(0 AS DOUBLE)) AS f_junk,
       coalesce(CAST(trunc(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS INTEGER), 0) AS i_trunc,
       {O.int_text_sql("replace(format('{:,}', event_id * 1001), ',', '')")} AS i_commas,
       {O.int_text_sql("replace(CAST(value AS VARCHAR), ',', '')")} AS i_fraction_rejected,
       {O.int_text_sql("json_extract_string(props, '$.k')")} AS i_json
FROM events""")
def q_safe_casts(spark, sf):
    e = standin.table(spark, sf, "events")
    return e.select(
        "event_id",
        N.safe_float(F.concat(F.lit(" "), F.col("value").cast("string"), F.lit(" "))).alias("f_value"),
        N.safe_float("event_type").alias("f_junk"),
        N.safe_int(F.col("value").cast("string")).alias("i_trunc"),
        N.safe_int_commas(F.format_number(F.col("event_id") * 1001, 0)).alias("i_commas"),
        N.safe_int_commas(F.col("value").cast("string")).alias("i_fraction_rejected"),
        N.safe_int_commas(F.get_json_object("props", "$.k")).alias("i_json"))


@register("first_of", """
SELECT c_custkey,
       coalesce(nullif(CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END, ''),
                nullif(CASE WHEN c_acctbal < 0 THEN NULL ELSE c_name END, ''),
                'unknown') AS first_value
FROM customer""")
def q_first_of(spark, sf):
    c = standin.table(spark, sf, "customer")
    a = F.when(F.col("c_mktsegment") == "BUILDING", F.lit("")).otherwise(F.col("c_mktsegment"))
    b = F.when(F.col("c_acctbal") < 0, F.lit(None).cast("string")).otherwise(F.col("c_name"))
    return c.select("c_custkey", T.first_of([a, b], F.lit("unknown")).alias("first_value"))





@register("census_standardise", O.CENSUS_SQL)
def q_census_standardise(spark, sf):
    """Census standardisation on rows with drifting header names: alias
    columns, thousands separators, rejected fractions, zero and total rows,
    title case (STD-4, STD-11..15)."""
    return standardise_census(standin.census_rows(spark, sf), standin.STANDIN_CENSUS_TS)


GEO_TS = "2024-06-01 00:00:00"


@register("rollup_first_geometry", O.with_ctes(["geodata"], "SELECT * FROM geodata"))
def q_rollup_first_geometry(spark, sf):
    return standardise_features(standin.raw_features(spark, sf), GEO_TS)


@register("stg_geodata", O.with_ctes(["geodata"], "SELECT * FROM stg_geodata"))
def q_stg_geodata(spark, sf):
    return staging.stg_geodata(standardise_features(standin.raw_features(spark, sf), GEO_TS))


# ------------------------------------------------------------ measures
@register("subarea_scores", O.with_ctes(["stg_facilities", "stg_population"], f"""
SELECT f.county_name, f.sub_county_name, f.n, p.population,
       round(CAST(f.n AS DOUBLE) / nullif(p.population, 0) * 10000, 2) AS per_10k,
       CASE WHEN CAST(f.n AS DOUBLE) / nullif(p.population, 0) * 10000 < 1 THEN 4
            WHEN CAST(f.n AS DOUBLE) / nullif(p.population, 0) * 10000 < 2 THEN 3
            WHEN CAST(f.n AS DOUBLE) / nullif(p.population, 0) * 10000 < 5 THEN 2 ELSE 1 END AS band_points,
       CASE WHEN p.population IS NULL THEN NULL
            ELSE greatest(0, CAST(((p.population + 250) // 500 + 9) // 10 - f.n AS INTEGER)) END AS needed_to_baseline
FROM (SELECT county_name, sub_county_name, count(*) AS n FROM stg_facilities
      GROUP BY county_name, sub_county_name) f
LEFT JOIN stg_population p
  ON {O.key_sql('f.county_name')} = {O.key_sql('p.county_name')}
 AND lower(f.sub_county_name) = p.sub_county_name"""))
def q_subarea_scores(spark, sf):
    """Rate, band points and baseline gap at (area, sub-area) grain
    (SCL-6, SCL-7, SCL-10)."""
    f = stg_fac(spark, sf).groupBy("county_name", "sub_county_name").agg(F.count(F.lit(1)).alias("n"))
    p = stg_pop(spark, sf)
    j = f.join(p.select(T.area_key("county_name").alias("_k"), F.col("sub_county_name").alias("_s"),
                        "population"),
               (T.area_key("county_name") == F.col("_k")) & (F.lower("sub_county_name") == F.col("_s")),
               "left")
    per = N.rate_per("n", "population", fixed.DENSITY_PER)
    return j.select("county_name", "sub_county_name", "n", "population", per.alias("per_10k"),
                    N.band(N.ratio("n", "population") * fixed.DENSITY_PER).alias("band_points"),
                    N.baseline_gap("population", "n").alias("needed_to_baseline"))


@register("growth_projection", O.with_ctes(["seed"], """
SELECT sub_county_name, population_2019, population_2024,
       CAST(round(population_2019 * pow(1 + growth_rate, projection_year - census_year)) AS BIGINT) AS projected
FROM seed"""))
def q_growth_projection(spark, sf):
    s = standin.subarea_seed(spark, sf)
    return s.select("sub_county_name", "population_2019", "population_2024",
                    N.project_population("population_2019", "growth_rate",
                                         F.col("projection_year") - F.col("census_year")).alias("projected"))


@register("severity_scores", O.with_ctes(["underserved"], """
SELECT county_name, severity_score, facilities_needed_to_baseline,
       CASE severity_score WHEN 3 THEN 'critical' WHEN 2 THEN 'high' END AS severity_label
FROM underserved"""))
def q_severity_scores(spark, sf):
    u = q_mart_underserved(spark, sf)
    return u.select("county_name", "severity_score", "facilities_needed_to_baseline",
                    N.severity_label("severity_score").alias("severity_label"))


# ------------------------------------------------------------ history (SCD2)

SNAP_COLS = ["user_id", "event_type", "value_band", "is_high"]
HIST_COLS = SNAP_COLS + ["valid_from", "valid_to", "is_deleted", "scd_id", "updated_at"]


def history_of(spark, sf) -> DataFrame:
    snaps = standin.daily_snapshots(spark, sf)
    return H.scd2_from_snapshots(snaps, standin.SNAPSHOT_KEY, "snapshot_at", standin.SNAPSHOT_CHECK_COLUMNS,
                                 standin.snapshot_days(spark, sf)).select(*HIST_COLS)


@register("scd2_build", O.with_ctes(["history"], "SELECT * FROM history"))
def q_scd2_build(spark, sf):
    """Whole history from 30 daily snapshots in one job (SCD-3)."""
    return history_of(spark, sf)


@register("scd2_apply", O.with_ctes(["history"], "SELECT * FROM history"))
def q_scd2_apply(spark, sf):
    """History of all but the last snapshot, then the last snapshot applied
    incrementally (SCD-1); equals the one-job rebuild."""
    snaps, days = standin.daily_snapshots(spark, sf), standin.snapshot_days(spark, sf)
    last = days.agg(F.max("snapshot_at")).first()[0]
    earlier = F.col("snapshot_at") < F.lit(last)
    before = H.scd2_from_snapshots(snaps.filter(earlier), standin.SNAPSHOT_KEY, "snapshot_at",
                                   standin.SNAPSHOT_CHECK_COLUMNS, days.filter(earlier)).select(*HIST_COLS)
    newest = snaps.filter(F.col("snapshot_at") == F.lit(last)).drop("snapshot_at")
    return H.scd2_apply(before, newest, standin.SNAPSHOT_KEY, standin.SNAPSHOT_CHECK_COLUMNS,
                        last).select(*HIST_COLS)


@register("scd2_late", O.with_ctes(["history"], "SELECT * FROM history"))
def q_scd2_late(spark, sf):
    """History of all but the tenth and the first snapshot, into which first
    the tenth and then the first come late; equals the rebuild in order."""
    from access_lake.operators import history_late as L
    snaps, days = standin.daily_snapshots(spark, sf), standin.snapshot_days(spark, sf)
    every = sorted(r[0] for r in days.distinct().collect())  # one per run
    late = [every[min(9, len(every) - 1)], every[0]]
    known = [t for t in every if t not in late]
    in_order = F.col("snapshot_at").isin(known)
    hist = H.scd2_from_snapshots(snaps.filter(in_order), standin.SNAPSHOT_KEY, "snapshot_at",
                                 standin.SNAPSHOT_CHECK_COLUMNS, days.filter(in_order)).select(*HIST_COLS)

    def of(t):
        return None if t is None else snaps.filter(F.col("snapshot_at") == F.lit(t)).drop("snapshot_at")

    for t in dict.fromkeys(late):
        before, after = L.neighbours(known, t)
        hist = written(spark, L.scd2_insert(hist, of(t), of(after), standin.SNAPSHOT_KEY, standin.SNAPSHOT_CHECK_COLUMNS, t, before, after)
                       .select(*HIST_COLS), "late")
        known = sorted([*known, t])
    return hist


LOG_RUNS = 4


def _log_runs(spark, sf):
    """The last days of the snapshots: the history before them, and each."""
    snaps, days = standin.daily_snapshots(spark, sf), standin.snapshot_days(spark, sf)
    every = sorted(r[0] for r in days.distinct().collect())  # one per run
    return snaps, every[-LOG_RUNS:]


@register("scd2_log", O.with_ctes(["snapshots"], """
, recent AS (SELECT * FROM snapshots WHERE snapshot_at IN (SELECT DISTINCT snapshot_at FROM snapshots ORDER BY 1 DESC LIMIT 4)),
""" + O.history_sql("recent", "recent_history") + " SELECT * FROM recent_history"))
def q_scd2_log(spark, sf):
    """Four runs into the append-only history log, the third one retried;
    the history read back from the logs (SCD-1, SCD-2)."""
    from access_lake.operators.history_log import HistoryLog
    snaps, runs = _log_runs(spark, sf)
    data = snaps.select(*SNAP_COLS).schema
    log = HistoryLog(spark, work_dir(spark, "history-log"), standin.SNAPSHOT_KEY, standin.SNAPSHOT_CHECK_COLUMNS, data)
    for k, t in enumerate(runs):
        for _ in range(2 if k == 2 else 1):
            log.apply(snaps.filter(F.col("snapshot_at") == F.lit(t)).select(*SNAP_COLS), t)
    return log.history().select(*HIST_COLS)


_AS_OF_TIMES = "SELECT DISTINCT date_trunc('day', snapshot_at) + INTERVAL 36 HOUR AS at FROM snapshots"


@register("scd2_as_of_many", O.with_ctes(["history"], f"""
SELECT t.at, h.event_type, h.is_high, CAST(count(*) AS BIGINT) AS open_count
FROM history h JOIN ({_AS_OF_TIMES}) t ON h.valid_from <= t.at AND (h.valid_to IS NULL OR t.at < h.valid_to)
GROUP BY ALL"""))
def q_scd2_as_of_many(spark, sf):
    """Open versions per event type and flag at noon of every day after a
    snapshot, all times and groups in one pass (SCD-5, SCD-7)."""
    from access_lake.operators.asof import counts_as_of
    times = standin.snapshot_days(spark, sf).select((F.date_trunc("day", "snapshot_at").cast("timestamp_ntz") + F.expr("INTERVAL 36 HOURS")).alias("at"))
    return counts_as_of(history_of(spark, sf), times, ["event_type", "is_high"])


@register("scd2_current", O.with_ctes(["history"], "SELECT * FROM history WHERE valid_to IS NULL"))
def q_scd2_current(spark, sf):
    return H.current(history_of(spark, sf))


AS_OF = "2024-01-15 12:00:00"


@register("scd2_as_of", O.with_ctes(["history"], f"""
SELECT * FROM history WHERE valid_from <= TIMESTAMP '{AS_OF}'
  AND (valid_to IS NULL OR TIMESTAMP '{AS_OF}' < valid_to)"""))
def q_scd2_as_of(spark, sf):
    return H.as_of(history_of(spark, sf), AS_OF)


PERIOD = ("2024-01-08 00:00:00", "2024-01-21 00:00:00")


@register("flag_transitions", O.with_ctes(["history"], f"""
SELECT user_id, valid_from AS changed_at, prev_is_high, is_high,
       CASE WHEN is_high THEN 'gained' ELSE 'lost' END AS change
FROM {O.previous_sql('history', 'user_id', 'is_high')}
WHERE valid_from BETWEEN TIMESTAMP '{PERIOD[0]}' AND TIMESTAMP '{PERIOD[1]}'
  AND coalesce(prev_is_high, false) <> coalesce(is_high, false)"""))
def q_flag_transitions(spark, sf):
    return H.flag_transitions(history_of(spark, sf), "user_id", "is_high", *PERIOD)


@register("type_transitions", O.with_ctes(["history"], f"""
SELECT user_id, valid_from AS changed_at, prev_event_type, event_type
FROM {O.previous_sql('history', 'user_id', 'event_type')}
WHERE prev_event_type = 'view' AND event_type = 'purchase'"""))
def q_type_transitions(spark, sf):
    return H.type_transitions(history_of(spark, sf), "user_id", "event_type", "view", "purchase")


@register("first_seen", O.with_ctes(["history"], """
SELECT user_id, min(valid_from) AS first_seen FROM history GROUP BY user_id"""))
def q_first_seen(spark, sf):
    return H.first_seen(history_of(spark, sf), "user_id")


@register("count_over_time", O.with_ctes(["history"], """
, spine AS (SELECT valid_from AS changed_at FROM history
            UNION SELECT valid_to FROM history WHERE valid_to IS NOT NULL),
deltas AS (
  SELECT changed_at, sum(d) AS d FROM (
    SELECT valid_from AS changed_at, 1 AS d FROM history WHERE event_type = 'purchase'
    UNION ALL
    SELECT valid_to, -1 FROM history WHERE event_type = 'purchase' AND valid_to IS NOT NULL) x
  GROUP BY changed_at)
SELECT s.changed_at,
       CAST(sum(coalesce(d.d, 0)) OVER (ORDER BY s.changed_at ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
            AS BIGINT) AS open_count
FROM spine s LEFT JOIN deltas d ON s.changed_at = d.changed_at"""))
def q_count_over_time(spark, sf):
    return H.count_over_time(history_of(spark, sf), "event_type", "purchase")


@register("net_change", O.with_ctes(["history"], f"""
SELECT coalesce(a.event_type, b.event_type) AS event_type,
       coalesce(a.n, 0) AS count_start, coalesce(b.n, 0) AS count_end,
       coalesce(b.n, 0) - coalesce(a.n, 0) AS net_change
FROM (SELECT event_type, count(*) AS n FROM history
      WHERE valid_from <= TIMESTAMP '{PERIOD[0]}' AND (valid_to IS NULL OR TIMESTAMP '{PERIOD[0]}' < valid_to)
      GROUP BY event_type) a
FULL OUTER JOIN
     (SELECT event_type, count(*) AS n FROM history
      WHERE valid_from <= TIMESTAMP '{PERIOD[1]}' AND (valid_to IS NULL OR TIMESTAMP '{PERIOD[1]}' < valid_to)
      GROUP BY event_type) b
ON a.event_type = b.event_type"""))
def q_net_change(spark, sf):
    return H.net_change(history_of(spark, sf), "event_type", *PERIOD)


# ------------------------------------------------------------ facility history

FACILITY_HISTORY_COLS = ["facility_id", *O.FACILITY_HISTORY_DATA, *H.VERSION_COLUMNS]


def facility_history_of(spark, sf) -> DataFrame:
    return H.scd2_from_snapshots(standin.facility_months(spark, sf), fixed.HISTORY_KEY, "snapshot_at",
                                 fixed.HISTORY_CHECK_COLUMNS,
                                 standin.facility_month_times(spark, sf)).select(*FACILITY_HISTORY_COLS)


@register("facility_history", O.with_ctes(["facility_history"],
          f"SELECT {', '.join(FACILITY_HISTORY_COLS)} FROM facility_history"))
def q_facility_history(spark, sf):
    """All versions over the product's 12 check columns, from every month's
    landing; facilities leave and return, one flag is NULL at times (MDL-8)."""
    return facility_history_of(spark, sf)


@register("facility_history_step", O.with_ctes(["facility_history"],
          f"SELECT {', '.join(FACILITY_HISTORY_COLS)} FROM facility_history"))
def q_facility_history_step(spark, sf):
    """The same history, its last month applied by the product's monthly
    step instead (SCD-1, SCD-2, MDL-8)."""
    snaps, times = standin.facility_months(spark, sf), standin.facility_month_times(spark, sf)
    last = times.agg(F.max("snapshot_at")).first()[0]
    earlier = F.col("snapshot_at") < F.lit(last)
    before = H.scd2_from_snapshots(snaps.filter(earlier), fixed.HISTORY_KEY, "snapshot_at",
                                   fixed.HISTORY_CHECK_COLUMNS, times.filter(earlier))
    newest = snaps.filter(F.col("snapshot_at") == F.lit(last)).drop("snapshot_at")
    return H.scd2_facilities(before, newest, last).select(*FACILITY_HISTORY_COLS)


@register("facility_current", O.with_ctes(["facility_history"], f"""
SELECT {', '.join(FACILITY_HISTORY_COLS)} FROM facility_history WHERE valid_to IS NULL"""))
def q_facility_current(spark, sf):
    return H.current(facility_history_of(spark, sf))


@register("profile_from_changes", O.with_ctes(["facility_months"], f"""
, three AS (SELECT * REPLACE ({O.TYPE_CASE} AS facility_type) FROM facility_months
            WHERE snapshot_at IN (SELECT DISTINCT snapshot_at FROM facility_months ORDER BY 1 DESC LIMIT 3))
SELECT snapshot_at, county_name, count(*) AS total_facilities,
       {O.cnt("facility_type = 'Hospital'")} AS hospital_count, {O.cnt("facility_type = 'Health Centre'")} AS health_centre_count,
       {O.cnt("facility_type = 'Dispensary'")} AS dispensary_count, {O.cnt("facility_type = 'Clinic'")} AS clinic_count,
       {O.cnt("has_maternity")} AS maternity_count, {O.cnt("has_art")} AS art_count, {O.cnt("has_tb")} AS tb_count,
       {O.cnt("has_emergency")} AS emergency_count, {O.cnt("has_outpatient")} AS outpatient_count,
       CAST(sum(CASE facility_type WHEN 'Hospital' THEN 4 WHEN 'Health Centre' THEN 2 ELSE 1 END) AS BIGINT) AS weighted_score
FROM three GROUP BY snapshot_at, county_name"""))
def q_profile_from_changes(spark, sf):
    """Area profiles of the last three months, each from the one before and
    the versions that the month opened and closed (AGG-1..7); equal to
    counting each month's facilities anew."""
    from access_lake.operators.history_log import HistoryLog
    from access_lake.plans import increments
    snaps = standin.facility_months(spark, sf).withColumn("facility_type", T.classify("facility_type", standin.STANDIN_TYPE_RULES))
    times = standin.facility_month_times(spark, sf)
    last = sorted(r[0] for r in times.distinct().collect())[-3:]  # one per run
    data = snaps.drop("snapshot_at").schema
    log, base = HistoryLog(spark, work_dir(spark, "months-log"), fixed.HISTORY_KEY, fixed.HISTORY_CHECK_COLUMNS, data), work_dir(spark, "profiles")
    profile = None
    for t in last:
        now = increments.step(log, profile, snaps.filter(F.col("snapshot_at") == F.lit(t)).drop("snapshot_at"), t)
        path = f"{base}/{log.run_name(t)}"
        now.withColumn("snapshot_at", F.lit(t)).write.parquet(path)
        profile = spark.read.parquet(path)
    return spark.read.parquet(*[f"{base}/{log.run_name(t)}" for t in last])


FACILITY_AS_OF = "1996-06-15 00:00:00"
FACILITY_PERIOD = ("1995-01-01 00:00:00", "1997-12-31 00:00:00")


@register("facility_as_of", O.with_ctes(["facility_history"], f"""
SELECT {', '.join(FACILITY_HISTORY_COLS)} FROM facility_history
WHERE valid_from <= TIMESTAMP '{FACILITY_AS_OF}' AND (valid_to IS NULL OR TIMESTAMP '{FACILITY_AS_OF}' < valid_to)"""))
def q_facility_as_of(spark, sf):
    return H.as_of(facility_history_of(spark, sf), FACILITY_AS_OF)


@register("facility_flag_changes", O.with_ctes(["facility_history"], f"""
SELECT facility_id, valid_from AS changed_at, prev_has_outpatient, has_outpatient,
       CASE WHEN has_outpatient THEN 'gained' ELSE 'lost' END AS change
FROM {O.previous_sql('facility_history', 'facility_id', 'has_outpatient')}
WHERE valid_from BETWEEN TIMESTAMP '{FACILITY_PERIOD[0]}' AND TIMESTAMP '{FACILITY_PERIOD[1]}'
  AND coalesce(prev_has_outpatient, false) <> coalesce(has_outpatient, false)"""))
def q_facility_flag_changes(spark, sf):
    """Outpatient service gained and lost; NULL and false are no change,
    a change across an absence is one (SCD-6)."""
    return H.flag_transitions(facility_history_of(spark, sf), "facility_id", "has_outpatient", *FACILITY_PERIOD)


@register("facility_status_changes", O.with_ctes(["facility_history"], f"""
SELECT facility_id, valid_from AS changed_at, prev_operation_status, operation_status
FROM {O.previous_sql('facility_history', 'facility_id', 'operation_status')}
WHERE prev_operation_status = 'Closed' AND operation_status = 'Operational'"""))
def q_facility_status_changes(spark, sf):
    """Facilities that reopened (SCD-10)."""
    return H.type_transitions(facility_history_of(spark, sf), "facility_id", "operation_status", "Closed", "Operational")


@register("facility_net_change", O.with_ctes(["facility_history"], f"""
SELECT coalesce(a.county_name, b.county_name) AS county_name, coalesce(a.n, 0) AS count_start, coalesce(b.n, 0) AS count_end,
       coalesce(b.n, 0) - coalesce(a.n, 0) AS net_change
FROM (SELECT county_name, count(*) AS n FROM facility_history WHERE valid_from <= TIMESTAMP '{FACILITY_PERIOD[0]}'
        AND (valid_to IS NULL OR TIMESTAMP '{FACILITY_PERIOD[0]}' < valid_to) GROUP BY county_name) a
FULL OUTER JOIN (SELECT county_name, count(*) AS n FROM facility_history WHERE valid_from <= TIMESTAMP '{FACILITY_PERIOD[1]}'
        AND (valid_to IS NULL OR TIMESTAMP '{FACILITY_PERIOD[1]}' < valid_to) GROUP BY county_name) b
ON a.county_name = b.county_name"""))
def q_facility_net_change(spark, sf):
    return H.net_change(facility_history_of(spark, sf), "county_name", *FACILITY_PERIOD)


# ------------------------------------------------------------ data quality


@register("dq_not_null", O.with_ctes(["stg_facilities"], """
SELECT 'stg_facilities' AS model, 'not_null' AS "check", column_name, failures FROM (
  SELECT 'facility_id' AS column_name, CAST(count(*) - count(facility_id) AS BIGINT) AS failures FROM stg_facilities
  UNION ALL SELECT 'facility_code', CAST(count(*) - count(facility_code) AS BIGINT) FROM stg_facilities
  UNION ALL SELECT 'has_outpatient', CAST(count(*) - count(has_outpatient) AS BIGINT) FROM stg_facilities
  UNION ALL SELECT 'sub_county_name', CAST(count(*) - count(sub_county_name) AS BIGINT) FROM stg_facilities) x"""))
def q_dq_not_null(spark, sf):
    return Q.check_not_null(stg_fac(spark, sf),
                            ["facility_id", "facility_code", "has_outpatient", "sub_county_name"],
                            "stg_facilities")


@register("dq_unique", O.with_ctes(["raw_facilities"], """
SELECT facility_id, count(*) AS n FROM raw_facilities WHERE facility_id IS NOT NULL
GROUP BY facility_id HAVING count(*) > 1"""))
def q_dq_unique(spark, sf):
    """Raw facility ids seen more than once (before dedup: many)."""
    return Q.check_unique(standin.raw_facilities(spark, sf), "facility_id")


@register("dq_accepted", O.with_ctes(["stg_facilities"], """
SELECT * FROM stg_facilities
WHERE facility_type NOT IN ('Hospital', 'Health Centre', 'Dispensary', 'Clinic')"""))
def q_dq_accepted(spark, sf):
    """Accepted-values check with 'Other' left out of the set, so the
    failing rows are the unclassified facilities."""
    return Q.check_accepted(stg_fac(spark, sf), "facility_type",
                            ["Hospital", "Health Centre", "Dispensary", "Clinic"])


@register("dq_row_count", O.with_ctes(["density"], """
SELECT count(*) AS row_count FROM density HAVING count(*) <> 47"""))
def q_dq_row_count(spark, sf):
    return Q.check_row_count(q_mart_density(spark, sf), fixed.EXPECTED_AREA_COUNT)


@register("dq_duplicates", O.with_ctes(["stg_facilities"], """
SELECT facility_id, count(*) AS n FROM stg_facilities GROUP BY facility_id HAVING count(*) > 1"""))
def q_dq_duplicates(spark, sf):
    return Q.check_no_duplicates(stg_fac(spark, sf), "facility_id")


@register("unmatched_keys", O.with_ctes(["stg_facilities", "pop_totals"], f"""
SELECT DISTINCT f.county_name AS unmatched_key FROM stg_facilities f
WHERE NOT EXISTS (SELECT 1 FROM pop_totals p WHERE {O.key_sql('p.county_name')} = {O.key_sql('f.county_name')})"""))
def q_unmatched_keys(spark, sf):
    """Areas whose facilities find no population row (JON-5)."""
    areas = stg_fac(spark, sf).select("county_name").distinct()
    return J.unmatched_keys(areas, agg.population_totals(stg_pop(spark, sf)))


def _dq_report_select(areas: int = fixed.EXPECTED_AREA_COUNT) -> str:
    """The 30 checks over the CTEs of the models."""
    from access_lake.plans.quality_suite import MART_NOT_NULL, STAGING_NOT_NULL, UNIQUE
    table = {"stg_facilities": "stg_facilities", "stg_population": "stg_population",
             "stg_geodata": "stg_geodata", "mart_county_density": "density",
             "mart_service_gaps": "gaps", "mart_underserved_counties": "underserved",
             "mart_nairobi_subcounty": "subarea"}
    parts = []
    for model, cols in {**STAGING_NOT_NULL, **MART_NOT_NULL}.items():
        for c in cols:
            parts.append(f"SELECT '{model}' AS model, 'not_null' AS \"check\", '{c}' AS column_name, "
                         f"CAST(count(*) - count({c}) AS BIGINT) AS failures FROM {table[model]}")
    for model, c in UNIQUE:
        parts.append(f"SELECT '{model}', 'unique', '{c}', CAST(count(*) AS BIGINT) FROM "
                     f"(SELECT {c} FROM {table[model]} WHERE {c} IS NOT NULL "
                     f"GROUP BY {c} HAVING count(*) > 1) u")
    parts.append("SELECT 'stg_facilities', 'accepted_values', 'facility_type', CAST(count(*) AS BIGINT) "
                 "FROM stg_facilities WHERE facility_type NOT IN "
                 "('Hospital', 'Health Centre', 'Dispensary', 'Clinic', 'Other')")
    parts.append("SELECT 'stg_facilities', 'no_duplicates', 'facility_id', CAST(count(*) AS BIGINT) FROM "
                 "(SELECT facility_id FROM stg_facilities GROUP BY facility_id HAVING count(*) > 1) d")
    parts.append("SELECT 'mart_county_density', 'row_count', '*', CAST(count(*) AS BIGINT) FROM "
                 f"(SELECT count(*) AS c FROM density HAVING count(*) <> {areas}) r")
    return "\nUNION ALL\n".join(parts)


def _dq_report_sql() -> str:
    return O.with_ctes(["underserved", "subarea", "geodata"], _dq_report_select())


@register("dq_report", _dq_report_sql())
def q_dq_report(spark, sf):
    """All 30 product checks over the stand-in models, one report row each
    (DQ-1..6). Staging is written as a table, as its users are many: one
    deduplication serves its own checks, the area marts and the drill-down."""
    from access_lake.sources import bucketed
    rows, path, buckets = stg_fac(spark, sf), work_dir(spark, "staging"), _facility_buckets(spark, sf)
    bucketed.write_load(rows, path, "facility_id", buckets, dealt=True)  # its keys are then counted without a shuffle
    fac = bucketed.read_loads(spark, path, rows.schema, "facility_id", buckets)
    pop = written(spark, stg_pop(spark, sf), "population")
    profile = written(spark, marts.area_profile(fac), "profile")
    density = written(spark, marts.mart_county_density(None, pop, profile), "density")
    gaps = written(spark, marts.mart_service_gaps(None, pop, profile), "gaps")
    models = {
        "stg_facilities": fac, "stg_population": pop,
        "stg_geodata": staging.stg_geodata(standardise_features(standin.raw_features(spark, sf), GEO_TS)),
        "mart_county_density": density, "mart_service_gaps": gaps,
        "mart_underserved_counties": marts.mart_underserved(density, gaps),
        "mart_nairobi_subcounty": marts.mart_subarea(fac, standin.subarea_seed(spark, sf),
                                                     standin.STANDIN_DRILL_AREA),
    }
    return run_checks(models)


@register("dq_empty", """
SELECT 'mart_county_density' AS model, c."check", c.column_name, CAST(c.failures AS BIGINT) AS failures
FROM (VALUES ('not_null', 'county_name', 0), ('unique', 'county_name', 0), ('row_count', '*', 1)) c("check", column_name, failures)""")
def q_dq_empty(spark, sf):
    """The checks of a mart that came out empty: nothing is NULL or double,
    but the row count must fail (DQ-4)."""
    density = q_mart_density(spark, sf)
    return Q.model_report(density.filter(F.lower("county_name") != F.lower("county_name")), "mart_county_density",
                          ["county_name"], unique="county_name", row_count=fixed.EXPECTED_AREA_COUNT)


@register("dq_gate", f"""
SELECT CAST(count(*) AS BIGINT) AS checks, CAST(count(*) FILTER (WHERE failures > 0) AS BIGINT) AS failed,
       coalesce(string_agg(model || '.' || column_name || ' ' || "check" || ' (' || failures || ')', ', '
                  ORDER BY model || '.' || column_name || ' ' || "check" || ' (' || failures || ')')
                FILTER (WHERE failures > 0), '') AS failures,
       count(*) FILTER (WHERE failures > 0) = 0 AS passed
FROM ({_dq_report_sql()}) r""")
def q_dq_gate(spark, sf):
    """The gate over the 30 checks: the stand-in areas are not 47, so it
    stays shut (DQ-6)."""
    return Q.gate_verdict(q_dq_report(spark, sf))


CHECKED_COLUMNS = ["facility_id", "facility_code", "facility_name", "sub_county_name", "has_outpatient"]
CHECK_SPLIT = "1995-06-01 00:00:00"


def _checked_rows(spark, sf):
    """Two loads of raw facility rows into a check log (the second twice)."""
    from access_lake.operators.quality_log import CheckLog
    raw = standin.raw_facilities(spark, sf)
    log = CheckLog(spark, work_dir(spark, "checks"), "raw_facilities", "facility_id", CHECKED_COLUMNS,
                   ("operation_status", ["Operational", "OPERATIONAL"]), buckets=_facility_buckets(spark, sf))
    early = F.col("ingested_at") < F.lit(CHECK_SPLIT).cast("timestamp_ntz")
    for load, part in (("a", raw.filter(early)), ("b", raw.filter(~early)), ("b", raw.filter(~early))):
        log.add(part, load)
    return log


@register("dq_incremental", O.with_ctes(["raw_facilities"], "\nUNION ALL\n".join(
    [f"""SELECT 'raw_facilities' AS model, 'not_null' AS "check", '{c}' AS column_name, CAST(count(*) FILTER (WHERE {c} IS NULL) AS BIGINT) AS failures
FROM raw_facilities""" for c in CHECKED_COLUMNS] +
    [f"""SELECT 'raw_facilities', '{chk}', 'facility_id', CAST(count(*) AS BIGINT)
FROM (SELECT facility_id FROM raw_facilities GROUP BY facility_id HAVING count(*) > 1)""" for chk in ("unique", "no_duplicates")] +
    ["""SELECT 'raw_facilities', 'accepted_values', 'operation_status', CAST(count(*) AS BIGINT)
FROM raw_facilities WHERE operation_status NOT IN ('Operational', 'OPERATIONAL')"""])))
def q_dq_incremental(spark, sf):
    """The checks of the raw rows from the states of two loads, the second
    checked twice; equal to checking all rows at once (DQ-2, DQ-5, DQ-6)."""
    return _checked_rows(spark, sf).report()


@register("dq_failing_keys", O.with_ctes(["raw_facilities"], f"""
SELECT facility_id, CAST(count(*) AS BIGINT) AS rows, CAST(sum({' + '.join(f"CASE WHEN {c} IS NULL THEN 1 ELSE 0 END" for c in CHECKED_COLUMNS)}
       + CASE WHEN operation_status NOT IN ('Operational', 'OPERATIONAL') THEN 1 ELSE 0 END) AS BIGINT) AS failures
FROM raw_facilities GROUP BY facility_id HAVING rows > 1 OR failures > 0"""))
def q_dq_failing_keys(spark, sf):
    """Keys of the raw rows that fail a check, duplicates among them."""
    return _checked_rows(spark, sf).failing_keys()


# ------------------------------------------------------------ dashboards
@register("dash_density", O.with_ctes(["density"], """
SELECT county_name, avg(facilities_per_10k) AS avg_facilities_per_10k FROM density GROUP BY county_name"""))
def q_dash_density(spark, sf):
    return D.dash_density(q_mart_density(spark, sf))


@register("dash_ranking", O.with_ctes(["underserved"], """
SELECT underserved_rank, county_name, severity_score, facilities_per_10k, total_population,
       maternity_gap_flag, art_gap_flag, tb_gap_flag, no_emergency_flag, facilities_needed_to_baseline,
       CASE severity_score WHEN 3 THEN 'critical' WHEN 2 THEN 'high' END AS severity_label
FROM underserved"""))
def q_dash_ranking(spark, sf):
    return D.dash_ranking(q_mart_underserved(spark, sf))


@register("dash_maternity", O.with_ctes(["gaps"], """
SELECT county_name, avg(maternity_per_100k) AS avg_maternity_per_100k FROM gaps GROUP BY county_name"""))
def q_dash_maternity(spark, sf):
    return D.dash_maternity(q_mart_gaps(spark, sf))


@register("dash_services", O.with_ctes(["gaps"], """
SELECT county_name, avg(tb_count) AS avg_tb_count, avg(maternity_per_100k) AS avg_maternity_per_100k,
       avg(art_per_100k) AS avg_art_per_100k, avg(emergency_per_100k) AS avg_emergency_per_100k
FROM gaps GROUP BY county_name"""))
def q_dash_services(spark, sf):
    return D.dash_services(q_mart_gaps(spark, sf))


@register("dash_services_long", O.with_ctes(["gaps"], """
, wide AS (SELECT county_name, avg(tb_count) AS avg_tb_count, avg(maternity_per_100k) AS avg_maternity_per_100k,
       avg(art_per_100k) AS avg_art_per_100k, avg(emergency_per_100k) AS avg_emergency_per_100k
  FROM gaps GROUP BY county_name)
SELECT county_name, 'avg_tb_count' AS metric, avg_tb_count AS value FROM wide
UNION ALL SELECT county_name, 'avg_maternity_per_100k', avg_maternity_per_100k FROM wide
UNION ALL SELECT county_name, 'avg_art_per_100k', avg_art_per_100k FROM wide
UNION ALL SELECT county_name, 'avg_emergency_per_100k', avg_emergency_per_100k FROM wide"""))
def q_dash_services_long(spark, sf):
    return D.dash_services(q_mart_gaps(spark, sf), long=True)


@register("dash_subarea_density", O.with_ctes(["subarea"], """
SELECT sub_county_name, avg(facilities_per_10k) AS avg_facilities_per_10k FROM subarea GROUP BY sub_county_name"""))
def q_dash_subarea_density(spark, sf):
    return D.dash_subarea_density(q_mart_subarea(spark, sf))


@register("dash_subarea_services", O.with_ctes(["subarea"], """
SELECT sub_county_name, total_facilities, population_2024, facilities_per_10k, maternity_count,
       art_count, emergency_count, subcounty_density_rank FROM subarea"""))
def q_dash_subarea_services(spark, sf):
    return D.dash_subarea_services(q_mart_subarea(spark, sf))


@register("dash_area_count", O.with_ctes(["density"], "SELECT count(*) AS areas_mapped FROM density"))
def q_dash_area_count(spark, sf):
    return D.dash_area_count(q_mart_density(spark, sf))


@register("dash_features", O.with_ctes(["density", "geodata"], """
SELECT g.county_name, d.facilities_per_10k,
       CASE WHEN d.facilities_per_10k IS NULL THEN NULL
            WHEN d.facilities_per_10k < 1.8 THEN 0 WHEN d.facilities_per_10k < 2.7 THEN 1
            WHEN d.facilities_per_10k < 3.5 THEN 2 WHEN d.facilities_per_10k < 4.4 THEN 3 ELSE 4 END AS density_band,
       '{"type":"Feature","geometry":' || g.geometry || ',"properties":'
         || to_json({'county_name': g.county_name, 'facilities_per_10k': d.facilities_per_10k}) || '}' AS feature
FROM stg_geodata g JOIN density d
  ON lower(d.county_name) = CASE lower(g.county_name)
        WHEN 'elegeyo-marakwet' THEN 'elgeyo marakwet'
        WHEN 'murang''a' THEN 'muranga'
        WHEN 'tharaka - nithi' THEN 'tharaka nithi'
        ELSE regexp_replace(regexp_replace(lower(g.county_name), '\\s*-\\s*', ' ', 'g'), '''', '', 'g') END"""))
def q_dash_features(spark, sf):
    geo = staging.stg_geodata(standardise_features(standin.raw_features(spark, sf), GEO_TS))
    return D.dash_features(geo, q_mart_density(spark, sf))


@register("top_k_underserved", O.with_ctes(["underserved"], """
SELECT underserved_rank, county_name, severity_score, facilities_per_10k, total_population,
       maternity_gap_flag, art_gap_flag, tb_gap_flag, no_emergency_flag, facilities_needed_to_baseline
FROM underserved ORDER BY underserved_rank LIMIT 5"""))
def q_top_k_underserved(spark, sf):
    """The five most under-served areas (SRT-4): the limit is the feature."""
    return D.top_underserved(q_mart_underserved(spark, sf), 5)


@register("global_row_number", f"""
SELECT {', '.join(LI_COLS)},
       CAST(row_number() OVER (ORDER BY l_shipdate, l_orderkey, l_linenumber, {LI_TIE}) AS BIGINT) AS row_number
FROM lineitem""")
def q_global_row_number(spark, sf):
    """Row number over all lineitems by ship date at row grain (WIN-5),
    without a single-partition window."""
    from access_lake.operators.ranking import global_row_number
    li = standin.table(spark, sf, "lineitem")
    order = total_order(li, [F.asc_nulls_last("l_shipdate"), F.asc_nulls_last("l_orderkey"),
                             F.asc_nulls_last("l_linenumber")],
                        exclude=["l_shipdate", "l_orderkey", "l_linenumber"])
    return global_row_number(li, order, "row_number", staged=False)


_RAW_TIES = "ingested_at DESC NULLS LAST, " + ", ".join(f"{c} ASC NULLS LAST" for c in staging.STG_FACILITY_COLUMNS if c != "ingested_at")


@register("facility_row_number", O.with_ctes(["raw_facilities"], f"""
SELECT facility_id, county_name, ingested_at, CAST(row_number() OVER (ORDER BY {_RAW_TIES}) AS BIGINT) AS row_number
FROM raw_facilities"""))
def q_facility_row_number(spark, sf):
    """Row number over the joined facility rows, newest landing first
    (WIN-5 on an input that is no plain scan)."""
    from access_lake.operators.ranking import global_row_number
    raw = standin.raw_facilities(spark, sf).select(*staging.STG_FACILITY_COLUMNS)
    order = [F.desc_nulls_last("ingested_at")] + [F.asc_nulls_last(c) for c in staging.STG_FACILITY_COLUMNS if c != "ingested_at"]
    return global_row_number(raw, order).select("facility_id", "county_name", "ingested_at", "row_number")


# ------------------------------------------------------------ registry standardisation

REG_TS = "2025-05-01 02:00:00"
REG_COLS = [f.name for f in S.FACILITY_RECORD.fields]


def _registry_records(extra: str = "") -> str:
    """The 43-field records of the stand-in registry, as CTE ``records``."""
    svc = [("has_maternity", "Maternity Services"), ("has_art", "ART"), ("has_tb", "TB Screening"),
           ("has_emergency", "Emergency"), ("has_outpatient", "Out-patient")]
    lst = "list_filter([" + ", ".join(f"CASE WHEN {f} THEN '{n}' END" for f, n in svc) + "], lambda x: x IS NOT NULL)"
    first = "coalesce(" + ", ".join(f"CASE WHEN {f} THEN '{n}' END" for f, n in svc) + ")"
    columns = {c: "''" for c in ["official_name", "registration_number", "keph_level", "facility_type",
                                 "facility_type_category", "owner", "owner_type", "regulatory_body",
                                 "constituency_name", "admission_status"]}
    columns |= {c: "false" for c in ["open_whole_day", "open_weekends", "open_public_holidays", "open_late_night",
                                     "closed", "is_published"]}
    columns |= {c: c for c in ["facility_id", "facility_name", "county_name", "sub_county_name", "ward_name",
                               "latitude", "operation_status"]}
    for name, kws in fixed.SERVICE_KEYWORDS.items():
        conds = " OR ".join(f"contains(lower(array_to_string(svc, ' ')), '{k}')" for k in kws)
        columns[name] = f"coalesce({conds}, false)"
    longitude = "(CASE WHEN line = 3 THEN CAST(0 AS DOUBLE) ELSE longitude END)"
    columns |= {
        "facility_code": "coalesce(facility_code, '')", "longitude": longitude,
        "has_gps": f"latitude <> 0 AND {longitude} <> 0", "beds": "CAST(trunc(longitude / 1000) AS INTEGER)",
        "cots": "0", "service_names": "array_to_string(svc, '|')", "infrastructure": "array_to_string(infra, '|')",
        "has_electricity": "len(list_filter(infra, lambda x: contains(lower(x), 'grid') OR contains(lower(x), 'solar') "
                           "OR contains(lower(x), 'electric'))) > 0",
        "has_water": "len(list_filter(infra, lambda x: contains(lower(x), 'water'))) > 0",
        "source": "'registry'", "ingested_at": f"TIMESTAMP '{REG_TS}'"}
    select = ",\n       ".join(f"{columns[c]} AS {c}" for c in REG_COLS)
    return f"""
, reg AS (
  SELECT r.*, CAST(split_part(facility_id, '-', 2) AS INTEGER) AS line,
         CASE WHEN CAST(split_part(facility_id, '-', 2) AS INTEGER) = 1
              THEN CASE WHEN {first} IS NULL THEN [] ELSE [{first}] END
              ELSE {lst} END AS svc,
         CASE WHEN latitude > 5000 THEN ['Grid power', 'Piped Water']
              WHEN latitude > 0 THEN ['Solar'] ELSE [] END AS infra
  FROM raw_facilities r),
records AS (
SELECT {select}{extra}
FROM reg)"""


@register("registry_standardise", O.with_ctes(["raw_facilities"], _registry_records() + " SELECT * FROM records"))
def q_registry_standardise(spark, sf):
    """Registry results → the 43-field facility records (STD-1..10):
    trimming, safe numbers, array-or-string services, keyword flags,
    flattening, infrastructure flags."""
    return standardise_registry(standin.registry_results(spark, sf), REG_TS).select(*REG_COLS)


# ------------------------------------------------------------ files

PAGE_RESULTS, FILE_PAGES = 100, 250


def write_pages(results: DataFrame, path: str) -> None:
    """Registry results as page files, one JSON page of about 100 results a
    line, as the registry's pages are. A task puts its own results into
    pages as they come, so nothing is shuffled; the files are compressed,
    and hold at most ``FILE_PAGES`` pages, as they do not split."""
    import pyarrow as pa
    import pyarrow.compute as pc

    def pages(batches):
        for batch in batches:
            rows = batch.column(0)
            parts = pa.ListArray.from_arrays(pa.array([*range(0, len(rows), PAGE_RESULTS), len(rows)], pa.int32()), rows)
            texts = pc.binary_join_element_wise('{"count":', pc.list_value_length(parts).cast("string"), ',"total_pages":1,"results":[',
                                                pc.binary_join(parts, ","), "]}", "")
            yield pa.RecordBatch.from_arrays([texts], ["value"])

    rows = results.select(F.to_json(F.struct(*results.columns)).alias("value"))
    (rows.mapInArrow(pages, "value string").write.options(**IO.FAST_GZIP)
         .option("maxRecordsPerFile", FILE_PAGES).text(path))


def write_feature_lines(features: DataFrame, path: str) -> None:
    """Features as line-delimited GeoJSON in the order of ``pos``."""
    props = F.to_json(F.struct(*[c for c in features.columns if c not in ("pos", "geometry")]))
    value = F.concat(F.lit('{"type":"Feature","properties":'), props, F.lit(',"geometry":'),
                     F.coalesce("geometry", F.lit("null")), F.lit("}"))
    features.repartitionByRange(4, "pos").sortWithinPartitions("pos").select(value.alias("value")).write.text(path)


@register("registry_pages", O.with_ctes(["raw_facilities"], _registry_records() + " SELECT * FROM records"))
def q_registry_pages(spark, sf):
    """The registry's results written as page files, read back by the page
    reader and standardised (SRC-1)."""
    path = work_dir(spark, "pages")
    write_pages(standin.registry_results(spark, sf), path)
    return standardise_registry(IO.read_registry_pages(spark, path), REG_TS).select(*REG_COLS)


#: JSON values as payloads spell them, and whether they count as set
JSON_FLAGS = [("true", True), ("false", False), ('"false"', True), ('" "', True), ('""', False), ("0", False), ("0.0", False),
              ("1e-3", True), ('"0"', True), ("null", False), ("[]", False), ("[0]", True), ("{}", False), ('{"on":false}', True)]


@register("registry_flags", "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS facility_id, v.b AS closed, o.b AS open_weekends\n"
          "FROM lineitem JOIN (VALUES " + ", ".join(f"({k}, {b})" for k, (_, b) in enumerate(JSON_FLAGS)) + f") v(k, b) ON l_orderkey % {len(JSON_FLAGS)} = v.k\n"
          "JOIN (VALUES " + ", ".join(f"({k}, {b})" for k, (_, b) in enumerate(JSON_FLAGS)) + f") o(k, b) ON (l_orderkey + l_linenumber) % {len(JSON_FLAGS)} = o.k")
def q_registry_flags(spark, sf):
    """Flags of every JSON type in page files, read with their types and
    standardised: a text "false" is set, a false is not (SRC-1, STD-5)."""
    path = work_dir(spark, "pages")
    raw = F.array(*[F.lit(v) for v, _ in JSON_FLAGS])

    def value(at):
        return F.get(raw, F.pmod(at, F.lit(len(JSON_FLAGS))).cast("int"))

    key, line = F.col("l_orderkey"), F.col("l_linenumber")
    facility = F.concat(F.lit('{"id":"'), key.cast("string"), F.lit("-"), line.cast("string"), F.lit('","closed":'), value(key),
                        F.lit(',"open_weekends":'), value(key + line), F.lit("}"))
    page = F.concat(F.lit('{"count":1,"total_pages":1,"results":['), facility, F.lit("]}"))
    standin.table(spark, sf, "lineitem").select(page.alias("value")).write.text(path)
    return standardise_registry(IO.read_registry_pages(spark, path), REG_TS).select("facility_id", "closed", "open_weekends")


@register("census_csv", O.CENSUS_SQL)
def q_census_csv(spark, sf):
    """Census rows written as CSV with their drifting headers, read back and
    standardised (SRC-2)."""
    path = work_dir(spark, "census")
    standin.census_rows(spark, sf).write.option("header", True).csv(path)
    return standardise_census(IO.read_census_csv(spark, path), standin.STANDIN_CENSUS_TS)


@register("features_file", O.with_ctes(["geodata"], "SELECT * FROM geodata"))
def q_features_file(spark, sf):
    """Boundary features written as files of GeoJSON lines, read back in
    file order and rolled up (SRC-3, AGG-11)."""
    path = work_dir(spark, "features")
    write_feature_lines(standin.raw_features(spark, sf), path)
    return standardise_features(IO.read_feature_lines(spark, path), GEO_TS)


def write_collection(features: DataFrame, path: str) -> None:
    """Features, in the order of ``pos``, as one FeatureCollection file."""
    props = F.to_json(F.struct(*[c for c in features.columns if c not in ("pos", "geometry")]))
    value = F.concat(F.lit('{ "type": "Feature", "properties":'), props, F.lit(',"geometry":'), F.coalesce("geometry", F.lit("null")), F.lit("}"))
    rows = features.select(F.lit(1).alias("part"), "pos", F.concat(value, F.lit(",")).alias("value"))
    last = rows.agg(F.max("pos")).first()[0]
    rows = rows.withColumn("value", F.when(F.col("pos") == F.lit(last), F.rtrim(F.col("value"), F.lit(","))).otherwise(F.col("value")))
    ends = features.sparkSession.createDataFrame([(0, '{"type":"FeatureCollection","name":"areas","features":['), (2, "]}")], "part int, value string")
    (rows.unionByName(ends, allowMissingColumns=True).repartition(1).sortWithinPartitions("part", "pos").select("value").write.text(path))


@register("feature_collection", O.with_ctes(["geodata"], "SELECT * FROM geodata"))
def q_feature_collection(spark, sf):
    """All boundary features in one FeatureCollection file, read back in
    byte ranges and rolled up in file order (SRC-3, AGG-11)."""
    path = work_dir(spark, "collection")
    write_collection(standin.raw_features(spark, sf), path)
    return standardise_features(IO.read_feature_collection(spark, path), GEO_TS)


@register("seed_csv", O.with_ctes(["seed"], """
SELECT *, CAST(round(population_2019 * pow(1 + growth_rate, projection_year - census_year)) AS BIGINT) AS projected
FROM seed"""))
def q_seed_csv(spark, sf):
    """The seed dimension written as CSV and read back with fixed types
    (SRC-6, MDL-9)."""
    path = work_dir(spark, "seed")
    standin.subarea_seed(spark, sf).write.option("header", True).csv(path)
    seed = IO.read_seed(spark, path)
    return seed.withColumn("projected", N.project_population("population_2019", "growth_rate",
                                                             F.col("projection_year") - F.col("census_year")))


@register("landing_registry", O.with_ctes(["raw_facilities"], _registry_records() + """
SELECT *, '2025' AS year, '05' AS month, '01' AS day FROM records"""))
def q_landing_registry(spark, sf):
    """Every standardised registry record landed twice on one day (the
    second landing replaces the first), ingested after each landing and read
    from the raw table (SNK-1, SRC-4, SRC-5)."""
    from access_lake.streaming.landing_ingest import ingest_landing
    base = work_dir(spark, "landing")
    recs = standardise_registry(standin.registry_results(spark, sf), REG_TS).select(*REG_COLS)
    for version in (recs.withColumn("beds", F.col("beds") + 1), recs):
        IO.land(version, f"{base}/landing", "facilities", _dt(2025, 5, 1))
        ingest_landing(spark, f"{base}/landing", "facilities", f"{base}/raw", f"{base}/checkpoint")
    return IO.raw_table(spark, f"{base}/raw", schema=S.with_partitions(S.FACILITY_RECORD))


@register("load_report", O.with_ctes(["raw_facilities"], _registry_records() + """
SELECT 'facilities' AS dataset, 'year=2025/month=05/day=01' AS partition, CAST(count(*) AS BIGINT) AS record_count,
       '2025-05-01T00:00:00' AS ingested_at, NULL::VARCHAR AS refused FROM records
UNION ALL SELECT 'facilities', NULL, 0, NULL, 'No records to land for dataset ' || chr(39) || 'facilities' || chr(39)"""))
def q_load_report(spark, sf):
    """The load report of all registry records, counted by the write itself,
    and the refusal of an empty load (SNK-2, SNK-3)."""
    root = work_dir(spark, "landing")
    recs = standardise_registry(standin.registry_results(spark, sf), REG_TS).select(*REG_COLS)
    done = IO.land(recs, root, "facilities", _dt(2025, 5, 1))
    rows = [(done.dataset, done.uri.split("/facilities/")[1], done.record_count, done.ingested_at, None)]
    try:
        IO.land(recs.filter(F.col("facility_id").isNull()), root, "facilities", _dt(2025, 5, 2))
    except ValueError as e:
        rows.append(("facilities", None, 0, None, str(e)))
    return spark.createDataFrame(rows, "dataset string, partition string, record_count bigint, ingested_at string, refused string")


@register("raw_point_in_time", O.with_ctes(["raw_facilities"], _registry_records() + """
SELECT 'first' AS state, * REPLACE (beds + 1 AS beds), '2025' AS year, '05' AS month, '01' AS day FROM records
UNION ALL SELECT 'second', *, '2025', '05', '01' FROM records"""))
def q_raw_point_in_time(spark, sf):
    """Every registry record landed on one day, loaded, landed again and
    loaded again; the raw table as of each load time (SRC-8, SRC-5)."""
    from access_lake.streaming.landing_ingest import ingest_landing
    base = work_dir(spark, "loads")
    recs = standardise_registry(standin.registry_results(spark, sf), REG_TS).select(*REG_COLS)
    times = [_dt(2025, 5, 1, 3), _dt(2025, 5, 20)]
    for version, t in zip((recs.withColumn("beds", F.col("beds") + 1), recs), times):
        IO.land(version, f"{base}/landing", "facilities", _dt(2025, 5, 1))
        ingest_landing(spark, f"{base}/landing", "facilities", f"{base}/raw", f"{base}/checkpoint", loaded_at=t)
    states = [IO.read_raw_as_of(spark, f"{base}/raw", S.FACILITY_RECORD, _date(2025, 5, 31), t)
                .select(F.lit(name).alias("state"), *REG_COLS, "year", "month", "day") for name, t in zip(("first", "second"), times)]
    return states[0].unionByName(states[1])


# ------------------------------------------------------------ the monthly batch

MONTHS = [_dt(2025, 1, 1, 2), _dt(2025, 2, 1, 2)]
MONTH_SPLIT = "1995-06-01 00:00:00"
_TIES = ", ".join(f"{c} ASC NULLS LAST" for c in staging.STG_FACILITY_COLUMNS if c not in ("facility_id", "ingested_at"))
_CHANGED = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in fixed.HISTORY_CHECK_COLUMNS)
_FAC = ", ".join(staging.STG_FACILITY_COLUMNS)


def _month_sql() -> str:
    stage = f"""SELECT {_FAC} FROM (
  SELECT * REPLACE (%s AS ingested_at, CASE WHEN lower(facility_type) LIKE '%%hospital%%' THEN 'Hospital' ELSE 'Other' END AS facility_type),
         row_number() OVER (PARTITION BY facility_id ORDER BY %s DESC, {_TIES}) AS rn
  FROM records WHERE lower(operation_status) = 'operational' AND %s) t WHERE rn = 1"""
    m1, m2 = (f"TIMESTAMP '{m}'" for m in MONTHS)
    early = f"shipped < TIMESTAMP '{MONTH_SPLIT}'"
    landed = f"CASE WHEN {early} THEN {m1} ELSE {m2} END"
    version = "md5(facility_id || '|' || CAST(%s AS VARCHAR)) AS scd_id"
    b = ", ".join(f"b.{c}" for c in staging.STG_FACILITY_COLUMNS)
    a = ", ".join(f"a.{c}" for c in staging.STG_FACILITY_COLUMNS)
    return O.with_ctes(["raw_facilities"], _registry_records(",\n       reg.ingested_at AS shipped") + f"""
, one AS ({stage % (m1, m1, early)}),
two AS ({stage % (landed, landed, "true")}),
pairs AS (SELECT a.facility_id AS a_id, b.facility_id AS b_id, ({_CHANGED}) AS changed
          FROM one a FULL OUTER JOIN two b ON a.facility_id = b.facility_id)
SELECT {a}, {m1} AS valid_from, CASE WHEN p.b_id IS NULL OR p.changed THEN {m2} END AS valid_to, p.b_id IS NULL AS is_deleted,
       md5(a.facility_id || '|' || CAST({m1} AS VARCHAR)) AS scd_id, {m1} AS updated_at
FROM one a JOIN pairs p ON p.a_id = a.facility_id
UNION ALL
SELECT {b}, {m2}, NULL, false, md5(b.facility_id || '|' || CAST({m2} AS VARCHAR)), {m2}
FROM two b JOIN pairs p ON p.b_id = b.facility_id WHERE p.a_id IS NULL OR p.changed""")


def _write_months(spark, sf, base) -> None:
    """The registry's rows as two months of page files, and the census."""
    results = standin.registry_results(spark, sf)
    early = F.col("shipped") < F.lit(MONTH_SPLIT).cast("timestamp_ntz")
    shipped = standin.registry_results(spark, sf, True)
    for k, part in enumerate([shipped.filter(early), shipped.filter(~early)]):
        write_pages(part.select(*results.columns), f"{base}/pages{k}")
    standin.census_rows(spark, sf).write.option("header", True).csv(f"{base}/census")


@register("month_batch", _month_sql())
def q_month_batch(spark, sf):
    """Two months of files through the whole batch, the second month retried
    with the same date; the facility history that comes out (MDL-10)."""
    from access_lake.plans.pipeline import MonthInputs, run_month
    base = work_dir(spark, "month")
    _write_months(spark, sf, base)
    for k in (0, 1, 1):
        run_month(spark, MonthInputs(registry_pages=f"{base}/pages{k}", census_csv=f"{base}/census"), f"{base}/lake",
                  MONTHS[k], check=False)
    return IO.read_latest(spark, f"{base}/lake/history").select(*staging.STG_FACILITY_COLUMNS, *H.VERSION_COLUMNS)


@register("month_batch_late", _month_sql())
def q_month_batch_late(spark, sf):
    """The same two months, the earlier one loaded after the later one: the
    later month's history is made again, and equals loading in order."""
    from access_lake.plans.pipeline import MonthInputs, run_month
    base = work_dir(spark, "month-late")
    _write_months(spark, sf, base)
    for k in (1, 0):
        run_month(spark, MonthInputs(registry_pages=f"{base}/pages{k}", census_csv=f"{base}/census"), f"{base}/lake",
                  MONTHS[k], check=False)
    return IO.read_latest(spark, f"{base}/lake/history").select(*staging.STG_FACILITY_COLUMNS, *H.VERSION_COLUMNS)


# the batch with everything it can take: boundaries, seed, checks and gate

ALL_AREAS = 25 + len(standin.SMALL_AREAS)  # nations and small areas


def _full_census(spark, sf) -> DataFrame:
    """A census that covers every area of the registry, as published rows."""
    cust, nation = standin.table(spark, sf, "customer"), standin.table(spark, sf, "nation")
    weight = (F.lit(20000) + F.lit(7000) * F.col("n_nationkey") + F.col("c_custkey") % 997).cast("bigint")
    per = cust.join(nation, cust.c_nationkey == nation.n_nationkey).groupBy("n_name").agg(F.sum(weight).alias("people"))
    small = spark.createDataFrame([(census, people) for _, census, _, people in standin.SMALL_AREAS], "n_name string, people bigint")
    return per.unionByName(small).select(F.replace("n_name", F.lit("_"), F.lit("-")).alias("County"), F.format_number("people", 0).alias("Total_Population19"))


def _typed_results(results: DataFrame) -> DataFrame:
    return results.withColumn("facility_type_name", F.col("name"))


@standin.per_session
def _gated_months(spark, sf) -> tuple[str, list[str]]:
    """Two months with boundary file, seed and gate. The first month's census
    lacks areas, so its gate refuses; the second one's is whole. Returns the
    batch's folder and what each month ended with."""
    from access_lake.plans.pipeline import MonthInputs, run_month
    base = work_dir(spark, "month-gated")
    early = F.col("shipped") < F.lit(MONTH_SPLIT).cast("timestamp_ntz")
    shipped = _typed_results(standin.registry_results(spark, sf, True))
    for k, part in enumerate([shipped.filter(early), shipped.filter(~early)]):
        write_pages(part.drop("shipped"), f"{base}/pages{k}")
    standin.census_rows(spark, sf).write.option("header", True).csv(f"{base}/census0")
    _full_census(spark, sf).write.option("header", True).csv(f"{base}/census1")
    write_collection(standin.raw_features(spark, sf), f"{base}/features")
    standin.subarea_seed(spark, sf).write.option("header", True).csv(f"{base}/seed")
    ends = []
    for k in (0, 1):
        inputs = MonthInputs(registry_pages=f"{base}/pages{k}", census_csv=f"{base}/census{k}", features=f"{base}/features",
                             seed_csv=f"{base}/seed", drill_area=standin.STANDIN_DRILL_AREA,
                             type_rules=standin.STANDIN_TYPE_RULES, expected_areas=ALL_AREAS)
        try:
            run_month(spark, inputs, f"{base}/lake", MONTHS[k])
            ends.append("passed")
        except AssertionError:  # what the gate raises
            ends.append("refused")
    return base, ends


def _gated_sql(month: int, select: str) -> str:
    """``select`` over the models of one month, the second of them from all
    that had landed."""
    part = f"shipped < TIMESTAMP '{MONTH_SPLIT}'" if month == 0 else "true"
    landed = f"CASE WHEN shipped < TIMESTAMP '{MONTH_SPLIT}' THEN TIMESTAMP '{MONTHS[0]}' ELSE TIMESTAMP '{MONTHS[1]}' END"
    if month == 0:
        census = f"SELECT county_code, lower(county_name) AS county_name, sub_county AS sub_county_name, population FROM ({O.CENSUS_SQL}) c"
    else:
        small = ", ".join(f"('{c.lower().replace(chr(39), chr(39) * 2)}', {n})" for _, c, _, n in standin.SMALL_AREAS)
        census = f"""SELECT '' AS county_code, county_name, '' AS sub_county_name, population
  FROM (SELECT lower(replace(n_name, '_', '-')) AS county_name, CAST(sum(w) AS BIGINT) AS population FROM cust_nation GROUP BY n_name
        UNION ALL SELECT * FROM (VALUES {small}) s) c"""
    models = ",\n".join(O.CTE[n] for n in ("pop_totals", "density", "gaps", "underserved", "seed", "subarea", "geodata"))
    return O.with_ctes(["raw_facilities", "raw_population", "features"], _registry_records(",\n       reg.ingested_at AS shipped") + f"""
, stg_facilities AS (
  SELECT {_FAC} FROM (
    SELECT *, row_number() OVER (PARTITION BY facility_id ORDER BY ingested_at DESC, {_TIES}) AS rn
    FROM (SELECT * REPLACE ({landed} AS ingested_at, {O.TYPE_CASE.replace("facility_type", "facility_name")} AS facility_type)
          FROM records WHERE lower(operation_status) = 'operational' AND {part}) r) t
  WHERE rn = 1),
stg_population AS ({census}),
{models}
{select}""")


def _gated_checks_sql(month: int, end: str) -> str:
    kept = "CAST((SELECT count(*) FROM stg_facilities) AS BIGINT)" if end == "passed" else "NULL::BIGINT"
    report = _gated_sql(month, f"SELECT *, {kept} AS history_rows FROM ({_dq_report_select(ALL_AREAS)}) r")
    return f"SELECT {month + 1} AS month_no, '{end}' AS gate, * FROM ({report}) m"


@register("month_batch_checks", _gated_checks_sql(0, "refused") + "\nUNION ALL\n" + _gated_checks_sql(1, "passed"))
def q_month_batch_checks(spark, sf):
    """The 30 checks of two months run with the gate on: the first month is
    refused and leaves no history, the second passes and starts one
    (MDL-10, DQ-6)."""
    base, ends = _gated_months(spark, sf)
    runs = set(IO.published_runs(spark, f"{base}/lake/history"))
    parts = []
    for k, end in enumerate(ends):
        report = IO.read_latest(spark, f"{base}/lake/checks", before=MONTHS[1]) if k == 0 else IO.read_latest(spark, f"{base}/lake/checks")
        history = IO.read_latest(spark, f"{base}/lake/history").agg(F.count(F.lit(1)).alias("history_rows")) if MONTHS[k] in runs \
            else spark.range(1).select(F.lit(None).cast("bigint").alias("history_rows"))
        kept = report.select("model", "check", "column_name", "failures")
        # one row beside 30
        parts.append(kept.withColumn("_one", F.lit(1)).join(F.broadcast(history.withColumn("_one", F.lit(1))), "_one").drop("_one")
                     .withColumns({"month_no": F.lit(k + 1), "gate": F.lit(end)}))
    return parts[0].unionByName(parts[1])


@register("month_batch_underserved", _gated_sql(1, "SELECT * FROM underserved"))
def q_month_batch_underserved(spark, sf):
    """The under-served mart that the batch published, from page and census
    files (MDL-10, MDL-6)."""
    return IO.read_latest(spark, f"{_gated_months(spark, sf)[0]}/lake/marts/mart_underserved_counties")


@register("month_batch_subarea", _gated_sql(1, "SELECT * FROM subarea"))
def q_month_batch_subarea(spark, sf):
    """The sub-area mart that the batch published, with the seed file
    (MDL-10, MDL-7)."""
    return IO.read_latest(spark, f"{_gated_months(spark, sf)[0]}/lake/marts/mart_subarea")


# ------------------------------------------------------------ order of reports

def _positions(df: DataFrame, *columns: str) -> DataFrame:
    """The rows in the order they come out, numbered (area grain)."""
    from pyspark.sql import Window
    at = df.select(*columns, F.monotonically_increasing_id().alias("_at"))
    return at.withColumn("position", F.row_number().over(Window.orderBy("_at")).cast("bigint")).drop("_at")


@register("order_ranked", O.with_ctes(["underserved"], """
SELECT county_name, underserved_rank, row_number() OVER (ORDER BY underserved_rank) AS position FROM underserved"""))
def q_order_ranked(spark, sf):
    """Worst first (SRT-1), with the place of each row in the output."""
    from access_lake.operators.ranking import ranked
    return _positions(ranked(q_mart_underserved(spark, sf)), "county_name", "underserved_rank")


@register("order_by_name", O.with_ctes(["density"], """
SELECT county_name, row_number() OVER (ORDER BY county_name) AS position FROM density"""))
def q_order_by_name(spark, sf):
    """Alphabetical (SRT-2), with the place of each row in the output."""
    from access_lake.operators.ranking import by_name
    return _positions(by_name(q_mart_density(spark, sf)), "county_name")


@register("order_worst_first", O.with_ctes(["density"], """
SELECT county_name, facilities_per_10k,
       row_number() OVER (ORDER BY facilities_per_10k ASC NULLS LAST, county_name) AS position FROM density"""))
def q_order_worst_first(spark, sf):
    """Lowest metric first, NULLs last (SRT-3), with places."""
    from access_lake.operators.ranking import worst_first
    return _positions(worst_first(q_mart_density(spark, sf), "facilities_per_10k", "county_name"),
                      "county_name", "facilities_per_10k")


@register("date_parts", """
SELECT o_orderkey, strftime(o_orderdate, '%Y') AS year, strftime(o_orderdate, '%m') AS month,
       strftime(o_orderdate, '%d') AS day FROM orders""")
def q_date_parts(spark, sf):
    o = standin.table(spark, sf, "orders")
    return o.select("o_orderkey", *T.date_parts("o_orderdate"))


# ------------------------------------------------------------ landing round trips


CENSUS_CTE = ("census AS (" + O.CENSUS_SQL.strip().replace("WITH per AS (", "SELECT * FROM (WITH per AS (", 1)
              + ") c)")


def _census(spark, sf):
    return standardise_census(standin.census_rows(spark, sf), standin.STANDIN_CENSUS_TS)


@register("landing_roundtrip", f"""
WITH {CENSUS_CTE}
SELECT *, '2025' AS year, '05' AS month, '01' AS day FROM census""")
def q_landing_roundtrip(spark, sf):
    """Land census records as NDJSON date partitions, re-run the same day
    (replaces), read back with an explicit schema (SNK-1..3, SRC-4)."""
    root = work_dir(spark, "landing")
    recs = _census(spark, sf)
    IO.land(recs.withColumn("population", F.col("population") + 1), root, "population", _dt(2025, 5, 1))
    IO.land(recs, root, "population", _dt(2025, 5, 1))
    return IO.read_landing(spark, root, "population", S.POPULATION_RECORD)


@register("read_as_of", f"""
WITH {CENSUS_CTE}
SELECT *, '2025' AS year, '04' AS month, '01' AS day FROM census""")
def q_read_as_of(spark, sf):
    """Two landings; the read as of a date between them returns the first
    only (SRC-8)."""
    root = work_dir(spark, "landing")
    recs = _census(spark, sf)
    IO.land(recs, root, "population", _dt(2025, 4, 1))
    IO.land(recs.withColumn("population", F.col("population") + 1), root, "population", _dt(2025, 5, 1))
    return IO.read_as_of(spark, root, "population", _date(2025, 4, 30), S.POPULATION_RECORD)


@register("schema_evolution", f"""
WITH {CENSUS_CTE}
SELECT county_code, county_name, sub_county, population, male, female, NULL::INTEGER AS households,
       census_year, ingested_at, '2025' AS year, '04' AS month, '01' AS day FROM census
UNION ALL
SELECT *, '2025' AS year, '05' AS month, '01' AS day FROM census""")
def q_schema_evolution(spark, sf):
    """An older landing lacks ``households``; reading both with the current
    schema gives NULL for it there (SRC-9)."""
    root = work_dir(spark, "landing")
    recs = _census(spark, sf)
    IO.land(recs.drop("households"), root, "population", _dt(2025, 4, 1))
    IO.land(recs, root, "population", _dt(2025, 5, 1))
    return IO.read_landing(spark, root, "population", S.POPULATION_RECORD)


# ------------------------------------------------------------ single aggregates
@register("pivot_types", O.with_ctes(["stg_facilities"], f"""
SELECT county_name,
       {O.cnt("facility_type = 'Hospital'")} AS hospital_count,
       {O.cnt("facility_type = 'Health Centre'")} AS health_centre_count,
       {O.cnt("facility_type = 'Dispensary'")} AS dispensary_count,
       {O.cnt("facility_type = 'Clinic'")} AS clinic_count
FROM stg_facilities GROUP BY county_name"""))
def q_pivot_types(spark, sf):
    """One count column per facility type and area (AGG-3)."""
    return agg.pivot_types(stg_fac(spark, sf))


@register("weighted_score", O.with_ctes(["stg_facilities"], """
SELECT county_name,
       CAST(sum(CASE facility_type WHEN 'Hospital' THEN 4 WHEN 'Health Centre' THEN 2 ELSE 1 END) AS BIGINT)
         AS weighted_score
FROM stg_facilities GROUP BY county_name"""))
def q_weighted_score(spark, sf):
    """Capacity-weighted facility count per area (AGG-4)."""
    return agg.weighted_score(stg_fac(spark, sf))


# ------------------------------------------------------------ streaming ingest
@register("streaming_ingest", f"""
WITH {CENSUS_CTE}
SELECT *, '2025' AS year, '04' AS month, '01' AS day FROM census
UNION ALL
SELECT *, '2025' AS year, '05' AS month, '01' AS day FROM census""")
def q_streaming_ingest(spark, sf):
    """Two landings appended to a raw Parquet table by the file-stream
    ingest (availableNow trigger, checkpointed), read back typed."""
    from access_lake.streaming.landing_ingest import ingest_landing
    base = work_dir(spark, "stream")
    recs = _census(spark, sf)
    IO.land(recs, f"{base}/landing", "population", _dt(2025, 4, 1))
    ingest_landing(spark, f"{base}/landing", "population", f"{base}/raw", f"{base}/checkpoint")
    IO.land(recs, f"{base}/landing", "population", _dt(2025, 5, 1))
    ingest_landing(spark, f"{base}/landing", "population", f"{base}/raw", f"{base}/checkpoint")
    return IO.raw_table(spark, f"{base}/raw", schema=S.with_partitions(S.POPULATION_RECORD))
