"""DuckDB SQL equivalents of the registered queries (the correctness gate).

Each oracle is built from the CTEs below, written independently of the
Spark code in plain ANSI SQL over the driver's tables. Conventions: sums
and row numbers are cast to BIGINT; ``regexp_replace`` takes the 'g' flag;
every window has a total order with explicit NULLS placement.
"""

from __future__ import annotations

TYPE_CASE = """CASE
      WHEN lower(facility_type) LIKE '%ring%'   THEN 'Hospital'
      WHEN lower(facility_type) LIKE '%plate%'  THEN 'Health Centre'
      WHEN lower(facility_type) LIKE '%widget%' THEN 'Dispensary'
      WHEN lower(facility_type) LIKE '%bolt%'   THEN 'Clinic'
      ELSE 'Other' END"""

CTE = {}

CTE["raw_facilities"] = """raw_facilities AS (
  SELECT
    CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS facility_id,
    CASE WHEN l_linenumber = 7 THEN NULL ELSE 'P' || CAST(l_partkey AS VARCHAR) END AS facility_code,
    p_name AS facility_name,
    p_name AS facility_type,
    CASE WHEN l_orderkey BETWEEN 41 AND 80 AND l_returnflag <> 'R' AND l_discount < CAST(0.05 AS DOUBLE)
              AND l_tax > 0 AND l_quantity <= 45 THEN 'NATION 0'
         WHEN l_orderkey BETWEEN 1 AND 40 AND l_returnflag <> 'R' AND l_discount < CAST(0.05 AS DOUBLE)
              AND l_tax > 0 AND l_quantity <= 45 THEN 'Muranga'
         WHEN l_orderkey BETWEEN 1 AND 7 THEN 'Elgeyo Marakwet'
         WHEN l_orderkey BETWEEN 8 AND 15 THEN 'Tharaka Nithi'
         WHEN l_orderkey BETWEEN 16 AND 40 THEN 'Kilifi'
         ELSE replace(n_name, '_', ' ') END AS county_name,
    CASE WHEN l_orderkey BETWEEN 41 AND 80 AND l_returnflag <> 'R' AND l_discount < CAST(0.05 AS DOUBLE)
              AND l_tax > 0 AND l_quantity <= 45 THEN 'Annex'
         WHEN c_mktsegment = 'AUTOMOBILE' THEN '' ELSE c_mktsegment END AS sub_county_name,
    'W' || CAST(l_suppkey AS VARCHAR) AS ward_name,
    c_acctbal AS latitude,
    o_totalprice AS longitude,
    CASE WHEN l_linestatus = 'O'
         THEN CASE WHEN l_returnflag = 'A' THEN 'OPERATIONAL' ELSE 'Operational' END
         ELSE 'Closed' END AS operation_status,
    l_returnflag = 'R' AS has_maternity,
    l_discount >= CAST(0.05 AS DOUBLE) AS has_art,
    l_tax = 0 AS has_tb,
    l_quantity > 45 AS has_emergency,
    CASE WHEN o_orderpriority = '4-NOT SPECIFIED' THEN NULL
         ELSE o_orderpriority IN ('1-URGENT', '2-HIGH') END AS has_outpatient,
    l_shipdate AS ingested_at
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN part ON l_partkey = p_partkey
)"""

STG_COLS = ("facility_id, facility_code, facility_name, facility_type, county_name, "
            "sub_county_name, ward_name, latitude, longitude, operation_status, has_maternity, "
            "has_art, has_tb, has_emergency, has_outpatient, ingested_at")
TIEBREAK = ", ".join(f"{c} ASC NULLS LAST" for c in STG_COLS.split(", ")
                     if c not in ("facility_id", "ingested_at"))

CTE["stg_facilities"] = f"""stg_clean AS (
  SELECT facility_id, facility_code, facility_name, {TYPE_CASE} AS facility_type,
         county_name, sub_county_name, ward_name, latitude, longitude, operation_status,
         has_maternity, has_art, has_tb, has_emergency, has_outpatient, ingested_at
  FROM raw_facilities
  WHERE lower(operation_status) = 'operational'
    AND facility_code IS NOT NULL AND county_name IS NOT NULL
),
stg_facilities AS (
  SELECT {STG_COLS} FROM (
    SELECT *, row_number() OVER (PARTITION BY facility_id
                                 ORDER BY ingested_at DESC NULLS LAST, {TIEBREAK}) AS rn
    FROM stg_clean) t
  WHERE rn = 1
)"""

CTE["raw_population"] = """cust_nation AS (
  SELECT *, CAST(20000 + 7000 * n_nationkey + c_custkey % 997 AS BIGINT) AS w
  FROM customer JOIN nation ON c_nationkey = n_nationkey
),
pop_rows AS (
  SELECT CAST(n_nationkey AS VARCHAR) AS county_code,
         replace(n_name, '_', '-') AS county_name,
         CASE WHEN n_regionkey < 2 THEN '' ELSE replace(n_name, '_', '-') END AS sub_county,
         CASE WHEN n_regionkey = 4 THEN CAST(0 AS BIGINT) ELSE CAST(sum(w) AS BIGINT) END AS population
  FROM cust_nation GROUP BY n_nationkey, n_name, n_regionkey
  UNION ALL
  SELECT CAST(n_nationkey AS VARCHAR), replace(n_name, '_', '-'), c_mktsegment, CAST(sum(w) AS BIGINT)
  FROM cust_nation GROUP BY n_nationkey, n_name, c_mktsegment
  UNION ALL
  SELECT s.code, s.name, s.sub, CAST(s.people AS BIGINT)
  FROM customer JOIN (VALUES (1, 'S0', 'Murang''a', '', 900000), (1, 'S0', 'Murang''a', 'Murang''a', 900000),
                             (2, 'S1', 'Elgeyo-Marakwet', '', 400000), (3, 'S2', 'Tharaka-Nithi', '', 30000),
                             (4, 'S3', 'Kilifi', '', 20000)) s(k, code, name, sub, people) ON c_custkey = s.k
),
raw_population AS (
  SELECT county_code, county_name, sub_county, population, 2019 AS census_year,
         TIMESTAMP '2019-08-24 00:00:00' AS ingested_at
  FROM pop_rows
)"""

CTE["stg_population"] = """stg_population AS (
  SELECT CAST(county_code AS VARCHAR) AS county_code, lower(county_name) AS county_name,
         lower(sub_county) AS sub_county_name, CAST(population AS BIGINT) AS population,
         CAST(census_year AS INTEGER) AS census_year, ingested_at
  FROM raw_population
  WHERE population IS NOT NULL AND population > 0 AND county_name IS NOT NULL
)"""

CTE["pop_totals"] = """pop_totals AS (
  SELECT county_name, CAST(sum(population) AS BIGINT) AS total_population
  FROM stg_population
  WHERE sub_county_name = '' OR lower(sub_county_name) = lower(county_name)
  GROUP BY county_name
)"""


def key_sql(expr: str) -> str:
    return f"regexp_replace(regexp_replace(lower({expr}), '-', ' ', 'g'), '''', '', 'g')"


def cnt(cond: str) -> str:
    return f"CAST(sum(CASE WHEN {cond} THEN 1 ELSE 0 END) AS BIGINT)"


CTE["density"] = f"""weighted AS (
  SELECT county_name,
         count(*) AS total_facilities,
         {cnt("facility_type = 'Hospital'")} AS hospital_count,
         {cnt("facility_type = 'Health Centre'")} AS health_centre_count,
         {cnt("facility_type = 'Dispensary'")} AS dispensary_count,
         {cnt("facility_type = 'Clinic'")} AS clinic_count,
         {cnt("has_maternity")} AS maternity_facilities,
         {cnt("has_art")} AS art_facilities,
         {cnt("has_tb")} AS tb_facilities,
         {cnt("has_emergency")} AS emergency_facilities,
         CAST(sum(CASE facility_type WHEN 'Hospital' THEN 4 WHEN 'Health Centre' THEN 2 ELSE 1 END) AS BIGINT)
           AS weighted_score
  FROM stg_facilities GROUP BY county_name
),
density AS (
  SELECT w.county_name, w.total_facilities, w.hospital_count, w.health_centre_count,
         w.dispensary_count, w.clinic_count, w.maternity_facilities, w.art_facilities,
         w.tb_facilities, w.emergency_facilities, w.weighted_score, p.total_population,
         round(CAST(w.total_facilities AS DOUBLE) / nullif(p.total_population, 0) * 10000, 2) AS facilities_per_10k,
         round(CAST(w.weighted_score AS DOUBLE) / nullif(p.total_population, 0) * 10000, 2) AS weighted_density_per_10k,
         CAST(row_number() OVER (ORDER BY CAST(w.total_facilities AS DOUBLE) / nullif(p.total_population, 0) ASC NULLS LAST,
                                          w.county_name ASC NULLS LAST, p.total_population ASC NULLS LAST) AS BIGINT)
           AS density_rank
  FROM weighted w LEFT JOIN pop_totals p ON {key_sql('w.county_name')} = {key_sql('p.county_name')}
)"""

CTE["gaps"] = f"""services AS (
  SELECT county_name, count(*) AS total_facilities,
         {cnt("has_maternity")} AS maternity_count, {cnt("has_art")} AS art_count,
         {cnt("has_tb")} AS tb_count, {cnt("has_emergency")} AS emergency_count,
         {cnt("has_outpatient")} AS outpatient_count
  FROM stg_facilities GROUP BY county_name
),
gaps AS (
  SELECT f.county_name, f.total_facilities, p.total_population, f.maternity_count, f.art_count,
         f.tb_count, f.emergency_count, f.outpatient_count,
         round(CAST(f.maternity_count AS DOUBLE) / nullif(p.total_population, 0) * 100000, 2) AS maternity_per_100k,
         round(CAST(f.art_count AS DOUBLE) / nullif(p.total_population, 0) * 100000, 2) AS art_per_100k,
         round(CAST(f.tb_count AS DOUBLE) / nullif(p.total_population, 0) * 100000, 2) AS tb_per_100k,
         round(CAST(f.emergency_count AS DOUBLE) / nullif(p.total_population, 0) * 100000, 2) AS emergency_per_100k,
         CASE WHEN f.maternity_count < 3 THEN true ELSE false END AS maternity_gap_flag,
         CASE WHEN f.art_count < 2 THEN true ELSE false END AS art_gap_flag,
         CASE WHEN f.tb_count < 2 THEN true ELSE false END AS tb_gap_flag,
         CASE WHEN f.emergency_count = 0 THEN true ELSE false END AS no_emergency_flag
  FROM services f LEFT JOIN pop_totals p ON {key_sql('f.county_name')} = {key_sql('p.county_name')}
)"""

CTE["underserved"] = """scored AS (
  SELECT d.county_name, d.total_facilities, d.total_population, d.facilities_per_10k,
         d.weighted_density_per_10k, d.density_rank, d.hospital_count, d.health_centre_count,
         d.dispensary_count, d.clinic_count, g.maternity_count, g.art_count, g.tb_count,
         g.emergency_count, g.maternity_per_100k, g.art_per_100k, g.tb_per_100k,
         g.emergency_per_100k, g.maternity_gap_flag, g.art_gap_flag, g.tb_gap_flag,
         g.no_emergency_flag,
         (CASE WHEN d.facilities_per_10k < 1 THEN 4
               WHEN d.facilities_per_10k < 2 THEN 3
               WHEN d.facilities_per_10k < 5 THEN 2
               ELSE 1 END
          + CASE WHEN g.maternity_gap_flag THEN 2 ELSE 0 END
          + CASE WHEN g.art_gap_flag THEN 2 ELSE 0 END
          + CASE WHEN g.tb_gap_flag THEN 1 ELSE 0 END
          + CASE WHEN g.no_emergency_flag THEN 3 ELSE 0 END) AS severity_score,
         CASE WHEN d.total_population IS NULL THEN NULL
              ELSE greatest(0, CAST(((d.total_population + 250) // 500 + 9) // 10 - d.total_facilities AS INTEGER))
         END AS facilities_needed_to_baseline
  FROM density d LEFT JOIN gaps g ON lower(d.county_name) = lower(g.county_name)
),
underserved AS (
  SELECT *, CAST(row_number() OVER (ORDER BY severity_score DESC NULLS LAST,
                                             facilities_per_10k ASC NULLS LAST,
                                             county_name ASC NULLS LAST,
                                             total_population ASC NULLS LAST) AS BIGINT) AS underserved_rank
  FROM scored
)"""

CTE["seed"] = """seed AS (
  SELECT upper(substr(lower(c_mktsegment), 1, 1)) || substr(lower(c_mktsegment), 2) AS sub_county_name,
         CAST(sum(w) AS BIGINT) AS population_2019,
         CAST(sum(w) + count(*) * 2311 AS BIGINT) AS population_2024,
         2019 AS census_year, 2024 AS projection_year, CAST(0.022 AS DOUBLE) AS growth_rate
  FROM cust_nation
  WHERE lower(replace(n_name, '_', ' ')) = 'nation 0'
  GROUP BY c_mktsegment
)"""

CTE["subarea"] = f"""sub_counts AS (
  SELECT sub_county_name, count(*) AS total_facilities,
         {cnt("has_maternity")} AS maternity_count, {cnt("has_art")} AS art_count,
         {cnt("has_tb")} AS tb_count, {cnt("has_emergency")} AS emergency_count,
         {cnt("facility_type = 'Hospital'")} AS hospital_count,
         {cnt("facility_type = 'Health Centre'")} AS health_centre_count,
         {cnt("facility_type = 'Dispensary'")} AS dispensary_count,
         {cnt("facility_type = 'Clinic'")} AS clinic_count
  FROM stg_facilities
  WHERE lower(county_name) = 'nation 0' AND sub_county_name != ''
  GROUP BY sub_county_name
),
subarea AS (
  SELECT s.sub_county_name, s.total_facilities, p.population_2019, p.population_2024,
         s.maternity_count, s.art_count, s.tb_count, s.emergency_count, s.hospital_count,
         s.health_centre_count, s.dispensary_count, s.clinic_count,
         round(CAST(s.total_facilities AS DOUBLE) / nullif(p.population_2024, 0) * 10000, 2) AS facilities_per_10k,
         CASE WHEN s.maternity_count = 0 THEN true ELSE false END AS no_maternity_flag,
         CASE WHEN s.art_count = 0 THEN true ELSE false END AS no_art_flag,
         CASE WHEN s.emergency_count = 0 THEN true ELSE false END AS no_emergency_flag,
         CAST(row_number() OVER (ORDER BY CAST(s.total_facilities AS DOUBLE) / nullif(p.population_2024, 0) ASC NULLS LAST,
                                          s.sub_county_name ASC NULLS LAST, p.population_2024 ASC NULLS LAST) AS BIGINT)
           AS subcounty_density_rank
  FROM sub_counts s LEFT JOIN seed p ON lower(s.sub_county_name) = lower(p.sub_county_name)
)"""

# dependencies between CTEs, in definition order
DEPS = {
    "raw_facilities": [],
    "stg_facilities": ["raw_facilities"],
    "raw_population": [],
    "stg_population": ["raw_population"],
    "pop_totals": ["stg_population"],
    "density": ["stg_facilities", "pop_totals"],
    "gaps": ["stg_facilities", "pop_totals"],
    "underserved": ["density", "gaps"],
    "seed": ["raw_population"],
    "subarea": ["stg_facilities", "seed"],
}


def with_ctes(names: list[str], select: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        for d in DEPS.get(n, []):
            visit(d)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    body = select.lstrip()
    sep = "\n" if not body.startswith(",") else ""
    return "WITH " + ",\n".join(CTE[n] for n in order) + sep + "\n" + body


# ------------------------------------------------------------------ helpers
def title_sql(expr: str) -> str:
    """Python-style title case: capitalise every letter run."""
    return (f"array_to_string(list_transform(regexp_extract_all({expr}, '(\\p{{L}}+|\\P{{L}}+)'), "
            f"lambda r: CASE WHEN r[1] = 'ß' THEN 'Ss' ELSE upper(r[1]) END || lower(r[2:])), '')")


def strip_sql(expr: str) -> str:
    return f"coalesce(regexp_replace({expr}, '^\\s+|\\s+$', '', 'g'), '')"


def int_text_sql(expr: str, typ: str = "BIGINT") -> str:
    """Integer text (sign and digits only) → integer, else 0."""
    return (f"CASE WHEN regexp_full_match(trim({expr}), '[+-]?[0-9]+') "
            f"THEN CAST(trim({expr}) AS {typ}) ELSE CAST(0 AS {typ}) END")


CTE["features"] = """features AS (
  SELECT s_suppkey AS pos,
         CASE WHEN s_suppkey = 1 THEN 'Murang''a'
              WHEN s_suppkey = 2 THEN 'Elegeyo-Marakwet'
              WHEN s_suppkey = 3 THEN 'Tharaka - Nithi'
              WHEN s_suppkey = 4 THEN 'Kilifi'
              WHEN s_acctbal < 0 THEN 'None'
              WHEN n_regionkey = 0 THEN replace(n_name, '_', ' - ')
              WHEN n_regionkey = 1 THEN replace(n_name, '_', '-')
              ELSE replace(n_name, '_', ' ') END AS COUNTY_NAM,
         CAST(n_nationkey AS VARCHAR) AS COUNTY_COD,
         CAST(s_suppkey AS VARCHAR) AS CONST_CODE,
         CASE WHEN s_acctbal > 9000 THEN NULL ELSE CAST(s_suppkey % 50 AS DOUBLE) / 4 END AS Shape_Area,
         CASE WHEN s_suppkey <> 4 THEN '{"type": "Point", "coordinates": [' || CAST(s_suppkey AS VARCHAR) || ', '
           || CAST(n_nationkey AS VARCHAR) || ']}' END AS geometry
  FROM supplier JOIN nation ON s_nationkey = n_nationkey
)"""

CTE["geodata"] = f"""named_features AS (
  SELECT *, {title_sql(strip_sql('COUNTY_NAM'))} AS fname FROM features
),
geodata AS (
  SELECT arg_min(COUNTY_COD, pos) AS county_code, fname AS county_name,
         arg_min(coalesce(geometry, 'null'), pos) AS geometry,
         sum(coalesce(Shape_Area, CAST(0 AS DOUBLE))) AS area_sqkm,
         TIMESTAMP '2024-06-01 00:00:00' AS ingested_at
  FROM named_features
  WHERE fname <> '' AND lower(fname) <> 'none'
  GROUP BY fname
),
stg_geodata AS (
  SELECT county_code, lower(county_name) AS county_name, geometry, area_sqkm, ingested_at
  FROM geodata WHERE county_name IS NOT NULL AND geometry IS NOT NULL
)"""

CTE["snapshots"] = """snapshots AS (
  SELECT user_id, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS snapshot_at, event_type,
         CAST(floor(value / 10) AS INTEGER) AS value_band,
         CAST(json_extract_string(props, '$.k') AS INTEGER) >= 50 AS is_high
  FROM (SELECT *, row_number() OVER (PARTITION BY user_id, CAST(ts AS DATE)
                                     ORDER BY ts DESC, event_id DESC) AS rn
        FROM events) e
  WHERE rn = 1
)"""


def history_sql(snap: str, name: str, key: str = "user_id",
                checks: tuple[str, ...] = ("event_type", "value_band", "is_high"),
                data: tuple[str, ...] | None = None) -> str:
    """SCD2 versions of a snapshot CTE ``snap`` (key, snapshot_at, data), as
    CTE ``name``: islands of contiguous rows unchanged in ``checks``."""
    changed = " OR ".join(f"lag({c}) OVER w IS DISTINCT FROM {c}" for c in checks)
    columns = ", ".join(f"st.{c}" for c in (data or checks))
    return f"""{name}_cal AS (
  SELECT snapshot_at, row_number() OVER (ORDER BY snapshot_at) AS ord,
         lead(snapshot_at) OVER (ORDER BY snapshot_at) AS next_at
  FROM (SELECT DISTINCT snapshot_at FROM {snap}) d
),
{name}_r AS (
  SELECT s.*, c.ord, c.next_at,
         lag(c.ord) OVER w AS prev_ord, lead(c.ord) OVER w AS next_ord,
         ({changed}) AS changed
  FROM {snap} s JOIN {name}_cal c ON s.snapshot_at = c.snapshot_at
  WINDOW w AS (PARTITION BY {key} ORDER BY s.snapshot_at)
),
{name}_s AS (
  SELECT *, (prev_ord IS NULL OR prev_ord <> ord - 1 OR changed) AS is_start FROM {name}_r
),
{name}_e AS (
  SELECT *, (next_ord IS NULL OR next_ord <> ord + 1
             OR coalesce(lead(is_start) OVER (PARTITION BY {key} ORDER BY snapshot_at), true)) AS is_end
  FROM {name}_s
),
{name}_m AS (
  SELECT *, min(CASE WHEN is_end THEN ord END) OVER (PARTITION BY {key} ORDER BY snapshot_at
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS end_ord
  FROM {name}_e
),
{name} AS (
  SELECT st.{key}, {columns},
         st.snapshot_at AS valid_from, en.next_at AS valid_to,
         (en.next_at IS NOT NULL AND (en.next_ord IS NULL OR en.next_ord <> en.ord + 1)) AS is_deleted,
         md5(CAST(st.{key} AS VARCHAR) || '|' || CAST(st.snapshot_at AS VARCHAR)) AS scd_id,
         st.snapshot_at AS updated_at
  FROM {name}_m st JOIN {name}_m en ON st.{key} = en.{key} AND en.ord = st.end_ord
  WHERE st.is_start
)"""


CTE["history"] = history_sql("snapshots", "history")

FACILITY_HISTORY_DATA = ("facility_code", "facility_name", "facility_type", "county_name", "sub_county_name",
                         "latitude", "longitude", "operation_status", "has_maternity", "has_art", "has_tb",
                         "has_emergency", "has_outpatient")
CTE["facility_months"] = f"""facility_months AS (
  SELECT ward_name AS facility_id, {", ".join(FACILITY_HISTORY_DATA)}, snapshot_at
  FROM (SELECT *, date_trunc('month', ingested_at) AS snapshot_at,
               row_number() OVER (PARTITION BY ward_name, date_trunc('month', ingested_at)
                                  ORDER BY ingested_at DESC NULLS LAST, facility_id ASC NULLS LAST, {TIEBREAK}) AS rn
        FROM raw_facilities) t
  WHERE rn = 1
)"""
CTE["facility_history"] = history_sql(
    "facility_months", "facility_history", "facility_id",
    ("facility_name", "facility_type", "operation_status", "county_name", "sub_county_name", "has_maternity",
     "has_art", "has_tb", "has_emergency", "has_outpatient", "latitude", "longitude"), FACILITY_HISTORY_DATA)


def previous_sql(history: str, key: str, col: str) -> str:
    """Versions but a key's first, with ``col`` in the version before."""
    return f"""(SELECT * FROM (
  SELECT *, lag({col}) OVER (PARTITION BY {key} ORDER BY valid_from) AS prev_{col},
         lag(valid_from) OVER (PARTITION BY {key} ORDER BY valid_from) AS before_from
  FROM {history}) x WHERE before_from IS NOT NULL)"""

DEPS.update({
    "features": [],
    "geodata": ["features"],
    "snapshots": [],
    "history": ["snapshots"],
    "facility_months": ["raw_facilities"],
    "facility_history": ["facility_months"],
})


# census standardisation over rows built from customer ⋈ nation
CENSUS_SQL = f"""
WITH per AS (
  SELECT n_nationkey, n_name, n_regionkey,
         CAST(sum(CAST(20000 + 7000 * n_nationkey + c_custkey % 997 AS BIGINT)) AS BIGINT) AS p,
         count(*) AS h
  FROM customer JOIN nation ON c_nationkey = n_nationkey
  GROUP BY n_nationkey, n_name, n_regionkey
)
SELECT CAST(n_nationkey AS VARCHAR) AS county_code,
       {title_sql("replace(lower(n_name), '_', '-')")} AS county_name,
       '' AS sub_county, p AS population,
       CAST(p * 49 // 100 AS INTEGER) AS male, 0 AS female, CAST(h AS INTEGER) AS households,
       2019 AS census_year, TIMESTAMP '2019-08-24 00:00:00' AS ingested_at
FROM per WHERE n_regionkey < 3"""
