from datetime import datetime


from access_lake.plans import marts, staging
from helpers import rows

RAW_COLS = ("facility_id string, facility_code string, facility_name string, facility_type string, "
            "county_name string, sub_county_name string, ward_name string, latitude double, "
            "longitude double, operation_status string, has_maternity boolean, has_art boolean, "
            "has_tb boolean, has_emergency boolean, has_outpatient boolean, ingested_at timestamp_ntz")
T1, T2, T3 = datetime(2025, 1, 1), datetime(2025, 2, 1), datetime(2025, 3, 1)


def fac(fid, code="C", name="F", ftype="Dispensary", county="Nairobi", sub="Westlands",
        status="Operational", mat=False, art=False, tb=False, em=False, op=False, ts=T1, ward="W"):
    return (fid, code, name, ftype, county, sub, ward, 1.0, 2.0, status, mat, art, tb, em, op, ts)


def test_stg_filters_then_dedups(spark):
    raw = spark.createDataFrame([
        fac("a", ts=T1, name="old-open"), fac("a", ts=T2, status="Closed", name="new-closed"),
        fac("b", ts=T1, status="OPERATIONAL"),
        fac("c", code=None), fac("d", code=""), fac("e", county=None),
        fac("f", ts=T2, name="z"), fac("f", ts=T2, name="y"),
        fac("g", ftype="County Hospital and clinic", mat=None),
        fac("h", ftype="Nursing home"),
    ], RAW_COLS)
    stg = staging.stg_facilities(raw)
    got = {r.facility_id: r for r in stg.collect()}
    assert got["a"].facility_name == "old-open"          # newest closed → older open survives
    assert "b" in got and "c" not in got and "d" in got and "e" not in got
    assert got["f"].facility_name == "y"                  # tie broken by the other columns
    assert got["g"].facility_type == "Hospital" and got["h"].facility_type == "Other"
    assert stg.groupBy("facility_id").count().filter("count > 1").count() == 0


def pop_rows(spark, rows_):
    df = spark.createDataFrame(rows_, "county_code string, county_name string, sub_county string, "
                                      "population long, census_year int, ingested_at timestamp_ntz")
    return staging.stg_population(df)


def test_marts_edge_areas(spark):
    fac_rows = []
    # A-b (pop via 'a b'): 3 maternity, 2 ART, 2 TB, 1 emergency, 1 hospital
    for i in range(3):
        fac_rows.append(fac(f"ab{i}", county="A-b", mat=True, art=i < 2, tb=i < 2, em=i == 0,
                            ftype="Hospital" if i == 0 else "Clinic"))
    # M'x (pop via 'mx'): 2 / 1 / 1 / 0 → all gap flags true
    for i in range(2):
        fac_rows.append(fac(f"mx{i}", county="M'x", mat=True, art=i == 0, tb=i == 0))
    # Lone: no population row
    fac_rows.append(fac("lone", county="Lone"))
    fac_df = staging.stg_facilities(spark.createDataFrame(fac_rows, RAW_COLS))
    pop = pop_rows(spark, [
        ("1", "a b", "", 1670200, 2019, T1),
        ("1", "a b", "some sub", 999, 2019, T1),           # not a total row: excluded
        ("2", "MX", "mx", 20000, 2019, T1),                # sub equal to area: total row
        ("3", "zero", "", 0, 2019, T1),                    # dropped by staging
    ])
    density = marts.mart_county_density(fac_df, pop)
    d = {r.county_name: r for r in density.collect()}
    assert d["A-b"].total_population == 1670200 and d["M'x"].total_population == 20000
    assert d["Lone"].total_population is None and d["Lone"].facilities_per_10k is None
    assert d["Lone"].density_rank == 3                      # NULL ratio ranks last
    assert d["A-b"].weighted_score == 4 + 1 + 1 and d["A-b"].hospital_count == 1
    gaps = marts.mart_service_gaps(fac_df, pop)
    g = {r.county_name: r for r in gaps.collect()}
    assert (g["A-b"].maternity_gap_flag, g["A-b"].art_gap_flag, g["A-b"].tb_gap_flag,
            g["A-b"].no_emergency_flag) == (False, False, False, False)
    assert (g["M'x"].maternity_gap_flag, g["M'x"].art_gap_flag, g["M'x"].tb_gap_flag,
            g["M'x"].no_emergency_flag) == (True, True, True, True)
    under = marts.mart_underserved(density, gaps)
    u = {r.county_name: r for r in under.collect()}
    assert u["A-b"].facilities_needed_to_baseline == 334 - 3   # 334.04 → 334, not 335
    assert u["Lone"].facilities_needed_to_baseline is None
    assert u["Lone"].severity_score == 1 + 2 + 2 + 1 + 3       # NULL density → 1 point
    assert u["M'x"].severity_score == 3 + 2 + 2 + 1 + 3        # density 1.0 → band 3
    assert u["M'x"].underserved_rank == 1 and u["Lone"].underserved_rank == 2
    assert sorted(r.underserved_rank for r in u.values()) == [1, 2, 3]


def test_subarea_golden_values(spark):
    rows_ = [fac(f"s{i}", county="Nairobi", sub="Starehe") for i in range(158)]
    rows_ += [fac(f"e{i}", county="nairobi", sub="Embakasi North") for i in range(18)]
    rows_ += [fac("blank", county="Nairobi", sub=""), fac("other", county="Kisumu", sub="Starehe")]
    seed = spark.createDataFrame([("starehe", 200000, 218388), ("Embakasi North", 250000, 291760)],
                                 "sub_county_name string, population_2019 long, population_2024 long")
    sub = marts.mart_subarea(staging.stg_facilities(spark.createDataFrame(rows_, RAW_COLS)), seed, "Nairobi")
    got = rows(sub, "sub_county_name", "total_facilities", "facilities_per_10k", "subcounty_density_rank")
    assert got == [("Embakasi North", 18, 0.62, 1), ("Starehe", 158, 7.23, 2)]


def test_roll_up_equals_one_level(spark):
    from access_lake.operators import aggregates as agg
    rows_ = [fac(f"x{i}", county="A" if i % 3 else "B", ftype=["Hospital", "Clinic", "Other"][i % 3],
                 mat=i % 2 == 0) for i in range(30)]
    stg = staging.stg_facilities(spark.createDataFrame(rows_, RAW_COLS))
    two = agg.roll_up(agg.type_service_counts(stg))
    pop = pop_rows(spark, [("1", "a", "", 100000, 2019, T1), ("2", "b", "", 50000, 2019, T1)])
    one = marts.mart_county_density(stg, pop)
    a = {r.county_name: (r.total_facilities, r.hospital_count, r.weighted_score) for r in two.collect()}
    b = {r.county_name: (r.total_facilities, r.hospital_count, r.weighted_score) for r in one.collect()}
    assert a == b


def test_rank_tie_break_density_then_name(spark):
    from access_lake.plans.marts import UNDERSERVED_COLUMNS
    base = {c: None for c in UNDERSERVED_COLUMNS}
    density_cols = ["county_name", "total_facilities", "total_population", "facilities_per_10k",
                    "weighted_density_per_10k", "density_rank", "hospital_count",
                    "health_centre_count", "dispensary_count", "clinic_count"]
    gap_cols = ["county_name", "maternity_count", "art_count", "tb_count", "emergency_count",
                "maternity_per_100k", "art_per_100k", "tb_per_100k", "emergency_per_100k",
                "maternity_gap_flag", "art_gap_flag", "tb_gap_flag", "no_emergency_flag"]
    d = spark.createDataFrame([("b", 1, 10000, 3.0, 3.0, 1, 0, 0, 0, 0), ("a", 1, 10000, 3.0, 3.0, 2, 0, 0, 0, 0),
                               ("c", 1, 10000, 2.5, 2.5, 3, 0, 0, 0, 0)],
                              ", ".join(f"{c} {'string' if c == 'county_name' else 'double' if 'per' in c else 'long'}"
                                        for c in density_cols))
    g = spark.createDataFrame([(n, 5, 5, 5, 5, 1.0, 1.0, 1.0, 1.0, False, False, False, False) for n in "abc"],
                              ", ".join(f"{c} {'string' if c == 'county_name' else 'boolean' if 'flag' in c else 'double' if 'per' in c else 'long'}"
                                        for c in gap_cols))
    u = marts.mart_underserved(d, g)
    assert rows(u, "underserved_rank", "county_name") == [(1, "c"), (2, "a"), (3, "b")]
    assert base


def test_models_by_name_with_sql(spark):
    """Staging and marts registered by model name answer the product's two
    singular SQL tests through the SQL API (SRC-7, SNK-4, FLT-8, AGG-9)."""
    from access_lake.sources.io import register_views
    rows_ = [fac(f"q{i}", county=c) for i, c in enumerate(["A", "B", "B"])]
    stg = staging.stg_facilities(spark.createDataFrame(rows_, RAW_COLS))
    pop = pop_rows(spark, [("1", "a", "", 1000, 2019, T1)])
    register_views({"stg_facilities": stg, "mart_county_density": marts.mart_county_density(stg, pop)})
    dup = spark.sql("select facility_id, count(*) as n from stg_facilities group by facility_id having count(*) > 1")
    assert dup.count() == 0
    cnt = spark.sql("select count(*) as county_count from mart_county_density having count(*) != 47")
    assert [r.county_count for r in cnt.collect()] == [2]


def test_join_checks(spark):
    from access_lake.operators.joins import fan_out_keys, join_by_area, unmatched_keys
    left = spark.createDataFrame([("Tharaka-Nithi",), ("Murang'a",), ("Lamu",)], "county_name string")
    right = spark.createDataFrame([("tharaka nithi", 1), ("muranga", 2), ("MURANGA", 3)],
                                  "county_name string, v int")
    assert rows(unmatched_keys(left, right)) == [("Lamu",)]
    joined = join_by_area(left, right)
    assert rows(fan_out_keys(joined)) == [("Murang'a", 2)]       # two population spellings fan out
