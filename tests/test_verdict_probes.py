"""Faults once found by probing stay mended: retries, backfills, bad input,
empty marts, NULL flags, returning keys, re-landed days."""

import json
import os
import time
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from access_lake.functions import fixed
from access_lake.functions import numeric as N
from access_lake.functions import text as T
from access_lake.operators import history as H
from access_lake.operators import quality as Q
from access_lake.plans import marts
from access_lake.plans.pipeline import run_month
from access_lake.plans.quality_suite import run_checks
from access_lake.session import ensure_checkpoint_dir
from access_lake.sources import io
from access_lake.sources.standardise import standardise_features, standardise_registry
from access_lake.streaming.landing_ingest import ingest_landing
from helpers import rows
from test_pipeline_streaming import fixtures, write

JAN, FEB = datetime(2025, 1, 1, 2), datetime(2025, 2, 1, 2)
COLS = ["facility_id", "facility_name", "valid_from", "valid_to", "is_deleted", "scd_id"]


def test_retry_and_backfill(spark, tmp):
    root = f"{tmp}/lake"
    run_month(spark, fixtures(tmp, 1), root, JAN)
    first = rows(io.read_latest(spark, f"{root}/history"), *COLS)
    out = run_month(spark, fixtures(tmp, 2), root, FEB)
    second = rows(io.read_latest(spark, f"{root}/history"), *COLS)
    again = run_month(spark, fixtures(tmp, 2), root, FEB)
    assert again["history"] != out["history"]
    assert rows(spark.read.parquet(out["history"]), *COLS) == second
    assert rows(io.read_latest(spark, f"{root}/history"), *COLS) == second
    back = run_month(spark, fixtures(tmp, 1), root, JAN)      # after February landed
    assert rows(spark.read.parquet(back["history"]), *COLS) == first
    assert "f99" not in {r[0] for r in first}
    assert rows(io.read_latest(spark, f"{root}/history"), *COLS) == second
    assert io.read_latest(spark, f"{root}/history", before=JAN) is None


def test_backfill_before_any_run_sees_only_its_landings(spark, tmp):
    root = f"{tmp}/lake"
    run_month(spark, fixtures(tmp, 2), root, FEB)
    out = run_month(spark, fixtures(tmp, 1), root, JAN)
    assert {str(r.valid_from) for r in spark.read.parquet(out["history"]).collect()} == {str(JAN)}


def test_a_newer_history_is_refused(spark):
    hist = H.scd2_from_snapshots(spark.createDataFrame([("a", 1, FEB)], "k string, v int, at timestamp_ntz"), "k", "at", ["v"])
    snap = spark.createDataFrame([("a", 2)], "k string, v int")
    with pytest.raises(Exception, match="newer"):
        H.scd2_apply(hist, snap, "k", ["v"], JAN).collect()


def test_listing_errors_are_not_an_empty_history(spark, tmp):
    assert io.latest_version(spark, f"{tmp}/nothing") is None
    with pytest.raises(Exception):
        io.latest_version(spark, "nosuchscheme://x/y")


@pytest.mark.parametrize("text", ['{"count": 1, "results": [{"id": "a"}', '{"count": 1, "results": "x', "not json"])
def test_truncated_pages_stop_the_read(spark, tmp, text):
    write(f"{tmp}/p/p.json", json.dumps({"count": 1, "results": [{"id": "ok"}]}) + "\n" + text)
    with pytest.raises(Exception):
        io.read_registry_pages(spark, f"{tmp}/p").collect()
    write(f"{tmp}/land/population/year=2025/month=01/day=01/x.json", '{"county_name": "a"}\n' + text)
    with pytest.raises(Exception):
        io.read_landing(spark, f"{tmp}/land", "population").collect()


def test_payload_values_as_text(spark, tmp):
    page = {"results": [{"id": "a", "closed": "yes", "is_published": True, "open_weekends": 0, "open_whole_day": "",
                         "open_late_night": 1, "lat": "12d", "long": "1.5F", "beds": "7f", "cots": " 3.9 ",
                         "service_names": "[Special] Maternity"},
                        {"id": "b", "closed": False, "lat": "inf", "beds": None, "service_names": ["ART", "TB"]}]}
    write(f"{tmp}/p/p.json", json.dumps(page))
    got = {r.facility_id: r for r in standardise_registry(io.read_registry_pages(spark, f"{tmp}/p"), "2025-01-01 00:00:00").collect()}
    a, b = got["a"], got["b"]
    assert (a.closed, a.is_published, a.open_weekends, a.open_whole_day, a.open_late_night) == (True, True, False, False, True)
    assert (a.latitude, a.longitude, a.beds, a.cots) == (0.0, 0.0, 0, 3)
    assert a.service_names == "[Special] Maternity" and a.has_maternity
    assert b.closed is False and b.latitude == float("inf") and b.service_names == "ART|TB"


def test_feature_areas_as_text_and_file_order(spark, tmp):
    def feature(name, code, area):
        return {"properties": {"COUNTY_NAM": name, "COUNTY_COD": code, "Shape_Area": area}, "geometry": {"type": "Point"}}

    write(f"{tmp}/g/b.json", json.dumps({"features": [feature("Lamu", "late", "0.5")] * 400}))
    write(f"{tmp}/g/a.json", json.dumps({"features": [feature("Lamu", "first", 0.25), feature("Lamu", "second", "junk")]}))
    (geo,) = standardise_features(io.read_features(spark, f"{tmp}/g"), "2025-01-01 00:00:00").collect()
    assert geo.county_code == "first" and geo.area_sqkm == 200.25
    write(f"{tmp}/l/b.json", "\n".join([json.dumps(feature("Lamu", "late", 1))] * 400))
    write(f"{tmp}/l/a.json", "\n".join([json.dumps(feature("Lamu", "first", 1)), json.dumps(feature("Lamu", "second", 1))]))
    (geo,) = standardise_features(io.read_feature_lines(spark, f"{tmp}/l"), "2025-01-01 00:00:00").collect()
    assert geo.county_code == "first"


def test_scalar_guards(spark):
    df = spark.createDataFrame([("12d",), ("1.5F",), ("NaN",), ("-inf",), ("1e3",), (None,), ("7.",)], "x string")
    got = [str(r[0]) for r in df.select(N.safe_float("x")).collect()]
    assert got == ["0.0", "0.0", "nan", "-inf", "1000.0", "0.0", "7.0"]
    arr = spark.createDataFrame([('["a","b"]',), ("[a",), ("[x] y",), ("",), (None,), ("plain",)], "x string")
    assert [r[0] for r in arr.select(T.as_array("x")).collect()] == [["a", "b"], ["[a"], ["[x] y"], [], [], ["plain"]]


def test_empty_and_missing_models_fail(spark):
    empty = spark.createDataFrame([], "county_name string, n long")
    got = {r.check: r.failures for r in Q.model_report(empty, "m", ["county_name"], unique="county_name", row_count=47).collect()}
    assert got == {"not_null": 0, "unique": 0, "row_count": 1}
    assert [r.failures for r in Q.check_not_null(empty, ["county_name", "n"]).collect()] == [0, 0]
    fac = spark.createDataFrame([], "facility_id string, facility_code string, facility_name string, facility_type string, county_name string, operation_status string")
    report = run_checks({"stg_facilities": fac})
    assert report.count() == 30
    with pytest.raises(AssertionError, match="mart_county_density.\\* row_count"):
        Q.gate(report)
    with pytest.raises(AssertionError):
        Q.gate(report.limit(0))


def snaps(spark, data):
    return spark.createDataFrame([(k, v, datetime(2025, m, 1)) for k, v, m in data], "k string, flag boolean, at timestamp_ntz")


def test_null_flags_and_returning_keys(spark):
    other = [("x", True, m) for m in range(1, 7)]
    h = H.scd2_from_snapshots(snaps(spark, other + [
        ("n", False, 1), ("n", None, 2), ("n", False, 3), ("n", True, 4), ("n", None, 5),
        ("g", False, 1), ("g", True, 4), ("g", True, 6)]), "k", "at", ["flag"])
    got = rows(H.flag_transitions(h, "k", "flag", "2025-01-01 00:00:00", "2025-12-31 00:00:00"), "k", "changed_at", "change")
    assert got == [("g", datetime(2025, 4, 1), "gained"), ("n", datetime(2025, 4, 1), "gained"), ("n", datetime(2025, 5, 1), "lost")]


def test_history_is_linear_in_a_keys_snapshots(spark):
    def build(n):
        df = spark.range(n).select(F.lit("k").alias("k"), (F.col("id") % 7 < 5).alias("flag"),
                                   F.timestamp_seconds(F.col("id") * 3600).cast("timestamp_ntz").alias("at"))
        t = time.perf_counter()
        n_rows = H.scd2_from_snapshots(df, "k", "at", ["flag"]).count()
        return time.perf_counter() - t, n_rows

    build(1000)
    small, _ = build(20_000)
    large, n = build(80_000)
    assert n == 80_000 // 7 * 2 + 1
    assert large < 6 * small + 2


def test_no_job_runs_while_the_history_plan_is_built(spark):
    df = snaps(spark, [("a", True, 1), ("a", False, 2)])
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("plan", "plan")
    H.scd2_from_snapshots(df, "k", "at", ["flag"])
    assert list(tracker.getJobIdsForGroup("plan")) == []
    spark.sparkContext.setJobGroup("rest", "rest")


def test_relanded_day_replaces_its_rows(spark, tmp):
    from access_lake.sources.schemas import with_partitions
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("county_name string, population long")
    land, raw, ck = f"{tmp}/landing", f"{tmp}/raw", f"{tmp}/ck"
    df = spark.createDataFrame([("a", 1), ("b", 2)], schema).repartition(2)
    io.land(df, land, "population", JAN)
    assert ingest_landing(spark, land, "population", raw, ck, schema, max_files_per_trigger=1) >= 2
    io.land(df.withColumn("population", F.col("population") * 10), land, "population", JAN)
    io.land(df, land, "population", FEB)
    assert ingest_landing(spark, land, "population", raw, ck, schema) == 4
    out = io.raw_table(spark, raw, schema=with_partitions(schema))
    assert rows(out, "county_name", "population", "month") == [("a", 1, "02"), ("a", 10, "01"), ("b", 2, "02"), ("b", 20, "01")]


def test_as_of_reads_one_directory(spark, tmp):
    df = spark.createDataFrame([("a", 1)], "county_name string, population long")
    for d in (JAN, FEB):
        io.land(df, tmp, "population", d)
    assert io.landed_days(spark, tmp, "population") == ["2025-01-01", "2025-02-01"]
    got = io.read_as_of(spark, tmp, "population", date(2025, 1, 31))
    assert all("month=01" in f for f in got.inputFiles()) and got.count() == 1
    assert io.read_as_of(spark, tmp, "population", date(2024, 1, 1)).count() == 0
    assert io.landed_days(spark, tmp, "nothing") == []


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, key, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())


# -- literal values of the product, not read from ``fixed`` ------------------

def test_golden_gap_flags_and_scores(spark):
    """Areas with few services: every flag fires, severity reaches 12."""
    fac, n = [], 0

    def add(area, maternity, art, tb, emergency, more=0):
        nonlocal n
        for k in range(max(maternity, art, tb, emergency) + more):
            fac.append((f"f{n}", "Clinic", area, "", k < maternity, k < art, k < tb, k < emergency, None))
            n += 1

    add("murang'a", 3, 2, 2, 1)
    add("elgeyo-marakwet", 2, 1, 1, 0)
    add("lamu", 3, 2, 1, 0, more=5)
    add("nowhere", 0, 0, 0, 0, more=1)
    schema = ("facility_id string, facility_type string, county_name string, sub_county_name string, has_maternity boolean, "
              "has_art boolean, has_tb boolean, has_emergency boolean, has_outpatient boolean")
    facilities = spark.createDataFrame(fac, schema)
    pop = spark.createDataFrame([("muranga", "", 8000), ("elgeyo marakwet", "", 400_000), ("lamu", "", 20_000), ("lamu", "lamu", 20_000)],
                                "county_name string, sub_county_name string, population long")
    density, gaps = marts.mart_county_density(facilities, pop), marts.mart_service_gaps(facilities, pop)
    got = {r.county_name: r for r in marts.mart_underserved(density, gaps).collect()}
    flags = {k: (r.maternity_gap_flag, r.art_gap_flag, r.tb_gap_flag, r.no_emergency_flag, r.severity_score) for k, r in got.items()}
    assert flags == {"murang'a": (False, False, False, False, 2), "elgeyo-marakwet": (True, True, True, True, 12),
                     "lamu": (False, False, True, True, 6), "nowhere": (True, True, True, True, 9)}
    assert got["murang'a"].facilities_per_10k == 3.75 and got["elgeyo-marakwet"].facilities_per_10k == 0.05
    assert got["elgeyo-marakwet"].facilities_needed_to_baseline == 78
    assert got["lamu"].total_population == 40_000 and got["nowhere"].total_population is None
    assert [r.county_name for r in sorted(got.values(), key=lambda r: r.underserved_rank)] == ["elgeyo-marakwet", "nowhere", "lamu", "murang'a"]


def test_golden_constants():
    assert fixed.EXPECTED_AREA_COUNT == 47 and fixed.BASELINE_PER_10K == "2.0"
    assert (fixed.MATERNITY_GAP_BELOW, fixed.ART_GAP_BELOW, fixed.TB_GAP_BELOW) == (3, 2, 2)
    assert fixed.DENSITY_BANDS == [(1, 4), (2, 3), (5, 2)] and fixed.DENSITY_BAND_DEFAULT == 1
    assert fixed.SEVERITY_WEIGHTS == {"maternity_gap_flag": 2, "art_gap_flag": 2, "tb_gap_flag": 1, "no_emergency_flag": 3}
    assert fixed.TYPE_WEIGHTS == {"Hospital": 4, "Health Centre": 2} and len(fixed.HISTORY_CHECK_COLUMNS) == 12
    assert os.path.basename(fixed.__file__) == "fixed.py"
