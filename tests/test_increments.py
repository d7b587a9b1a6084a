"""Marts from changes, and checks whose state is kept."""

import random
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.functions import fixed
from access_lake.operators import quality as Q
from access_lake.operators.history_log import HistoryLog
from access_lake.operators.quality_log import CheckLog
from access_lake.plans import increments
from access_lake.plans.marts import area_profile
from helpers import rows

FAC = "facility_id string, county_name string, facility_type string, has_maternity boolean, has_art boolean, has_tb boolean, has_emergency boolean, has_outpatient boolean"
CHECKS = FAC.replace(" string", "").replace(" boolean", "").split(", ")[1:]


def month(spark, rng, areas, n=40):
    data = [(f"f{i}", rng.choice(areas), rng.choice(fixed.FACILITY_TYPES), *[rng.choice([True, False, None]) for _ in range(5)])
            for i in range(n) if rng.random() < 0.8]
    return spark.createDataFrame(data, FAC)


def test_profiles_of_changes_equal_full_counts(spark, tmp):
    rng = random.Random(3)
    log, profile = HistoryLog(spark, f"{tmp}/log", "facility_id", CHECKS, T._parse_datatype_string(FAC), buckets=2), None
    for k, areas in enumerate([["a", "b", None], ["a", "b", "c"], ["c"]]):  # areas come and go
        snap = month(spark, rng, areas)
        found = increments.step(log, profile, snap, datetime(2025, 1 + k, 1))
        path = f"{tmp}/p{k}"
        found.write.parquet(path)
        profile = spark.read.parquet(path)
        want = area_profile(snap)
        assert rows(profile, *want.columns) == rows(want)
    # an empty month closes everything
    assert increments.step(log, profile, snap.limit(0), datetime(2025, 6, 1)).count() == 0


def test_check_states_merge_and_replace(spark, tmp):
    schema = "id string, name string, kind string"
    first = [("a", "x", "k1"), ("b", None, "k1"), (None, "y", "bad"), (None, None, None)]
    second = [("a", "z", "k1"), ("c", "x", "bad"), ("d", "q", "k1")]
    checks = dict(not_null=["id", "name"], accepted=("kind", ["k1"]))
    log = CheckLog(spark, tmp, "m", "id", buckets=2, **checks)
    assert rows(log.report().select("check", "column_name", "failures")) == rows(
        Q.model_report(spark.createDataFrame([], schema), "m", unique="id", no_duplicates="id", **checks).select("check", "column_name", "failures"))
    log.add(spark.createDataFrame(second[:1] + first, schema), "2025-01")  # a wrong load, replaced by the next line
    log.add(spark.createDataFrame(first, schema), "2025-01")
    log.add(spark.createDataFrame(second, schema), "2025-02")
    whole = spark.createDataFrame(first + second, schema)
    assert rows(log.report()) == rows(Q.model_report(whole, "m", unique="id", no_duplicates="id", **checks))
    assert rows(log.failing_keys()) == sorted([("a", 2, 0), ("b", 1, 1), ("c", 1, 1), (None, 2, 4)], key=lambda t: tuple(map(str, t)))
    plan = log.state()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert rows(Q.gate_verdict(log.report()).select("passed")) == [(False,)]
