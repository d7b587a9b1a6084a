"""Late snapshots, the history log and as-of joins against the bulk build."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.operators import asof
from access_lake.operators import history as H
from access_lake.operators.history_late import neighbours, scd2_insert
from access_lake.operators.history_log import HistoryLog
from helpers import rows

SNAP = "id string, status string, flag boolean, extra int, at timestamp_ntz"
CHECKS = ["status", "flag"]


def day(k):
    return datetime(2024, 1, 1) + timedelta(days=k)


def random_snapshots(rng, n_days, n_keys=25):
    """Full snapshots with absences, NULLs, and an unchecked column that
    differs on every day."""
    out = []
    for k in range(n_days):
        for i in range(n_keys):
            if rng.random() < 0.7:
                out.append((f"f{i}", rng.choice(["open", "shut", None]), rng.choice([True, None]), k * 100 + i, day(k)))
    return out


def bulk(spark, data):
    df = spark.createDataFrame(data, SNAP)
    return H.scd2_from_snapshots(df, "id", "at", CHECKS)


@pytest.mark.parametrize("order", [[0, 2, 1], [1, 2, 0], [0, 3, 1, 2], [3, 0, 2, 1], [0, 1, 2]])
def test_any_order_of_months_equals_the_build_in_order(spark, order):
    rng = random.Random(sum(k * 7 ** i for i, k in enumerate(order)))
    data = random_snapshots(rng, len(order))
    known, hist = [], None
    snaps = {k: spark.createDataFrame([r for r in data if r[4] == day(k)], SNAP).drop("at") for k in order}
    for k in order:
        if hist is None:
            hist = bulk(spark, [r for r in data if r[4] == day(k)])
        else:
            before, after = neighbours(known, day(k))
            following = snaps[(after - day(0)).days] if after else None
            hist = scd2_insert(hist, snaps[k], following, "id", CHECKS, day(k), before, after)
        hist = spark.createDataFrame(hist.collect(), hist.schema)  # cut the plan
        known.append(day(k))
    assert rows(hist, *sorted(hist.columns)) == rows(bulk(spark, data), *sorted(hist.columns))


def test_a_late_month_into_an_empty_history(spark):
    data = random_snapshots(random.Random(2), 1)
    none = bulk(spark, []).limit(0)
    got = scd2_insert(none, spark.createDataFrame(data, SNAP).drop("at"), None, "id", CHECKS, day(0), None, None)
    assert rows(got) == rows(bulk(spark, data).select(*got.columns))


def log_of(spark, root):
    data = T._parse_datatype_string(SNAP)
    return HistoryLog(spark, root, "id", CHECKS, T.StructType([f for f in data.fields if f.name != "at"]), buckets=3)


def test_the_log_equals_the_bulk_build_and_writes_what_changed(spark, tmp):
    data = random_snapshots(random.Random(8), 5)
    log = log_of(spark, tmp)
    for k in range(5):
        snap = spark.createDataFrame([r for r in data if r[4] == day(k)], SNAP).drop("at")
        log.apply(snap, day(k))
        if k == 3:
            log.apply(snap, day(k))  # a retry repeats itself
    want = bulk(spark, data)
    assert rows(log.history(), *want.columns) == rows(want)
    assert rows(log.open_versions().select(*["id", "status"])) == rows(H.current(want).select("id", "status"))
    # an unchanged snapshot writes nothing
    again = spark.createDataFrame([r for r in data if r[4] == day(4)], SNAP).drop("at")
    log.apply(again, day(5))
    assert spark.read.parquet(f"{tmp}/changes/{log.run_name(day(5))}").count() == 0
    # a second session object over the same files finds them
    assert rows(log_of(spark, tmp).history(), *want.columns) == rows(want)
    with pytest.raises(ValueError, match="runs after"):
        log.apply(again, day(1) + timedelta(hours=1))


def test_the_log_joins_without_an_exchange_on_the_history_side(spark, tmp):
    log = log_of(spark, tmp)
    data = random_snapshots(random.Random(9), 2)
    log.apply(spark.createDataFrame([r for r in data if r[4] == day(0)], SNAP).drop("at"), day(0))
    log.apply(spark.createDataFrame([r for r in data if r[4] == day(1)], SNAP).drop("at"), day(1))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = log.history()._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Bucketed: true" in plan
        snap = spark.createDataFrame([r for r in data if r[4] == day(1)], SNAP).drop("at")
        plan = log.changes(snap, day(2))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1  # the snapshot's
        assert "extra" not in "".join(line for line in plan.splitlines() if "FileScan" in line)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_as_of_many_equals_one_filter_per_time(spark):
    data = random_snapshots(random.Random(4), 6)
    hist = bulk(spark, data)
    asked = [day(k) + timedelta(hours=h) for k in range(-1, 8) for h in (0, 13)] + [None, day(2)]
    times = spark.createDataFrame([(t,) for t in asked], "at timestamp_ntz")
    got = asof.as_of_many(hist, times)
    want = sorted(((t, *r) for t in set(asked) - {None} for r in map(tuple, H.as_of(hist, t).collect())), key=lambda t: tuple(map(str, t)))
    assert rows(got) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = asof.as_of_many(hist, times)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    counts = {(r.at, r.status): r.open_count for r in asof.counts_as_of(hist, times, ["status"]).collect()}
    assert sum(counts.values()) == len(want)


def test_as_of_many_without_times_and_with_one(spark):
    hist = bulk(spark, random_snapshots(random.Random(6), 3))
    none = spark.createDataFrame([(None,)], "at timestamp_ntz")
    assert asof.as_of_many(hist, none).count() == 0
    one = spark.createDataFrame([(day(1),)], "at timestamp_ntz")
    assert asof.as_of_many(hist, one).count() == H.as_of(hist, day(1)).count()
