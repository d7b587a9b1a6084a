"""A key or area holding a third of all rows: results stay whole and
correct, and the plan combines the hot group before the shuffle."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from access_lake.operators import history as H
from access_lake.operators.dedup import latest_per_key
from access_lake.plans import marts, staging
from test_staging_marts import RAW_COLS, fac, pop_rows

T0 = datetime(2025, 1, 1)


def test_hot_facility_and_hot_area(spark):
    rows = []
    for i in range(600):                    # one id with 200 copies, one area with 1/3 of rows
        fid = "hot" if i % 3 == 0 else f"f{i}"
        area = "Hot" if i % 3 == 1 else f"A{i % 7}"
        rows.append(fac(fid, county=area, ts=T0 + timedelta(days=i), mat=i % 2 == 0, name=f"n{i}"))
    raw = spark.createDataFrame(rows, RAW_COLS).repartition(6)
    stg = staging.stg_facilities(raw)
    got = {r.facility_id: r for r in stg.collect()}
    assert got["hot"].facility_name == "n597"              # newest copy of the hot id
    assert len(got) == 1 + 400
    pop = pop_rows(spark, [("1", "hot", "", 100000, 2019, T0)])
    d = {r.county_name: r for r in marts.mart_county_density(stg, pop).collect()}
    assert d["Hot"].total_facilities == 200 and d["Hot"].facilities_per_10k == 20.0
    assert sum(r.total_facilities for r in d.values()) == 401


def test_history_with_hot_key(spark):
    snaps = spark.createDataFrame(
        [("hot", f"s{d // 5}", T0 + timedelta(days=d)) for d in range(60)]
        + [(f"k{i}", "x", T0 + timedelta(days=d)) for i in range(10) for d in range(0, 60, 2)],
        "k string, state string, at timestamp_ntz")
    h = H.scd2_from_snapshots(snaps, "k", "at", ["state"])
    hot = sorted((r.valid_from, r.valid_to) for r in h.filter("k = 'hot'").collect())
    assert len(hot) == 12 and hot[-1][1] is None
    assert all(a[1] == b[0] for a, b in zip(hot, hot[1:]))  # contiguous versions
    # the others appear every second day: each missing day closes a version
    assert h.filter("k = 'k0'").count() == 30


def test_dedup_of_many_copies_is_whole(spark):
    df = spark.range(0, 30000).select((F.col("id") % 3 == 0).cast("int").alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], [F.desc("v")], tiebreak=[])
    assert sorted(tuple(r) for r in out.collect()) == [(0, 29999), (1, 29997)]
