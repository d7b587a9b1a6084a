from datetime import datetime

from pyspark.sql import functions as F

from access_lake.operators import history as H
from helpers import rows

D = [datetime(2025, m, 1) for m in (1, 2, 3, 4)]
SCHEMA = "k string, name string, ftype string, flag boolean, ward string, at timestamp_ntz"
CHECK = ["name", "ftype", "flag"]


def snapshots(spark):
    data = []
    for i, d in enumerate(D):
        data.append(("same", "S", "Dispensary", True, "w", d))                        # unchanged
        data.append(("rename", "R" if i < 2 else "R2", "Clinic", False, "w", d))     # name change on 3
        data.append(("flag", "F", "Clinic", None if i == 0 else True, "w", d))       # NULL → true on 2
        if i != 2:
            data.append(("gap", "G", "Clinic", False, "w", d))                        # missing on 3
        if i >= 1:
            data.append(("new", "N", "Clinic", False, "w", d))                        # new on 2
        data.append(("up", "U", "Dispensary" if i < 3 else "Health Centre", False, "w", d))
        data.append(("ward", "W", "Clinic", False, f"ward{i}", d))                   # unchecked change
    return spark.createDataFrame(data, SCHEMA)


def build(spark):
    return H.scd2_from_snapshots(snapshots(spark), "k", "at", CHECK)


def fold(spark):
    snaps = snapshots(spark)
    hist = H.scd2_from_snapshots(snaps.filter(F.col("at") == D[0]), "k", "at", CHECK)
    for d in D[1:]:
        snap = snaps.filter(F.col("at") == d).drop("at")
        # each applied version is cut from its lineage, as a written table would be
        hist = H.scd2_apply(hist, snap, "k", CHECK, d.strftime("%Y-%m-%d %H:%M:%S")).checkpoint()
    return hist


COLS = ["k", "name", "ftype", "flag", "valid_from", "valid_to", "is_deleted", "scd_id"]


def test_versions(spark):
    h = {(r.k, r.valid_from): r for r in build(spark).collect()}
    assert len([k for k in h if k[0] == "same"]) == 1 and h[("same", D[0])].valid_to is None
    assert h[("rename", D[0])].valid_to == D[2] and h[("rename", D[2])].name == "R2"
    assert h[("flag", D[0])].valid_to == D[1] and h[("flag", D[1])].flag is True
    assert h[("gap", D[0])].valid_to == D[2] and h[("gap", D[0])].is_deleted is True
    assert h[("gap", D[3])].valid_to is None
    assert ("new", D[1]) in h and ("new", D[0]) not in h
    assert h[("up", D[3])].ftype == "Health Centre"
    assert len([k for k in h if k[0] == "ward"]) == 1        # unchecked column: no new version


def test_fold_equals_bulk_build(spark):
    assert rows(fold(spark), *COLS) == rows(build(spark), *COLS)


def test_apply_twice_is_idempotent(spark):
    snaps = snapshots(spark)
    hist = build(spark)
    last = snaps.filter(F.col("at") == D[3]).drop("at")
    again = H.scd2_apply(hist, last, "k", CHECK, "2025-04-01 00:00:00")
    assert rows(again, *COLS) == rows(hist, *COLS)


def test_history_properties(spark):
    h = build(spark)
    assert h.filter("valid_to is null").groupBy("k").count().filter("count > 1").count() == 0
    a, b = h.alias("a"), h.alias("b")
    overlap = a.join(b, (F.col("a.k") == F.col("b.k")) & (F.col("a.valid_from") < F.col("b.valid_from"))
                     & (F.col("a.valid_to").isNull() | (F.col("a.valid_to") > F.col("b.valid_from"))))
    assert overlap.count() == 0


def test_history_queries(spark):
    h = build(spark)
    assert rows(H.as_of(h, "2025-03-15 00:00:00").filter("k = 'gap'")) == []
    assert H.current(h).count() == 7
    up = H.type_transitions(h, "k", "ftype", "Dispensary", "Health Centre")
    assert rows(up, "k", "changed_at") == [("up", D[3])]
    fl = H.flag_transitions(h, "k", "flag", "2025-01-15 00:00:00", "2025-04-30 00:00:00")
    assert rows(fl, "k", "change") == [("flag", "gained")]
    fs = dict(rows(H.first_seen(h, "k")))
    assert fs["new"] == D[1] and fs["same"] == D[0]
    cot = rows(H.count_over_time(h, "ftype", "Clinic"))
    assert cot == [(D[0], 4), (D[1], 5), (D[2], 4), (D[3], 5)]   # gap key back on date 4
    net = {r.ftype: r.net_change for r in H.net_change(h, "ftype", "2025-01-15 00:00:00",
                                                       "2025-04-15 00:00:00").collect()}
    assert net == {"Clinic": 1, "Dispensary": -1, "Health Centre": 1}
