"""Map the driver's star-schema tables onto the product's raw tables.

The product reads a facility registry, a census and boundary features; the
test harness ships TPC-H-like tables instead. These adapters are views over
those tables, so every query's work grows with the data:

================  ===========================================================
facility          one ``lineitem`` row; id ``orderkey-linenumber``, landed at
                  ``l_shipdate``; area = customer's nation, sub-area =
                  customer's market segment, type text = ``p_name``
service flags     maternity ``l_returnflag = 'R'``, ART ``l_discount >= .05``,
                  TB ``l_tax = 0``, emergency ``l_quantity > 45``, outpatient
                  from the order priority (NULL for '4-NOT SPECIFIED')
population        per nation and per (nation, segment) from ``customer``;
                  names spelled with '-' instead of ' ' to exercise the keys
boundary feature  one ``supplier`` per feature (a "constituency"), in
                  supplier-key order, geometry a GeoJSON point
daily snapshot    ``events``: latest event per user and day
small areas       orders 1 to 40 lie in four small areas whose names carry
                  apostrophes, dashes and alias spellings: rows without any
                  service in the first, the others by order; so every gap
                  flag is true somewhere. Rows without services of orders 41
                  to 80 are a small sub-area of the drill-down area
================  ===========================================================
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from access_lake.operators.dedup import latest_per_key

# Type-text rules for the stand-in part names (the product rules look for
# 'hospital', 'health centre', ... which part names never contain).
STANDIN_TYPE_RULES = [
    ("ring", "Hospital"),
    ("plate", "Health Centre"),
    ("widget", "Dispensary"),
    ("bolt", "Clinic"),
]
# The area used by the single-area drill-down.
STANDIN_DRILL_AREA = "nation 0"
# Small areas by registry, census and boundary spelling, and population.
SMALL_AREAS = [("Muranga", "Murang'a", "Murang'a", 900_000), ("Elgeyo Marakwet", "Elgeyo-Marakwet", "Elegeyo-Marakwet", 400_000),
               ("Tharaka Nithi", "Tharaka-Nithi", "Tharaka - Nithi", 30_000), ("Kilifi", "Kilifi", "Kilifi", 20_000)]
SMALL_SUBAREA = "Annex"
# Census landing time of the stand-in population.
STANDIN_CENSUS_TS = "2019-08-24 00:00:00"


# Read schemas of the driver's tables. Declaring them skips Parquet schema
# inference, which otherwise runs a footer-reading job per read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
              "props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}


def per_session(fn):
    """Reuse the (lazy, already analysed) stand-in plans of the session in
    use: they are pure functions of their inputs and hold no data, so
    queries built on them skip re-analysing the shared sub-plan. A new
    session or folder drops all earlier plans, with their file listings."""
    cache: dict = {}
    owner: list = [None]

    @functools.wraps(fn)
    def inner(spark: SparkSession, sf_dir: str, *args):
        now = (spark.sparkContext.applicationId, id(spark), sf_dir.rstrip("/"))
        if owner[0] != now:
            cache.clear()
            owner[0] = now
        if args not in cache:
            cache[args] = fn(spark, sf_dir, *args)
        return cache[args]
    return inner


@per_session
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reader = spark.read
    if name in DRIVER_SCHEMAS:
        reader = reader.schema(DRIVER_SCHEMAS[name])
    return reader.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _bare() -> F.Column:
    """Rows without any of the four counted services."""
    return ((F.col("l_returnflag") != "R") & (F.col("l_discount") < 0.05) & (F.col("l_tax") > 0) & (F.col("l_quantity") <= 45))


def _annex() -> F.Column:
    return F.col("l_orderkey").between(41, 80) & _bare()


def _small_area() -> F.Column:
    """The area of the first orders' rows, open for ``otherwise``."""
    key, names = F.col("l_orderkey"), [F.lit(a[0]) for a in SMALL_AREAS]
    return (F.when(_annex(), F.lit(STANDIN_DRILL_AREA.upper()))
             .when(key.between(1, 40) & _bare(), names[0]).when(key.between(1, 7), names[1])
             .when(key.between(8, 15), names[2]).when(key.between(16, 40), names[3]))


@per_session
def raw_facilities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw facility rows in the product's column names."""
    li = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    part = table(spark, sf_dir, "part")
    # order-side dimensions first (a quarter of lineitem's rows), so each
    # lineitem row probes two join sides instead of four
    oc = (orders.join(cust, orders.o_custkey == cust.c_custkey)
                .join(nation, cust.c_nationkey == nation.n_nationkey)
                .select("o_orderkey", "o_totalprice", "o_orderpriority", "c_acctbal",
                        "c_mktsegment", "n_name"))
    j = (li.join(oc, li.l_orderkey == oc.o_orderkey)
           .join(part, li.l_partkey == part.p_partkey))
    status = (F.when(F.col("l_linestatus") == "O",
                     F.when(F.col("l_returnflag") == "A", F.lit("OPERATIONAL"))
                      .otherwise(F.lit("Operational")))
               .otherwise(F.lit("Closed")))
    return j.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"),
                    F.col("l_linenumber").cast("string")).alias("facility_id"),
        F.when(F.col("l_linenumber") == 7, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit("P"), F.col("l_partkey").cast("string"))).alias("facility_code"),
        F.col("p_name").alias("facility_name"),
        F.col("p_name").alias("facility_type"),
        _small_area().otherwise(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))).alias("county_name"),
        F.when(_annex(), F.lit(SMALL_SUBAREA))
         .when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit(""))
         .otherwise(F.col("c_mktsegment")).alias("sub_county_name"),
        F.concat(F.lit("W"), F.col("l_suppkey").cast("string")).alias("ward_name"),
        F.col("c_acctbal").alias("latitude"),
        F.col("o_totalprice").alias("longitude"),
        status.alias("operation_status"),
        (F.col("l_returnflag") == "R").alias("has_maternity"),
        (F.col("l_discount") >= 0.05).alias("has_art"),
        (F.col("l_tax") == 0).alias("has_tb"),
        (F.col("l_quantity") > 45).alias("has_emergency"),
        F.when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(None).cast("boolean"))
         .otherwise(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")).alias("has_outpatient"),
        F.col("l_shipdate").alias("ingested_at"),
    )


def _customer_weight() -> F.Column:
    return (F.lit(20000) + F.lit(7000) * F.col("n_nationkey")
            + F.col("c_custkey") % 997).cast("bigint")


@per_session
def raw_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census rows: one total row per nation (blank sub-area, or the area
    name itself) and one row per (nation, segment). Region 4 reports a zero
    total, which staging drops, so those areas have no population."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    cn = cust.join(nation, cust.c_nationkey == nation.n_nationkey).withColumn("_w", _customer_weight())
    name = F.replace(F.col("n_name"), F.lit("_"), F.lit("-"))
    # one pass over the customers: per-segment sums, and the nation totals
    # summed from those (the shared aggregate is reused, not rescanned)
    per_seg = (cn.groupBy("n_nationkey", "n_name", "n_regionkey", "c_mktsegment")
                 .agg(F.sum("_w").alias("_pop")))
    totals = (per_seg.groupBy("n_nationkey", "n_name", "n_regionkey")
                .agg(F.sum("_pop").alias("_pop"))
                .select(F.col("n_nationkey").cast("string").alias("county_code"),
                        name.alias("county_name"),
                        F.when(F.col("n_regionkey") < 2, F.lit("")).otherwise(name).alias("sub_county"),
                        F.when(F.col("n_regionkey") == 4, F.lit(0).cast("bigint"))
                         .otherwise(F.col("_pop")).alias("population")))
    subs = (per_seg
              .select(F.col("n_nationkey").cast("string").alias("county_code"),
                      name.alias("county_name"),
                      F.col("c_mktsegment").alias("sub_county"),
                      F.col("_pop").alias("population")))
    # one more row per small area, from the first customers; the first area
    # is loaded twice: with a blank sub-area and under its own name
    key = F.col("c_custkey")
    spelt, people, code = F.lit(None), F.lit(None), F.lit(None)
    for k, (_, census, _, population) in enumerate(SMALL_AREAS):
        spelt = F.when(key == k + 1, F.lit(census)).otherwise(spelt)
        people = F.when(key == k + 1, F.lit(population)).otherwise(people)
        code = F.when(key == k + 1, F.lit(f"S{k}")).otherwise(code)
    small = cust.filter(key.between(1, len(SMALL_AREAS))).select(
        code.alias("county_code"), spelt.alias("county_name"),
        F.explode(F.when(key == 1, F.array(F.lit(""), spelt)).otherwise(F.array(F.lit("")))).alias("sub_county"),
        people.cast("bigint").alias("population"))
    return (totals.unionByName(subs).unionByName(small)
                  .withColumn("census_year", F.lit(2019))
                  .withColumn("ingested_at", F.lit(STANDIN_CENSUS_TS).cast("timestamp_ntz")))


@per_session
def subarea_seed(spark: SparkSession, sf_dir: str, area: str = STANDIN_DRILL_AREA) -> DataFrame:
    """Sub-area population seed of the drill-down area: per segment of the
    area's customers, with a 2024 projection."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    cn = (cust.join(nation, cust.c_nationkey == nation.n_nationkey)
              .filter(F.lower(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))) == area.lower())
              .withColumn("_w", _customer_weight()))
    return (cn.groupBy("c_mktsegment")
              .agg(F.sum("_w").cast("bigint").alias("population_2019"),
                   F.count(F.lit(1)).alias("_n"))
              .select(F.initcap(F.col("c_mktsegment")).alias("sub_county_name"),
                      "population_2019",
                      (F.col("population_2019") + F.col("_n") * 2311).cast("bigint").alias("population_2024"),
                      F.lit(2019).alias("census_year"),
                      F.lit(2024).alias("projection_year"),
                      F.lit(0.022).cast("double").alias("growth_rate")))


@per_session
def raw_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundary features, one per supplier, in supplier-key order ``pos``.
    Suppliers with a negative balance carry the name 'None' (dropped by
    standardisation); balances above 9000 have no area."""
    sup = table(spark, sf_dir, "supplier")
    nation = table(spark, sf_dir, "nation")
    j = sup.join(nation, sup.s_nationkey == nation.n_nationkey)
    small = None
    for k, (_, _, boundary, _) in enumerate(SMALL_AREAS):
        cond = F.col("s_suppkey") == k + 1
        small = F.when(cond, F.lit(boundary)) if small is None else small.when(cond, F.lit(boundary))
    name = (small.when(F.col("s_acctbal") < 0, F.lit("None"))
             .when(F.col("n_regionkey") == 0, F.replace(F.col("n_name"), F.lit("_"), F.lit(" - ")))
             .when(F.col("n_regionkey") == 1, F.replace(F.col("n_name"), F.lit("_"), F.lit("-")))
             .otherwise(F.replace(F.col("n_name"), F.lit("_"), F.lit(" "))))
    geometry = F.when(F.col("s_suppkey") == 4, F.lit(None).cast("string")).otherwise(F.concat(F.lit('{"type": "Point", "coordinates": ['),
                        F.col("s_suppkey").cast("string"), F.lit(", "),
                        F.col("n_nationkey").cast("string"), F.lit("]}")))
    area = (F.when(F.col("s_acctbal") > 9000, F.lit(None).cast("double"))
             .otherwise((F.col("s_suppkey") % 50).cast("double") / 4))
    return j.select(
        F.col("s_suppkey").alias("pos"),
        name.alias("COUNTY_NAM"),
        F.col("n_nationkey").cast("string").alias("COUNTY_COD"),
        F.col("s_suppkey").cast("string").alias("CONST_CODE"),
        area.alias("Shape_Area"),
        geometry.alias("geometry"))


def snapshot_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times of :func:`daily_snapshots`, without building them: each day
    with an event has a snapshot."""
    return table(spark, sf_dir, "events").select(F.to_date("ts").cast("timestamp_ntz").alias("snapshot_at"))


@per_session
def facility_months(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly facility snapshots for the history: the last row landed in a
    month per ward code. Wards without a row in a month are absent from it
    (and return later), the outpatient flag is NULL for one order priority."""
    raw = raw_facilities(spark, sf_dir)
    cols = [c for c in raw.columns if c != "ingested_at"]
    month = raw.withColumn("snapshot_at", F.date_trunc("month", "ingested_at").cast("timestamp_ntz"))
    last = latest_per_key(month, ["ward_name", "snapshot_at"], [F.desc_nulls_last("ingested_at")],
                          [F.asc_nulls_last(c) for c in cols if c != "ward_name"])
    return last.select(F.col("ward_name").alias("facility_id"),
                       *[c for c in cols if c not in ("facility_id", "ward_name")], "snapshot_at")


def facility_month_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The times of :func:`facility_months`."""
    return table(spark, sf_dir, "lineitem").select(
        F.date_trunc("month", "l_shipdate").cast("timestamp_ntz").alias("snapshot_at"))


@per_session
def daily_snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (user, day): the state after the user's last event of
    the day. Users without events on a day are absent from that snapshot."""
    ev = table(spark, sf_dir, "events")
    day = ev.withColumn("snap_date", F.to_date("ts"))
    last = latest_per_key(day, ["user_id", "snap_date"],
                          [F.desc("ts"), F.desc("event_id")], tiebreak=[])
    return last.select(
        "user_id",
        F.col("snap_date").cast("timestamp_ntz").alias("snapshot_at"),
        "event_type",
        F.floor(F.col("value") / 10).cast("int").alias("value_band"),
        (F.get_json_object("props", "$.k").cast("int") >= 50).alias("is_high"))


SNAPSHOT_KEY = "user_id"
SNAPSHOT_CHECK_COLUMNS = ["event_type", "value_band", "is_high"]


SERVICE_NAMES = [("has_maternity", "Maternity Services"), ("has_art", "ART"),
                 ("has_tb", "TB Screening"), ("has_emergency", "Emergency"),
                 ("has_outpatient", "Out-patient")]


@per_session
def registry_results(spark: SparkSession, sf_dir: str, with_shipped: bool = False) -> DataFrame:
    """Registry result rows as the API returns them (text fields, services
    as a JSON array text or a single string), one per raw facility row.
    Line 1 of an order lists its first service as a plain string; ``lat``
    carries spaces, ``long`` is junk on line 3, ``beds`` is fractional text,
    ``code`` is missing on line 7. ``with_shipped`` keeps the landing time
    that the stand-in months are split by."""
    raw = raw_facilities(spark, sf_dir)
    line = F.split(F.col("facility_id"), "-").getItem(1).cast("int")
    names = [F.when(F.col(flag), F.lit(f'"{label}"')) for flag, label in SERVICE_NAMES]
    first = F.coalesce(*[F.when(F.col(flag), F.lit(label)) for flag, label in SERVICE_NAMES])
    arr_text = F.concat(F.lit("["), F.concat_ws(",", *names), F.lit("]"))
    infra = (F.when(F.col("latitude") > 5000, F.lit('["Grid power","Piped Water"]'))
              .when(F.col("latitude") > 0, F.lit('["Solar"]')))
    return raw.select(
        F.col("facility_id").alias("id"),
        F.col("facility_code").alias("code"),
        F.concat(F.lit("  "), F.col("facility_name"), F.lit("\t")).alias("name"),
        F.concat(F.lit(" "), F.col("latitude").cast("string"), F.lit(" ")).alias("lat"),
        F.when(line == 3, F.lit("abc")).otherwise(F.col("longitude").cast("string")).alias("long"),
        (F.col("longitude") / 1000).cast("string").alias("beds"),
        F.when(line == 1, first).otherwise(arr_text).alias("service_names"),
        infra.alias("infrastructure_names"),
        F.col("county_name"), F.col("sub_county_name"), F.col("ward_name"),
        F.col("operation_status").alias("operation_status_name"),
        *([F.col("ingested_at").alias("shipped")] if with_shipped else []))


@per_session
def census_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Census rows as published, with drifting header names, one per nation
    plus a Total row: populations with thousands separators, a fractional
    text (rejected) for region 3 and zero for region 4."""
    cust = table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation")
    cn = cust.join(nation, cust.c_nationkey == nation.n_nationkey)
    w = (F.lit(20000) + F.lit(7000) * F.col("n_nationkey") + F.col("c_custkey") % 997).cast("bigint")
    per = (cn.groupBy("n_nationkey", "n_name", "n_regionkey")
             .agg(F.sum(w).alias("p"), F.count(F.lit(1)).alias("h")))
    name = F.replace(F.lower(F.col("n_name")), F.lit("_"), F.lit("-"))
    pop_text = (F.when(F.col("n_regionkey") == 3, F.concat(F.col("p").cast("string"), F.lit(".0")))
                 .when(F.col("n_regionkey") == 4, F.lit("0"))
                 .otherwise(F.format_number(F.col("p"), 0)))
    rows = per.select(
        F.concat(F.lit(" "), name, F.lit(" ")).alias("County"),
        F.col("n_nationkey").cast("string").alias("Code"),
        pop_text.alias("Total_Population19"),
        F.format_number(F.expr("p * 49 div 100"), 0).alias("Male populatio 2019"),
        F.col("h").cast("string").alias("Households"))
    total = per.agg(F.sum("p").alias("p"), F.sum("h").alias("h")).select(
        F.lit("Total").alias("County"), F.lit("").alias("Code"),
        F.format_number(F.col("p"), 0).alias("Total_Population19"),
        F.lit("").alias("Male populatio 2019"), F.col("h").cast("string").alias("Households"))
    return rows.unionByName(total)
