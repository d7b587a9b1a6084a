"""Physical-plan properties the scale design relies on."""

from datetime import datetime

from pyspark.sql import functions as F

from access_lake.operators.dedup import latest_per_key
from access_lake.plans import marts, staging
from access_lake.sources import io, standin

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedup_limits_before_the_shuffle(spark):
    df = spark.range(0, 1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("ts"))
    p = plan(latest_per_key(df, ["k"], [F.desc("ts")], tiebreak=[]))
    # partial limit before the exchange, final after: a hot key ships one row per task
    assert p.count("WindowGroupLimit") == 2


def test_marts_aggregate_partially_and_prune_columns(spark):
    fac = staging.stg_facilities(standin.raw_facilities(spark, SF), standin.STANDIN_TYPE_RULES)
    pop = staging.stg_population(standin.raw_population(spark, SF))
    d = marts.mart_county_density(fac, pop)
    d.collect()
    p = plan(d)
    assert "partial_count" in p or "partial_sum" in p
    scans = [line for line in d._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line
             or "Scan parquet" in line]
    li_scan = [s for s in scans if "lineitem" in s]
    assert li_scan and all("l_extendedprice" not in s for s in li_scan)


def test_landing_dates_prune_partitions(spark, tmp):
    from datetime import date
    df = spark.createDataFrame([("a", 1)], "county_name string, population long")
    for m in (1, 2, 3):
        io.land(df, tmp, "population", datetime(2025, m, 1))
    from pyspark.sql.types import _parse_datatype_string
    r = io.read_landing(spark, tmp, "population", _parse_datatype_string("county_name string, population long"),
                        since=date(2025, 2, 1), until=date(2025, 2, 28))
    assert r.count() == 1
    assert "PartitionFilters: [(concat_ws" in plan(r)       # pruned on directories, not rows
    a = io.read_as_of(spark, tmp, "population", date(2025, 2, 15),
                      _parse_datatype_string("county_name string, population long"))
    assert [(x.month, x.population) for x in a.collect()] == [("02", 1)]
    # only the chosen day's directory is listed at all
    assert {f.split("/population/")[1].rsplit("/", 1)[0] for f in a.inputFiles()} == {"year=2025/month=02/day=01"}


def test_no_python_udfs_in_registered_queries(spark):
    import __spark_entry__ as E
    for name in ["mart_underserved", "registry_standardise", "title_case", "scd2_build", "dash_features"]:
        p = plan(E.queries()[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_staging_over_the_bucketed_table_has_no_exchange(spark):
    from access_lake import catalog
    df = staging.stg_facilities(catalog._bucketed_raw(spark, SF), standin.STANDIN_TYPE_RULES)
    p = plan(df)
    assert "Exchange" not in p and "Bucketed: true" in p and "WindowGroupLimit" in p
