"""Disk and memory that follow the input: compressed landing and page files
of bounded size, buckets by the number of rows."""

import os
from datetime import datetime

from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.readwriter import DataStreamReader

from access_lake import catalog
from access_lake.sources import bucketed, io
from access_lake.sources import schemas as S
from access_lake.sources.standardise import standardise_registry
from access_lake.streaming.landing_ingest import ingest_landing
from helpers import rows


def files(path):
    return [os.path.join(d, n) for d, _, names in os.walk(path) for n in names if n.startswith("part-")]


def test_landed_files_are_compressed_and_bounded(spark, tmp, monkeypatch):
    monkeypatch.setattr(io, "LANDED_RECORDS", 10)
    df = spark.createDataFrame([(f"county {i % 7}", i) for i in range(25)], "county_name string, population long").coalesce(1)
    report = io.land(df, f"{tmp}/land", "population", datetime(2025, 3, 1))
    landed = files(f"{tmp}/land")
    assert report.record_count == 25 and len(landed) == 3 and all(f.endswith(".json.gz") for f in landed)
    assert rows(io.read_landing(spark, f"{tmp}/land", "population"), "county_name", "population") == rows(df)


def test_pages_hold_every_result_without_a_shuffle(spark, tmp, monkeypatch):
    monkeypatch.setattr(catalog, "FILE_PAGES", 2)
    df = spark.createDataFrame([(str(i % 300), None if i % 5 else "x", 'a "b"\n') for i in range(450)], "id string, code string, name string")
    catalog.write_pages(df.coalesce(1), f"{tmp}/pages")
    pages = spark.read.schema(S.REGISTRY_PAGE).json(f"{tmp}/pages")
    assert [r[0] for r in pages.select(F.size("results")).collect()].count(100) == 4 and pages.filter(F.col("count") != F.size("results")).count() == 0
    assert len(files(f"{tmp}/pages")) == 3 and all(f.endswith(".txt.gz") for f in files(f"{tmp}/pages"))
    assert rows(io.read_registry_pages(spark, f"{tmp}/pages"), "id", "code", "name") == rows(df)
    catalog.write_pages(df.limit(0), f"{tmp}/none")
    assert io.read_registry_pages(spark, f"{tmp}/none").count() == 0


def test_registry_arrays_are_parsed_once(spark):
    raw = spark.createDataFrame([("1", '["ART", "TB"]', '["Solar"]', " 2 ", "x")] * 3, "id string, service_names string, infrastructure_names string, lat string, long string")
    df = standardise_registry(raw, "2025-01-01 00:00:00")
    assert df._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2
    row = df.first()
    assert (row.service_names, row.has_art, row.has_electricity, row.latitude, row.longitude, row.has_gps) == ("ART|TB", True, True, 2.0, 0.0, False)


def test_ingest_reads_each_landed_record_once(spark, tmp, monkeypatch):
    df = spark.createDataFrame([("a", 1), ("b", 2)], "county_name string, population long")
    schema = T.StructType(df.schema.fields)
    for day in (1, 2, 2):
        io.land(df.withColumn("population", F.col("population") + day), f"{tmp}/l", "population", datetime(2025, 3, day))
        # new files are found by name; their records are parsed by the write alone
        monkeypatch.setattr(DataStreamReader, "json", None)
        assert ingest_landing(spark, f"{tmp}/l", "population", f"{tmp}/raw", f"{tmp}/ck", schema) == 2
    assert ingest_landing(spark, f"{tmp}/l", "population", f"{tmp}/all", f"{tmp}/ck2", schema) == 4  # two days at once
    for at in ("raw", "all"):
        got = io.raw_table(spark, f"{tmp}/{at}", schema=S.with_partitions(schema))
        assert sorted(map(tuple, got.collect())) == sorted((c, n + d, "2025", "03", f"0{d}") for c, n in (("a", 1), ("b", 2)) for d in (1, 2))


def test_buckets_grow_with_the_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    spark.range(105).select(F.col("id").alias("l_orderkey")).write.parquet(f"{tmp}/sf/lineitem.parquet")
    buckets = catalog._facility_buckets(spark, f"{tmp}/sf")
    assert buckets == 11 and bucketed.buckets_for(3) == bucketed.BUCKETS
    df = spark.createDataFrame([(str(i % 90), i) for i in range(105)] + [(None, -1)], "id string, v long")
    bucketed.write_load(df, f"{tmp}/plain", "id", buckets)
    # dealt by a shuffle of 8 partitions, whose tasks hold rows of many of the 11 buckets
    bucketed.write_load(df.repartition("id"), f"{tmp}/dealt", "id", buckets, dealt=True)
    for at in ("plain", "dealt"):
        assert rows(bucketed.read_loads(spark, f"{tmp}/{at}", df.schema, "id", buckets)) == rows(df)
        assert len(files(f"{tmp}/{at}")) <= buckets


def test_check_states_of_a_query_take_the_buckets_of_its_rows(spark, tmp, monkeypatch):
    monkeypatch.setattr(bucketed, "BUCKET_ROWS", 10)
    raw = spark.createDataFrame([(str(i), None, "n", "s", None, "Closed", datetime(1995, 1 + i % 12, 1)) for i in range(120)],
                                "facility_id string, facility_code string, facility_name string, sub_county_name string, "
                                "has_outpatient boolean, operation_status string, ingested_at timestamp_ntz")
    spark.range(120).select(F.col("id").alias("l_orderkey")).write.parquet(f"{tmp}/sf/lineitem.parquet")
    monkeypatch.setattr(catalog.standin, "raw_facilities", lambda *a: raw)
    log = catalog._checked_rows(spark, f"{tmp}/sf")
    assert log.buckets == 12 and log.failing_keys().count() == 120
