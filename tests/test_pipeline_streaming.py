import json
import os
from datetime import datetime

from pyspark.sql import functions as F

from access_lake.plans.pipeline import MonthInputs, run_month
from access_lake.sources import io
from access_lake.streaming.landing_ingest import ingest_landing


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def fixtures(tmp, month):
    names = ["Nairobi", "Mombasa", "Lamu"]
    results = []
    for i in range(30):
        county = names[i % 3]
        closed_late = month == 2 and i == 4
        results.append({
            "id": f"f{i}", "code": f"C{i}", "name": f"Facility {i}",
            "facility_type_name": ["Sub-County Hospital", "Health Centre", "Dispensary", "Medical Clinic"][i % 4],
            "county_name": county, "sub_county_name": ["Westlands", "Starehe", ""][(i // 3) % 3] if county == "Nairobi" else "",
            "lat": "-1.2", "long": "36.8",
            "operation_status_name": "Closed" if closed_late else "Operational",
            "service_names": ["Maternity", "ART", "TB-screening"] if i % 2 else "Emergency",
        })
    if month == 2:
        results.append({"id": "f99", "code": "C99", "name": "New", "facility_type_name": "Dispensary",
                        "county_name": "Lamu", "operation_status_name": "Operational"})
    pages = [{"count": len(results), "total_pages": 2, "results": results[:15]},
             {"count": len(results), "total_pages": 2, "results": results[15:]}]
    write(f"{tmp}/in{month}/pages/p.json", "\n".join(json.dumps(p) for p in pages))
    write(f"{tmp}/in{month}/census/c.csv",
          "County,Total_Population19\nNairobi,\"4,397,073\"\nMombasa,\"1,208,333\"\nLamu,143920\nTotal,\"5,749,326\"\n")
    fc = {"features": [{"properties": {"COUNTY_NAM": n, "COUNTY_COD": str(k), "Shape_Area": 0.5},
                        "geometry": {"type": "Point", "coordinates": [k, k]}} for k, n in enumerate(names)]}
    write(f"{tmp}/in{month}/geo/k.geojson", json.dumps(fc))
    write(f"{tmp}/in{month}/seed/s.csv", "sub_county_name,population_2019,population_2024,census_year,"
                                         "projection_year,growth_rate\nWestlands,308854,344000,2019,2024,0.022\n"
                                         "Starehe,210423,218388,2019,2024,0.022\n")
    return MonthInputs(registry_pages=f"{tmp}/in{month}/pages", census_csv=f"{tmp}/in{month}/census",
                       features=f"{tmp}/in{month}/geo/k.geojson", seed_csv=f"{tmp}/in{month}/seed",
                       expected_areas=3)


def test_run_month_twice(spark, tmp):
    root = f"{tmp}/lake"
    out1 = run_month(spark, fixtures(tmp, 1), root, datetime(2025, 1, 1, 2))
    out2 = run_month(spark, fixtures(tmp, 2), root, datetime(2025, 2, 1, 2))
    from access_lake.sources.io import read_latest
    under = read_latest(spark, f"{root}/marts/mart_underserved_counties")
    assert under.count() == 3
    assert sorted(r[0] for r in under.select("underserved_rank").collect()) == [1, 2, 3]
    sub = read_latest(spark, f"{root}/marts/mart_subarea")
    assert {r.sub_county_name for r in sub.collect()} == {"Westlands", "Starehe"}
    report = spark.read.parquet(out2["checks"])
    assert report.count() == 30 and report.filter("failures > 0").count() == 0
    hist = spark.read.parquet(out2["history"])
    # staging filters before it deduplicates over every landing, so the
    # month-1 operational row of f4 survives its month-2 closure
    f4 = hist.filter("facility_id = 'f4'").collect()
    assert len(f4) == 1 and f4[0].valid_to is None
    assert hist.filter("facility_id = 'f99' and valid_to is null").count() == 1
    assert hist.filter("valid_to is null").count() == 31
    assert out1["history"] != out2["history"]
    assert read_latest(spark, f"{root}/history").count() == hist.count()
    # a version that died mid-write (never published) is ignored by readers
    spark.range(3).write.parquet(f"{root}/history/v20990101000000")
    assert read_latest(spark, f"{root}/history").count() == hist.count()


def test_streaming_ingest_is_incremental(spark, tmp):
    land = f"{tmp}/landing"
    df = spark.createDataFrame([("a", 1), ("b", 2)], "county_name string, population long")
    io.land(df, land, "population", datetime(2025, 1, 1))
    from pyspark.sql.types import _parse_datatype_string
    schema = _parse_datatype_string("county_name string, population long")
    raw, ck = f"{tmp}/raw/population", f"{tmp}/ck/population"
    assert ingest_landing(spark, land, "population", raw, ck, schema) == 2
    io.land(df.withColumn("population", F.col("population") * 10), land, "population", datetime(2025, 2, 1))
    assert ingest_landing(spark, land, "population", raw, ck, schema) == 2
    assert ingest_landing(spark, land, "population", raw, ck, schema) == 0   # nothing new
    from access_lake.sources.schemas import with_partitions
    out = io.raw_table(spark, raw, schema=with_partitions(schema))
    assert out.count() == 4 and sorted(r[0] for r in out.select("month").distinct().collect()) == ["01", "02"]
