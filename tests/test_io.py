import json
import os
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from access_lake.plans import staging
from access_lake.sources import io
from access_lake.sources.standardise import (standardise_census, standardise_features,
                                             standardise_registry)

RUN_TS = "2025-05-01 02:00:00"


def write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as fh:
        fh.write(text)


def test_registry_pages_standardise(spark, tmp):
    page1 = {"count": 3, "total_pages": 2, "results": [
        {"id": "f1", "code": 101, "name": "  Alpha Dispensary\t", "lat": " -1.2 ", "long": "36.8",
         "beds": "12.7", "service_names": ["Maternity", "ART"], "infrastructure_names": ["Off-Grid"],
         "operation_status_name": "Operational", "county_name": "Nairobi", "closed": None},
        {"id": "f2", "code": None, "name": "Beta", "lat": "abc", "long": None, "beds": None,
         "service_names": "TB-screening", "is_published": True},
    ]}
    page2 = {"count": 3, "total_pages": 2, "results": [
        {"id": "f3", "name": "Gamma", "service_names": ["ART", "Heart Clinic"], "lat": "1", "long": "2",
         "infrastructure_names": ["Borehole water", "solar"]}]}
    page3 = {"count": 3, "total_pages": 2, "results": []}
    write(f"{tmp}/pages/p.json", "\n".join(json.dumps(p) for p in [page1, page2, page3]))
    rec = standardise_registry(io.read_registry_pages(spark, f"{tmp}/pages"), RUN_TS)
    assert len(rec.columns) == 43
    got = {r.facility_id: r for r in rec.collect()}
    f1, f2, f3 = got["f1"], got["f2"], got["f3"]
    assert f1.facility_code == "101" and f1.facility_name == "Alpha Dispensary"
    assert (f1.latitude, f1.longitude, f1.has_gps, f1.beds) == (-1.2, 36.8, True, 12)
    assert f1.has_maternity and not f1.has_art and f1.has_electricity and not f1.has_water
    assert f1.service_names == "Maternity|ART" and f1.closed is False
    assert f2.facility_code == "" and f2.latitude == 0.0 and f2.has_gps is False and f2.beds == 0
    assert f2.has_tb and f2.service_names == "TB-screening" and f2.is_published
    assert f3.has_art and f3.has_water and f3.has_electricity
    assert str(f1.ingested_at) == "2025-05-01 02:00:00"


def test_census_csv(spark, tmp):
    csv = ("County,Code,Total_Population19,Male populatio 2019,Female population 2019,Households\n"
           'nairobi,47,"4,397,073","2,192,452","2,204,376","1,506,888"\n'
           "murang'a,21,1056640,523940,532669,318105\n"
           "Total,,47564296,,,\n"
           "Kenya,,47564296,,,\n"
           ",,100,,,\n"
           "elgeyo-marakwet,28,1234.0,,,\n"
           "zero,9,0,,,\n")
    write(f"{tmp}/census/c.csv", csv)
    out = standardise_census(io.read_census_csv(spark, f"{tmp}/census"), RUN_TS)
    got = {r.county_name: r for r in out.collect()}
    assert set(got) == {"Nairobi", "Murang'A"}
    assert got["Nairobi"].population == 4397073 and got["Nairobi"].male == 2192452
    assert got["Murang'A"].households == 318105 and got["Nairobi"].sub_county == ""
    # a file whose population column is called 'total'
    write(f"{tmp}/census2/c.csv", "name,total\nlamu,143920\n")
    out2 = standardise_census(io.read_census_csv(spark, f"{tmp}/census2"), RUN_TS)
    assert [(r.county_name, r.population) for r in out2.collect()] == [("Lamu", 143920)]


def test_geojson_first_geometry_and_area_sum(spark, tmp):
    fc = {"type": "FeatureCollection", "features": [
        {"properties": {"COUNTY_NAM": "NAIROBI", "COUNTY_COD": "47", "Shape_Area": 0.1},
         "geometry": {"type": "Polygon", "coordinates": [[[1, 2], [3, 4], [1, 2]]]}},
        {"properties": {"COUNTY_NAM": "nairobi", "COUNTY_COD": "99", "Shape_Area": 0.25},
         "geometry": {"type": "MultiPolygon", "coordinates": []}},
        {"properties": {"COUNTY_NAM": "Nairobi "}, "geometry": None},
        {"properties": {"COUNTY_NAM": "None", "Shape_Area": 5}, "geometry": {"type": "Point"}},
        {"properties": {"COUNTY_NAM": "", "Shape_Area": 5}, "geometry": {"type": "Point"}},
        {"properties": {"COUNTY_NAM": "Elegeyo-Marakwet", "COUNTY_COD": "28"}, "geometry": None},
    ]}
    write(f"{tmp}/geo/k.geojson", json.dumps(fc))
    feats = io.read_features(spark, f"{tmp}/geo/k.geojson")
    geo = {r.county_name: r for r in standardise_features(feats, RUN_TS).collect()}
    assert set(geo) == {"Nairobi", "Elegeyo-Marakwet"}
    n = geo["Nairobi"]
    assert n.county_code == "47" and json.loads(n.geometry)["type"] == "Polygon"
    assert abs(n.area_sqkm - 0.35) < 1e-12
    e = geo["Elegeyo-Marakwet"]
    assert e.geometry == "null" and e.area_sqkm == 0.0      # null geometry → text 'null'
    stg = staging.stg_geodata(standardise_features(feats, RUN_TS))
    assert stg.count() == 2                                  # text 'null' passes NOT NULL


def test_landing_roundtrip_overwrite_and_evolution(spark, tmp):
    root = f"{tmp}/landing"
    base = spark.createDataFrame([("a", 1), ("b", 2)], "county_name string, population long")
    r1 = io.land(base, root, "population", datetime(2025, 3, 1))
    assert r1.record_count == 2 and r1.uri.endswith("year=2025/month=03/day=01")
    io.land(base.limit(1), root, "population", datetime(2025, 4, 1))
    io.land(base, root, "population", datetime(2025, 4, 1))          # same-day re-run replaces
    wider = base.withColumn("census_year", F.lit(2019))               # new column appears
    io.land(wider, root, "population", datetime(2025, 5, 2))
    schema = "county_name string, population long, census_year int"
    from pyspark.sql.types import _parse_datatype_string
    s = _parse_datatype_string(schema)
    allrows = io.read_landing(spark, root, "population", s)
    assert allrows.count() == 6
    assert allrows.filter("year = '2025' and month = '04'").count() == 2
    assert allrows.filter("census_year is null").count() == 4           # old files: NULL
    assert dict(allrows.dtypes)["month"] == "string"
    pruned = io.read_landing(spark, root, "population", s, since=date(2025, 4, 1), until=date(2025, 4, 30))
    assert pruned.count() == 2
    plan = pruned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan or "partitionFilters" in plan.lower() or pruned.inputFiles()
    asof = io.read_as_of(spark, root, "population", date(2025, 4, 15), s)
    assert sorted(r.day for r in asof.select("day").distinct().collect()) == ["01"]
    assert asof.count() == 2
    with pytest.raises(ValueError):
        io.land(base.limit(0), root, "population", datetime(2025, 6, 1))


def test_read_seed(spark, tmp):
    write(f"{tmp}/seed/s.csv", "sub_county_name,population_2019,population_2024,census_year,"
                               "projection_year,growth_rate\nStarehe,210423,218388,2019,2024,0.023\n")
    seed = io.read_seed(spark, f"{tmp}/seed")
    r = seed.first()
    assert (r.sub_county_name, r.population_2024, r.growth_rate) == ("Starehe", 218388, 0.023)
    assert dict(seed.dtypes)["population_2019"] == "bigint"


def test_feature_lines_keep_file_order(spark, tmp):
    lines = [json.dumps({"properties": {"COUNTY_NAM": "Lamu" if i % 2 else "Kilifi", "COUNTY_COD": str(i),
                                        "Shape_Area": 0.5}, "geometry": {"type": "Point", "coordinates": [i, i]}})
             for i in range(2000)]
    write(f"{tmp}/geoseq/f.json", "\n".join(lines))
    feats = io.read_feature_lines(spark, f"{tmp}/geoseq")
    geo = {r.county_name: r for r in standardise_features(feats, RUN_TS).collect()}
    assert geo["Kilifi"].county_code == "0" and geo["Lamu"].county_code == "1"
    assert geo["Kilifi"].area_sqkm == 500.0


def test_raw_loads_are_kept_and_read_by_day_and_load_time(spark, tmp):
    from datetime import date, datetime
    from pyspark.sql.types import _parse_datatype_string
    from access_lake.streaming.landing_ingest import ingest_landing
    schema = _parse_datatype_string("county_name string, population long")

    def load(day, value, at):
        io.land(spark.createDataFrame([("a", value), ("b", value)], schema), f"{tmp}/landing", "population", datetime(2025, 5, day))
        ingest_landing(spark, f"{tmp}/landing", "population", f"{tmp}/raw", f"{tmp}/check", schema, loaded_at=at)

    load(1, 10, datetime(2025, 5, 1, 3))
    load(2, 20, datetime(2025, 5, 2, 3))
    load(1, 11, datetime(2025, 5, 9, 3))   # the first day again

    def state(day=None, by=None):
        return sorted({(r.day, r.population) for r in io.read_raw_as_of(spark, f"{tmp}/raw", schema, day, by).collect()})

    assert state() == [("01", 11), ("02", 20)]
    assert state(by=datetime(2025, 5, 5)) == [("01", 10), ("02", 20)]
    assert state(by=datetime(2025, 5, 1, 3)) == [("01", 10)]
    assert state(day=date(2025, 5, 1)) == [("01", 11)]
    assert state(by=datetime(2025, 4, 1)) == [] == state(day=date(2024, 1, 1))
    assert ingest_landing(spark, f"{tmp}/landing", "population", f"{tmp}/raw", f"{tmp}/check", schema, loaded_at=datetime(2025, 6, 1)) == 0


def collection(path, features, opening='{"type": "Feature", ', glue=",\n"):
    body = glue.join(opening + f'"properties": {p}, "geometry": {g}' + "}" for p, g in features)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write('{"type": "FeatureCollection", "name": "x",\n "features": [\n' + body + '\n], "bbox": "x"}\n' if glue != "," else '{"type":"FeatureCollection","features":[' + body + "]}")


@pytest.mark.parametrize("opening,glue", [('{"type": "Feature", ', ",\n"), ('{"type":"Feature",', ","), ('{\n  "type": "Feature",\n  ', "\n  ,\n")])
def test_one_collection_file_is_read_by_many_tasks_in_file_order(spark, tmp, opening, glue):
    features = [(json.dumps({"COUNTY_NAM": f"area {i} }}],{{ \\\" [", "CONST_CODE": i}), json.dumps({"type": "Point", "coordinates": [i, [1, 2]]}) if i % 5 else "null")
                for i in range(400)]
    collection(f"{tmp}/fc/a.geojson", features, opening, glue)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        got = io.read_feature_collection(spark, f"{tmp}/fc")
        assert got.rdd.getNumPartitions() > 5
        found = got.orderBy("pos").collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    want = io.read_features(spark, f"{tmp}/fc").orderBy("pos").collect()
    assert len(found) == 400 and [tuple(r)[1:-1] for r in found] == [tuple(r)[1:-1] for r in want]
    assert [r.geometry for r in found] == [g if g != "null" else None for _, g in features]  # the file's own text


def test_collections_without_features_or_in_another_form(spark, tmp):
    collection(f"{tmp}/none/a.geojson", [], glue=",")
    assert io.read_feature_collection(spark, f"{tmp}/none").count() == 0
    os.makedirs(f"{tmp}/other")
    with open(f"{tmp}/other/a.geojson", "w") as f:
        f.write('{"type":"FeatureCollection","features":[{"properties":{"COUNTY_NAM":"x"},"type":"Feature","geometry":null}]}')
    with pytest.raises(ValueError, match="read_features"):
        io.read_feature_collection(spark, f"{tmp}/other")
    # the opening bytes inside a text cut a feature in two: loud, not lost
    collection(f"{tmp}/cut/a.geojson", [('{"COUNTY_NAM": "a"}', "null"), ('{"COUNTY_NAM": "{\\"type\\": \\"Feature\\"", "x": [{"type": "Feature"}]}', "null")], '{"type": "Feature", ')
    with pytest.raises(Exception):
        io.read_feature_collection(spark, f"{tmp}/cut").collect()
