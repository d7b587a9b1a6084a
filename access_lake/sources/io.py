"""Readers and writers (SRC-1..9, SNK-1..5).

JSON is read with ``FAILFAST``: a truncated or malformed page, feature or
landed record stops the read instead of vanishing from the result.
"""

from __future__ import annotations

import re
import time
import uuid
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.sources import schemas


def read_registry_pages(spark: SparkSession, path: str) -> DataFrame:
    """Registry pages (one JSON page per line) → one row per facility
    result (SRC-1). Plain page files split across tasks, compressed ones
    are dealt whole; ``explode`` keeps each page's results in its task."""
    pages = spark.read.schema(schemas.REGISTRY_PAGE).option("mode", "FAILFAST").json(path)
    return pages.select(F.explode("results").alias("r")).select("r.*")


def read_census_csv(spark: SparkSession, path: str) -> DataFrame:
    """Census CSV read as text with its own header names (SRC-2); the
    names are normalised by ``standardise_census``."""
    return (spark.read.option("header", True).option("inferSchema", False)
                 .option("multiLine", False).csv(path))


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """GeoJSON FeatureCollections → one row per feature with its position
    (file, then place in the file) and the geometry as raw JSON text
    (SRC-3). A FeatureCollection file is not splittable: one task parses
    each file; :func:`read_feature_lines` is the form for large sets."""
    fc = (spark.read.schema(schemas.FEATURE_COLLECTION).option("multiLine", True)
               .option("mode", "FAILFAST").json(path))
    rows = fc.select(F.col("_metadata.file_path").alias("file"), F.posexplode("features").alias("at", "f"))
    return rows.select(F.struct("file", "at").alias("pos"), "f.properties.*", F.col("f.geometry").alias("geometry"))


def read_feature_lines(spark: SparkSession, path: str) -> DataFrame:
    """Line-delimited GeoJSON features (one Feature per line): the
    splittable form of :func:`read_features` for large boundary sets. The
    position is (file, offset of the split, row inside it), so "first in
    file order" is kept however the files are packed into tasks."""
    feature = schemas.FEATURE_COLLECTION["features"].dataType.elementType
    rows = spark.read.schema(feature).option("mode", "FAILFAST").json(path)
    return rows.select(F.struct(F.col("_metadata.file_path").alias("file"),
                                F.col("_metadata.file_block_start").alias("split"),
                                F.monotonically_increasing_id().alias("at")).alias("pos"),
                       "properties.*", "geometry")


_FEATURE_OPENS = re.compile(r'\{\s*"type"\s*:\s*$')


def read_feature_collection(spark: SparkSession, path: str) -> DataFrame:
    """Large FeatureCollection files, each read by many tasks (SRC-3).

    A JSON document cannot be split, but a text file can, at any separator.
    All features of a file are written alike and begin with their type, so
    the bytes that open the first one (``{"type": "Feature"``, with the
    file's own blanks) separate the records: Spark cuts the file into byte
    ranges, a task reads the features that begin in its range, and each
    piece, opened again, is parsed by itself. A piece that is no whole
    feature (those bytes inside a text, or features written in different
    ways) stops the read, as does a file whose features do not begin with
    their type; :func:`read_features` reads such files whole. The position
    is (file, start of the range, place in it), that is file order. All
    files of ``path`` open their features alike.
    """
    first = spark.read.option("lineSep", '"Feature"').text(path).limit(1).first()
    empty = first is None or '"features"' not in first.value
    opening = None if empty else first.value[first.value.rfind("{"):]
    if opening is None or not _FEATURE_OPENS.match(opening):
        if first is not None and re.search(r'"features"\s*:\s*\[\s*\]', first.value):
            opening = '{"type":'  # a collection without features
        else:
            raise ValueError(f"{path}: features do not begin with their type; use read_features")
    opening += '"Feature"'
    feature = schemas.FEATURE_COLLECTION["features"].dataType.elementType
    pieces = spark.read.option("lineSep", opening).text(path)
    pos = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
                   F.monotonically_increasing_id().alias("at"))
    head = F.col("value").rlike(r'^\s*\{\s*"[^{}]*"features"\s*:\s*\[\s*(\]\s*\}\s*)?$')
    whole = F.concat(F.lit(opening), F.regexp_replace("value", r"[\s,]*(\]\s*(,[^\[\]]*)?\}\s*)?$", ""))
    # a later filter on the features may run before the one below, so the head is never parsed
    parsed = (pieces.select(pos.alias("pos"), "value").filter(~head)
                    .select("pos", whole.alias("whole"), F.when(~head, F.from_json(whole, feature, {"mode": "FAILFAST"})).alias("f")))
    # the parser writes a geometry anew, without blanks; the file's own text
    # is kept where the geometry is the last member and reads the same
    text = F.regexp_extract("whole", r'(?s)"geometry"\s*:\s*(\{.*\})\s*\}$', 1)
    again = F.from_json(F.concat(F.lit('{"geometry":'), text, F.lit("}")), "geometry string")["geometry"]
    geometry = F.when(again == F.col("f.geometry"), text).otherwise(F.col("f.geometry"))
    return parsed.select("pos", "f.properties.*", geometry.alias("geometry"))


def landing_path(root: str, dataset: str) -> str:
    return f"{root.rstrip('/')}/{dataset}"


def read_landing(spark: SparkSession, root: str, dataset: str, schema: T.StructType | None = None,
                 since: date | None = None, until: date | None = None) -> DataFrame:
    """Read landed NDJSON below ``<root>/<dataset>/year=/month=/day=``
    (SRC-4, SRC-9). The explicit schema keeps partition values as text and
    gives NULL for columns a file lacks; date bounds become
    ``PartitionFilters`` so only the matching directories are read."""
    schema = schema or schemas.RECORDS[dataset]
    df = (spark.read.schema(schemas.with_partitions(schema)).option("mode", "FAILFAST")
               .option("basePath", landing_path(root, dataset))
               .json(landing_path(root, dataset)))
    key = F.concat_ws("-", "year", "month", "day")
    if since is not None:
        df = df.filter(key >= since.isoformat())
    if until is not None:
        df = df.filter(key <= until.isoformat())
    return df


_DAY_DIR = re.compile(r"year=(\d{4})/month=(\d{2})/day=(\d{2})$")


def landed_days(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """Landing days (``YYYY-MM-DD``), from the directory names alone: one
    entry per day, however many files a day holds."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{landing_path(root, dataset)}/year=*/month=*/day=*")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return sorted("-".join(m.groups()) for s in found if (m := _DAY_DIR.search(s.getPath().toString())))


def read_as_of(spark: SparkSession, root: str, dataset: str, as_of: date,
               schema: T.StructType | None = None) -> DataFrame:
    """The latest landing on or before ``as_of`` (SRC-8). The day is chosen
    from the directory names, then only that directory is listed and read."""
    schema = schemas.with_partitions(schema or schemas.RECORDS[dataset])
    days = [d for d in landed_days(spark, root, dataset) if d <= as_of.isoformat()]
    if not days:
        return spark.createDataFrame([], schema)
    base = landing_path(root, dataset)
    y, m, d = days[-1].split("-")
    return (spark.read.schema(schema).option("mode", "FAILFAST").option("basePath", base)
                 .json(f"{base}/year={y}/month={m}/day={d}"))


@dataclass
class LoadReport:
    dataset: str
    uri: str
    record_count: int
    ingested_at: str


def require_rows(n: int, what: str) -> None:
    """Refuse an empty load (SNK-3)."""
    if n == 0:
        raise ValueError(f"No records to land for dataset '{what}'")


#: JSON names its fields in every record, so the fastest level of gzip, at a
#: third of the time, already takes most of that out
FAST_GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}

#: Records of one landed file: a compressed file does not split, and a task
#: that sorts what it reads should hold a few hundred MB of records at most
LANDED_RECORDS = 25_000


def land(df: DataFrame, root: str, dataset: str, run_date: datetime) -> LoadReport:
    """Write records as UTF-8 NDJSON under ``year=YYYY/month=MM/day=DD``
    (SNK-1), gzip-compressed: the records name all their fields, so plain
    text takes many times the room of the data. A compressed file does not
    split; so a writer starts a new one after ``LANDED_RECORDS`` records.
    Dynamic partition overwrite makes a same-day re-run replace
    that day only. The record count comes from an ``Observation`` of the
    write itself, so the data is not read twice (SNK-2); an empty load
    is refused after the fact with nothing visible written for the day
    (SNK-3)."""
    obs = Observation(f"land_{dataset}")
    # counted below the constant columns, whose rows then need no sort by them
    parts = df.observe(obs, F.count(F.lit(1)).alias("n")).select(
        "*",
        F.lit(f"{run_date.year:04d}").alias("year"),
        F.lit(f"{run_date.month:02d}").alias("month"),
        F.lit(f"{run_date.day:02d}").alias("day"))
    (parts.write.mode("overwrite").partitionBy("year", "month", "day")
             .option("partitionOverwriteMode", "dynamic")
             .options(**FAST_GZIP).option("maxRecordsPerFile", LANDED_RECORDS)
             .option("ignoreNullFields", False).json(landing_path(root, dataset)))
    n = int(obs.get.get("n", 0))
    require_rows(n, dataset)
    uri = (f"{landing_path(root, dataset)}/year={run_date.year:04d}/month={run_date.month:02d}"
           f"/day={run_date.day:02d}")
    return LoadReport(dataset, uri, n, run_date.isoformat())


def raw_table(spark: SparkSession, path: str, merge_schema: bool = True,
              schema: T.StructType | None = None) -> DataFrame:
    """Scan a typed raw Parquet table (SRC-5); ``mergeSchema`` lets files
    written before a column was added read it as NULL (SRC-9). Pass the
    schema (with text partition columns) to keep '05' from becoming 5."""
    reader = spark.read.option("mergeSchema", merge_schema)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(path)


LOAD = "load"
_LOAD_DIR = re.compile(r"year=(\d{4})/month=(\d{2})/day=(\d{2})/load=([0-9-]+)$")


def load_name(loaded_at: datetime, number: int = 0) -> str:
    """Names of loads sort by load time, then by batch."""
    return f"{loaded_at:%Y%m%d%H%M%S}-{number:06d}"


def raw_loads(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(landing day, load) of a raw table that keeps its loads, from the
    directory names alone: one entry per day and load."""
    place = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/year=*/month=*/day=*/load=*")
    found = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    return sorted(("-".join(m.groups()[:3]), m.group(4)) for s in found if (m := _LOAD_DIR.search(s.getPath().toString())))


def read_raw_as_of(spark: SparkSession, path: str, schema: T.StructType, day: date | None = None,
                   loaded_by: datetime | None = None) -> DataFrame:
    """The raw table as it was (SRC-8): of each landing day up to ``day``
    the newest load made by ``loaded_by`` (each all of them without the
    bound). Only the chosen directories are listed and read; the result has
    the partition columns, ``load`` included."""
    schema = schemas.with_partitions(schema)
    schema = T.StructType([*schema.fields, T.StructField(LOAD, T.StringType())])
    until = load_name(loaded_by, 999_999) if loaded_by is not None else None
    newest = {d: load for d, load in raw_loads(spark, path)  # loads of a day come in order
              if (day is None or d <= day.isoformat()) and (until is None or load <= until)}
    if not newest:
        return spark.createDataFrame([], schema)
    base = path.rstrip("/")
    dirs = ["{}/year={}/month={}/day={}/load={}".format(base, *d.split("-"), load) for d, load in newest.items()]
    return spark.read.schema(schema).option("basePath", base).parquet(*dirs)


def read_seed(spark: SparkSession, path: str,
              schema: T.StructType = schemas.SUBAREA_SEED) -> DataFrame:
    """A seed dimension CSV with fixed types (SRC-6)."""
    return spark.read.schema(schema).option("header", True).csv(path)


_PUBLISHED = re.compile(r"/published/(v\d{14}-\d{15}-[0-9a-f]{8})/")


def publish(df: DataFrame, base: str, run_ts: datetime) -> str:
    """Write a full new version (SNK-5) below ``base``, then record it under
    ``<base>/published/``; return the version path.

    A version's name holds the run time, the time of the attempt and a
    random part, so a retry of a run writes beside the version it may be
    reading and nothing is ever overwritten. The marker is written only
    after the data write committed: a job that dies mid-write leaves an
    unpublished directory that :func:`read_latest` never returns."""
    name = f"v{run_ts:%Y%m%d%H%M%S}-{int(time.time() * 1000):015d}-{uuid.uuid4().hex[:8]}"
    path = f"{base.rstrip('/')}/{name}"
    df.write.mode("errorifexists").parquet(path)
    marker = df.sparkSession.createDataFrame([(path,)], "path string").coalesce(1)
    marker.write.mode("errorifexists").text(f"{base.rstrip('/')}/published/{name}")
    return path


def latest_version(spark: SparkSession, base: str, before: datetime | None = None, of: datetime | None = None) -> str | None:
    """Newest published version below ``base``: of the latest run (strictly
    before ``before`` if given; of the run ``of`` alone) the last attempt. Only a missing folder
    means that nothing is published; any other listing error is raised."""
    try:
        files = spark.read.text(f"{base.rstrip('/')}/published/v*").inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    versions = sorted({m.group(1) for f in files if (m := _PUBLISHED.search(f))})
    if before is not None:
        versions = [v for v in versions if v[:15] < f"v{before:%Y%m%d%H%M%S}"]
    if of is not None:
        versions = [v for v in versions if v[:15] == f"v{of:%Y%m%d%H%M%S}"]
    return f"{base.rstrip('/')}/{versions[-1]}" if versions else None


def published_runs(spark: SparkSession, base: str) -> list[datetime]:
    """Run times with a published version below ``base``, oldest first."""
    try:
        files = spark.read.text(f"{base.rstrip('/')}/published/v*").inputFiles()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return []
    return sorted({datetime.strptime(m.group(1)[1:15], "%Y%m%d%H%M%S") for f in files if (m := _PUBLISHED.search(f))})


def read_latest(spark: SparkSession, base: str, before: datetime | None = None) -> DataFrame | None:
    path = latest_version(spark, base, before)
    return spark.read.parquet(path) if path else None


def register_views(frames: dict[str, DataFrame]) -> None:
    """Expose DataFrames by model name for SQL use (SNK-4, SRC-7)."""
    for name, df in frames.items():
        df.createOrReplaceTempView(name)
