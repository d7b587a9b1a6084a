"""Tables bucketed by a key (SRC-5, SCD-2): joins and grouping without a shuffle.

A bucketed table keeps the rows of a key in one of ``buckets`` files per
write, dealt by the same hash as a shuffle. Reading it, Spark knows that
layout, so grouping by the key, or joining two tables of equal buckets,
needs no exchange. Files lie below a path of the caller's choice (shared by
all executors); the catalogue entry is only a view of them and is made anew
by :func:`attach` in each session.

The optional partition column separates loads (a run, a landing day): a load
replaces its own partition, so a retry repeats itself, and a reader prunes
the loads that it must not see.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS, BUCKET_ROWS = 8, 500_000


def buckets_for(rows: int) -> int:
    """Buckets of a table that will hold about ``rows`` rows: a task sorts
    or groups one bucket, so their number grows with the table and not their
    size. The layout of a table is fixed by its first load."""
    return max(BUCKETS, -(-rows // BUCKET_ROWS))


def table_name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.rstrip("/").encode()).hexdigest()


def attach(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS,
           load: str | None = None) -> str:
    """Enter the files below ``path`` into the session's catalogue (created
    empty where there are none yet); returns the table's name. ``schema``
    holds all columns, the load column last."""
    name = table_name(path)
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        partition = f"PARTITIONED BY (`{load}`) " if load else ""
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet {partition}"
                  f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'")
    if load and _exists(spark, path):
        spark.catalog.recoverPartitions(name)
    return name


def _exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place))


def write_load(df: DataFrame, path: str, key: str, buckets: int = BUCKETS, load: str | None = None,
               value: str | None = None, dealt: bool = False) -> None:
    """Write ``df`` into the bucketed table at ``path``: with a ``load``
    column as the load ``value``, replacing that partition alone, whatever
    the session's overwrite mode is; without one the whole table is
    replaced. Rows are dealt by the bucket hash first, so each bucket is one
    file of one task; rows that come ``dealt`` by the key already (out of a
    grouping or a deduplication by it) skip that shuffle, where a task of it
    holds rows of one bucket only."""
    spark = df.sparkSession
    dealt = dealt and int(spark.conf.get("spark.sql.shuffle.partitions")) % buckets == 0
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    if load:
        schema = schema.add(load, "string")
    name = attach(spark, path, schema, key, buckets, load)
    partition = f"PARTITION (`{load}` = '{value}') " if load else ""
    spark.sql(f"INSERT OVERWRITE TABLE {name} {partition}SELECT * FROM {{rows}}", rows=df if dealt else df.repartition(buckets, key))
    spark.catalog.refreshTable(name)


def read_loads(spark: SparkSession, path: str, schema: T.StructType, key: str, buckets: int = BUCKETS,
               load: str | None = None, before: str | None = None) -> DataFrame:
    """The bucketed table; with ``before`` only loads below it."""
    df = spark.table(attach(spark, path, schema, key, buckets, load))
    return df.filter(F.col(load) < before) if load and before is not None else df
