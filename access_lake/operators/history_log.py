"""A version history kept as two append-only logs (SCD-1, SCD-2).

``scd2_apply`` returns the whole history, closed versions included, so a
month that changes a hundredth of the facilities writes all of it anew. The
log writes what changed and nothing else:

* ``opened``: key, data columns, ``valid_from``: a version started;
* ``closed``: key, ``valid_from``, ``valid_to``, ``is_deleted``: it ended.

Both are bucketed by the key and partitioned by run. A run joins the open
versions (opened without a closing, met bucket by bucket, no exchange on the
history's side) with the snapshot, and writes its own two partitions. It
reads runs before its own only, so a retry repeats itself. The history with
all version columns is the join of the two logs, again without an exchange.
"""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.operators.history import _differs, _scd_id
from access_lake.sources import bucketed

LOAD = "run"


class HistoryLog:
    """The logs below ``root`` of a history versioned on ``key``;
    ``data`` is the schema of its data columns."""

    def __init__(self, spark: SparkSession, root: str, key: str, check_cols: Sequence[str], data: T.StructType,
                 buckets: int = bucketed.BUCKETS) -> None:
        self.spark, self.root, self.key, self.check_cols = spark, root.rstrip("/"), key, list(check_cols)
        self.columns, self.buckets = data.names, buckets
        time, run = T.TimestampNTZType(), T.StructField(LOAD, T.StringType())
        plain = [T.StructField(f.name, f.dataType) for f in data.fields]
        self.opened_schema = T.StructType([*plain, T.StructField("valid_from", time), run])
        self.closed_schema = T.StructType([T.StructField(key, data[key].dataType), T.StructField("valid_from", time),
                                           T.StructField("valid_to", time), T.StructField("is_deleted", T.BooleanType()), run])

    @staticmethod
    def run_name(run_ts: datetime) -> str:
        return f"r{run_ts:%Y%m%d%H%M%S}"

    def runs(self) -> list[str]:
        """Names of the runs in the log, oldest first (one per run)."""
        name = bucketed.attach(self.spark, f"{self.root}/opened", self.opened_schema, self.key, self.buckets, LOAD)
        return sorted(r[0].split("=", 1)[1] for r in self.spark.sql(f"SHOW PARTITIONS {name}").collect())

    def _read(self, log: str, before: str | None) -> DataFrame:
        schema = self.opened_schema if log == "opened" else self.closed_schema
        return bucketed.read_loads(self.spark, f"{self.root}/{log}", schema, self.key, self.buckets, LOAD, before)

    def _versions(self, before: str | None, columns: Sequence[str]) -> DataFrame:
        """Opened versions with their closing, if any. The closings of a key
        are one small list (at most one per run), so both sides meet on the
        key alone, which is what the buckets are dealt by."""
        opened = self._read("opened", before).select(*dict.fromkeys([self.key, *columns, "valid_from"]))
        ends = (self._read("closed", before).groupBy(self.key)
                    .agg(F.collect_list(F.struct("valid_from", "valid_to", "is_deleted")).alias("_ends")))
        both = opened.join(ends, self.key, "left")
        end = F.get(F.filter("_ends", lambda e: e["valid_from"] == F.col("valid_from")), F.lit(0))
        return both.withColumn("_end", end).drop("_ends")

    def open_versions(self, before: datetime | None = None, columns: Sequence[str] | None = None) -> DataFrame:
        """Versions without an end, from the runs before ``before``."""
        name = self.run_name(before) if before else None
        return self._versions(name, self.columns if columns is None else columns).filter(F.col("_end").isNull()).drop("_end")

    def history(self) -> DataFrame:
        """All versions with the version columns of SCD-2."""
        v = self._versions(None, self.columns)
        return v.select(*self.columns, "valid_from", F.col("_end.valid_to").alias("valid_to"),
                        F.coalesce("_end.is_deleted", F.lit(False)).alias("is_deleted"),
                        _scd_id(self.key, F.col("valid_from")).alias("scd_id"), F.col("valid_from").alias("updated_at"))

    def changes(self, snapshot: DataFrame, run_ts: datetime) -> DataFrame:
        """One row per key that changed: its open version's start (``_from``,
        NULL for a new key), ``_here`` (in the snapshot) and the new row."""
        held = self.open_versions(run_ts, self.check_cols)
        h = held.select(F.col(self.key).alias("_key"), F.col("valid_from").alias("_from"),
                        *[F.col(c).alias(f"_h_{c}") for c in self.check_cols])
        s = snapshot.select(*self.columns, F.lit(True).alias("_in"))
        j = h.join(s, F.col("_key") == F.col(self.key), "full_outer").withColumn("_here", F.coalesce("_in", F.lit(False)))
        same = F.col("_here") & F.col("_from").isNotNull() & ~_differs([(F.col(f"_h_{c}"), F.col(c)) for c in self.check_cols])
        return j.filter(~same).select("_key", "_from", "_here", *self.columns)

    def changed_rows(self, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
        """Data columns of the versions that a run opened, and of those that
        it closed: at most one a key, met bucket by bucket in the runs
        before. Checked columns are those of the version's every row."""
        run = self.run_name(run_ts)
        opened = self._read("opened", None).filter(F.col(LOAD) == run).select(*self.columns)
        ended = self._read("closed", None).filter(F.col(LOAD) == run).select(F.col(self.key).alias("_key"), F.col("valid_from").alias("_from"))
        held = self._read("opened", run)
        closed = held.join(ended, held[self.key] == F.col("_key")).filter(F.col("valid_from") == F.col("_from"))
        return opened, closed.select(*self.columns)

    def apply(self, snapshot: DataFrame, run_ts: datetime) -> None:
        """Write the openings and closings that a full snapshot brings."""
        run, ts = self.run_name(run_ts), F.lit(str(run_ts)).cast("timestamp_ntz")
        later = [r for r in self.runs() if r > run]
        if later:
            raise ValueError(f"the history has runs after {run}: {', '.join(later)}; insert a late snapshot with scd2_insert")
        found = self.changes(snapshot, run_ts)
        path = f"{self.root}/changes/{run}"
        found.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(path)  # both logs are written from one join
        found = self.spark.read.schema(found.schema).parquet(path)
        opened = found.filter("_here").select(*self.columns, ts.alias("valid_from"))
        closed = found.filter(F.col("_from").isNotNull()).select(
            F.col("_key").alias(self.key), F.col("_from").alias("valid_from"), ts.alias("valid_to"),
            (~F.col("_here")).alias("is_deleted"))
        bucketed.write_load(opened, f"{self.root}/opened", self.key, self.buckets, LOAD, run)
        bucketed.write_load(closed, f"{self.root}/closed", self.key, self.buckets, LOAD, run)
