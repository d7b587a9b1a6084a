"""Checks whose state is kept, so that a month checks its new rows only
(DQ-2, DQ-5, DQ-6).

Not-null and accepted-value failures add up over loads, but a key is a
duplicate by its rows in all loads together. So each load leaves a state
that merges: per key its rows and its failures (:func:`quality.key_state`),
bucketed by the key and partitioned by load. A report sums the states, key
by key inside the buckets, without a shuffle and without the old rows
themselves. A load that is checked again replaces its own state.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from access_lake.operators import quality as Q
from access_lake.sources import bucketed

LOAD = "load"


class CheckLog:
    """Check states of ``model`` below ``root``, keyed on ``key``."""

    def __init__(self, spark: SparkSession, root: str, model: str, key: str, not_null: Sequence[str] = (),
                 accepted: tuple[str, Sequence[str]] | None = None, key_type: T.DataType = T.StringType(),
                 buckets: int = bucketed.BUCKETS) -> None:
        self.spark, self.path, self.model, self.key = spark, f"{root.rstrip('/')}/{model}", model, key
        self.not_null, self.accepted, self.buckets = list(not_null), accepted, buckets
        self.counts = ["_n", *[f"nn{i}" for i in range(len(self.not_null))], *(["acc"] if accepted else [])]
        self.schema = T.StructType([T.StructField(key, key_type), *[T.StructField(c, T.LongType()) for c in self.counts],
                                    T.StructField(LOAD, T.StringType())])

    def add(self, rows: DataFrame, load: str) -> None:
        """Check the rows of a load (a landing day) and keep the state."""
        state = Q.key_state(rows, self.key, self.not_null, self.accepted)
        state = state.select(F.col(self.key).cast(self.schema[self.key].dataType), *[F.col(c).cast("bigint").alias(c) for c in self.counts])
        bucketed.write_load(state, self.path, self.key, self.buckets, LOAD, load)

    def state(self) -> DataFrame:
        """One row per key over all loads."""
        loads = bucketed.read_loads(self.spark, self.path, self.schema, self.key, self.buckets, LOAD)
        return loads.groupBy(self.key).agg(*[F.sum(c).cast("bigint").alias(c) for c in self.counts])

    def report(self) -> DataFrame:
        """The model's report over everything loaded so far."""
        return Q.report_rows(Q.summed(self.state(), self.key), self.model, self.not_null, self.key, self.accepted, self.key)

    def failing_keys(self) -> DataFrame:
        """(key, rows, failures): keys that a check fails on, to be stored
        beside the report."""
        per_row = [F.col(c) for c in self.counts if c != "_n"]
        total = sum(per_row[1:], per_row[0]) if per_row else F.lit(0)
        failing = self.state().select(self.key, F.col("_n").alias("rows"), total.cast("bigint").alias("failures"))
        return failing.filter((F.col("rows") > 1) | (F.col("failures") > 0))
