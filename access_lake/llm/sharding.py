"""Operator 3: shards of equal bytes by sampled splitters.

Rows are ordered by (fingerprint of the text, fingerprint of the id), so
equal texts stand together. Rows that are equal in everything are collapsed
to one row with its number of copies, so a row repeated a billion times is
one small row to sample, sort and place; the copies are dealt out at the end.
The collapsed rows, without their texts, are written once to the shared
folder, and all passes but the first read that small table. A size-weighted sample of the key gives quantile
boundaries; records are range-partitioned by them, and ranges that turn out
overfull get a denser sample of their own and are subdivided. The exact bytes
of each range (one small row per range) then place every range on the line
of all bytes, and a window inside each range places every row. Shard k takes
the k-th equal part of that line.

Equal texts stay in one shard unless their group weighs more than
``WHOLE`` of a shard; a heavier group may be cut at a shard's edge, so one
text that holds a third of all bytes spreads over as many shards as it needs.

Law: ``bytes``. Two shards differ by ``WHOLE`` of a shard or one record.

Defined cases: a null text weighs one byte, as an empty one, and both form
one group; repeated rows each get a slot; a null id is kept and sorts by its
own fingerprint; an empty table gives an empty result; the input's other
columns are left behind or, by ``shard(carry=True)``, kept in ``record``.
"""

from __future__ import annotations

from math import ceil

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from .common import shared_dir

SHARDS = 8
RANGES = 256  #: at least; more when a range would exceed RANGE_ROWS
RANGE_ROWS = 1_000_000
PER_RANGE = 24  #: sampled keys per range
WHOLE = 0.02
OVERFULL = 2.0


def _rows(docs: DataFrame, doc_id: str, text: str, carry: bool) -> DataFrame:
    own = F.coalesce(F.col(text).cast("string"), F.lit(""))
    ident = F.col(doc_id).cast("long")
    record = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("record")] if carry else []
    rows = docs.select(ident.alias("doc_id"), (F.octet_length(own) + 1).cast("long").alias("size"), F.crc32(own.cast("binary")).alias("text_crc32"),
                       F.xxhash64(own).alias("key"), F.xxhash64(ident, F.lit("tie")).alias("tie"), *record)
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies"))


def _sample(rows: DataFrame, rate) -> np.ndarray:
    """(key, tie) of collapsed rows drawn with probability min(1, bytes of
    all copies * rate), by a hash, so that every attempt draws the same ones."""
    draw = F.pmod(F.xxhash64("key", "tie", F.lit("draw")), F.lit(1 << 40)) / float(1 << 40)
    got = rows.filter(draw < _bytes() * rate).select("key", "tie").toPandas()
    return np.array(sorted(zip(got["key"].tolist(), got["tie"].tolist())), dtype=np.int64).reshape(-1, 2)


def splitters(sample: np.ndarray, n: int) -> list[tuple[int, int]]:
    """n - 1 quantile boundaries at most. A key met by one quantile only is
    cut before its first row, so light groups stay in one range."""
    if not len(sample):
        return []
    picks = [tuple(x) for x in sample[np.unique([len(sample) * k // n for k in range(1, n)])].tolist()]
    heavy = {a[0] for a, b in zip(picks, picks[1:]) if a[0] == b[0]}
    low = np.iinfo(np.int64).min
    return sorted({(k, t if k in heavy else low) for k, t in picks})


def _range_of(bounds: list[tuple[int, int]]):
    """Column expression: number of boundaries at or below (key, tie)."""
    pairs = np.array(bounds, dtype=[("key", np.int64), ("tie", np.int64)])
    keys = np.ascontiguousarray(pairs["key"])
    ties = np.ascontiguousarray(pairs["tie"])

    @F.pandas_udf("int")
    def find(key: pd.Series, tie: pd.Series) -> pd.Series:
        k, t = key.to_numpy(np.int64), tie.to_numpy(np.int64)
        lo, hi = np.searchsorted(keys, k, "left"), np.searchsorted(keys, k, "right")
        out = hi.copy()
        for i in np.flatnonzero(hi > lo):  # rows of a key that has boundaries
            out[i] = lo[i] + np.searchsorted(ties[lo[i]:hi[i]], t[i], "right")
        return pd.Series(out.astype(np.int32))

    return find(F.col("key"), F.col("tie")) if bounds else F.lit(0)


def _bytes() -> Column:
    """Bytes of all copies of a collapsed row."""
    return F.col("size") * F.col("copies")


def _totals(rows: DataFrame, bounds: list) -> dict[int, tuple[int, int, int]]:
    """Per range: bytes and rows of all copies, collapsed rows."""
    found = rows.groupBy(_range_of(bounds).alias("rng")).agg(F.sum(_bytes()).alias("b"), F.sum("copies").alias("n"), F.count(F.lit(1)).alias("c")).collect()
    return {r["rng"]: (r["b"], r["n"], r["c"]) for r in found}


def shard(docs: DataFrame, n_shards: int = SHARDS, doc_id: str = "doc_id", text: str = "text", carry: bool = False, ranges: int = RANGES) -> DataFrame:
    """One row per record: doc_id, size, text_crc32, shard, slot (and the
    whole ``record`` with ``carry``)."""
    spark = docs.sparkSession
    light, path = _rows(docs, doc_id, text, False), shared_dir(spark, "sharding")
    light.write.parquet(path)
    light = spark.read.schema(light.schema).parquet(path)
    total, count = light.agg(F.coalesce(F.sum(_bytes()), F.lit(0)), F.count(F.lit(1))).first()
    n = max(ranges, ceil(count / RANGE_ROWS))
    ideal = max(1.0, total / n)
    bounds = splitters(_sample(light, PER_RANGE / ideal), n)
    totals = _totals(light, bounds)
    over = [k for k, (b, _, c) in totals.items() if b > OVERFULL * ideal or c > 2 * RANGE_ROWS]
    if over:
        inside = light.filter(_range_of(bounds).isin(over))
        more = _sample(inside, 4 * PER_RANGE / ideal)
        heavy = sum(totals[k][0] for k in over)
        bounds = sorted({*bounds, *splitters(more, max(2, ceil(2 * heavy / ideal)))})
        totals = _totals(light, bounds)
    before_b, before_n, table = 0, 0, []
    for k in sorted(totals):
        table.append((k, before_b, before_n))
        before_b, before_n = before_b + totals[k][0], before_n + totals[k][1]
    # a few numbers per range; ranges are RANGES or one per million rows
    edges = spark.createDataFrame(table, "rng int, before_b long, before_n long")
    rows = (_rows(docs, doc_id, text, True) if carry else light).withColumn("rng", _range_of(bounds))
    order = W.partitionBy("rng").orderBy("key", "tie", F.col("doc_id").asc_nulls_first(), "text_crc32")
    before, group = order.rowsBetween(W.unboundedPreceding, -1), W.partitionBy("rng", "key")
    placed = (rows.withColumn("from_b", F.coalesce(F.sum(_bytes()).over(before), F.lit(0))).withColumn("from_n", F.coalesce(F.sum("copies").over(before), F.lit(0)))
              .withColumn("group_b", F.sum(_bytes()).over(group)).withColumn("group_till", F.max(F.col("from_b") + _bytes()).over(group))
              .join(F.broadcast(edges), "rng")
              .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))  # streamed, row by row
              .withColumn("till", F.col("from_b") + F.col("size") * F.col("copy")).withColumn("rank", F.col("from_n") + F.col("copy")))
    part = max(total, 1) / n_shards
    middle = F.when(F.col("group_b") <= WHOLE * part, F.col("group_till") - F.col("group_b") / 2).otherwise(F.col("till") - F.col("size") / 2)
    placed = placed.withColumn("shard", F.least(F.lit(n_shards - 1), F.floor((F.col("before_b") + middle) / F.lit(part))).cast("int"))
    sizes = placed.groupBy("shard").agg(F.min(F.col("before_n") + F.col("rank")).alias("first_n"))
    keep = ["doc_id", "size", "text_crc32", "shard", (F.col("before_n") + F.col("rank") - F.col("first_n")).cast("long").alias("slot")]
    return placed.join(F.broadcast(sizes), "shard").select(*keep, *(["record"] if carry else []))


def write_shards(sharded: DataFrame, path: str) -> None:
    """Write the records of a ``shard(carry=True)`` result, one folder a shard."""
    sharded.select("record.*", F.col("shard").alias("__shard"), F.col("slot").alias("__slot")).sortWithinPartitions("__shard", "__slot").write.partitionBy("__shard").parquet(path)
