"""Operator 10: SimHash near-duplicates by tiled exact comparison.

A text's fingerprint is the bitwise majority of the XXH64 values of its
word shingles. Distinct fingerprints are filed in **tiles** by their
population counts: the set bits of three segments (21, 21 and 22 bits). The
Hamming distance of two fingerprints is at least the sum of the differences
of their segment counts, so tile pairs whose counts differ by more than the
radius are skipped; all others are compared in full with numpy exclusive-or
and bit counts. Nothing is approximate.

The lattice has 22 * 22 * 23 tiles at most, so the table of tile sizes is
small at any input size. A tile over ``TILE`` fingerprints is split into
parts, and parts meet parts, so a comparison's two sides stay memory-sized
however many fingerprints a tile holds. The number of comparisons grows
with the square of the distinct fingerprints (times the share of tile pairs
that remain, about 6 %); that is the method's price.

A comparison emits a spanning forest of the links it found, not the links:
a group of thousands of mutual near-copies costs one edge per member, and
the components are the same.

Defined cases: a null or blank text has the fingerprint zero and is linked
like any other; repeated rows share a fingerprint; a null id never becomes a
component id unless the whole component has none (then the component id is
null); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, shared_dir
from .components import components
from .words import text_buffer

SHINGLE = 3
RADIUS = 3
SEED = 42
TILE = 4096
CELLS = 4_000_000  #: comparisons held in memory at once
SEGMENTS = ((0, 21), (21, 21), (42, 22))


def fingerprint(words: list[bytes], shingle: int) -> int:
    import xxhash

    n = len(words)
    if not n:
        return 0
    line = b" ".join(words)
    if n <= shingle:
        return xxhash.xxh64_intdigest(line, SEED)
    edge = np.zeros(n + 1, np.int64)
    np.cumsum([len(w) + 1 for w in words], out=edge[1:])
    lo, hi = edge[:n - shingle + 1].tolist(), (edge[shingle:] - 1).tolist()
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for k in range(0, len(lo), 65536):
        h = np.array([digest(line[a:b], SEED) for a, b in zip(lo[k:k + 65536], hi[k:k + 65536])], "<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(lo), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, row_key, fp) of (doc_id, text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            buf, offsets = text_buffer(batch.column("text"))
            data, at = buf.tobytes().lower(), offsets.tolist()
            fps = np.fromiter((fingerprint(data[a:b].split(), shingle) for a, b in zip(at, at[1:])), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("row_key"), pa.array(fps.view(np.int64))], ["doc_id", "row_key", "fp"])

    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("row_key"))
    return keyed.mapInArrow(run, "doc_id long, row_key long, fp long")


def _segment_counts(fp):
    return [F.bit_count(F.shiftrightunsigned(fp, at).bitwiseAND((1 << n) - 1)) for at, n in SEGMENTS]


def _tile(a, b, c):
    return (a * 32 + b) * 32 + c


def neighbour_offsets(radius: int) -> list[int]:
    """Tile steps with a count difference of ``radius`` at most, one of each
    opposite pair, and zero."""
    reach = range(-radius, radius + 1)
    steps = [s for s in product(reach, repeat=3) if sum(map(abs, s)) <= radius and s >= (0, 0, 0)]
    return [(a * 32 + b) * 32 + c for a, b, c in steps]


class Forest:
    """Labels of n nodes; keeps the edges that joined two trees."""

    def __init__(self, n: int) -> None:
        self.label = np.arange(n)
        self.edges: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            a, b = self.label[i], self.label[j]
            new = a != b
            if not new.any():
                return
            i, j, a, b = i[new], j[new], a[new], b[new]
            u, first = np.unique(np.maximum(a, b), return_index=True)
            self.edges.append((i[first], j[first]))
            parent = np.arange(len(self.label))
            parent[u] = np.minimum(a, b)[first]
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            self.label = parent[self.label]


def compare(home: np.ndarray, other: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the links between two lists of fingerprints."""
    both, number = np.unique(np.concatenate([home, other]), return_inverse=True)
    forest, n = Forest(len(both)), len(home)
    step = max(1, CELLS // max(1, len(other)))
    for k in range(0, n, step):
        i, j = np.nonzero(np.bitwise_count(home[k:k + step, None] ^ other[None, :]) <= radius)
        if len(i):
            forest.add(number[k + i], number[n + j])
    if not forest.edges:
        return home[:0], home[:0]
    i, j = (np.concatenate(x) for x in zip(*forest.edges))
    return both[i], both[j]


def links(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(u, v): a spanning forest of the links among distinct ``fp`` values."""
    nodes = nodes.select("fp", _tile(*_segment_counts(F.col("fp"))).alias("tile"))
    sizes = nodes.groupBy("tile").count().select("tile", F.ceil(F.col("count") / TILE).cast("int").alias("parts"))
    nodes = nodes.join(F.broadcast(sizes), "tile").withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
    homes = F.explode(F.array(*[F.col("tile") - F.lit(s) for s in neighbour_offsets(radius)])).alias("home")
    home_of = sizes.select(F.col("tile").alias("home"), F.col("parts").alias("home_parts"))
    # how many parts the largest neighbour of a home tile has
    waves = (sizes.select("parts", homes).join(F.broadcast(home_of), "home")
             .groupBy("home").agg(F.max("parts").alias("waves")).withColumnRenamed("home", "tile"))
    home = (nodes.join(F.broadcast(waves), "tile")
            .select("tile", "part", F.explode(F.sequence(F.lit(0), F.col("waves") - 1)).alias("wave"), "fp", F.lit(True).alias("home")))
    other = (nodes.select("fp", F.col("part").alias("wave"), homes).join(F.broadcast(home_of), "home")
             .select(F.col("home").alias("tile"), F.explode(F.sequence(F.lit(0), F.col("home_parts") - 1)).alias("part"), "wave", "fp", F.lit(False).alias("home")))

    def run(t: pa.Table) -> pa.Table:
        fp, own = t.column("fp").to_numpy().view(np.uint64), t.column("home").to_numpy()
        u, v = compare(fp[own], fp[~own], radius)
        return pa.table({"u": u.view(np.int64), "v": v.view(np.int64)})

    return home.unionByName(other).groupBy("tile", "part", "wave").applyInArrow(run, "u long, v long")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: doc_id, row_key, fp, component_id (smallest doc_id
    reachable over links of ``radius`` bits), component_key (the row_key of
    that row) and ``keeper``: whether this (doc_id, row_key) stands for its
    component."""
    spark = docs.sparkSession
    path = shared_dir(spark, "simhash")
    fingerprints(id_and_text(docs, doc_id, text), shingle).write.parquet(path)
    prints = spark.read.parquet(path)
    best = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "row_key"))
    nodes = prints.groupBy("fp").agg(best.alias("best"))
    roots = components(links(nodes.select("fp"), radius)).withColumnRenamed("u", "fp")
    classes = nodes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = classes.groupBy("root").agg(F.min("best").alias("first"))
    named = classes.join(firsts, "root").select("fp", "first")
    return prints.join(named, "fp").select(
        "doc_id", "row_key", "fp", F.col("first.doc_id").alias("component_id"), F.col("first.row_key").alias("component_key"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("row_key") == F.col("first.row_key"))).alias("keeper"))


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near-copies: one row of each component,
    that with the smallest id."""
    keep = (near_duplicates(docs, shingle, radius, doc_id, text).filter("keeper")
            .select(F.col("doc_id").alias("__llm_id"), F.col("row_key").alias("__llm_key")).distinct())
    key = F.xxhash64(F.col(doc_id).cast("long"), F.col(text).cast("string"))
    rows = docs.withColumn("__llm_own", key)
    met = rows.join(keep, (F.col("__llm_own") == F.col("__llm_key")) & F.col(doc_id).cast("long").eqNullSafe(F.col("__llm_id")), "left_semi")
    return met.dropDuplicates(["__llm_own"]).select(*[F.col(f"`{c}`") for c in docs.columns])
