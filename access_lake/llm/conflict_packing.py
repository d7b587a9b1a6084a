"""Operator 4: best-fit packing under conflicts.

Documents go into bins of ``CAPACITY`` words, the longest first, each into
the tightest bin that fits and holds no document of the same source and none
of the same duplicate cluster. A bin carries its sources and clusters as a
bitmap; bins are kept in the order of their residual capacity, and the search
goes from the first sufficient residual to its successors until a bin's
bitmap is free of the document's bits.

A key that many documents share (a source with a third of all rows) would
make that search step over most bins. Each such key has a shelf of its own
with only the bins that lack it, so the tightest compatible bin is found
without stepping over the others; the result is the same.

Packing needs only lengths and keys, so the texts stay where they are: a
shuffle of small rows deals them into blocks of about ``BLOCK`` documents by
a hash of the row, and each block packs on its own. Hot sources and groups of
copies spread evenly over the blocks. (Bins never cross blocks; the loss is
at most the few half-filled bins at the end of each block.)

A document longer than a bin is cut into full pieces, a bin each, and a rest
that is packed like a document; nothing is dropped.

Defined cases: a text without words (null, empty, blank) gets one row with
no bin; a null source conflicts with nothing; repeated rows are documents of
one cluster; a null id is kept; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces, shared_dir
from .simhash_tiles import near_duplicates
from .words import text_buffer

CAPACITY = 2048
BLOCK = 20_000
HOT = 0.02  #: share of a block's documents that gives a key its own shelf

ITEMS = "doc_id long, n_words long, source string, cluster long, row_key long"
PACKED = "doc_id long, piece int, start long, words long, bin_id long, offset long, bin_words long, source string, cluster long"


def measure(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(doc_id, n_words, source, cluster, row_key); the cluster of a text is the
    fingerprint of its lower-cased words, so copies share it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            buf, offsets = text_buffer(batch.column("text"))
            data, at = buf.tobytes().lower(), offsets.tolist()
            words = (data[a:b].split() for a, b in zip(at, at[1:]))
            rows = [(len(w), xxhash.xxh64_intdigest(b" ".join(w)) - (1 << 63)) for w in words]
            n, cluster = zip(*rows) if rows else ((), ())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), batch.column("source"), pa.array(cluster, pa.int64()), batch.column("row_key")], ["doc_id", "n_words", "source", "cluster", "row_key"])

    own_id, own_text = F.col(doc_id).cast("long"), F.col(text).cast("string")
    rows = docs.select(own_id.alias("doc_id"), own_text.alias("text"), F.col(source).cast("string").alias("source"), F.xxhash64(own_id, own_text).alias("row_key"))
    return rows.mapInArrow(run, ITEMS)


def measure_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``measure`` with the near-copy component of operator 10 as cluster:
    its smallest id, or, in a component without ids, a key of its first row.
    The small rows are written, since packing reads them twice."""
    spark = docs.sparkSession
    component = F.coalesce("component_id", "component_key").alias("component")
    found = near_duplicates(docs, doc_id=doc_id, text=text).select(F.col("doc_id").alias("own_id"), F.col("row_key").alias("own_key"), component).distinct()
    rows = measure(docs, doc_id, text, source)
    path = shared_dir(spark, "measured")
    (rows.join(found, (F.col("row_key") == F.col("own_key")) & F.col("doc_id").eqNullSafe(F.col("own_id")))
     .select("doc_id", "n_words", "source", F.col("component").alias("cluster"), "row_key").write.parquet(path))
    return spark.read.parquet(path)


class Shelf:
    """Open bins by residual capacity. ``levels`` has bit r set if some bin
    has residual r, so the successor of a length is its lowest bit above."""

    def __init__(self) -> None:
        self.levels = 0
        self.bins: dict[int, dict[int, None]] = {}

    def put(self, number: int, residual: int) -> None:
        if residual not in self.bins:
            self.bins[residual] = {}
            self.levels |= 1 << residual
        self.bins[residual][number] = None

    def drop(self, number: int, residual: int) -> None:
        at = self.bins[residual]
        del at[number]
        if not at:
            del self.bins[residual]
            self.levels &= ~(1 << residual)

    def tightest(self, need: int, keys: int, bitmaps: list[int]) -> int | None:
        """Successor search for a bin free of ``keys``."""
        above = self.levels >> need
        residual = need
        while above:
            step = (above & -above).bit_length() - 1
            residual += step
            for number in self.bins[residual]:
                if not bitmaps[number] & keys:
                    return number
            above >>= step + 1
            residual += 1
        return None


def best_fit(lengths: list[int], keys: list[int], hot: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """(bin of each item, its offset, fill of each bin). ``keys``: bitmaps;
    ``hot``: bits that have their own shelf, the most frequent first."""
    shelves = {bit: Shelf() for bit in hot}
    rest = Shelf()
    bitmaps: list[int] = []
    residuals: list[int] = []
    put, offset = [], []
    for need, bits in zip(lengths, keys):
        own = next((b for b in hot if bits >> b & 1), None)
        number = (rest if own is None else shelves[own]).tightest(need, bits, bitmaps)
        if number is None:
            number = len(bitmaps)
            bitmaps.append(0)
            residuals.append(capacity)
        elif residuals[number]:
            rest.drop(number, residuals[number])
            for b, shelf in shelves.items():
                if not bitmaps[number] >> b & 1:
                    shelf.drop(number, residuals[number])
        put.append(number)
        offset.append(capacity - residuals[number])
        bitmaps[number] |= bits
        residuals[number] -= need
        if residuals[number]:
            rest.put(number, residuals[number])
            for b, shelf in shelves.items():
                if not bitmaps[number] >> b & 1:
                    shelf.put(number, residuals[number])
    return put, offset, [capacity - r for r in residuals]


def bitmaps(*columns: list) -> tuple[list[int], Counter]:
    """Each row's keys as bits; a key that one row has needs no bit."""
    out, width, times = [0] * len(columns[0]), 0, Counter()
    for column in columns:
        seen = Counter(x for x in column if x is not None)
        bit = {}
        for i, x in enumerate(column):
            if x is not None and seen[x] > 1:
                b = bit.setdefault(x, width + len(bit))
                out[i] |= 1 << b
                times[b] += 1
        width += len(bit)
    return out, times


def pack_block(rows: pd.DataFrame, capacity: int) -> pd.DataFrame:
    rows = rows.sort_values(["n_words", "cluster", "doc_id"], ascending=[False, True, True], kind="stable", na_position="first").reset_index(drop=True)
    keys, times = bitmaps([None if pd.isna(s) else s for s in rows["source"]], rows["cluster"].tolist())
    hot = [b for b, n in times.most_common() if n >= HOT * len(rows)]
    n = rows["n_words"].to_numpy(np.int64)
    full, rest = n // capacity, n % capacity
    order = np.argsort(-rest, kind="stable")
    order = order[rest[order] > 0]
    put, offset, fill = best_fit(rest[order].tolist(), [keys[i] for i in order], hot, capacity)
    put, fill = np.array(put, np.int64), np.array(fill, np.int64)
    whole = np.repeat(np.arange(len(rows)), full)
    number = np.arange(len(whole)) - np.repeat(np.cumsum(full) - full, full)
    none = np.flatnonzero(n == 0)
    row = np.concatenate([whole, order, none])
    out = rows.loc[row, ["doc_id", "source", "cluster"]].reset_index(drop=True)
    out["piece"] = np.concatenate([number, full[order], np.zeros(len(none), np.int64)])
    out["start"] = out["piece"] * capacity
    out["words"] = np.concatenate([np.full(len(whole), capacity), rest[order], np.zeros(len(none), np.int64)])
    block = int(rows["block"].iloc[0]) << 32
    blank = [None] * len(none)
    out["bin_id"] = pd.array([*(block + len(fill) + np.arange(len(whole))), *(block + put), *blank], "Int64")
    out["offset"] = pd.array([*np.zeros(len(whole), np.int64), *offset, *blank], "Int64")
    out["bin_words"] = pd.array([*np.full(len(whole), capacity), *(fill[put] if len(put) else []), *blank], "Int64")
    return out[[c.split()[0] for c in PACKED.split(", ")]]


def pack(items: DataFrame, capacity: int = CAPACITY, block: int = BLOCK) -> DataFrame:
    """One row per piece of a document: its words ``start`` to ``start +
    words`` stand at ``offset`` in bin ``bin_id``."""
    n = pieces(items.count(), block)
    dealt = items.select("doc_id", "n_words", "source", "cluster", F.pmod(F.xxhash64("doc_id", "row_key"), F.lit(n)).cast("int").alias("block"))
    return dealt.groupBy("block").applyInPandas(lambda rows: pack_block(rows, capacity), PACKED)
