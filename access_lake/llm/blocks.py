"""Blocks of documents, and the exchange of keys between blocks.

Several operators ask, for every position of every text, something about
*all* texts (how often does this window, this word pair occur?). One row
per position would drown a shuffle in row overhead, so positions travel as
packed arrays:

1. texts are dealt into memory-sized **blocks** by a hash of their row;
2. a block sends each *distinct* key once (a map-side combine, so a key that
   holds a third of all positions costs one entry per block) to the key's
   **group**, as one packed array per (block, group);
3. a group, memory-sized as well, merges its arrays and answers each array
   with an array of the same order;
4. the block meets its answers in a co-group and applies them.

The shuffle of texts into blocks is the same exchange each time; Spark plans
it once and reuses it. Blocks sort their rows, so a recomputed task after a
lost executor rebuilds the same keys in the same order.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pieces

BLOCK_BYTES = 8 << 20
GROUP_KEYS = 3_000_000
ENTRY_TYPE = "grp int, block int, kind int, data binary"


def in_blocks(docs: DataFrame, n_bytes: int, n_rows: int, block_bytes: int = BLOCK_BYTES,
              doc_id: str = "doc_id", text: str = "text", carry: list[str] | None = None) -> DataFrame:
    """(block, key, doc_id, text, rest); ``rest`` holds the carried columns.

    The block depends on the row's id and text alone, so copies of a text
    spread over blocks while a recomputed task finds the same rows.
    """
    n = max(pieces(n_bytes, block_bytes), pieces(n_rows, 100_000))
    own_id, own_text = F.col(doc_id).cast("long"), F.col(text).cast("string")
    key = F.xxhash64(own_id, own_text)
    rest = F.struct(*[F.col(f"`{c}`") for c in carry]) if carry else F.lit(0)
    return docs.select(F.pmod(key, F.lit(n)).cast("int").alias("block"), key.alias("key"),
                       own_id.alias("doc_id"), own_text.alias("text"), rest.alias("rest"))


def sorted_block(t: pa.Table) -> pa.Table:
    """Rows of a block in an order that every attempt repeats (rows with
    the same key and text are interchangeable)."""
    return t.sort_by([("key", "ascending"), ("text", "ascending")])


def send(block: int, kind: int, grp: np.ndarray, data: np.ndarray) -> Iterator[tuple]:
    """One (grp, block, kind, bytes) per group, ``data`` in group order."""
    edges = np.flatnonzero(np.diff(grp)) + 1
    lo = np.concatenate([[0], edges])
    hi = np.concatenate([edges, [len(grp)]])
    for a, b in zip(lo.tolist(), hi.tolist()):
        if b > a:
            yield int(grp[a]), block, kind, data[a:b].tobytes()


def entry_table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.table([pa.array(list(c), f.type) for c, f in zip(cols, schema)], schema=schema)


ENTRY_SCHEMA = pa.schema([("grp", pa.int32()), ("block", pa.int32()), ("kind", pa.int32()), ("data", pa.binary())])


def _done(t: pa.Table) -> pa.Table:
    """Give freed Arrow memory back before a reused worker goes idle."""
    pa.default_memory_pool().release_unused()
    return t


def from_blocks(blocks: DataFrame, f: Callable[[int, pa.Table], list[tuple]]) -> DataFrame:
    """Run ``f(block, sorted rows)`` on each block; it returns entries."""
    def run(t: pa.Table) -> pa.Table:
        return _done(entry_table(f(t.column("block")[0].as_py(), sorted_block(t)), ENTRY_SCHEMA))

    return blocks.groupBy("block").applyInArrow(run, ENTRY_TYPE)


def answer(entries: DataFrame, f: Callable[[list[tuple]], list[tuple]]) -> DataFrame:
    """Run ``f(entries of a group)`` on each group; it returns entries, one
    answer for each it got, plus any of block -1 (statistics)."""
    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "ascending"), ("kind", "ascending")])
        rows = list(zip(*(t.column(c).to_pylist() for c in ("grp", "block", "kind", "data"))))
        del t
        return _done(entry_table(f(rows), ENTRY_SCHEMA))

    return entries.groupBy("grp").applyInArrow(run, ENTRY_TYPE)


def with_answers(blocks: DataFrame, answers: DataFrame, f: Callable[[int, pa.Table, dict], pa.Table], schema: str) -> DataFrame:
    """Run ``f(block, sorted rows, {(kind, grp): bytes})`` on each block."""
    def run(t: pa.Table, a: pa.Table) -> pa.Table:
        got = {(k, g): d for k, g, d in zip(a.column("kind").to_pylist(), a.column("grp").to_pylist(), a.column("data").to_pylist())}
        if t.num_rows == 0:  # statistics, addressed to no block
            return f(-1, t, got)
        del a
        return _done(f(t.column("block")[0].as_py(), sorted_block(t), got))

    return blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(run, schema)
