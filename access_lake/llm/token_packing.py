"""Operator 1: token ids, packed by best-fit-decreasing into fixed rows.

Each text becomes token ids and one end token. A document longer than a row
is cut into full pieces and a rest (nothing is lost). Pieces are packed the
longest first, each into the row whose free capacity is smallest among those
that suffice; a segment tree over capacities finds that row in logarithmic
time. A result row is one row of the packed id matrix with the cumulative
segment lengths (``cu_seqlens``) and position ids that restart at 0 with each
segment.

Packing runs inside each input partition, over blocks of ``BLOCK_TOKENS``
tokens, so no token is shuffled and memory is bounded by the block; the cost
is a few partly filled rows per block. A recomputed task packs the same
partition again to the same rows. Which documents share a row depends on the
input's partitioning; the ids of each document do not.

Defined cases: a null or empty text is its end token alone; repeated rows
are packed as often as they come; a null id is kept; an empty table gives an
empty result; other columns are ignored; text that spells a special token is
ordinary text; a text of any length is encoded whole and cut into rows, also
one with a run of millions of blanks; of equally long pieces the one that
comes first in its block is packed first.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import id_and_text

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: How that vocabulary splits text before merging (a fixed value).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
END = 50256
ROW = 2048
BLOCK_TOKENS = 4_000_000
LONG_BLANKS = 100_000  #: a run of so many blanks is encoded by itself

RESULT = "row_id long, n_tokens int, input_ids binary, position_ids binary, cu_seqlens array<int>, doc_ids array<long>, pieces array<int>, starts array<long>"


class Capacities:
    """Segment tree over capacities 0..row: each node holds the largest free
    capacity below it, each leaf the rows with exactly that capacity."""

    def __init__(self, row: int) -> None:
        self.size = 1 << row.bit_length()
        self.largest = [-1] * (2 * self.size)
        self.rows: list[list[int]] = [[] for _ in range(row + 1)]

    def _set(self, capacity: int, value: int) -> None:
        tree, i = self.largest, self.size + capacity
        tree[i] = value
        i >>= 1
        while i:
            now = max(tree[2 * i], tree[2 * i + 1])
            if tree[i] == now:
                return
            tree[i] = now
            i >>= 1

    def put(self, number: int, capacity: int) -> None:
        self.rows[capacity].append(number)
        if len(self.rows[capacity]) == 1:
            self._set(capacity, capacity)

    def take(self, need: int) -> tuple[int, int] | None:
        """(row, capacity) with the smallest capacity of at least ``need``."""
        tree = self.largest
        if tree[1] < need:
            return None
        # the lowest capacity at or above need: up from its leaf until a
        # right neighbour has one, then down to that neighbour's lowest
        i = self.size + need
        if tree[i] < 0:
            while i & 1 or tree[i + 1] < 0:
                i >>= 1
            i += 1
            while i < self.size:
                i = 2 * i if tree[2 * i] >= 0 else 2 * i + 1
        capacity = i - self.size
        number = self.rows[capacity].pop()
        if not self.rows[capacity]:
            self._set(capacity, -1)
        return number, capacity


def best_fit_decreasing(lengths: np.ndarray, row: int) -> list[list[int]]:
    """Items of each row, the longest first."""
    free, rows = Capacities(row), []
    for item in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[item])
        found = free.take(need)
        if found is None:
            found = len(rows), row
            rows.append([])
        number, capacity = found
        rows[number].append(item)
        if capacity > need:
            free.put(number, capacity - need)
    return rows


def encoder(vocabulary: bytes, pattern: str):
    import base64

    import tiktoken

    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encode, long_blanks, text: str) -> np.ndarray:
    """Ids of a text of any length. The splitting pattern backtracks over a
    run of blanks, which fails for very long ones, so those are cut out: the
    pattern takes all of a run but its last blank as one piece (all of it at
    the end of the text), and the rest of the text is split as before."""
    runs = list(long_blanks(text)) if len(text) > LONG_BLANKS else []
    if not runs:
        return encode.encode_to_numpy(text, disallowed_special=())
    out, at = [], 0
    for m in runs:
        end = m.end() if m.end() == len(text) else m.end() - 1
        out.append(encode.encode_to_numpy(text[at:m.start()], disallowed_special=()))
        out.append(np.array(encode._encode_single_piece(text[m.start():end].encode()), np.uint32))
        at = end
    out.append(encode.encode_to_numpy(text[at:], disallowed_special=()))
    return np.concatenate(out)


def packed_rows(docs: list[tuple], row: int, kind: np.dtype, end: int) -> Iterator[tuple]:
    """Rows (without id) of a block of (doc_id, ids)."""
    segments = [(d, k, a, min(row, len(ids) - a)) for d, (_, ids) in enumerate(docs) for k, a in enumerate(range(0, len(ids), row))]
    positions = np.arange(row, dtype=np.uint32)
    for items in best_fit_decreasing(np.array([s[3] for s in segments], np.int64), row):
        ids, at, edges = np.full(row, end, kind), np.zeros(row, np.uint32), [0]
        for i in items:
            d, _, start, n = segments[i]
            lo = edges[-1]
            ids[lo:lo + n] = docs[d][1][start:start + n]
            at[lo:lo + n] = positions[:n]
            edges.append(lo + n)
        lo = edges[-1]
        at[lo:] = positions[:row - lo]
        own = [segments[i] for i in items]
        yield lo, ids.tobytes(), at.astype(kind).tobytes(), edges, [docs[s[0]][0] for s in own], [s[1] for s in own], [s[2] for s in own]


def pack(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, end: int = END, row: int = ROW,
         block_tokens: int = BLOCK_TOKENS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per row of the packed matrix. ``input_ids`` and
    ``position_ids`` are little-endian, 2 bytes a value where the vocabulary
    and the row length allow it, else 4; past ``n_tokens`` stand end tokens."""
    with open(vocabulary, "rb") as f:
        raw = f.read()  # a vocabulary is a few megabytes; tasks get it from here
    kind = np.dtype("<u2" if max(end, raw.count(b"\n"), row) < 65536 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        import regex

        encode, long_blanks = encoder(raw, pattern), regex.compile(r"\s{%d,}" % LONG_BLANKS).finditer
        number = TaskContext.get().partitionId() << 32
        names = ["row_id", "n_tokens", "input_ids", "position_ids", "cu_seqlens", "doc_ids", "pieces", "starts"]
        types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int32()), pa.list_(pa.int64())]

        def flush(block: list[tuple]) -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = list(packed_rows(block, row, kind, end))
            for k in range(0, len(rows), 1024):
                part = rows[k:k + 1024]
                cols = [range(number, number + len(part)), *zip(*part)]
                number += len(part)
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(cols, types)], names)

        block, held = [], 0
        for batch in batches:
            for ident, text_value in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                value = text_value.as_py()
                ids = np.append(encode_text(encode, long_blanks, value) if value else np.zeros(0, np.uint32), np.uint32(end)).astype(kind)
                block.append((ident, ids))
                held += len(ids)
                if held >= block_tokens:
                    yield from flush(block)
                    block, held = [], 0
        if block:
            yield from flush(block)

    return id_and_text(docs, doc_id, text).mapInArrow(run, RESULT)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write the packed matrix as Parquet (ids and positions as binary)."""
    packed.write.parquet(path)
