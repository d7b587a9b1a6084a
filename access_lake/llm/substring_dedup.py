"""Operator 2: substring dedup with prefix-partitioned suffix trees.

The suffixes of all texts (as word sequences, cut at ``width`` = 35 words)
form a truncated suffix tree; its nodes at depth ``width`` with two or more
leaves are the repeats, and runs of neighbouring repeats are the maximal
ones. The tree is built in parts:

* **Vertical partitioning.** Every suffix is filed under its 12-word prefix,
  and prefixes under memory-sized groups. A group counts its prefixes over
  the whole corpus. A prefix seen once is a leaf above the depth that
  matters and its suffix is pruned. A prefix that is still too frequent for
  one group is lengthened to the whole window, so prefixes vary in length
  and a passage that a third of the corpus shares does not meet in one task.
* **Subtrees.** The surviving suffixes travel to their prefix's group as
  strings of three symbols (fingerprints of words 1-12, 13-24 and 25-35).
  A group sorts them, takes the longest common prefixes of neighbours, and
  reads the internal nodes off them; the leaves of nodes at full depth are
  repeated windows.

A block sends each distinct suffix once with its multiplicity, so a group
holds at most one entry per block and distinct suffix.

Defined cases: a null text has no words (``kept_text`` null in, null out);
texts shorter than the window repeat nothing; equal rows (same id, same
text) are two texts and so repeat each other; a null id is kept as null; an
empty table gives an empty result; other columns are ignored, or carried
under their own names by ``remove_repeats``.
"""

from __future__ import annotations

import hashlib
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import blocks as B
from .common import pieces, text_bytes
from .words import hashed_words, spans, window_hash, word_ends

WIDTH = 35
PREFIX = 12  #: words of the first prefix; the next symbols take 12 and 11
CROWDED = 2_000  #: blocks that may share a prefix before it is lengthened

U, U32 = np.uint64, np.uint32


def suffixes(h: np.ndarray, counts: np.ndarray, width: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Starts of full windows, and their symbols (32-bit) from left to right,
    preceded by the 64-bit fingerprint of the first symbol."""
    first = min(PREFIX, width)
    sizes = [first] + [s for s in (min(PREFIX, width - first), max(0, width - 2 * PREFIX)) if s > 0]
    _, end = word_ends(counts)
    starts = np.flatnonzero(np.arange(len(h)) + width <= end)
    symbols, at = [], 0
    for s in sizes:
        w = window_hash(h, s)
        symbols.append(w[starts + at])
        at += s
    return starts, symbols


def by_prefix(prefix: np.ndarray, n_groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (group, 31-bit prefix) of a block, their inverse and counts."""
    keys = ((prefix >> U(32)) % U(n_groups)) << U(32) | (prefix & U(0x7FFFFFFF))
    return np.unique(keys, return_inverse=True, return_counts=True)


def send_prefixes(block: int, t: pa.Table, width: int, n_groups: int) -> list[tuple]:
    h, counts = hashed_words(t.column("text"))
    _, symbols = suffixes(h, counts, width)
    keys, _, n = by_prefix(symbols[0], n_groups)
    data = (keys & U(0x7FFFFFFF)).astype(U32) << U32(1) | (n > 1).astype(U32)
    return list(B.send(block, 1, (keys >> U(32)).astype(np.int64), data))


def count_prefixes(rows: list[tuple], crowded: int) -> list[tuple]:
    """Per prefix: 0 unique, 1 repeated, 2 repeated and too frequent."""
    arrays = [np.frombuffer(d, U32) for *_, d in rows]
    every = np.concatenate(arrays)
    _, inverse, times = np.unique(every >> U32(1), return_inverse=True, return_counts=True)
    double = np.bincount(inverse, weights=(every & U32(1)), minlength=len(times))
    verdict = np.where(times + double > 1, 1, 0) + (times > crowded)
    got, out, lo = verdict[inverse], [], 0
    for (grp, block, kind, _), a in zip(rows, arrays):
        v = got[lo:lo + len(a)]
        lo += len(a)
        if v.any():
            out.append((grp, block, kind, np.packbits(v > 0).tobytes() + np.packbits(v > 1).tobytes()))
    return out


class Survivors:
    """Suffixes of a block whose prefix repeats, as distinct strings."""

    def __init__(self, t: pa.Table, answers: dict, width: int, n_groups: int) -> None:
        h, self.counts = hashed_words(t.column("text"))
        self.starts, symbols = suffixes(h, self.counts, width)
        keys, inverse, _ = by_prefix(symbols[0], n_groups)
        grp = (keys >> U(32)).astype(np.int64)
        edge = np.searchsorted(grp, np.arange(n_groups + 1))
        verdict = np.zeros(len(keys), np.uint8)
        for (kind, g), d in answers.items():
            if kind == 1:
                n = edge[g + 1] - edge[g]
                half = -(-n // 8)
                bits = np.frombuffer(d, np.uint8)
                verdict[edge[g]:edge[g + 1]] = np.unpackbits(bits[:half], count=n) + np.unpackbits(bits[half:], count=n)
        self.at = np.flatnonzero(verdict[inverse]) if len(inverse) else np.zeros(0, np.int64)
        kept = [s[self.at] for s in symbols]
        own = (kept[0] >> U(32)) % U(n_groups)
        if len(self.at):
            whole = kept[0]
            for s in kept[1:]:
                whole = whole * U(0x9E3779B97F4A7C15) + s
            crowded = verdict[inverse[self.at]] > 1
            own = np.where(crowded, (whole >> U(32)) % U(n_groups), own)
        low = [(s & U(0xFFFFFFFF)) for s in kept]
        hi = own << U(32) | low[0]
        lo = np.zeros(len(hi), U)
        for s in low[1:]:
            lo = lo << U(32) | s
        order = np.lexsort((lo, hi))
        hi, lo = hi[order], lo[order]
        new = np.ones(len(hi), bool)
        new[1:] = (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1])
        number = np.cumsum(new) - 1
        self.inverse = np.zeros(len(hi), np.int64)
        self.inverse[order] = number
        first = np.flatnonzero(new)
        self.hi, self.lo = hi[first], lo[first]
        self.times = np.bincount(number, minlength=len(first)) if len(first) else np.zeros(0, np.int64)
        self.grp = (self.hi >> U(32)).astype(np.int64)


STRING = np.dtype([("hi", "<u4"), ("lo", "<u8"), ("more", "u1")])


def send_survivors(block: int, t: pa.Table, answers: dict, width: int, n_groups: int) -> list[tuple]:
    s = Survivors(t, answers, width, n_groups)
    data = np.zeros(len(s.hi), STRING)
    data["hi"], data["lo"], data["more"] = s.hi & U(0xFFFFFFFF), s.lo, s.times > 1
    # the first answers are needed once more at the end: the group sends them back
    return [*B.send(block, 2, s.grp, data), *((g, block, kind, d) for (kind, g), d in answers.items() if kind == 1)]


def deep_leaves(hi: np.ndarray, lo: np.ndarray, times: np.ndarray) -> np.ndarray:
    """Leaves below internal nodes at full depth, of the subtree of these
    suffix strings: sort, longest common prefixes of neighbours, nodes."""
    order = np.lexsort((lo, hi))
    hi, lo, times = hi[order], lo[order], times[order]
    lcp = np.where(hi[1:] != hi[:-1], 0, np.where(lo[1:] >> U(32) != lo[:-1] >> U(32), 1, np.where(lo[1:] != lo[:-1], 2, 3)))
    node = np.concatenate([[0], np.cumsum(lcp < 3)])  # the node at full depth above each leaf
    leaves = np.bincount(node, weights=times)
    out = np.zeros(len(hi), bool)
    out[order] = leaves[node] > 1
    return out


def grow_subtrees(rows: list[tuple]) -> list[tuple]:
    out = [r for r in rows if r[2] == 1]
    mine = [(r, np.frombuffer(r[3], STRING)) for r in rows if r[2] == 2]
    if mine:
        every = np.concatenate([a for _, a in mine])
        deep = deep_leaves(every["hi"].astype(U), every["lo"], 1 + every["more"].astype(np.int64))
        lo = 0
        for (grp, block, kind, _), a in mine:
            v = deep[lo:lo + len(a)]
            lo += len(a)
            if v.any():
                out.append((grp, block, kind, np.packbits(v).tobytes()))
    return out


def repeated_starts(t: pa.Table, answers: dict, width: int, n_groups: int) -> tuple[np.ndarray, np.ndarray]:
    """Word positions in the block where a repeated window starts; words per text."""
    s = Survivors(t, answers, width, n_groups)
    edge = np.searchsorted(s.grp, np.arange(n_groups + 1))
    deep = np.zeros(len(s.hi), bool)
    for (kind, g), d in answers.items():
        if kind == 2:
            n = edge[g + 1] - edge[g]
            deep[edge[g]:edge[g + 1]] = np.unpackbits(np.frombuffer(d, np.uint8), count=n).astype(bool)
    return s.starts[s.at[deep[s.inverse]]], s.counts


def covered(starts: np.ndarray, n_words: int, width: int) -> np.ndarray:
    change = np.zeros(n_words + 1, np.int32)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + width, -1)
    return np.cumsum(change[:-1]) > 0


def kept_rows(t: pa.Table, answers: dict, width: int, n_groups: int, schema: pa.Schema) -> pa.Table:
    starts, counts = repeated_starts(t, answers, width, n_groups)
    gone = covered(starts, int(counts.sum()), width)
    edge = np.concatenate([[0], np.cumsum(counts)])
    n_removed = np.diff(np.concatenate([[0], np.cumsum(gone)])[edge]).astype(np.int64)
    digests, texts, passages = [], [], []
    for i, text in enumerate(t.column("text")):
        raw = b"" if text.as_py() is None else text.as_py().encode()
        words = raw.split()
        if n_removed[i]:
            mask = gone[edge[i]:edge[i + 1]]
            digests.append(hashlib.sha256(b" ".join(compress(words, (~mask).tolist()))).hexdigest())
            flips = np.flatnonzero(np.diff(np.concatenate([[False], mask, [False]]).astype(np.int8)))
            passages.append([{"start": int(a), "words": int(b - a)} for a, b in zip(flips[::2], flips[1::2])])
            if "kept_text" in schema.names:
                begins, ends, _ = spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                till = np.concatenate([begins[1:], [len(raw)]])
                head = raw[:begins[0]]
                texts.append((head + b"".join(raw[a:b] for a, b in zip(begins[~mask].tolist(), till[~mask].tolist()))).decode())
        else:
            digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
            passages.append([])
            texts.append(text.as_py())
    cols = {"doc_id": t.column("doc_id"), "n_words": pa.array(counts, pa.int64()), "n_removed": pa.array(n_removed, pa.int64()),
            "kept_sha256": pa.array(digests, pa.string()), "passages": pa.array(passages, schema.field("passages").type)}
    if "kept_text" in schema.names:
        cols |= {"kept_text": pa.array(texts, pa.string()), "rest": t.column("rest")}
    return pa.table([cols[f.name].cast(f.type) if f.name != "rest" else cols["rest"] for f in schema], names=schema.names)


def repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text",
            carry: list[str] | None = None, with_text: bool = False,
            group_keys: int = B.GROUP_KEYS, block_bytes: int = B.BLOCK_BYTES) -> DataFrame:
    """One row per text: doc_id, n_words, n_removed, kept_sha256 and the
    removed ``passages`` (first word, words); with ``with_text`` also the
    kept text (whitespace between kept words as it was) and ``rest``."""
    from pyspark.sql.pandas.types import to_arrow_schema

    if not 2 <= width <= 3 * PREFIX - 1:
        raise ValueError(f"width must be 2 to {3 * PREFIX - 1} words")
    n_rows, n_bytes = text_bytes(docs.select(F.col(text).cast("string").alias("text")))
    n_groups = pieces(n_bytes, 6 * group_keys)
    b = B.in_blocks(docs, n_bytes, n_rows, block_bytes, doc_id, text, carry)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()),
                           T.StructField("kept_sha256", T.StringType()),
                           T.StructField("passages", T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("words", T.LongType())])))])
    if with_text:
        schema = schema.add("kept_text", T.StringType()).add("rest", b.schema["rest"].dataType)
    arrow = to_arrow_schema(schema)
    first = B.answer(B.from_blocks(b, lambda k, t: send_prefixes(k, t, width, n_groups)), lambda rows: count_prefixes(rows, CROWDED))
    second = B.answer(B.with_answers(b, first, lambda k, t, a: B.entry_table(send_survivors(k, t, a, width, n_groups) if t.num_rows else [], B.ENTRY_SCHEMA), B.ENTRY_TYPE), grow_subtrees)
    return B.with_answers(b, second, lambda k, t, a: kept_rows(t, a, width, n_groups, arrow), schema)


def remove_repeats(docs: DataFrame, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text", drop_emptied: bool = True) -> DataFrame:
    """The input's rows and columns with repeated passages cut out of the
    text; rows that lose every word go if ``drop_emptied``."""
    found = repeats(docs, width, doc_id, text, carry=docs.columns, with_text=True)
    if drop_emptied:
        found = found.filter(~((F.col("n_words") > 0) & (F.col("n_removed") == F.col("n_words"))))
    return found.select(*[F.col("kept_text").alias(c) if c == text else F.col("rest")[c].alias(c) for c in docs.columns])
