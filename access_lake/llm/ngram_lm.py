"""Operator 7: bigram language model by deleted interpolation.

The probability of a token after its predecessor mixes three maximum-
likelihood estimates: bigram, unigram and uniform. The mixture weights
depend on how often the predecessor was seen (buckets by powers of two) and
are learned by expectation-maximisation on counts held out from the
training texts: a sixth of them is deleted from the counts, and the weights
are those that predict the deleted part best. Scoring then uses the counts of
all training texts.

Counting follows ``blocks``: a block of texts sends each distinct word and
word pair once, with its count in the block, to the key's group; the group
answers with the counts over the corpus. Texts are scored where they are
blocked. The EM reads a histogram of (bucket, bigram estimate, unigram
count) on a logarithmic grid, whose size the grid bounds; the weights are one
small row. Nothing grows with the corpus on the driver.

Training texts: crc32 of the id as text, modulo ``FOLDS``, other than
``HELD_OUT``; of those, remainder ``DELETED`` is deleted for the EM.

Defined cases: a null or empty text is its end token alone; a null id counts
as remainder 0 (training); repeated rows count and are scored as often as
they come; an empty table gives an empty result; without training texts all
counts are 0 and the uniform part scores; other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import blocks as B
from .common import pieces, text_bytes
from .words import hashed_words, mix, word_ends

FOLDS, HELD_OUT, DELETED = 7, 2, 3
BUCKETS = 24
GRID_P, GRID_C, GRID = 0.25, 0.3, 100  #: histogram steps (natural logarithm) and their number
ROUNDS = 60
BLOCK_BYTES = 5 << 20
GROUP_KEYS = 1_000_000

U = np.uint64
END, BEGIN = U(0x5851F42D4C957F2D), U(0x14057B7EF767814F)
WORD, PAIR, TOTALS = 1, 2, 3
TOKEN = np.dtype([("bucket", "u1"), ("pair", "<f4"), ("word", "<f4")])


# -- counts on the wire -----------------------------------------------------

def _pack_counts(*columns: np.ndarray) -> bytes:
    """Small counts in a byte each; larger ones follow in 8."""
    return b"".join(np.minimum(c, 255).astype(np.uint8).tobytes() for c in columns) + b"".join(c[c >= 255].astype("<i8").tobytes() for c in columns)


def _unpack_counts(data: bytes, n: int, columns: int) -> list[np.ndarray]:
    out, at = [], n * columns
    for k in range(columns):
        c = np.frombuffer(data, np.uint8, n, k * n).astype(np.int64)
        big = np.flatnonzero(c == 255)
        c[big] = np.frombuffer(data, "<i8", len(big), at)
        at += 8 * len(big)
        out.append(c)
    return out


def group_of(keys: np.ndarray, n_groups: int) -> np.ndarray:
    """Group of each key, in the order of the keys."""
    return ((keys >> U(32)) * U(n_groups) >> U(32)).astype(np.int64)


def _edges(grp: np.ndarray, n_groups: int) -> np.ndarray:
    return np.searchsorted(grp, np.arange(n_groups + 1))


class Tokens:
    """The tokens of a block: words and an end for each text."""

    def __init__(self, t: pa.Table) -> None:
        h, counts = hashed_words(t.column("text"), lower=True)
        edge, _ = word_ends(counts)
        self.ids = t.column("doc_id").to_pylist()
        self.token = np.insert(h, edge[1:], END)
        self.count = counts + 1
        self.edge = edge + np.arange(len(edge))
        self.part = np.array([0 if d is None else zlib.crc32(str(d).encode()) % FOLDS for d in self.ids], np.int64)
        del h
        before = np.empty_like(self.token)
        before[1:] = self.token[:-1]
        before[self.edge[:-1]] = BEGIN
        self.pair = mix(before * U(0xD1342543DE82EF95) + self.token)
        owner = np.repeat(self.part, self.count)
        self.main = (owner != HELD_OUT) & (owner != DELETED)
        self.deleted = owner == DELETED


def _send(block: int, kind: int, keys: np.ndarray, main: np.ndarray, deleted: np.ndarray, n_groups: int) -> Iterator[tuple]:
    distinct, inverse = np.unique(keys, return_inverse=True)
    a = np.bincount(inverse, weights=main, minlength=len(distinct)).astype(np.int64)
    b = np.bincount(inverse, weights=deleted, minlength=len(distinct)).astype(np.int64)
    edge = _edges(group_of(distinct, n_groups), n_groups)
    for g in np.flatnonzero(np.diff(edge)).tolist():
        k = distinct[edge[g]:edge[g + 1]]
        # a group's number repeats the top of its keys: 48 bits tell them apart
        body = k.tobytes() if kind == WORD else k.astype("<u4").tobytes() + (k >> U(32)).astype("<u2").tobytes()
        yield g, block, kind, struct.pack("<i", len(k)) + body + _pack_counts(a[edge[g]:edge[g + 1]], b[edge[g]:edge[g + 1]])


def send_counts(block: int, t: pa.Table, n_groups: int) -> list[tuple]:
    x = Tokens(t)
    return [*_send(block, WORD, x.token, x.main, x.deleted, n_groups), *_send(block, PAIR, x.pair, x.main, x.deleted, n_groups)]


def _entry(kind: int, data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    n = struct.unpack_from("<i", data)[0]
    if kind == WORD:
        keys, at = np.frombuffer(data, "<u8", n, 4), 4 + 8 * n
    else:
        keys, at = np.frombuffer(data, "<u4", n, 4).astype(U) | np.frombuffer(data, "<u2", n, 4 + 4 * n).astype(U) << U(32), 4 + 6 * n
    return keys, *_unpack_counts(data[at:], n, 2)


def add_counts(rows: list[tuple]) -> list[tuple]:
    """Corpus counts (main, deleted) of each entry's keys; and the totals of
    the group's words: main and deleted tokens, distinct main and distinct
    training words."""
    out = []
    for kind in (WORD, PAIR):
        mine = [(r, *_entry(kind, r[3])) for r in rows if r[2] == kind]
        if not mine:
            continue
        keys, inverse = np.unique(np.concatenate([m[1] for m in mine]), return_inverse=True)
        a, b = (np.bincount(inverse, weights=np.concatenate([m[c] for m in mine]), minlength=len(keys)).astype(np.int64) for c in (2, 3))
        if kind == WORD:
            out.append((mine[0][0][0], -1, TOTALS, struct.pack("<4q", a.sum(), b.sum(), (a > 0).sum(), (a + b > 0).sum())))
        lo = 0
        for (grp, block, _, _), own, *_ in mine:
            at = inverse[lo:lo + len(own)]
            lo += len(own)
            out.append((grp, block, kind, _pack_counts(a[at], b[at])))
    return out


def _corpus_counts(keys: np.ndarray, kind: int, answers: dict, n_groups: int, deleted: bool) -> np.ndarray:
    """Count of each position's key over the main texts, and over the
    deleted ones as well if asked."""
    distinct, inverse = np.unique(keys, return_inverse=True)
    edge = _edges(group_of(distinct, n_groups), n_groups)
    total = np.zeros(len(distinct), np.int64)
    for (k, g), data in answers.items():
        if k == kind:
            lo, hi = edge[g], edge[g + 1]
            a, b = _unpack_counts(data, hi - lo, 2)
            total[lo:hi] = a + b if deleted else a
    return total[inverse]


def bucket_of(count: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(count.astype(float))[1], BUCKETS - 1)


def counted(x: Tokens, answers: dict, n_groups: int, deleted: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per position of a block: corpus count of the word, of the pair, of
    the context. The block's keys are given up on the way."""
    word = _corpus_counts(x.token, WORD, answers, n_groups, deleted)
    del x.token
    pair = _corpus_counts(x.pair, PAIR, answers, n_groups, deleted)
    del x.pair
    context = np.empty_like(word)
    context[1:] = word[:-1]
    # a text's begin is seen as often as an end
    context[x.edge[:-1]] = word[x.edge[1:] - 1]
    return word, pair, context


# -- mixture weights --------------------------------------------------------

def cells(word: np.ndarray, pair: np.ndarray, context: np.ndarray) -> np.ndarray:
    p = pair / np.maximum(context, 1)
    qp = np.where(pair > 0, 1 + np.minimum(GRID - 2, np.rint(-np.log(np.maximum(p, 1e-300)) / GRID_P)), 0)
    qc = np.where(word > 0, 1 + np.minimum(GRID - 2, np.rint(np.log(np.maximum(word, 1)) / GRID_C)), 0)
    return (bucket_of(context) * GRID * GRID + qp * GRID + qc).astype(np.int64)


STATISTICS = "kind int, cell long, n long"


def gather_statistics(block: int, t: pa.Table, answers: dict, n_groups: int) -> pa.Table:
    if t.num_rows:
        x = Tokens(t)
        word, pair, context = (v[x.deleted] for v in counted(x, answers, n_groups, deleted=False))
        cell, n = np.unique(cells(word, pair, context), return_counts=True)
        kind = np.ones(len(cell), np.int32)
    else:
        n = np.sum([struct.unpack("<4q", d) for (k, _), d in answers.items() if k == TOTALS], axis=0, dtype=np.int64)
        cell, kind = np.arange(4), np.zeros(4, np.int32)
    return pa.table({"kind": pa.array(kind, pa.int32()), "cell": pa.array(cell, pa.int64()), "n": pa.array(n, pa.int64())})


def learn_weights(cell: np.ndarray, n: np.ndarray, tokens: int, words: int) -> np.ndarray:
    """EM: (buckets, 3) weights of bigram, unigram and uniform. One event of
    each kind is added so that no weight vanishes."""
    bucket, qp, qc = cell // (GRID * GRID), cell // GRID % GRID, cell % GRID
    p = np.stack([np.where(qp > 0, np.exp(-GRID_P * (qp - 1.0)), 0),
                  np.where(qc > 0, np.exp(GRID_C * (qc - 1.0)) / max(tokens, 1), 0), np.full(len(cell), 1 / (words + 1))], axis=1)
    weights = np.full((BUCKETS, 3), 1 / 3)
    for _ in range(ROUNDS):
        share = weights[bucket] * p
        share *= (n / np.maximum(share.sum(axis=1), 1e-300))[:, None]
        total = np.ones((BUCKETS, 3))
        np.add.at(total, bucket, share)
        weights = total / total.sum(axis=1, keepdims=True)
    weights[0, 1:] /= weights[0, 1:].sum()
    weights[0, 0] = 0  # a context never seen has no bigrams
    return weights


MODEL = "one int, weights array<double>, train_tokens long, train_words long"


def _learn(rows: pd.DataFrame) -> pd.DataFrame:
    total = rows[rows["kind"] == 0].set_index("cell")["n"]
    hist = rows[rows["kind"] == 1].sort_values("cell")
    main, deleted, main_words, words = (int(total.get(k, 0)) for k in range(4))
    weights = learn_weights(hist["cell"].to_numpy(np.int64), hist["n"].to_numpy(float), main, main_words)
    return pd.DataFrame({"one": [1], "weights": [weights.ravel()], "train_tokens": [main + deleted], "train_words": [words]})


# -- scores -----------------------------------------------------------------

COUNTED = "one int, doc_id long, held_out boolean, n_tokens long, n_known long, log_counts double, tokens binary"


def count_texts(t: pa.Table, answers: dict, n_groups: int) -> pa.Table:
    names = [c.split()[0] for c in COUNTED.split(", ")]
    types = [pa.int32(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary()]
    if not t.num_rows:
        return pa.table([pa.array([], k) for k in types], names)
    x = Tokens(t)
    word, pair, context = counted(x, answers, n_groups, deleted=True)
    token = np.zeros(len(word), TOKEN)
    token["bucket"], token["pair"], token["word"] = bucket_of(context), pair / np.maximum(context, 1), word
    del pair, context
    edge = x.edge
    known = np.add.reduceat(word > 0, edge[:-1], dtype=np.int64)
    logs = np.add.reduceat(np.log10(word + 1.0), edge[:-1])
    raw, at = memoryview(token.tobytes()), (edge * TOKEN.itemsize).tolist()
    cols = [np.ones(len(known), np.int32), x.ids, x.part == HELD_OUT, x.count, known, logs, [bytes(raw[a:b]) for a, b in zip(at, at[1:])]]
    return pa.table([pa.array(v, k) for v, k in zip(cols, types)], names)


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if not batch.num_rows:
            continue
        weights = np.array(batch.column("weights")[0].as_py()).reshape(BUCKETS, 3)
        n, v = batch.column("train_tokens")[0].as_py(), batch.column("train_words")[0].as_py()
        by = weights / np.array([1, max(n, 1), v + 1])
        scores = []
        for data in batch.column("tokens"):
            t = np.frombuffer(data.as_py(), TOKEN)
            w = by[t["bucket"]]
            scores.append(float(np.log10(w[:, 0] * t["pair"] + w[:, 1] * t["word"] + w[:, 2]).sum()))
        base = batch.column("log_counts").to_numpy() - batch.column("n_tokens").to_numpy() * np.log10(n + v + 1)
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "held_out", "n_tokens", "n_known", "train_tokens")), pa.array(base), pa.array(scores, pa.float64())],
                                         [c.split()[0] for c in SCORES.split(", ")])


def score(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", block_bytes: int = BLOCK_BYTES, group_keys: int = GROUP_KEYS) -> DataFrame:
    """One row per text: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-one unigram) and score (log10 probability)."""
    n_rows, n_bytes = text_bytes(docs.select(F.col(text).cast("string").alias("text")))
    n_groups = pieces(n_bytes, 6 * group_keys)
    b = B.in_blocks(docs, n_bytes, n_rows, block_bytes, doc_id, text)
    counts = B.answer(B.from_blocks(b, lambda k, t: send_counts(k, t, n_groups)), add_counts)
    statistics = B.with_answers(b, counts, lambda k, t, a: gather_statistics(k, t, a, n_groups), STATISTICS)
    # the grid and the four totals bound these rows, whatever the corpus
    summed = statistics.groupBy("kind", "cell").agg(F.sum("n").alias("n"))
    model = summed.withColumn("one", F.lit(1)).groupBy("one").applyInPandas(_learn, MODEL)
    texts = B.with_answers(b, counts, lambda k, t, a: count_texts(t, a, n_groups), COUNTED)
    return texts.join(F.broadcast(model), "one").mapInArrow(_score, SCORES)
