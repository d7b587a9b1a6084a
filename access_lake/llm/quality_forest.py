"""Operator 9: quality rules with an isolation forest on rule statistics.

Each text gets rule statistics in one vectorised pass. Two base rules reject
outright (very short, or largely repeated). For the rest an isolation forest
judges the statistics as rates: trees of random splits isolate unusual texts
after few steps, and the mean path length gives an anomaly score between 0
and 1. All labelled rows take part: their rates span the box that the trees
split at random, and the good ones among them are counted in every node,
where the tasks that hold the rows add up counts of one size. A node that
would hold less than two of ``SAMPLE`` rows is a leaf, as in a tree grown on
that many; its count is the share of all good rows. The score beyond which a
text goes is calibrated on all labelled rows as well: the lowest threshold
that loses at most ``max_loss`` of the good ones (base failures aside).

Defined cases: a null or empty text has no words and fails the base rules;
rows repeat in the result as in the input; a null id is kept as null; an
empty table gives an empty result; without labelled good rows no threshold
can be calibrated and only the base rules reject; of several labels of one
document the lowest counts; null labels are ignored; other columns are
ignored by ``verdicts`` and carried by ``keep_good``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, shared_dir
from .words import SCAN_BYTES, SEPARATORS, SpanHash, mix, slices, spans, text_buffer, window_hash, word_ends

MIN_WORDS, REPEAT_PERCENT, REPEAT_WINDOW = 10, 20, 5
TREES, SAMPLE, DEPTH = 100, 256, 8
NODES = 2 ** (DEPTH + 1) - 1
MAX_LOSS = 0.001
RANK_BINS = 1024  #: bins of one pass of the search for the threshold

NEWLINE = np.zeros(256, bool)
NEWLINE[10] = True
SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
MARKS = np.zeros(256, bool)
MARKS[list(b"!?;:\"'()[]{}@/\\=+~^_`-")] = True
LEAD = (np.arange(256) & 0xC0) != 0x80

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_upper", "n_marks", "n_lines"]


def statistics(texts) -> dict[str, np.ndarray]:
    """Rule statistics of a column of texts, one array per name of COUNTS."""
    buf, offsets = text_buffer(texts)
    span_hash, parts = SpanHash(), {k: [np.zeros(0, np.int64)] for k in COUNTS}
    for a, b in slices(np.diff(offsets), SCAN_BYTES):
        part, at = buf[offsets[a]:offsets[b]], offsets[a:b + 1] - offsets[a]
        for k, v in _slice_statistics(part, at, span_hash).items():
            parts[k].append(v.astype(np.int64))
    return {k: np.concatenate(v) for k, v in parts.items()}


def _per_text(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[at])


def _slice_statistics(buf: np.ndarray, at: np.ndarray, span_hash: SpanHash) -> dict[str, np.ndarray]:
    n = len(at) - 1
    starts, ends, counts = spans(buf, at)
    out = {"n_words": counts, "word_chars": _per_text(LEAD[buf] & ~SEPARATORS[buf], at), "n_symbols": _per_text(SYMBOLS[buf], at),
           "n_upper": _per_text(UPPER[buf], at), "n_marks": _per_text(MARKS[buf], at)}
    # words inside windows that occur twice or more in their text
    owner = np.repeat(np.arange(n), counts)
    edge, end = word_ends(counts)
    w = window_hash(span_hash(buf, starts, ends), REPEAT_WINDOW)
    first = np.flatnonzero(np.arange(len(w)) + REPEAT_WINDOW <= end[:len(w)])
    change = np.zeros(len(starts) + 1, np.int32)
    if len(first):
        _, inverse, times = np.unique(w[first] ^ mix(owner[first].astype(np.uint64) + np.uint64(1)), return_inverse=True, return_counts=True)
        twice = first[times[inverse] > 1]
        np.add.at(change, twice, 1)
        np.add.at(change, twice + REPEAT_WINDOW, -1)
    out["n_repeat_words"] = _per_text(np.cumsum(change[:-1]) > 0, edge)
    # lines that hold a word, and equal an earlier one
    ls, le, _ = spans(buf, at, NEWLINE)
    worded = np.searchsorted(starts, ls) < np.searchsorted(starts, le)
    ls, le = ls[worded], le[worded]
    lines = np.diff(np.searchsorted(ls, at))
    line_owner = np.repeat(np.arange(n), lines)
    _, at_first = np.unique(span_hash(buf, ls, le) ^ mix(line_owner.astype(np.uint64) + np.uint64(1)), return_index=True)
    out["n_lines"] = lines
    out["n_dup_lines"] = lines - np.bincount(line_owner[at_first], minlength=n)
    return out


def base_failed(s: dict[str, np.ndarray]) -> np.ndarray:
    return (s["n_words"] < MIN_WORDS) | (100 * s["n_repeat_words"] > REPEAT_PERCENT * s["n_words"])


def rates(s: dict[str, np.ndarray]) -> np.ndarray:
    """What the forest sees: rates, so that length alone is no anomaly;
    rates without an upper end are damped towards one."""
    words, chars = np.maximum(s["n_words"], 1), np.maximum(s["word_chars"], 1)
    damped = [x / (x + 0.2) for x in (s["n_symbols"] / words, s["n_marks"] / words)]
    return np.stack([*damped, s["n_upper"] / chars, s["n_dup_lines"] / np.maximum(s["n_lines"], 1), s["n_repeat_words"] / words,
                     np.log(chars / words)], axis=1)


def expected_path(n) -> np.ndarray:
    """Mean depth of an unsuccessful search among n values."""
    n = np.maximum(np.asarray(n, float), 1)
    return np.where(n > 2, 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / n, np.where(n > 1, 1.0, 0.0))


@dataclass
class Forest:
    feature: np.ndarray  #: (trees, nodes), -1 at a leaf; children of k: 2k+1, 2k+2
    split: np.ndarray
    path: np.ndarray  #: path length at a leaf
    sample: int
    threshold: float = np.inf

    def steps(self, tree: int, x: np.ndarray) -> Iterator[np.ndarray]:
        """The node of each row of ``x`` after each step down a tree."""
        feature, split = self.feature[tree], self.split[tree]
        rows, node = np.arange(len(x)), np.zeros(len(x), np.int64)
        yield node
        for _ in range(DEPTH):
            f = feature[node]
            below = 2 * node + 1 + (x[rows, np.maximum(f, 0)] >= split[node])
            node = np.where(f < 0, node, below)
            yield node

    def score(self, x: np.ndarray) -> np.ndarray:
        total = np.zeros(len(x))
        for tree, path in enumerate(self.path):
            for node in self.steps(tree, x):
                pass
            total += path[node]
        return 2.0 ** (-total / len(self.feature) / max(float(expected_path(self.sample)), 1e-9))

    def met(self, x: np.ndarray) -> np.ndarray:
        """(trees, nodes): how many rows of ``x`` pass through each node."""
        out = np.zeros(self.feature.shape, np.int64)
        for tree in range(len(out)):
            last = None
            for node in self.steps(tree, x):
                moved = node if last is None else node[node != last]  # a row at a leaf stays there
                out[tree] += np.bincount(moved, minlength=NODES)
                last = node
        return out


def grow(box: tuple[np.ndarray, np.ndarray], sample: int, trees: int = TREES, seed: int = 7) -> Forest:
    """Trees of random splits, down to ``DEPTH``. Cuts fall anywhere in the
    node's part of ``box`` (the range of all labelled rows), also where no
    good row is: what lies there reaches an empty leaf after few steps."""
    rng = np.random.default_rng(seed)
    forest = Forest(np.full((trees, NODES), -1), np.zeros((trees, NODES)), np.zeros((trees, NODES)), sample)
    for t in range(trees):
        todo = [(0, 0, *box)]
        while todo:
            node, depth, lo, hi = todo.pop()
            free = np.flatnonzero(hi > lo)
            if depth == DEPTH or not len(free):
                continue
            f = rng.choice(free)
            cut = rng.uniform(lo[f], hi[f])
            cut = cut if cut > lo[f] else hi[f]
            forest.feature[t, node], forest.split[t, node] = f, cut
            left_hi, right_lo = hi.copy(), lo.copy()
            left_hi[f] = right_lo[f] = cut
            todo += [(2 * node + 1, depth + 1, lo, left_hi), (2 * node + 2, depth + 1, right_lo, hi)]
    return forest


def settle(forest: Forest, met: np.ndarray) -> None:
    """Path lengths from the numbers of good rows that pass through each
    node, taken to ``forest.sample`` rows in all; nodes of less than two such
    rows become leaves."""
    share = met * (forest.sample / np.maximum(met[:, :1], 1))
    leaf = (forest.feature < 0) | (share < 2)
    forest.feature[leaf] = -1
    whole = np.arange(forest.sample + 1)
    depth = np.floor(np.log2(np.arange(NODES) + 1))
    forest.path[:] = depth + np.interp(share, whole, expected_path(whole))


def _counts_of(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(s[k]) for k in COUNTS)], ["doc_id", *COUNTS])

    return docs.mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS))


def _labelled(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Rates of labelled rows, and which of them are good."""
    s = {k: batch.column(k).to_numpy() for k in COUNTS}
    return rates(s), (batch.column("quality").to_numpy() == 1) & ~base_failed(s)


def _spread(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, int]:
    """Smallest and largest rates of all labelled rows, and how many are good."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                x, good = _labelled(batch)
                yield pa.RecordBatch.from_arrays([pa.array(np.arange(x.shape[1])), pa.array(x.min(axis=0)), pa.array(x.max(axis=0)),
                                                  pa.array(np.full(x.shape[1], good.sum()))], ["at", "lo", "hi", "good"])

    per = (rows.mapInArrow(run, "at long, lo double, hi double, good long").groupBy("at")
               .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sum("good").alias("good")).orderBy("at").collect())  # one row per rate
    return np.array([r.lo for r in per]), np.array([r.hi for r in per]), int(per[0].good) if per else 0


def _met(rows: DataFrame, forest: Forest) -> np.ndarray:
    """Good rows through each node of the forest: each task adds up its own."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(forest.feature.size, np.int64)
        for batch in batches:
            x, good = _labelled(batch)
            total += forest.met(x[good]).ravel()
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[at])], ["at", "n"])

    out = np.zeros(forest.feature.size, np.int64)
    for r in rows.mapInArrow(run, "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toLocalIterator():  # at most one row per node
        out[r.at] = r.n
    return out.reshape(forest.feature.shape)


def nth_largest(values: DataFrame, n: int) -> float:
    """The value of rank ``n`` (from 0) of the one column ``v`` in falling
    order, exactly: passes that count at most ``RANK_BINS`` bins, each over
    the bin that holds the rank."""
    lo, hi = values.agg(F.min("v"), F.max("v")).first()
    while lo < hi:
        width = (hi - lo) / RANK_BINS
        bins = (values.filter(F.col("v").between(lo, hi)).groupBy(F.floor((F.col("v") - lo) / width).alias("bin"))
                      .agg(F.count(F.lit(1)).alias("rows"), F.min("v").alias("lo"), F.max("v").alias("hi")).orderBy(F.desc("bin")).collect())
        for b in bins:
            if n < b.rows:
                lo, hi = b.lo, b.hi
                break
            n -= b.rows
    return float(hi)


def calibrate(forest: Forest, rows: DataFrame, good: int, max_loss: float) -> float:
    """Lowest score beyond which at most ``max_loss`` of the good rows lie."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, fine = _labelled(batch)
            yield pa.RecordBatch.from_arrays([pa.array(forest.score(x[fine]))], ["v"])

    scores = rows.mapInArrow(run, "v double").persist()  # eight bytes a labelled row
    try:
        return nth_largest(scores, int(max_loss * good))
    finally:
        scores.unpersist()


def fit(docs: DataFrame, labels: DataFrame, labelled: int | None = None, max_loss: float = MAX_LOSS,
        doc_id: str = "doc_id", text: str = "text") -> Forest | None:
    """Grow and calibrate on all labelled rows (None with less than two good
    ones). The texts are turned into statistics where they lie; labels meet
    only those, and the result is written, as several passes read it. A
    caller who wants less may ask for ``labelled`` labels, those with the
    smallest hash of their id."""
    spark = docs.sparkSession
    marks = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("long").alias("quality")).dropna()
             .groupBy("doc_id").agg(F.min("quality").alias("quality")))
    if labelled is not None:
        marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(labelled)
    path = shared_dir(spark, "quality-statistics")
    _counts_of(id_and_text(docs, doc_id, text)).join(marks, "doc_id").select("quality", *COUNTS).write.parquet(path)
    rows = spark.read.schema(", ".join(f"{k} long" for k in ("quality", *COUNTS))).parquet(path)
    lo, hi, good = _spread(rows)
    if good < 2:
        return None
    forest = grow((lo, hi), min(SAMPLE, good))
    settle(forest, _met(rows, forest))
    forest.threshold = calibrate(forest, rows, good, max_loss)
    return forest


def judge(s: dict[str, np.ndarray], forest: Forest | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base failed, anomaly score, kept)."""
    failed = base_failed(s)
    score = forest.score(rates(s)) if forest else np.zeros(len(failed))
    return failed, score, ~failed & (score <= (forest.threshold if forest else np.inf))


def verdicts(docs: DataFrame, forest: Forest | None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per text: its statistics, base_failed, anomaly and kept."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            s = statistics(batch.column("text"))
            failed, score, kept = judge(s, forest)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(s[k]) for k in COUNTS), pa.array(failed), pa.array(score), pa.array(kept)],
                                             ["doc_id", *COUNTS, "base_failed", "anomaly", "kept"])

    return id_and_text(docs, doc_id, text).mapInArrow(run, "doc_id long, " + ", ".join(f"{k} long" for k in COUNTS) + ", base_failed boolean, anomaly double, kept boolean")


def keep_good(docs: DataFrame, forest: Forest | None, text: str = "text") -> DataFrame:
    """The rows of ``docs``, with all columns, that pass."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(judge(statistics(batch.column(text)), forest)[2]))

    return docs.mapInArrow(run, docs.schema)
