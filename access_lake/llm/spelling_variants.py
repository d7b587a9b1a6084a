"""Operator 12: spelling variants by a variable-length gram index.

Words that differ by one inserted, deleted or replaced character are *near*;
each word's *form* is its most frequent near word (if that is at least twice
as frequent), and its *root* the end of the chain of forms.

* **Words** are counted over all texts, with a map-side count per task.
* **Gram dictionary.** Substrings of 2 to 8 characters of the (edge-marked)
  words are counted. A gram that occurs often is pruned, that is lengthened:
  at each place of a word stands the shortest gram that is not frequent. The
  threshold rises with the vocabulary, so at most ``FREQUENT_GRAMS`` grams
  are frequent, whatever the size of the corpus.
* **Decomposition and affected grams.** From its left edge a word is cut
  into disjoint grams, each the next one to end; from its right edge alike.
  One edit at a place affects only the grams around it: those of the left
  cut that end before it and those of the right cut that start after it
  survive in the other word, and are found there again, because what a gram
  is depends on its own characters only. So for each place there is one key:
  the text up to the last unaffected gram on the left, and from the first
  unaffected one on the right. A word has one key per distinct pair of such
  bounds (about six).
* **Lists.** Words with equal keys are one list; near words share at least
  the list of the place where they differ. Lists of at most ``LIST`` words
  are merged pair by pair, for gaps whose lengths differ by one at most. A
  longer list (or one without any gram, for short words) is split by the
  gap with one character left out, which two near gaps must share; such a
  list holds at most one word per place and character. (Gaps of over 64
  characters, in words made of frequent grams alone, share a half.)
* **Verify** the gaps by their edit distance.

No list is cut short: what is too long is split. All exchanges are by key.

Defined cases: a null text has no words; a null id counts as the empty id;
repeated rows count as often as they come; ties go to the smaller word in
code-point order; texts and words of any length are taken whole (a word of
a million characters is one word); an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import id_and_text, shared_dir

LETTERS = "[A-Za-zÀ-ÿ]+"
SHORTEST, FEWEST = 5, 3
GRAMS = range(2, 9)
FREQUENT = 8192
FREQUENT_GRAMS = 100_000
LIST = 128
LONG_GAP = 64
HELD = 200_000  #: distinct words or grams that a task counts before it sends them on
LEFT, RIGHT = "\x01", "\x02"

CAPITALS = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def runs_of(doc_id: int | None, text: str, letters: str, every: int | None) -> Iterator[tuple[str, int]]:
    """(word, occurrences) of one text. With ``every``, a run whose id and
    text have a crc32 that ``every`` divides loses one character."""
    head = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    lowered = text.encode().translate(CAPITALS).decode()
    for run, n in Counter(re.findall(letters, lowered)).items():
        if every:
            h = zlib.crc32(run.encode(), head)
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
        yield run, n


def counted(pairs: Iterator[tuple[str, int]], name: str) -> Iterator[pa.RecordBatch]:
    """Sums per key, sent on whenever many keys are held."""
    def table(held: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())], [name, "n"])

    held: Counter = Counter()
    for key, n in pairs:
        held[key] += n
        if len(held) >= HELD:
            yield table(held)
            held.clear()
    if held:
        yield table(held)


def word_counts(docs: DataFrame, shortest: int = SHORTEST, fewest: int = FEWEST, every: int | None = None,
                letters: str = LETTERS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of the words with ``shortest`` characters and ``fewest``
    occurrences over all texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted(((w, n) for b in batches for i, t in zip(b.column("doc_id").to_pylist(), b.column("text")) if t.is_valid
                        for w, n in runs_of(i, t.as_py(), letters, every) if len(w) >= shortest), "word")

    found = id_and_text(docs, doc_id, text).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= fewest)


def gram_counts(words: DataFrame) -> DataFrame:
    """(gram, n): in how many places of the edge-marked words it stands."""
    def grams(word: str) -> Iterator[tuple[str, int]]:
        marked = LEFT + word + RIGHT
        for q in GRAMS:
            for p in range(len(marked) - q + 1):
                yield marked[p:p + q], 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return counted((g for b in batches for w in b.column("word") for g in grams(w.as_py())), "gram")

    return words.select("word").mapInArrow(run, "gram string, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def frequent_grams(words: DataFrame, frequent: int = FREQUENT, most: int = FREQUENT_GRAMS) -> frozenset[str]:
    """The grams that are too frequent to stand for themselves. Each has
    more places than the threshold and all grams together have at most
    len(GRAMS) per place, so at most ``most`` come to the driver."""
    places = words.agg(F.sum(F.length("word") + 2).alias("n")).first()["n"] or 0
    threshold = max(frequent, len(GRAMS) * places // most)
    return frozenset(r["gram"] for r in gram_counts(words).filter(F.col("n") > threshold).select("gram").toLocalIterator())


def rare_grams(marked: str, frequent: frozenset[str]) -> list[tuple[int, int]]:
    """(start, end) of the shortest gram that is not frequent at each place
    that has one."""
    out, n = [], len(marked)
    for p in range(n - GRAMS[0] + 1):
        end, last = p + GRAMS[0], min(n, p + GRAMS[-1])
        while end <= last and marked[p:end] in frequent:
            end += 1
        if end <= last:
            out.append((p, end))
    return out


def keys_of(word: str, frequent: frozenset[str]) -> list[tuple[int, int]]:
    """(left, right) bounds of the unaffected text for each place of an
    edit in the edge-marked word, without repetition. The edit lies in
    [left, right) of the marked word."""
    n, left, right = len(word) + 2, [0], [len(word) + 2]
    grams = rare_grams(LEFT + word + RIGHT, frequent)
    for start, end in sorted(grams, key=lambda g: (g[1], g[0])):
        if start >= left[-1] and end > left[-1]:
            left.append(end)
    for start, end in sorted(grams, key=lambda g: (-g[0], g[1])):
        if end <= right[-1] and start < right[-1]:
            right.append(start)
    out, a, b = [], 0, len(right) - 1
    for place in range(n):
        while a + 1 < len(left) and left[a + 1] <= place:
            a += 1
        while right[b] <= place:
            b -= 1
        if not out or out[-1] != (left[a], right[b]):
            out.append((left[a], right[b]))
    return out


def index(words: DataFrame, frequent: frozenset[str]) -> DataFrame:
    """(key, gap, word): one row per word and key; ``key`` is null where no
    gram is unaffected."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys, gaps, own = [], [], []
            for w in b.column("word").to_pylist():
                marked = LEFT + w + RIGHT
                for lo, hi in keys_of(w, frequent):
                    bare = lo == 0 and hi == len(marked)
                    keys.append(None if bare else marked[:lo] + "\x00" + marked[hi:])
                    gaps.append(marked[lo:hi])
                    own.append(w)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array(gaps, pa.string()), pa.array(own, pa.string())], ["key", "gap", "word"])

    return words.select("word").mapInArrow(run, "key string, gap string, word string")


def merged(lists: DataFrame, on: list[str]) -> DataFrame:
    """Verified pairs of words (u < v) within each list."""
    a = lists.select(*on, F.col("gap").alias("gap_u"), F.col("word").alias("u"))
    b = lists.select(*on, F.col("gap").alias("gap_v"), F.col("word").alias("v"))
    met = a.join(b, on).filter((F.col("u") < F.col("v")) & (F.abs(F.length("gap_u") - F.length("gap_v")) <= 1)
                               & (F.levenshtein("gap_u", "gap_v", 1) == 1))
    return met.select("u", "v")


def shared_rests() -> Column:
    """What two near gaps share. Short ones: the gap without one character,
    or as it is (an insertion in the other). Long ones, whose number of
    such rests would be as large as they are: one of the halves, by the
    length of the shorter gap of a pair. At the limit both are given."""
    gap, n = F.col("gap"), F.length("gap")
    less = F.transform(F.sequence(F.lit(1), n), lambda i: F.concat(F.substring(gap, F.lit(1), i - 1), F.substring(gap, i + 1, n)))

    def halves(m: Column) -> list[Column]:
        h = F.floor(m / 2).cast("int")
        return [F.concat(F.lit("<"), m.cast("string"), F.substring(gap, F.lit(1), h)),
                F.concat(F.lit(">"), m.cast("string"), F.substring(gap, n - m + h + 1, m - h))]

    short = F.when(n <= LONG_GAP, F.concat(F.array(gap), less)).otherwise(F.array().cast("array<string>"))
    long = F.when(n >= LONG_GAP, F.array(*halves(n), *halves(n - 1))).otherwise(F.array().cast("array<string>"))
    return F.concat(short, long)


def near_pairs(words: DataFrame, frequent: frozenset[str], most: int = LIST) -> DataFrame:
    """(u, v), u < v: all pairs of ``words`` one edit apart."""
    rows = words.sparkSession.read.parquet(_written(index(words, frequent), "variant-index"))
    sizes = rows.filter(F.col("key").isNotNull()).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    long = sizes.filter(F.col("n") > most).select("key", F.lit(True).alias("long"))
    sized = rows.join(long, "key", "left")
    short_lists = sized.filter(F.col("key").isNotNull() & F.col("long").isNull()).select("key", "gap", "word")
    split = (sized.filter(F.col("key").isNull() | F.col("long"))
                  .select(F.coalesce("key", F.lit("")).alias("key"), "gap", "word", F.explode(F.array_distinct(shared_rests())).alias("rest")))
    return merged(short_lists, ["key"]).unionByName(merged(split, ["key", "rest"])).distinct()


def _written(df: DataFrame, name: str) -> str:
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return path


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of a forest given as (word, form): pointers double each
    round, each round written out; a chain is as long as frequencies can
    double, so there are few rounds."""
    spark = forms.sparkSession
    now = spark.read.parquet(_written(forms.select("word", F.col("form").alias("root")), "variant-roots"))
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        step = now.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved"))
        step = spark.read.parquet(_written(step, "variant-roots"))
        if step.filter("moved").isEmpty():
            return step.select("word", "root")
        now = step.select("word", "root")


def variants(words: DataFrame, frequent: int = FREQUENT, most: int = LIST) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each row of ``words``
    (word, n; each word once)."""
    words = words.sparkSession.read.parquet(_written(words.select("word", "n"), "variant-words"))
    pairs = near_pairs(words, frequent_grams(words, frequent), most)
    both = pairs.select(F.explode(F.array(F.struct(F.col("u").alias("word"), F.col("v").alias("near")),
                                          F.struct(F.col("v").alias("word"), F.col("u").alias("near")))).alias("p")).select("p.*")
    best = (both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
                .groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    chosen = words.join(best, "word", "left")
    good = -F.col("best.less") >= 2 * F.col("n")
    chosen = chosen.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                           F.when(good, F.col("best.near")).alias("form"), F.when(good, -F.col("best.less")).alias("form_n"))
    chosen = words.sparkSession.read.parquet(_written(chosen, "variant-forms"))
    above = roots(chosen.filter(F.col("form").isNotNull()))
    return chosen.join(above, "word", "left").withColumn("root", F.coalesce("root", "word"))
