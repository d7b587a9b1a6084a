"""Operator 5: benchmark decontamination by spaced seeds (DataFrame only).

Texts become words: runs of letters and digits, lower-cased. A mask samples
six positions of a short window and ignores the others, so a substituted
word at an ignored position leaves the seed's hash unchanged. The two masks
together hit every stretch of ``WINDOW`` = 13 words with up to two
substitutions, wherever they fall (checked over all patterns in the tests).

Seeds of all benchmark positions are hashed and joined with the seeds of all
text positions. Each hit fixes an alignment of one item with one text; the
words around it are compared one by one, and the alignment counts if some
13 aligned words have at most two differences. An item shorter than that
must occur unchanged. Items under ``SHORTEST`` words are shorter than a mask:
their one seed is the whole item, met by every run of as many words in the
texts. ``shortest`` says from how many words on items count; it is
``SHORTEST`` unless given, since a question of a word or two occurs in clean
texts as well, and a filter would drop those.

Only benchmark seeds are broadcast, in chunks of ``CHUNK`` at most, by a
hash of the seed; a larger benchmark takes more chunks, each a pass over the
texts. Text positions are generated, probed and dropped inside one stage,
so nothing of the texts is shuffled but the few aligned stretches.

Defined cases: a null or empty text matches nothing; null or repeated items
are ignored; an item without an id matches like any other; equal finds of equal ids (repeated rows) are listed once; a null
id is kept; empty tables give an empty result; other columns are ignored by
``overlaps`` and kept by ``without_leaks`` and ``without_leaking_rows``.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MASKS = ((0, 1, 2, 3, 5, 6), (0, 1, 4, 6, 7, 8))
WINDOW = 13
DIFFERENCES = 2
SHORTEST = 7
CHUNK = 500_000  #: seeds broadcast at once: at 40 bytes each, 20 MB


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), "")


def _hashes(words: Column) -> Column:
    return F.transform(words, lambda w: F.xxhash64(w))


def _whole(hashes: Column, at: Column, size: Column | int) -> Column:
    """The seed of ``size`` words in a row."""
    return F.xxhash64(F.lit(len(MASKS)), F.slice(hashes, at + 1, size))


def _seeds(hashes: Column, at: Column, short: Sequence[int] = ()) -> Column:
    """One hash per mask of the window at ``at``, and per size in ``short``
    one of so many words; null past the end."""
    def seed(number: int, mask: tuple[int, ...]) -> Column:
        return F.when(at + mask[-1] < F.size(hashes), F.xxhash64(F.lit(number), *[F.get(hashes, at + k) for k in mask]))

    return F.array(*[seed(n, m) for n, m in enumerate(MASKS)], *[F.when(at + n <= F.size(hashes), _whole(hashes, at, n)) for n in short])


def _positions(hashes: Column, short: Sequence[int] = ()) -> Column:
    last = F.size(hashes) - min([m[-1] + 1 for m in MASKS] + list(short))
    return F.when(last >= 0, F.sequence(F.lit(0), last))


def benchmark_items(benchmark: DataFrame, item_id: str = "item_id", text: str = "text", shortest: int = SHORTEST) -> DataFrame:
    """(item_id, item_words, item_key), distinct; items of ``shortest`` words
    and more, one at least. The key is a hash of the words, so items without an id and
    different items of one id are told apart."""
    return (benchmark.select(F.col(item_id).cast("long").alias("item_id"), words_of(F.col(text).cast("string")).alias("item_words"))
            .filter(F.size("item_words") >= max(shortest, 1)).distinct().withColumn("item_key", F.xxhash64("item_words")))


def item_seeds(items: DataFrame) -> DataFrame:
    """(seed, item_key, item_at, item_size)."""
    hashed = items.select("item_key", F.size("item_words").alias("item_size"), _hashes(F.col("item_words")).alias("hashes"))
    placed = hashed.select("item_key", "item_size", "hashes", F.explode(_positions(F.col("hashes"))).alias("item_at"))
    seeds = placed.select("item_key", "item_size", "item_at", F.explode(_seeds(F.col("hashes"), F.col("item_at"))).alias("seed"))
    whole = (hashed.filter(F.col("item_size") < SHORTEST)
             .select("item_key", "item_size", F.lit(0).alias("item_at"), _whole(F.col("hashes"), F.lit(0), F.col("item_size")).alias("seed")))
    return seeds.unionByName(whole).filter("seed IS NOT NULL").distinct()


def _alignments(texts: DataFrame, seeds: DataFrame, ids: list[str], short: list[int]) -> DataFrame:
    """Distinct (*ids, item_key, start, lead, stretch): the item's first
    word stands at ``start`` of the text (may be negative; then the first
    ``lead`` words of the item are before the text)."""
    placed = texts.select(*ids, "words", "hashes", F.explode(_positions(F.col("hashes"), short)).alias("at"))
    probes = placed.select(*ids, "words", "at", F.explode(_seeds(F.col("hashes"), F.col("at"), short)).alias("seed"))
    start = F.col("at") - F.col("item_at")
    lead = F.greatest(-start, F.lit(0))
    return (probes.join(F.broadcast(seeds), "seed")
            .select(*ids, "item_key", start.alias("start"), lead.alias("lead"), F.slice("words", F.greatest(start, F.lit(0)) + 1, F.col("item_size") - lead).alias("stretch"))
            .distinct())


def _total(numbers: Column) -> Column:
    return F.aggregate(numbers, F.lit(0), lambda a, b: a + b)


def overlaps(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", chunk: int = CHUNK, shortest: int = SHORTEST) -> DataFrame:
    """One row per alignment of a text with an item that counts: doc_id,
    item_id, first_word (of the compared words in the text), item_word (in the
    item), words (compared), matched (of them), best_window (matches in the
    best WINDOW words) and share (matched of the item's words)."""
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return _overlaps(texts, benchmark, ["doc_id"], item_id, chunk, shortest)


def _overlaps(docs: DataFrame, benchmark: DataFrame, ids: list[str], item_id: str, chunk: int = CHUNK, shortest: int = SHORTEST) -> DataFrame:
    """``overlaps`` of (*ids, text); rows equal in ``ids`` are one text's."""
    items = benchmark_items(benchmark, item_id, shortest=shortest)
    short = []
    if shortest < SHORTEST:  # SHORTEST - 1 sizes at most
        short = sorted(r[0] for r in items.filter(F.size("item_words") < SHORTEST).select(F.size("item_words")).distinct().collect())
    n_chunks = max(1, -(-item_seeds(items).count() // chunk))
    texts = docs.select(*ids, words_of(F.col("text")).alias("words")).select(*ids, "words", _hashes(F.col("words")).alias("hashes"))
    seeds = item_seeds(items)
    if n_chunks > 1:
        part = F.pmod(F.xxhash64(F.col("seed"), F.lit("chunk")), F.lit(n_chunks))
        found = reduce(DataFrame.unionByName, [_alignments(texts, seeds.filter(part == k), ids, short) for k in range(n_chunks)])
    else:
        found = _alignments(texts, seeds, ids, short)
    found = found.distinct() if n_chunks > 1 else found
    size = F.size("item_words")
    window = F.least(F.lit(WINDOW), size)
    equal = F.zip_with(F.slice("item_words", F.col("lead") + 1, F.size("stretch")), F.col("stretch"), lambda a, b: (a == b).cast("int"))
    sums = F.transform(F.sequence(F.lit(1), F.size("equal") - window + 1), lambda i: _total(F.slice("equal", i, window)))
    # stretches shorter than a window go first, so every window is a full one
    met = (found.join(items, "item_key").withColumn("equal", equal).filter(F.size("equal") >= window)
           .withColumn("best_window", F.array_max(sums)).withColumn("matched", _total(F.col("equal"))))
    least = F.when(size < WINDOW, size).otherwise(F.lit(WINDOW - DIFFERENCES))
    return met.filter(F.col("best_window") >= least).select(
        *ids, "item_id", F.greatest("start", F.lit(0)).cast("long").alias("first_word"), F.col("lead").cast("long").alias("item_word"),
        F.size("equal").cast("long").alias("words"), F.col("matched").cast("long").alias("matched"), F.col("best_window").cast("long").alias("best_window"),
        (F.col("matched") / size).alias("share")).distinct()


def without_leaks(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that no item overlaps. Leaking ids are matched
    null-safely, so leaking rows with a null id take all null ids along."""
    leaks = overlaps(docs, benchmark, doc_id, text, item_id, shortest=shortest).select(F.col("doc_id").alias("__llm_leak")).distinct()
    return docs.join(leaks, F.col(doc_id).cast("long").eqNullSafe(F.col("__llm_leak")), "left_anti")


def without_leaking_rows(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", shortest: int = SHORTEST) -> DataFrame:
    """The rows of ``docs`` that no item overlaps, each judged by its own
    text: rows are told apart by id and hash of id and text, so a clean row
    stays whatever other rows of its id (or without an id) hold."""
    own_id, own_text = F.col(doc_id).cast("long"), F.col(text).cast("string")
    key = F.xxhash64(own_id, own_text)
    texts = docs.select(own_id.alias("doc_id"), key.alias("row_key"), own_text.alias("text"))
    leaks = (_overlaps(texts, benchmark, ["doc_id", "row_key"], item_id, shortest=shortest)
             .select(F.col("doc_id").alias("__llm_leak"), F.col("row_key").alias("__llm_key")).distinct())
    return docs.join(leaks, (key == F.col("__llm_key")) & own_id.eqNullSafe(F.col("__llm_leak")), "left_anti")
