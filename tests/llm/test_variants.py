"""Operator 12 against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from access_lake.llm import spelling_variants as V
from access_lake.llm.catalog import QUERIES
from data import DOC, empty, messy, messy_rows


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:]


def variants_by_hand(counts):
    out = {}
    for w, n in counts.items():
        near = [x for x in counts if one_edit(w, x)]
        best = min(near, key=lambda x: (-counts[x], x), default=None)
        form = best if best is not None and counts[best] >= 2 * n else None
        out[w] = [n, len(near), form, counts[form] if form else None]
    for w in out:
        root = w
        while out[root][2]:
            root = out[root][2]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def words_by_hand(rows, every):
    counts = Counter()
    for doc_id, text, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if every and h % every == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def got(df):
    return {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in df.collect()}


def syllables(rng, k):
    return "".join(rng.choice(["on", "th", "é", "re", "a", "ing", "st", "ou", "À", "÷"]) for _ in range(k))


@pytest.mark.parametrize("frequent,most", [(V.FREQUENT, V.LIST), (40, 5), (3, 2), (200, 1), (0, 3)])
def test_every_near_pair_is_found_whatever_the_dictionary(spark, frequent, most):
    rng = random.Random(frequent)
    counts = {}
    for _ in range(250):
        w = syllables(rng, rng.randrange(2, 7))
        for _ in range(rng.randrange(1, 4)):
            if len(w) >= 5:
                counts[w] = rng.randrange(3, 60)
            at = rng.randrange(len(w) + 1)
            w = rng.choice([w[:at] + w[at + 1:], w[:at] + rng.choice("aéoz") + w[at:], w[:at] + rng.choice("aéoz") + w[at + 1:]])
    counts["aaaaa"], counts["aaaaaa"], counts["aaaaaaa"], counts["w" * 3000], counts["w" * 3001] = 5, 10, 20, 3, 9
    for k in (60, 61, 62, 63, 64, 65):  # gaps around the limit of long ones
        counts["ab" * k] = 70 + k
        counts["ab" * 30 + "c" + "ab" * (k - 30)] = 80 + k
        counts["ab" * k + "d"] = counts["d" + "ab" * (k - 1) + "a"] = 90 + k
    words = spark.createDataFrame(list(counts.items()), "word string, n long").repartition(3).withColumn("key", F.lit(1))
    assert got(V.variants(words, frequent, most)) == variants_by_hand(counts)


def test_lists_without_a_gram_and_all_grams_frequent(spark):
    # every gram frequent: each key is bare, the gap is the whole word
    assert V.keys_of("hello", frozenset(("\x01hello\x02")[p:p + q] for q in V.GRAMS for p in range(8))) == [(0, 7)]
    keys = V.keys_of("hello", frozenset())
    assert keys[0][0] == 0 and keys[-1][1] == 7 and all(hi > lo for lo, hi in keys)


def test_words_of_a_messy_table(spark):
    rows = messy_rows() + messy_rows() + messy_rows(2)
    docs = spark.createDataFrame(rows, DOC).repartition(4).withColumn("word", F.lit("x")).withColumn("n", F.lit(1))
    for every in (None, 2, 97):
        found = {r.word: r.n for r in V.word_counts(docs, every=every).collect()}
        assert found == words_by_hand(rows, every)
    assert got(V.variants(V.word_counts(docs, every=2))) == variants_by_hand(words_by_hand(rows, 2))


def test_small_counts_held_give_the_same_words(spark, monkeypatch):
    want = {r.word: r.n for r in V.word_counts(messy(spark)).collect()}
    assert dict(Counter()) == {} and want
    pairs = [("a", 1), ("b", 2), ("a", 3), ("c", 1), ("b", 1)]
    monkeypatch.setattr(V, "HELD", 2)
    sums = Counter()
    for t in V.counted(iter(pairs), "word"):
        for w, n in zip(t.column("word").to_pylist(), t.column("n").to_pylist()):
            sums[w] += n
    assert sums == {"a": 4, "b": 3, "c": 1}


def test_empty_table_and_query(spark):
    assert V.variants(V.word_counts(empty(spark))).count() == 0
    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    assert got(QUERIES["op12_spelling_variants"](spark, sf)) == variants_by_hand(words_by_hand(rows, 97))
