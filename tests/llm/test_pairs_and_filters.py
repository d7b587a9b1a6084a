"""Operators 5, 9 and 10."""

import collections
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from access_lake.llm import components, decontamination, quality_forest, simhash_tiles
from data import DOC, WORDS, empty, messy, messy_rows, prose

WORD = re.compile(r"[^\x20\x09-\x0D]+")


# -- operator 10 ------------------------------------------------------------

def fingerprint_by_hand(text):
    w = (text or "").encode().lower().split()
    if not w:
        return 0
    shingles = [b" ".join(w[i:i + 3]) for i in range(len(w) - 2)] if len(w) >= 3 else [b" ".join(w)]
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes_by_hand(prints, radius):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, j in itertools.combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= radius:
            parent[find(j)] = find(i)
    return [find(i) for i in range(len(prints))]


def near_rows():
    rng = random.Random(5)
    rows = messy_rows()
    long = prose(rng, 900).split()
    for k in range(25):  # a chain of near copies
        long[rng.randrange(900)] = f"new{k}"
        rows.append((200 + k, " ".join(long), "en", "s0", 1))
    return rows


@pytest.mark.parametrize("tile", [4096, 3])
def test_simhash_equals_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash_tiles, "TILE", tile)
    rows = near_rows()
    prints = [fingerprint_by_hand(r[1]) for r in rows]
    group = classes_by_hand(prints, 3)
    smallest = {g: min((r[0] for r, x in zip(rows, group) if x == g and r[0] is not None), default=None) for g in set(group)}
    expected = collections.Counter((r[0], p, smallest[g]) for r, p, g in zip(rows, prints, group))
    got = simhash_tiles.near_duplicates(spark.createDataFrame(rows, DOC).repartition(3)).collect()
    assert collections.Counter((r.doc_id, r.fp % (1 << 64), r.component_id) for r in got) == expected


def test_links_of_random_fingerprints(spark):
    rng = np.random.default_rng(3)
    seeds = rng.integers(-2**63, 2**63 - 1, 60)
    prints = {int(s) for s in seeds}
    for s in seeds:
        for _ in range(4):
            x = int(s) % (1 << 64)
            for b in rng.choice(64, rng.integers(1, 6), replace=False):
                x ^= 1 << int(b)
            prints.add(x - (1 << 64) if x >= 1 << 63 else x)
    prints = sorted(prints)
    want = classes_by_hand([p % (1 << 64) for p in prints], 3)
    edges = simhash_tiles.links(spark.createDataFrame([(p,) for p in prints], "fp long"))
    root = {r.u: r.root for r in components.components(edges).collect()}
    got = [root.get(p, p) for p in prints]
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got))
    for u, v in [(r.u, r.v) for r in edges.collect()]:
        assert ((u ^ v) % (1 << 64)).bit_count() <= 3


def test_a_clique_gives_a_forest_not_all_pairs():
    base = np.uint64(0x0F0F12345678)
    clique = np.array([base ^ np.uint64(1 << b) for b in range(60)], np.uint64)
    u, _ = simhash_tiles.compare(clique, clique, 3)
    assert len(u) == 59


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(40)]
    star = [(100, 100 + i) for i in range(1, 40)]
    got = {r.u: r.root for r in components.components(spark.createDataFrame(chain + star + [(7, 7)], "u long, v long")).collect()}
    assert all(got[i] == 0 for i in range(41)) and all(got[i] == 100 for i in range(100, 140))


def test_keep_one(spark):
    rows = near_rows()
    docs = spark.createDataFrame(rows, DOC).withColumnRenamed("lang", "fp").withColumnRenamed("source", "keeper")
    kept = simhash_tiles.keep_one(docs)
    assert kept.columns == docs.columns
    group = classes_by_hand([fingerprint_by_hand(r[1]) for r in rows], 3)
    best = {}
    for r, g in zip(rows, group):
        best[g] = min(best.get(g, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted("None" if u else str(i) for u, i in best.values())


def test_simhash_of_nothing(spark):
    assert simhash_tiles.near_duplicates(empty(spark)).count() == 0
    assert simhash_tiles.keep_one(empty(spark)).count() == 0


# -- operator 9 -------------------------------------------------------------

def statistics_by_hand(text):
    text = text or ""
    w = WORD.findall(text)
    seen = collections.Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    mark = [0] * len(w)
    for i in range(len(w) - 4):
        if seen[tuple(w[i:i + 5])] > 1:
            mark[i:i + 5] = [1] * 5
    lines, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in text), dup, sum(mark)


def labelled(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def test_statistics_and_base_rules(spark):
    odd = [(300, "a b\na b\n \na b \na b\n\n#*$ %&|<>\r\n#*$ %&|<>\r", "en", "s", 1), (301, "a b c d e f a b c d e\nq", "en", "s", 1)]
    docs = messy(spark).unionByName(spark.createDataFrame(odd, DOC), allowMissingColumns=True)
    got = quality_forest.verdicts(docs, None).collect()
    expected = sorted((str(r[0]), *statistics_by_hand(r[1])) for r in messy_rows() + odd)
    assert sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == expected
    for r in got:
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed)  # no forest, no further verdict


def test_forest_separates_junk(spark):
    rng = random.Random(2)
    rows, labels = [], []
    for i in range(400):
        bad = i % 8 == 0
        text = " ".join(w + ("%%%" if bad else "") for w in prose(rng, rng.randrange(20, 200)).split())
        rows.append((i, text, "en", "s", 1))
        labels += [(i, int(not bad), 0)] * (i < 200)
    labels += [(None, 1, 0), (5, None, 0), (3, 1, 0), (10_000, 0, 0)]
    docs = spark.createDataFrame(rows, DOC)
    forest = quality_forest.fit(docs, labelled(spark, labels))
    again = quality_forest.fit(docs, labelled(spark, labels))
    assert (forest.split == again.split).all() and forest.threshold == again.threshold
    verdict = {r.doc_id: r.kept for r in quality_forest.verdicts(docs, forest).collect()}
    held_out = range(200, 400)
    assert not any(verdict[i] for i in held_out if i % 8 == 0)
    assert sum(verdict[i] for i in held_out if i % 8) >= 0.97 * sum(1 for i in held_out if i % 8)
    kept = quality_forest.keep_good(docs, forest)
    assert kept.columns == docs.columns and kept.count() == sum(verdict.values())


def test_fit_reads_a_bounded_sample(spark):
    rows = [(i, prose(random.Random(i), 30), "en", "s", 1) for i in range(60)]
    forest = quality_forest.fit(spark.createDataFrame(rows, DOC), labelled(spark, [(i, 1, 0) for i in range(60)]), labelled=10)
    assert forest.sample <= 10


def test_no_labels_no_threshold(spark):
    assert quality_forest.fit(messy(spark), labelled(spark, [])) is None
    assert quality_forest.fit(empty(spark), labelled(spark, [(1, 1, 0)])) is None
    assert quality_forest.keep_good(empty(spark), None).count() == 0


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    odd, even = labels.filter("doc_id % 2 = 1"), labels.filter("doc_id % 2 = 0")
    forest = quality_forest.fit(docs, odd)
    rows = quality_forest.verdicts(docs, forest).join(even, "doc_id").filter("not base_failed").select("quality", "kept").collect()
    good, bad = ([r.kept for r in rows if r.quality == q] for q in (1, 0))
    assert sum(good) >= 0.99 * len(good) and sum(bad) <= 0.1 * len(bad)


# -- operator 5 -------------------------------------------------------------

def own_words(text):
    return [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]


def overlaps_by_hand(docs, items, shortest=7):
    out = set()
    for d, text in docs:
        w = own_words(text)
        for it, own in items:
            b = own_words(own)
            if len(b) < shortest:
                continue
            win, need = min(13, len(b)), len(b) if len(b) < 13 else 11
            for start in range(-len(b) + 1, len(w)):
                lo, hi = max(0, -start), min(len(b), len(w) - start)
                eq = [b[j] == w[start + j] for j in range(lo, hi)]
                best = max((sum(eq[k:k + win]) for k in range(len(eq) - win + 1)), default=0)
                if best >= need:
                    out.add((d, it, max(start, 0), lo, len(eq), sum(eq), best))
    return out


def test_masks_hit_every_pattern():
    for gone in itertools.combinations(range(13), 2):
        assert any(not any(at + k in gone for k in mask) for mask in decontamination.MASKS for at in range(13 - mask[-1]))


def leak_tables(spark):
    rng = random.Random(9)
    items = [(i, prose(rng, n)) for i, n in enumerate([13, 14, 20, 40, 59, 12, 8, 7, 6, 3])]
    items += [(20, None), (21, ""), (3, items[3][1]), (22, "one, two! three_four five; six seven (eight) nine ten eleven twelve thirteen fourteen")]
    docs, k = [(r[0], r[1]) for r in messy_rows() if r[0] != 60], 500
    for it, text in items:
        for subs in range(4):
            w = (text or "").split()
            for s in rng.sample(range(len(w)), min(subs, len(w))):
                w[s] = "changed"
            for shape in (w, w[:-2], w[3:]):
                docs.append((k, prose(rng, 9) + " " + " ".join(shape).upper() + ". " + prose(rng, rng.randrange(9))))
                k += 1
    docs += [(k, "One two three four five six seven eight nine ten eleven twelve thirteen fourteen"), (k + 1, items[2][1]), (None, items[2][1]), (k + 1, items[2][1])]
    return docs, items


@pytest.mark.parametrize("chunk", [500_000, 60])
def test_overlaps_equal_brute_force(spark, chunk):
    docs, items = leak_tables(spark)
    found = decontamination.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"), chunk=chunk).collect()
    got = [tuple(r)[:7] for r in found]
    assert len(got) == len(set(got))
    assert set(got) == overlaps_by_hand(docs, items)
    assert len(got) > 40 and all(0 < r.share <= 1 for r in found)


def test_short_items_are_met_as_a_whole(spark):
    docs, items = leak_tables(spark)
    items += [(30, "two"), (31, "Two, three"), (32, "one two three four"), (33, "one two three four five"), (34, "amber12"), (35, "never said"), (None, "nine ten"), (36, "...")]
    docs += [(9001, "two"), (9002, "Two three two three"), (9003, "nine ten"), (9004, "one two"), (9005, "")]
    want = overlaps_by_hand(docs, items, 1)
    assert set(range(7)) <= {len(own_words(t)) for _, t in items} and len(want) > 80
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r)[:7] for r in decontamination.overlaps(df, bench, shortest=1).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    leaking = {r[0] for r in overlaps_by_hand(docs, items, 3)}
    clean = decontamination.without_leaks(df, bench, shortest=3)
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in leaking)


def test_without_leaks(spark):
    docs, items = leak_tables(spark)
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], "doc_id long, text string, item_id string, words string")
    clean = decontamination.without_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    leaking = {r[0] for r in overlaps_by_hand(docs, items)}
    assert clean.columns == df.columns
    assert sorted(str(r.doc_id) for r in clean.collect()) == sorted(str(d) for d, _ in docs if d not in leaking)


def test_leaking_rows_leave_other_rows_of_their_id(spark, tmp):
    import corpus_pipeline
    docs, items = leak_tables(spark)
    docs += [(None, "clean and without an id"), (None, "clean and without an id"), (docs[-1][0], "clean text of an id that leaks"), (500, None)]
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in docs], "doc_id long, text string, item_id string, words string").repartition(3)
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp}/benchmark.parquet")
    clean = corpus_pipeline.drop_leaks(spark, df, tmp)
    leaks = [bool(overlaps_by_hand([d], items)) for d in docs]
    assert any(x and d[0] is None for x, d in zip(leaks, docs)) and clean.columns == df.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in clean.collect()) == sorted((str(d), str(t)) for (d, t), x in zip(docs, leaks) if not x)
    assert decontamination.without_leaking_rows(empty(spark), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_items_without_an_id_or_with_a_repeated_one(spark):
    rng = random.Random(5)
    items = [(None, prose(rng, 20)), (None, prose(rng, 31)), (7, prose(rng, 25)), (7, prose(rng, 14)), (8, prose(rng, 15))]
    items += [(9, items[2][1]), (None, items[0][1]), (None, None)]
    docs = [(i, f"{prose(rng, 9)} {text or ''} {prose(rng, 5)}") for i, (_, text) in enumerate(items)] + [(50, prose(rng, 40))]
    df, bench = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r)[:7] for r in decontamination.overlaps(df, bench).collect()]
    assert len(got) == len(set(got)) and set(got) == overlaps_by_hand(docs, items)
    for clean in (decontamination.without_leaks(df, bench), decontamination.without_leaking_rows(df, bench)):
        assert sorted(r.doc_id for r in clean.collect()) == [7, 50]


def test_leaks_of_nothing(spark):
    bench = spark.createDataFrame([(1, " ".join(WORDS))], "item_id long, text string")
    assert decontamination.overlaps(empty(spark), bench).count() == 0
    assert decontamination.overlaps(messy(spark), bench.limit(0)).count() == 0
    assert decontamination.without_leaks(messy(spark), bench.limit(0)).count() == len(messy_rows())


def test_no_python_in_the_plan(spark):
    docs, items = leak_tables(spark)
    df = decontamination.overlaps(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_forest_is_fitted_on_every_labelled_row(spark):
    # the good rows are the last by the hash of their id, so no sample by hash holds them
    ids = [r.id for r in spark.range(9000).orderBy(F.xxhash64("id")).collect()]
    good = set(ids[-60:])
    rows = [(i, prose(random.Random(i), 30) if i in good else "%%% %%%", "en", "s", 1) for i in ids]
    docs = spark.createDataFrame(rows, DOC)
    forest = quality_forest.fit(docs, labelled(spark, [(i, int(i in good), 0) for i in ids]), max_loss=0.0)
    assert forest is not None and forest.sample == 60
    assert {r.doc_id for r in quality_forest.verdicts(docs, forest).filter("kept").collect()} == good


def test_nth_largest_is_exact(spark):
    rng = random.Random(4)
    values = [rng.random() ** 9 for _ in range(3000)] + [0.25] * 500 + [0.25 + 2 ** -54 * k for k in range(9)]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    falling = sorted(values, reverse=True)
    for n in (0, 1, 30, falling.index(0.25), falling.index(0.25) + 499, 2999, len(values) - 1):
        assert quality_forest.nth_largest(df, n) == falling[n]
