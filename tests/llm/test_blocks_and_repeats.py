"""Operators 2 and 7 and the block exchange they share."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st

from access_lake.llm import ngram_lm, substring_dedup, words
from data import empty, messy, messy_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def split(text):
    return WORD.findall(text or "")


def repeats_by_hand(texts, width):
    seen = collections.Counter()
    for t in texts:
        w = split(t)
        seen.update(tuple(w[i:i + width]) for i in range(len(w) - width + 1))
    out = []
    for t in texts:
        w = split(t)
        gone = [False] * len(w)
        for i in range(len(w) - width + 1):
            if seen[tuple(w[i:i + width])] > 1:
                gone[i:i + width] = [True] * width
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest()))
    return out


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(alphabet="ab \t\né\x1c", max_size=30) | st.none(), max_size=8))
def test_spans_and_hashes_follow_words(texts):
    column = pa.array(texts, pa.string())
    buf, offsets = words.text_buffer(column)
    starts, ends, counts = words.spans(buf, offsets)
    found = [bytes(buf[a:b]).decode() for a, b in zip(starts, ends)]
    assert found == [w for t in texts for w in split(t)]
    assert counts.tolist() == [len(split(t)) for t in texts]
    h, n = words.hashed_words(column)
    assert n.tolist() == counts.tolist()
    assert len(set(zip(h.tolist(), found))) == len(set(found)) == len(set(h.tolist()))


def test_window_hash_equals_iff_words_equal():
    h = np.array([1, 2, 3, 1, 2, 3, 4, 1, 2], np.uint64)
    for width in range(1, 9):
        w = words.window_hash(h, width)
        runs = [tuple(h[i:i + width]) for i in range(len(h) - width + 1)]
        assert len(w) == len(runs)
        for i, a in enumerate(runs):
            for j, b in enumerate(runs):
                assert (w[i] == w[j]) == (a == b)


def test_word_longer_than_a_segment(monkeypatch):
    monkeypatch.setattr(words, "SEGMENT", 64)
    h, n = words.hashed_words(pa.array(["b" * 500 + " " + "b" * 500 + " " + "b" * 499]))
    assert n.tolist() == [3] and h[0] == h[1] != h[2]


@pytest.mark.parametrize("width,crowded", [(5, 2000), (13, 2000), (35, 2000), (35, 1), (5, 1)])
def test_repeats_equal_brute_force(spark, monkeypatch, width, crowded):
    monkeypatch.setattr(substring_dedup, "CROWDED", crowded)  # lengthens prefixes
    rows = messy_rows()
    got = substring_dedup.repeats(messy(spark), width=width, group_keys=500, block_bytes=20_000).collect()
    expected = sorted((str(r[0]), *x) for r, x in zip(rows, repeats_by_hand([r[1] for r in rows], width)))
    assert sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256) for r in got) == expected
    for r in got:
        assert sum(p["words"] for p in r.passages) == r.n_removed


def test_hot_passage_is_found_everywhere(spark):
    passage = " ".join(f"hot{i}" for i in range(40))
    rows = [(i, f"a{i} b{i} {passage} c{i}", "en", "s", 0) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = substring_dedup.repeats(df, group_keys=200, block_bytes=2_000).collect()
    assert {(r.n_words, r.n_removed) for r in got} == {(43, 40)}


def test_remove_repeats_keeps_rows_columns_and_whitespace(spark):
    docs = messy(spark)
    got = substring_dedup.remove_repeats(docs, drop_emptied=False)
    assert got.schema.names == docs.schema.names and got.count() == docs.count()
    by = collections.defaultdict(list)
    for r in got.collect():
        by[r.doc_id].append(r.text)
    for i, text, *_ in messy_rows():
        if i in (0, 22, 50, 60):
            assert by[i] == [text]
    assert by[31] == ["tail"]
    assert substring_dedup.remove_repeats(docs).count() < docs.count()


def test_repeats_of_nothing(spark):
    got = substring_dedup.repeats(empty(spark))
    assert got.count() == 0 and got.columns[:4] == ["doc_id", "n_words", "n_removed", "kept_sha256"]
    assert substring_dedup.remove_repeats(empty(spark)).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_width_is_checked(spark):
    with pytest.raises(ValueError):
        substring_dedup.repeats(empty(spark), width=36)


# -- operator 7 -------------------------------------------------------------

def lm_by_hand(rows):
    tokens = [split((t or "").translate(LOWER)) + ["<end>"] for _, t in rows]
    part = [0 if d is None else zlib.crc32(str(d).encode()) % 7 for d, _ in rows]

    def count(pick):
        uni, bi = collections.Counter(), collections.Counter()
        for w, p in zip(tokens, part):
            if pick(p):
                uni.update(w)
                bi.update(zip(["<begin>"] + w, w))
        return uni, bi

    return tokens, part, count


def test_scores_equal_brute_force(spark):
    rows = [(r[0], r[1]) for r in messy_rows()]
    tokens, part, count = lm_by_hand(rows)
    uni, bi = count(lambda p: p != 2)
    main, main_bi = count(lambda p: p not in (2, 3))
    n, v = sum(uni.values()), len(uni)

    def context(c, p):
        return c["<end>"] if p == "<begin>" else c[p]

    cells = collections.Counter()
    for w, p in zip(tokens, part):
        if p == 3:
            triples = [(main[x], main_bi[(a, x)], context(main, a)) for a, x in zip(["<begin>"] + w, w)]
            cells.update(ngram_lm.cells(*np.array(triples).T).tolist())
    weights = ngram_lm.learn_weights(np.array(sorted(cells), np.int64), np.array([cells[c] for c in sorted(cells)], float), sum(main.values()), len(main))
    assert np.allclose(weights.sum(axis=1), 1)
    expected = []
    for (d, _), w, p in zip(rows, tokens, part):
        base = sum(math.log10((uni[x] + 1) / (n + v + 1)) for x in w)
        score = 0.0
        for a, x in zip(["<begin>"] + w, w):
            c = context(uni, a)
            m = weights[0 if not c else min(23, c.bit_length())]
            score += math.log10(m[0] * bi[(a, x)] / max(c, 1) + m[1] * uni[x] / n + m[2] / (v + 1))
        expected.append((str(d), p == 2, len(w), sum(uni[x] > 0 for x in w), n, base, score))
    got = [(str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score)
           for r in ngram_lm.score(messy(spark), block_bytes=20_000, group_keys=500).collect()]
    for g, e in zip(sorted(got), sorted(expected)):
        assert g[:5] == e[:5]
        assert g[5] == pytest.approx(e[5], rel=1e-9) and g[6] == pytest.approx(e[6], rel=1e-5)
    assert len(got) == len(expected)


def test_em_prefers_the_estimate_that_predicts():
    cell = np.array([3 * 100 * 100 + 1 * 100 + 1, 5 * 100 * 100 + 0 * 100 + 30])
    w = ngram_lm.learn_weights(cell, np.array([1000.0, 1000.0]), tokens=10_000, words=1_000)
    assert w[3, 0] > 0.9  # bigram estimate 1
    assert w[5, 1] > 0.9  # bigram estimate 0, a frequent word
    assert (w[:, 2] > 0).all()


def test_counts_survive_the_wire():
    a, b = np.array([0, 254, 255, 256, 10**12]), np.array([255, 0, 1, 2, 3])
    back = ngram_lm._unpack_counts(ngram_lm._pack_counts(a, b), 5, 2)
    assert back[0].tolist() == a.tolist() and back[1].tolist() == b.tolist()


def test_lm_of_nothing(spark):
    assert ngram_lm.score(empty(spark)).count() == 0
    held = [d for d in range(100) if zlib.crc32(str(d).encode()) % 7 == 2][:2]
    only = spark.createDataFrame([(d, "a b", "en", "s", 3) for d in held], "doc_id long, text string, lang string, source string, n_chars long")
    for r in ngram_lm.score(only).collect():
        assert r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0.0 and math.isfinite(r.score)


def test_lm_beats_the_base_on_held_out_texts(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = ngram_lm.score(docs).filter("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)
