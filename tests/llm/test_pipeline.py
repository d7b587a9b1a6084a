"""The corpus pipeline against brute force, stage by stage."""

import collections
import random

import pytest

import corpus_pipeline
from access_lake.llm import quality_forest
from data import DOC, messy_rows, prose
from test_blocks_and_repeats import repeats_by_hand, split
from test_pairs_and_filters import classes_by_hand, fingerprint_by_hand, overlaps_by_hand, statistics_by_hand


def tables(spark, path, rows, bench, labels):
    spark.createDataFrame(rows, DOC).repartition(2).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(bench, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def corpus():
    rng = random.Random(11)
    bench = [(i, prose(rng, 20 + i)) for i in range(6)]
    passage, rows = prose(rng, 50), messy_rows()
    for i in range(100, 220):
        rows.append((i, prose(rng, rng.randrange(40, 160)), "en", f"s{i % 4}", 1))
    for i in range(300, 306):
        rows.append((i, f"{prose(rng, 60)} {bench[i - 300][1]} {prose(rng, 5)}", "en", "s0", 1))
    for i in range(310, 330):
        rows.append((i, f"{prose(rng, 40)}\n{passage}\n{prose(rng, 70)}", "en", "s1", 1))
    for i in range(340, 360):
        rows.append((i, " ".join(w + "$$$" for w in prose(rng, 60).split()), "en", "s2", 1))
    copy = prose(rng, 90)
    rows += [(i, copy, "en", "s0", 1) for i in range(370, 400)]
    labels = [(r[0], 0 if 340 <= r[0] < 350 else 1, 0) for r in rows if r[0] is not None and (100 <= r[0] < 190 or 310 <= r[0] < 350 or 370 <= r[0] < 380)]
    return rows, bench, labels


def test_stages_equal_brute_force(spark, tmp):
    rows, bench, labels = corpus()
    path = tables(spark, f"{tmp}/sf", rows, bench, labels)
    docs = spark.read.parquet(f"{path}/documents.parquet")
    names = docs.columns
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality rules", "SimHash near-dedup", "substring dedup", "benchmark decontamination", "best-fit packing"]
    state = [(r[0], r[1]) for r in rows]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
        if name == "best-fit packing":
            break
        assert docs.columns == names
        got = sorted((str(r.doc_id), r.text) for r in docs.collect())
        if name == "quality rules":
            forest = quality_forest.fit(spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
            kept = {r.doc_id for r in quality_forest.verdicts(spark.createDataFrame(rows, DOC), forest).filter("kept").collect()}
            for i, t in state:
                n, _, _, _, repeat = statistics_by_hand(t)
                assert i is None or i not in kept or (n >= 10 and 100 * repeat <= 20 * n)
            assert not kept & set(range(340, 360)) and len(kept & set(range(100, 220))) >= 115
            assert set(range(310, 330)) <= kept and set(range(370, 400)) <= kept
            state = [(i, t) for i, t in state if str(i) in {g[0] for g in got} and (str(i), t) in got]
        elif name == "SimHash near-dedup":
            group = classes_by_hand([fingerprint_by_hand(t) for _, t in state], 3)
            best = {}
            for x, g in zip(state, group):
                own = (x[0] is None, x[0] or 0, x[1])
                best[g] = min(best.get(g, own), own)
            state = [(None if u else i, t) for u, i, t in best.values()]
            assert 370 in {i for i, _ in state} and 371 not in {i for i, _ in state}
        elif name == "substring dedup":
            hand = repeats_by_hand([t for _, t in state], 35)
            assert any(n for _, n, _ in hand)
            after = [(i, n - gone, digest) for (i, _), (n, gone, digest) in zip(state, hand) if not (n and n == gone)]
            assert sorted((i, len(split(t))) for i, t in got) == sorted((str(i), n) for i, n, _ in after)
            state = [(None if i == "None" else int(i), t) for i, t in got]
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            leaks = {x[0] for x in overlaps_by_hand(state, bench)}
            assert set(range(300, 306)) <= leaks
            state = [(i, t) for i, t in state if i not in leaks]
        assert got == sorted((str(i), t) for i, t in state), name
    words = collections.Counter()
    for r in docs.collect():
        words[r.doc_id] += r.words
    assert words == {i: len(split(t)) for i, t in state}


def test_run_equals_its_stages(spark, tmp):
    rows, bench, labels = corpus()
    path = tables(spark, f"{tmp}/sf", rows, bench, labels)
    out = corpus_pipeline.run(spark, path).collect()
    docs = spark.read.parquet(f"{path}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, path).write.parquet(f"{tmp}/{k}")
        docs = spark.read.parquet(f"{tmp}/{k}")
    assert sorted((str(r.doc_id), r.piece, r.words, r.bin_words) for r in out) == sorted((str(r.doc_id), r.piece, r.words, r.bin_words) for r in docs.collect())


def test_empty_tables(spark, tmp):
    path = tables(spark, f"{tmp}/sf", [], [], [])
    assert corpus_pipeline.run(spark, path).count() == 0


def test_registered():
    import __spark_entry__ as E

    names = set(E.queries())
    assert {f"op{n}_" for n in range(1, 14)} == {q[:q.index("_") + 1] for q in names if q.startswith("op")} and "pipeline" in names


@pytest.mark.parametrize("name", [f"op{n}_" for n in range(1, 11)])
def test_queries_follow_their_contract(spark, name):
    import __spark_entry__ as E

    columns = {
        "op2_": "doc_id n_words n_removed kept_sha256", "op3_": "doc_id size text_crc32 law shard slot grown_shard",
        "op6_": "doc_id n_words n_base first_word last_word base_labels labels score", "op7_": "doc_id held_out n_tokens n_known train_tokens base_score score",
        "op8_": "page_id payload_bytes payload_digest record_type refers_to",
        "op9_": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept", "op10_": "doc_id fingerprint component_id"}
    query = next(q for n, q in E.queries().items() if n.startswith(name))
    df = query(spark, "/root/testdata/sf0.001")
    assert set(columns.get(name, "").split()) <= set(df.columns)
    rows = df.count()
    if name in ("op2_", "op3_", "op6_", "op7_", "op9_", "op10_"):
        assert rows == spark.read.parquet("/root/testdata/sf0.001/documents.parquet").count()
