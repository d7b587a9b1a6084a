"""Operator 11 against the tokenizers library, text by text."""

import hashlib
import random

import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from access_lake.llm import trie_encoding as T
from access_lake.llm.catalog import QUERIES
from data import DOC, empty, messy, messy_rows

ODD = ["a  <|endoftext|> b<|endoftext|><|endoftext|>", "<|endoftext|", "   x" + " " * 5000, "\n\n \t x y\x85z\x1c\x1d 　q", "'s 'll'LL don't",
       "a" * 3000, "\U0001f600" * 40, "=-" * 300, " " * 2_000_000, "\n" * 1_000_000 + "x", "word" * 200_000]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(T.TOKENIZER)


def test_every_kind_of_character_splits_and_merges_as_in_the_library(library):
    coder = T.TextEncoder(T.read_tokenizer(T.TOKENIZER))
    every = [chr(x) for x in range(1, 0x30000) if not 0xD800 <= x < 0xE000]
    rng = random.Random(3)
    texts = ["".join(f"a{c}1{c} {c}{c} " for c in every[i:i + 3000:7]) for i in range(0, len(every), 3000)]
    texts += ["".join(rng.choice("ab -'s\n1é<|") for _ in range(200)) for _ in range(200)] + [None, ""]
    ids, counts = coder.encode(texts)
    at = 0
    for text, n in zip(texts, counts.tolist()):
        assert ids[at:at + n].tolist() == library.encode(text or "", add_special_tokens=False).ids
        at += n


def test_texts_of_a_messy_table_round_trip(spark, library):
    rows = messy_rows() + [(100 + i, t, "en", "s", 0) for i, t in enumerate(ODD)]
    docs = spark.createDataFrame(rows, DOC).repartition(3).withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(1))
    got = T.decode(T.encode(docs)).collect()
    want = sorted(((d, t or "") for d, t, *_ in rows), key=str)
    assert sorted(((r.doc_id, r.text) for r in got), key=str) == want
    by_text = {t: library.encode(t, add_special_tokens=False).ids for _, t in want}
    assert all(list(r.ids) == by_text[r.text] for r in got)
    both = T.encode(docs, with_decoded=True).collect()
    assert sorted(map(str, ((r.doc_id, r.ids, r.decoded) for r in both))) == sorted(map(str, ((r.doc_id, r.ids, r.text) for r in got)))


def test_special_tokens_can_be_ordinary_text(spark, library):
    docs = spark.createDataFrame([(1, ODD[0])], "doc_id long, text string")
    library.encode_special_tokens = True
    try:
        want = library.encode(ODD[0], add_special_tokens=False).ids
    finally:
        library.encode_special_tokens = False
    assert list(T.encode(docs, specials=False).first().ids) == want
    assert T.decode(T.encode(docs, specials=False)).first().text == ODD[0]


def test_unknown_ids_and_broken_bytes_decode_as_in_the_library(spark, library):
    lists = [[50_300, 464, -1], [None, 464], [], None, [447], [262, 447, 220]]
    docs = spark.createDataFrame(list(enumerate(lists)), "k int, ids array<int>")
    got = {r.k: r.text for r in T.decode(docs).collect()}
    for k, ids in enumerate(lists):
        assert got[k] == library.decode([i for i in ids or [] if i is not None and 0 <= i < 50_257], skip_special_tokens=False)


def test_small_blocks_and_a_forgetful_memory_change_nothing(spark, monkeypatch):
    docs = messy(spark)
    want = sorted(map(str, T.encode(docs).collect()))
    coder = T.TextEncoder(T.read_tokenizer(T.TOKENIZER))
    monkeypatch.setattr(T, "REMEMBERED", 10)
    got = []
    for doc_id, text in [(r.doc_id, r.text) for r in docs.collect()]:
        ids, _ = coder.encode([text])
        got.append((doc_id, ids.tolist()))
    assert sorted(f"Row(doc_id={d}, ids={i})" for d, i in got) == want


def test_empty_table_and_query(spark, library):
    assert T.decode(T.encode(empty(spark))).count() == 0
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_trie_encoding"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = library.encode(d.text or "", add_special_tokens=False).ids
        r = got[d.doc_id]
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()
