"""Operator 8 on archives that others wrote; operator 1 on runs of blanks."""

import gzip

import numpy as np
import regex

from access_lake.llm import token_packing, warc_convert
from access_lake.llm.common import shared_dir
from tokenizers import Tokenizer

LATIN = "HTTP/1.0 200 OK\r\nServer: caf\xe9\r\nContent-Type: text/html; charset=iso-8859-1\r\n\r\n<p>d\xe9j\xe0 vu</p>".encode("latin-1")
IMAGE = b"HTTP/1.1 200 OK\r\nContent-Type: image/gif\r\n\r\n" + bytes(range(256)) * 2
DNS = b"20010101120000\nwww.example.org.\t3600\tIN\tA\t192.0.2.7"


def arc(records):
    names = b"1 0 Someone\n" + warc_convert.ARC_FIELDS[1].encode() + b"\n"
    out = b"filedesc://old.arc 0.0.0.0 20010101000000 text/plain %d\n" % len(names) + names + b"\n"
    for url, ip, mime, block in records:
        out += b"%s %s 20010101120000 %s %d\n" % (url, ip, mime, len(block)) + block + b"\n"
    return out


def test_latin_1_images_and_lookups_survive_byte_for_byte(spark, tmp_path):
    records = [(b"http://a/caf\xe9", b"192.0.2.1", b"text/html", LATIN), (b"http://a/x.gif", b"192.0.2.1", b"image/gif", IMAGE),
               (b"dns:www.example.org", b"192.0.2.9", b"text/dns", DNS), (b"http://b/x.gif", b"192.0.2.2", b"image/gif", IMAGE),
               (b"http://c/none", b"0.0.0.0", b"text/html", b"HTTP/1.0 404 Not Found\r\n\r\n")]
    (tmp_path / "old.arc.gz").write_bytes(gzip.compress(arc(records)))
    out = shared_dir(spark, "foreign")
    warc_convert.convert(spark, str(tmp_path), out)
    got = warc_convert.read_warc(spark, out).collect()
    kinds = sorted((r.record_type, r.payload_bytes) for r in got)
    assert kinds == [("resource", len(DNS)), ("response", 0), ("response", 14), ("response", 512), ("revisit", 512)]
    raw = {r.url: bytes(r.raw) for r in got if r.record_type != "revisit"}
    assert raw["dns:www.example.org"] == DNS and bytes(range(256)) * 2 in raw.values()
    latin = next(r for r in got if r.payload_bytes == 14)
    assert bytes(latin.raw) == "<p>d\xe9j\xe0 vu</p>".encode("latin-1") and latin.payload is None
    files = b"".join(gzip.decompress(open(f.removeprefix("file:"), "rb").read())
                     for f in (r[0] for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(out).select("path").collect()))
    assert files.count(b"WARC-IP-Address: 192.0.2.1\r\n") == 2 and b"0.0.0.0" not in files and b"WARC-Filename" not in files
    assert files.count(b"WARC-Type: resource\r\n") == 1 and b"Content-Type: text/dns\r\n" in files
    assert LATIN in files and IMAGE in files


def test_runs_of_blanks_of_any_length_keep_their_ids(spark, monkeypatch):
    encode = token_packing.encoder(open(token_packing.VOCABULARY, "rb").read(), token_packing.PATTERN)
    library = Tokenizer.from_file(token_packing.VOCABULARY.replace(".tiktoken", ".json"))
    monkeypatch.setattr(token_packing, "LONG_BLANKS", 5)
    cut = regex.compile(r"\s{5,}").finditer
    for text in ("a" + " " * 9 + "b", " " * 9, "a" + " " * 9, "a\n\n\n\n\n\n\nb \n \n \n \n c", " " * 6 + "\t" * 6 + "'s", "\xa0" * 7 + "x" + "　" * 8, "no blanks here", "x" + " " * 5 + "\ny"):
        assert token_packing.encode_text(encode, cut, text).tolist() == library.encode(text).ids, text


def test_millions_of_blanks_are_packed(spark):
    texts = [" " * 2_000_000, "a" + "\n" * 1_500_000 + "b", "word " * 10]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    library = Tokenizer.from_file(token_packing.VOCABULARY.replace(".tiktoken", ".json"))
    found: dict = {}
    for r in token_packing.pack(docs).collect():
        ids, edges = np.frombuffer(r.input_ids, "<u2"), r.cu_seqlens
        for d, p, a, b in zip(r.doc_ids, r.pieces, edges, edges[1:]):
            found.setdefault(d, {})[p] = ids[a:b]
    for d, text in enumerate(texts):
        whole = np.concatenate([found[d][p] for p in sorted(found[d])])
        assert whole.tolist() == library.encode(text).ids + [token_packing.END]
