"""Queries of the operators over the given tables, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import conflict_packing, decontamination, license_scan, ngram_lm, quality_forest, sharding, simhash_tiles, spelling_variants, substring_dedup, token_alignment, token_packing, trie_encoding, warc_convert
from .common import shared_dir, table

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each text left after cutting every repeated 35-word window."""
    found = substring_dedup.repeats(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op10_simhash_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of each document."""
    found = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op9_quality_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule statistics and verdict on each document."""
    docs = table(spark, sf_dir, "documents")
    forest = quality_forest.fit(docs, table(spark, sf_dir, "labels"))
    return quality_forest.verdicts(docs, forest).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "anomaly")


@query
def op3_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of equal bytes."""
    return sharding.shard(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op4_conflict_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents packed into bins of 2048 words without conflicts."""
    return conflict_packing.pack(conflict_packing.measure_near_copies(table(spark, sf_dir, "documents")))


@query
def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and fuzzy notices in each document."""
    return license_scan.scan(table(spark, sf_dir, "documents"))


@query
def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, packed into rows of 2048."""
    return token_packing.pack(table(spark, sf_dir, "documents"))


@query
def op8_warc_convert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages archived as ARC, converted to WARC, and read back."""
    arc, warc = shared_dir(spark, "arc"), shared_dir(spark, "warc")
    warc_convert.write_arc(table(spark, sf_dir, "pages"), arc)
    warc_convert.convert(spark, arc, warc)
    return warc_convert.read_warc(spark, warc, with_payload=False).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLE["op8_warc_convert"] = """
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN n >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 100 AND page_id <> first THEN first END AS refers_to
FROM (SELECT page_id, digest, n, min(page_id) OVER (PARTITION BY digest) AS first
      FROM (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS n, sha256(coalesce(html, '')) AS digest FROM pages))
"""


@query
def op7_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bigram model learned from the training folds, on all documents."""
    return ngram_lm.score(table(spark, sf_dir, "documents"))


@query
def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items in documents, up to two substitutions in 13 words;
    shorter items, down to one word, where they occur unchanged."""
    return decontamination.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), shortest=1)


@query
def op11_trie_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of each whole text, and the text that they decode to."""
    coded = trie_encoding.encode(table(spark, sf_dir, "documents"), with_decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
                        F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near words, forms and roots of the words of all texts; of the runs of
    letters whose checksum 97 divides one character is left out."""
    words = spelling_variants.word_counts(table(spark, sf_dir, "documents"), every=97)
    return spelling_variants.variants(words).select("word", "form", "root", "n", "n_near", "form_n")


@query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, per document."""
    return token_alignment.align(table(spark, sf_dir, "documents"))
