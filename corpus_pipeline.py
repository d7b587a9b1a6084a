"""The corpus pipeline: documents through five stages, one operator each.

Every stage works on all rows that its predecessor kept and keeps the columns
of ``documents``; the last one returns the packing. Defined cases are those
of the operators: null, empty and blank texts fail the quality rules; rows
repeated as a whole are near-copies of each other; tables may be empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from access_lake.llm import conflict_packing, decontamination, quality_forest, simhash_tiles, substring_dedup
from access_lake.llm.common import shared_dir, table


def reject_poor(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: documents that the rules or the forest reject go."""
    return quality_forest.keep_good(docs, quality_forest.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: of each group of near-copies the smallest id stays."""
    return simhash_tiles.keep_one(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 2: passages of 35 words and more that repeat are cut out;
    a document that loses every word goes."""
    cut = substring_dedup.remove_repeats(docs)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 5: documents that hold benchmark passages go, row by row:
    other rows of the same id, or without an id, stay."""
    return decontamination.without_leaking_rows(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: what is left is packed into bins."""
    return conflict_packing.pack(conflict_packing.measure(docs))


STAGES = [
    ("quality rules", reject_poor),
    ("SimHash near-dedup", drop_near_copies),
    ("substring dedup", cut_repeats),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack),
]

#: SQL can express neither the forest, the fingerprints nor the packing; the
#: tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written to the
    shared folder as Parquet and reread as the next stage's input."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES[:-1]):
        path = shared_dir(spark, f"stage-{i}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
