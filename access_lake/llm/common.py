"""Inputs, shared folders and sizes for the operators of this subpackage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which every executor
    shares. Only a local master may go without that setting (tests)."""
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="llm-shared-")
        sc.setCheckpointDir(base)
    elif not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
    return f"{base.rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_and_text(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The two columns an operator reads; whatever else a table has, under
    any name, is left behind here and so cannot clash."""
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))


def text_bytes(docs: DataFrame) -> tuple[int, int]:
    """Rows, and UTF-8 bytes of all texts (one cheap pass)."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("b")).first()
    return int(row["n"]), int(row["b"])


def per_worker(key, build):
    """``build()``, once per Python worker: workers serve many tasks, and a
    read-only model (an automaton, a loaded vocabulary) outlives a task.
    Kept on a module of its own, since this one is pickled by value."""
    import sys
    import types

    kept = sys.modules.setdefault("_llm_kept", types.ModuleType("_llm_kept")).__dict__
    if key not in kept:
        kept[key] = build()
    return kept[key]


def pieces(total: int, each: int) -> int:
    return max(1, -(-int(total) // each))
