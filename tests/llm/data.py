"""Small tables for the operator tests."""

import random

WORDS = "amber basin cedar delta ember fjord grove haven inlet jetty knoll ledge marsh north oasis prairie quartz ridge spring tundra".split()
DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: columns whose names operators use inside
CLASHING = ["block", "key", "rest", "grp", "kind", "data", "fp", "row_key", "tile", "size", "shard", "slot", "n_words", "kept",
            "component_id", "seed", "words", "hashes", "quality", "item_id", "bin_id", "cluster", "passages", "kept_text", "salt", "one"]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(400)) for _ in range(n))


def messy_rows(seed=1):
    """Nulls, blanks, ties, repeated rows, odd bytes and a very long text."""
    rng = random.Random(seed)
    shared = prose(rng, 60)
    rows = [(i, prose(rng, rng.randrange(1, 120)), "en", f"s{i % 3}", 0) for i in range(12)]
    rows += [(20, None, None, None, None), (21, "", "en", "s0", 0), (22, " \t\n ", "en", "s1", 3), (None, "no id here " + shared, None, "s2", 1), (None, None, None, None, None)]
    rows += [(30, prose(rng, 30) + " " + shared + "\n" + prose(rng, 20), "en", "s0", 9), (31, shared + " tail", "en", "s0", 9)]
    rows += [(40, rows[3][1], "en", "s0", 5), (41, rows[3][1], "fr", "s1", 5), (42, rows[5][1], "en", "s0", 1), (42, rows[5][1], "en", "s0", 1)]
    rows += [(50, "x\x00y z éÉ \U0001f600 A\x0bB\x0cC\x1cD E " * 3, "en", "s9", 7), (51, "Word " * 400, "en", "s9", 7), (52, "w" * 5000, "en", "s9", 7)]
    rows += [(60, prose(rng, 30_000), "en", "s0", 1), (-7, prose(rng, 50), "en", "s0", 1)]
    return rows


def messy(spark, seed=1, clash=True):
    from pyspark.sql import functions as F
    df = spark.createDataFrame(messy_rows(seed), DOC).repartition(3)
    for c in CLASHING if clash else []:
        df = df.withColumn(c, F.lit("x"))
    return df


def empty(spark):
    return spark.createDataFrame([], DOC)
