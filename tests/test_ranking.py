from pyspark.sql import Window
from pyspark.sql import functions as F

from access_lake.operators.ranking import global_row_number, rank_by, top_k


def test_global_row_number_equals_single_partition(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 3).alias("g"))
    order = [F.asc("g"), F.asc("k")]
    got = global_row_number(df, order, "rn", num_partitions=4)
    ref = df.withColumn("rn2", F.row_number().over(Window.orderBy(*order)).cast("bigint"))
    j = got.join(ref, ["k", "g"])
    assert j.count() == 5000
    assert j.filter("rn != rn2").count() == 0
    assert sorted(r[0] for r in got.select("rn").collect()) == list(range(1, 5001))


def test_rank_by_nulls_last_and_top_k(spark):
    df = spark.createDataFrame([("a", 2.0), ("b", None), ("c", 1.0)], "n string, r double")
    ranked = {r.n: r.rk for r in rank_by(df, [F.asc_nulls_last("r"), F.asc("n")], "rk").collect()}
    assert ranked == {"c": 1, "a": 2, "b": 3}
    assert [r.n for r in top_k(df, [F.desc_nulls_last("r")], 2).collect()] == ["a", "c"]
