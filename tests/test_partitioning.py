from pyspark.sql import functions as F

from tessera.operators.partitioning import dense_index, fan_out, hot_classes, salted_join, split_join


def test_dense_index_numbers_every_row_in_order(spark):
    df = spark.range(0, 3000).select((F.col("id") * 7919 % 3001).alias("x"))
    rows = dense_index(df, "x").orderBy("x").collect()
    assert [r.pos for r in rows] == list(range(3000))


def test_fan_out_partition_count_and_rows(spark):
    df = spark.range(0, 1000).select((F.col("id") % 7).alias("s"), "id")
    out = fan_out(df, "s")
    assert out.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism * 2
    assert sorted(r.id for r in out.collect()) == list(range(1000))


def test_salted_join_equals_plain_join(spark):
    small = spark.createDataFrame([(k, f"q{k}") for k in range(5)], "k INT, q STRING")
    large = spark.range(0, 500).select((F.col("id") % 3).alias("k").cast("int"), F.col("id").alias("m"))
    plain = sorted(tuple(r) for r in small.join(large, ["k"]).select("k", "q", "m").collect())
    for salts in (1, 2, 5):
        got = sorted(tuple(r) for r in salted_join(small, large, ["k"], "m", salts).select("k", "q", "m").collect())
        assert got == plain


def test_split_join_spreads_a_key_of_every_row_and_loses_none(spark):
    n = 60_000
    large = spark.range(n).select(F.col("id").alias("m"), F.explode(F.array(F.lit("the"), F.concat(F.lit("t"), F.col("id") % 3000))).alias("token"))
    small = spark.createDataFrame([(q, t) for q in range(3) for t in ("the", f"t{q}", "none")], "q INT, token STRING")
    hot = hot_classes(large, ["token"], parts=8, few_rows=1000).collect()
    assert [r._n for r in hot] == [4]  # half of the rows, and eight shares
    plain = small.join(large, "token").select("q", "m", "token")
    got = split_join(small, large, ["token"], "m", parts=8, few_rows=1000)
    assert sorted(got.columns) == ["m", "q", "token"]
    assert got.select("q", "m", "token").exceptAll(plain).isEmpty() and got.count() == plain.count()
    salts = large.where("token = 'the'").groupBy(F.pmod(F.xxhash64("m"), F.lit(4))).count().collect()
    rows = [r["count"] for r in salts]
    assert max(rows) <= 2 * sorted(rows)[len(rows) // 2]
    assert hot_classes(large.limit(0), ["token"]).isEmpty()
    assert hot_classes(large.where("token <> 'the'"), ["token"], parts=8, few_rows=1000).isEmpty()
