import math

from pyspark.sql import functions as F

from tessera.operators import cardinality as K


def hashed(spark, n, start=0, groups=1):
    df = spark.range(start, start + n).select(F.col("id").alias("v"), (F.col("id") % groups).alias("g"))
    return K.with_hash(df, "v")


def test_exact(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b"), (3, None)], "g INT, v STRING")
    got = {r.g: r.n_distinct for r in K.distinct_exact(df, "v", "g").collect()}
    assert got == {1: 1, 2: 1, 3: 0}


def test_hll_error_bound_and_small_p(spark):
    h = hashed(spark, 20000)
    for p in (4, 10, 12):
        est = K.hll_estimate(K.hll_registers(h, p), p).first().estimate
        assert abs(est - 20000) / 20000 < 3 * 1.04 / math.sqrt(1 << p) + 0.05, (p, est)
    # p below the built-in sketch's range still runs (4 registers: wide error)
    r = K.hll_estimate(K.hll_registers(h, 2), 2).first()
    assert r.registers_used == 4 and r.estimate > 0


def test_hll_fold_equals_direct(spark):
    h = hashed(spark, 5000, groups=3)
    direct = K.hll_registers(h, 6, "g")
    folded = K.hll_fold(K.hll_registers(h, 11, "g"), 11, 6, "g")
    assert sorted(direct.collect()) == sorted(folded.collect())


def test_hll_merge_is_union(spark):
    a, b = hashed(spark, 3000, 0), hashed(spark, 3000, 2000)
    merged = K.hll_merge(K.hll_registers(a, 8), K.hll_registers(b, 8))
    union = K.hll_registers(a.unionByName(b), 8)
    assert sorted(merged.collect()) == sorted(union.collect())


def test_kmv_exact_below_k_and_duplicates(spark):
    df = spark.createDataFrame([(x % 7,) for x in range(100)], "v INT")
    r = K.kmv_count(df, "v", 16).first()
    assert r.held == 7 and r.estimate == 7.0


def test_kmv_error_bound_and_merge(spark):
    a, b = hashed(spark, 20000, 0), hashed(spark, 20000, 10000)
    k = 256
    est = K.kmv_estimate(K.kmv_smallest(a, k), k).first().estimate
    assert abs(est - 20000) / 20000 < 3 / math.sqrt(k - 2)
    merged = K.kmv_merge(K.kmv_smallest(a, k), K.kmv_smallest(b, k), k=k)
    union = K.kmv_smallest(a.unionByName(b), k)
    assert sorted(r.h for r in merged.collect()) == sorted(r.h for r in union.collect())


def test_kmv_k1_uses_k_estimator(spark):
    r = K.kmv_estimate(K.kmv_smallest(hashed(spark, 1000), 1), 1).first()
    assert r.held == 1 and r.estimate > 0


def test_rmse_shape(spark):
    df = spark.range(0, 3000).select(F.col("id").cast("string").alias("v"))
    out = K.estimator_rmse(df, "v", seeds=(1, 2, 3), hll_ps=(4, 8), kmv_ks=(8, 64)).collect()
    assert len(out) == 4 and all(r.exact == 3000 for r in out)


def test_xxhash_path(spark):
    df = spark.range(0, 5000).select(F.col("id").cast("string").alias("v"))
    r = K.hll_count(df, "v", 10, hash_fn="xxhash64").first()
    assert abs(r.estimate - 5000) / 5000 < 0.15
    h = K.with_hash(df, "v", hash_fn="xxhash64").agg(F.min("h"), F.max("h")).first()
    assert h[0] >= 0 and h[1] < (1 << 60)


def test_builtin_hll(spark):
    df = spark.range(0, 20000).select((F.col("id") % 3).alias("g"), F.col("id").alias("v"))
    got = {r.g: r.estimate for r in K.hll_builtin(df, "v", 12, "g").collect()}
    assert set(got) == {0, 1, 2} and all(abs(e - 6667) / 6667 < 0.1 for e in got.values())


def test_theta_sets_within_their_error(spark):
    n = 40_000
    rows = spark.range(n).select(F.col("id").alias("v"), F.lit("a").alias("g")).unionByName(
        spark.range(n // 2, n + n // 2).select(F.col("id").alias("v"), F.lit("b").alias("g"))
    )
    rows = rows.unionByName(rows).unionByName(spark.createDataFrame([(None, "a"), (None, "c")], "v BIGINT, g STRING"))
    for lg, error in ((16, 0.0), (10, 0.15)):
        sk = K.theta_sketch(rows, "v", "g", lg)
        one = {g: sk.where(f"g = '{g}'").select(F.col("sketch").alias(g)) for g in "ab"}
        got = K.theta_compare(one["a"].crossJoin(one["b"]), "a", "b", lg).first()
        want = {"n_a": n, "n_b": n, "n_union": 1.5 * n, "n_both": n / 2, "n_only_a": n / 2, "n_only_b": n / 2}
        for k, x in want.items():
            assert abs(got[k] - x) <= error * want["n_union"], (lg, k, got[k], x)
        whole = K.theta_union(sk, None, lg).select(F.theta_sketch_estimate("sketch")).first()[0]
        assert abs(whole - 1.5 * n) <= error * 1.5 * n
    assert sk.count() == 3
    none = spark.createDataFrame([(None, bytes(1))], "x BINARY, y BINARY").select("x", F.lit(None).cast("binary").alias("y"))
    got = K.theta_compare(none, "x", "y").first()
    assert [got[c] for c in ("n_a", "n_b", "n_union", "n_both", "n_only_a", "n_only_b")] == [0] * 6
