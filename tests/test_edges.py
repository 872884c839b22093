"""Edge cases: tiny or empty inputs."""

import math

from pyspark.sql import functions as F

from conftest import edges_df, ids_df
from tessera.operators import cardinality as K
from tessera.operators import evaluate as E
from tessera.operators import lsh as L
from tessera.operators.bags import token_bag
from tessera.operators.graph.components import strong_components, weak_components
from tessera.operators.similarity import knn_exact


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id BIGINT, text STRING")


def test_knn_k_larger_than_model(spark):
    model = docs(spark, [(10, "a b"), (11, "c")])
    q = docs(spark, [(1, "a")])
    got = [(r.rank, r.m_id) for r in knn_exact(token_bag(q), token_bag(model), 5).orderBy("rank").collect()]
    assert got == [(1, 10), (2, 11)]


def test_hll_single_register(spark):
    h = K.with_hash(spark.range(0, 1000).select(F.col("id").alias("v")), "v")
    r = K.hll_estimate(K.hll_registers(h, 0), 0).first()
    assert r.registers_used == 1 and r.estimate > 0


def test_lsh_nearest_empty_model(spark):
    q = docs(spark, [(1, "a b")])
    m = docs(spark, [(10, "")])
    out = L.lsh_nearest(token_bag(q), token_bag(m), L.lsh_signature(q, 4, 1), L.lsh_signature(m, 4, 1)).collect()
    assert out == []


def test_components_without_edges(spark):
    e = edges_df(spark, [(1, 1)]).where("src <> dst")
    v = ids_df(spark, [3, 1, 2])
    assert sorted((r.id, r.component) for r in weak_components(e, v).collect()) == [(1, 1), (2, 2), (3, 3)]
    assert sorted((r.id, r.component) for r in strong_components(e, v).collect()) == [(1, 1), (2, 2), (3, 3)]


def test_evaluation_over_shared_ids_only(spark):
    pred = spark.createDataFrame([(1, 1), (2, 1), (3, 2), (9, 5)], "id BIGINT, cluster BIGINT")
    actual = spark.createDataFrame([(1, 7), (2, 7), (3, 7), (8, 7)], "id BIGINT, cluster BIGINT")
    r = E.evaluate_clustering(pred, actual).first()
    assert r.n == 3 and (r.tp, r.fp, r.fn, r.tn) == (1, 0, 2, 0)
    assert math.isclose(r.precision, 1.0) and math.isclose(r.recall, 1 / 3)
