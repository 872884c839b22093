import pytest
from pyspark.sql import functions as F

from tessera.operators import lsh as L
from tessera.operators.bags import token_bag
from tessera.operators.similarity import nearest_distance
from tessera.plans import corpus as C

SF = "/root/testdata/sf0.001"


def test_signature_bounds_and_mask(spark):
    d = spark.createDataFrame([(1, "a b c"), (2, ""), (3, "a b c")], "doc_id BIGINT, text STRING")
    s = L.lsh_signature(d, 40, 2).collect()
    assert {r.doc_id for r in s} == {1, 3} and len(s) == 4
    by = {(r.doc_id, r.band): (r.sig_lo, r.sig_hi) for r in s}
    assert by[(1, 0)] == by[(3, 0)] and all(0 <= hi < (1 << 8) for _, hi in by.values())
    m = L.mask_signature(L.lsh_signature(d, 40, 1), 5).collect()
    assert all(r.sig_lo < 32 and r.sig_hi == 0 for r in m)


def test_candidates_subset_and_approx_not_below_exact(spark):
    qs, model = C.query_sample(spark, SF), C.model(spark, SF)
    qb, mb = token_bag(qs), token_bag(model)
    exact = {r.q_id: r.distance for r in nearest_distance(qb, mb).collect()}
    approx = L.lsh_nearest(qb, mb, L.lsh_signature(qs, 8, 1), L.lsh_signature(model, 8, 1)).collect()
    for r in approx:
        assert r.distance >= exact[r.q_id] - 1e-12
    cands = L.lsh_candidates(L.lsh_signature(qs, 4, 3), L.lsh_signature(model, 4, 3))
    assert cands.where((F.col("hits") < 1) | (F.col("hits") > 3)).count() == 0


def test_one_plane_sweep_errors_grow(spark):
    qs, model = C.query_sample(spark, SF), C.model(spark, SF)
    out = {r.num_hyperplanes: r.mean_abs_err for r in L.plane_sweep(qs, model, token_bag(qs), token_bag(model), (1, 64)).collect()}
    assert out[1] <= out[64] + 1e-9


def test_classify_picks_true_nearest(spark):
    model = spark.createDataFrame([(10, "a b c d", 1), (11, "a b c x", 0)], "doc_id BIGINT, text STRING, label INT")
    q = spark.createDataFrame([(1, "a b c d", 1)], "doc_id BIGINT, text STRING, label INT")
    cands = spark.createDataFrame([(1, 10, 1), (1, 11, 1)], "q_id BIGINT, m_id BIGINT, hits BIGINT")
    labels = model.select(F.col("doc_id").alias("m_id"), "label")
    r = L.lsh_classify(cands, token_bag(q), token_bag(model), labels).first()
    assert r.m_id == 10 and r.predicted == 1


def test_zero_planes_one_bucket(spark):
    d = spark.createDataFrame([(1, "a"), (2, "b c"), (3, "")], "doc_id BIGINT, text STRING")
    s = L.lsh_signature(d, 0, 2).collect()
    assert sorted((r.doc_id, r.band, r.sig_lo, r.sig_hi) for r in s) == [(1, 0, 0, 0), (1, 1, 0, 0), (2, 0, 0, 0), (2, 1, 0, 0)]


def test_projections_by_arrays_are_the_md5_signs(spark, monkeypatch):
    import hashlib

    from tessera.operators import planes as P

    monkeypatch.setattr(P, "OCCURRENCES", 3)  # texts in several pieces
    rows = [(1, "a b a  c a"), (2, " é"), (3, None), (4, " "), (1, "b d"), (5, "x")]
    d = spark.createDataFrame(rows, "doc_id BIGINT, text STRING").coalesce(1)
    got = {(r.doc_id, r.band): (r.sig_lo, r.sig_hi) for r in L.lsh_signature(d, 50, 2, 7).collect()}
    words = {1: "a b a c a b d".split(), 2: ["é"], 5: ["x"]}
    for doc, ws in words.items():
        for band in range(2):
            halves = [hashlib.md5(f"7|{band}|{w}".encode()).hexdigest()[:16] for w in ws]
            above = [sum(2 * (int(h[8 * (i // 32) : 8 * (i // 32) + 8], 16) >> i % 32 & 1) - 1 for h in halves) > 0 for i in range(50)]
            assert got[doc, band] == (sum(b << i for i, b in enumerate(above[:32])), sum(b << i for i, b in enumerate(above[32:])))
    assert len(got) == 6


def test_sweep_makes_no_row_per_pair(spark, monkeypatch):
    import random

    from tessera.operators import blocks as B
    from tessera.operators import similarity as S

    rng = random.Random(5)
    text = lambda: " ".join(rng.choices([f"w{i}" for i in range(30)], k=rng.randint(1, 9)))
    schema = "doc_id BIGINT, text STRING"
    q = spark.createDataFrame([*((i, text()) for i in range(12)), (12, ""), (13, "alone")], schema)
    m = spark.createDataFrame([(100 + i, text()) for i in range(40)], schema)
    qb, mb = token_bag(q), token_bag(m)
    dist = {(r.q_id, r.m_id): r.distance for r in S.overlap_distance(qb, mb).collect()}
    sig = [{r.doc_id: r.sig_lo for r in L.lsh_signature(d, 12, 1).collect()} for d in (q, m)]
    near = lambda x, n: [dist.get((x, y), S.HALF_PI) for y in sig[1] if not (sig[0][x] ^ sig[1][y]) & ((1 << n) - 1)]
    pairs = lambda *a, **k: pytest.fail("a table of pairs")
    monkeypatch.setattr(S, "pair_dot", pairs)
    monkeypatch.setattr(L, "overlap_distance", pairs, raising=False)
    monkeypatch.setattr(B, "BLOCK_ROWS", 5)
    for r in L.plane_sweep(q, m, qb, mb, (1, 4, 12)).collect():
        n = r.num_hyperplanes
        missed = [x for x in sig[0] if not near(x, n)]
        assert (r.queries, r.fallbacks) == (13, len(missed))
        if not missed:
            assert r.mean_abs_err == pytest.approx(sum(min(near(x, n)) - min(near(x, 0)) for x in sig[0]) / 13)
