"""op9: the exchange of pseudo-labels covers all rows and helps."""

import numpy as np
import pytest

from tessera.llm import common, quality

SF = "/root/testdata/sf0.1"


def packed(spark, a, b):
    rows = [(i, x.tobytes(), z.tobytes()) for i, (x, z) in enumerate(zip(a.astype("<f2"), b.astype("<f2"), strict=True))]
    return spark.createDataFrame(rows, "key BIGINT, t BINARY, m BINARY").repartition(4)


def two_views(rng, n, dims=30):
    """Rows whose views are independent given the class, each of them noisy."""
    y = (rng.random(n) < 0.5).astype(float)
    shift = np.r_[np.full(6, 0.55), np.zeros(dims - 6)]
    return y, *[rng.normal(size=(n, dims)) + np.outer(2 * y - 1, shift) for _ in range(2)]


def test_rounds_beat_no_rounds_with_few_labels(spark):
    gains = []
    for seed in range(3):
        rng = np.random.default_rng(seed)
        y, a, b = two_views(rng, 30)
        _, ua, ub = two_views(rng, 4000)
        ty, ta, tb = two_views(rng, 4000)
        pool = packed(spark, ua, ub).cache()
        right = [
            np.mean((quality.co_train(a, b, y, pool, rounds).scores(ta, tb)[2] >= 0.5) == ty) for rounds in (0, 4)
        ]
        gains.append(right[1] - right[0])
        pool.unpersist()
    assert min(gains) > 0 and np.mean(gains) > 0.01


def test_every_row_can_be_handed_over(spark):
    """The surest rows are found wherever they lie; copies count once."""
    rng = np.random.default_rng(7)
    y, a, b = two_views(rng, 400)
    view = {"t": quality.View(a, y), "m": quality.View(b, y)}
    for v in view.values():
        v.fit()
    _, ua, ub = two_views(rng, 9000)
    got = quality._confident(packed(spark, ua, ub), view, [("t", True, 1.0, 25), ("m", False, 1.0, 10)], np.array([3]))
    zt = view["t"].logit(ua.astype("<f2").astype(float))
    zm = view["m"].logit(ub.astype("<f2").astype(float))
    zt[3], zm[3] = -99, 99
    assert {r.key for r in got if r.want == 0} == set(np.argsort(-zt)[:25])
    assert {r.key for r in got if r.want == 1} == set(np.argsort(zm)[:10])


def test_rounds_do_no_harm_on_given_documents(spark):
    docs, labels = common.read_table(spark, SF, "documents"), common.read_table(spark, SF, "labels")
    held = labels.where("doc_id % 3 = 1")
    right = {}
    for rounds in (0, 4):
        model = quality.train(docs, labels.where("doc_id % 3 <> 1"), max_labelled=60, rounds=rounds)
        rows = quality.score(docs, model).join(held, "doc_id").collect()
        right[rounds] = np.mean([r.keep == (r.quality == 1) for r in rows])
    assert right[4] >= right[0] > 0.95 and sum(model.taught) > 0


@pytest.mark.parametrize("pool_rows", [0, 1])
def test_small_pools(spark, pool_rows):
    rng = np.random.default_rng(1)
    y, a, b = two_views(rng, 40)
    _, ua, ub = two_views(rng, 1)
    p = quality.co_train(a, b, y, packed(spark, ua, ub).limit(pool_rows)).scores(a, b)[2]
    assert len(p) == 40 and np.isfinite(p).all()
