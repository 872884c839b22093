import itertools
import math

from tessera.operators import evaluate as E


def clust(spark, pairs):
    return spark.createDataFrame(pairs, "id BIGINT, cluster BIGINT")


def brute(pred, actual):
    p, a = dict(pred), dict(actual)
    ids = sorted(set(p) & set(a))
    tp = fp = fn = tn = 0
    for x, y in itertools.combinations(ids, 2):
        sp, sa = p[x] == p[y], a[x] == a[y]
        tp += sp and sa
        fp += sp and not sa
        fn += sa and not sp
        tn += not sp and not sa
    return tp, fp, fn, tn


def test_crosstab_closed_form_equals_brute_force(spark):
    pred = [(i, i % 3) for i in range(40)]
    actual = [(i, i % 5 if i < 30 else 9) for i in range(40)]
    r = E.pair_crosstab(clust(spark, pred), clust(spark, actual)).first()
    assert (r.tp, r.fp, r.fn, r.tn) == brute(pred, actual)


def test_nmi_identical_is_one_and_single_cluster_null(spark):
    c = clust(spark, [(i, i % 4) for i in range(20)])
    assert abs(E.nmi(c, c).first().nmi - 1.0) < 1e-12
    one = clust(spark, [(i, 0) for i in range(20)])
    assert E.nmi(one, one).first().nmi is None


def test_all_alone_and_prf(spark):
    alone = clust(spark, [(i, i) for i in range(10)])
    one = clust(spark, [(i, 0) for i in range(10)])
    r = E.pair_prf(E.pair_crosstab(alone, one)).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (0, 0, 45, 0)
    assert r.precision is None and r.recall == 0.0


def test_evaluate_clustering_matches_parts(spark):
    pred = clust(spark, [(i, i % 3) for i in range(30)])
    actual = clust(spark, [(i, i % 2) for i in range(30)])
    full = E.evaluate_clustering(pred, actual).first()
    n = E.nmi(pred, actual).first()
    assert math.isclose(full.nmi, n.nmi, abs_tol=1e-12)


def test_empty_join(spark):
    a = clust(spark, [(1, 1)])
    b = clust(spark, [(2, 1)])
    r = E.pair_crosstab(a, b).first()
    assert (r.tp, r.fp, r.fn, r.tn) == (0, 0, 0, 0)
