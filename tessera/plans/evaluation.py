"""Registered clustering-evaluation queries: documents clustered by ``lang``
(predicted) against ``source`` (actual)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.operators import evaluate as E
from tessera.sources.tables import table


def _clusterings(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    pred = docs.select(F.col("doc_id").alias("id"), F.col("lang").alias("cluster"))
    actual = docs.select(F.col("doc_id").alias("id"), F.col("source").alias("cluster"))
    return pred, actual


def _r(cols):
    return [F.round(c, 6).alias(c) for c in cols]


def _whole(cols):
    return [F.col(c).cast("bigint").alias(c) for c in cols]


def q_cluster_sizes(spark, sf_dir):
    return E.cluster_sizes(_clusterings(spark, sf_dir)[1])


def q_contingency(spark, sf_dir):
    return E.contingency(*_clusterings(spark, sf_dir))


def q_nmi(spark, sf_dir):
    return E.nmi(*_clusterings(spark, sf_dir)).select("n", *_r(["h_pred", "h_actual", "mi", "nmi"]))


def q_pair_crosstab(spark, sf_dir):
    return E.pair_crosstab(*_clusterings(spark, sf_dir)).select(*_whole(["tp", "fp", "fn", "tn"]))


def q_pair_prf(spark, sf_dir):
    return E.pair_prf(E.pair_crosstab(*_clusterings(spark, sf_dir))).select(
        *_whole(["tp", "fp", "fn", "tn"]), *_r(["precision", "recall", "f1"])
    )


def q_evaluate_clustering(spark, sf_dir):
    return E.evaluate_clustering(*_clusterings(spark, sf_dir)).select(
        "n", *_whole(["tp", "fp", "fn", "tn"]), *_r(["h_pred", "h_actual", "mi", "nmi", "precision", "recall", "f1"])
    )


QUERIES = {
    "cluster_sizes": q_cluster_sizes,
    "contingency": q_contingency,
    "nmi": q_nmi,
    "pair_crosstab": q_pair_crosstab,
    "pair_prf": q_pair_prf,
    "evaluate_clustering": q_evaluate_clustering,
}

_CT = """ct AS (SELECT lang AS pred, source AS actual, count(*)::BIGINT AS n FROM documents GROUP BY 1, 2),
tot AS (SELECT SUM(n)::DOUBLE AS total FROM ct),
pm AS (SELECT pred, SUM(n) AS ni FROM ct GROUP BY 1),
am AS (SELECT actual, SUM(n) AS nj FROM ct GROUP BY 1),
hp AS (SELECT -SUM(ni / total * ln(ni / total)) AS h_pred FROM pm, tot),
ha AS (SELECT -SUM(nj / total * ln(nj / total)) AS h_actual FROM am, tot),
mi AS (SELECT SUM(n / total * ln(total * n / (ni * nj))) AS mi
       FROM ct JOIN pm USING (pred) JOIN am USING (actual), tot),
nm AS (SELECT total::BIGINT AS n, h_pred, h_actual, mi,
       CASE WHEN (h_pred + h_actual) / 2 > 0 THEN mi / ((h_pred + h_actual) / 2) END AS nmi
       FROM tot, hp, ha, mi),
xt AS (SELECT (SELECT SUM(n * (n - 1) // 2) FROM ct)::BIGINT AS tp,
              ((SELECT SUM(ni * (ni - 1) // 2) FROM pm) - (SELECT SUM(n * (n - 1) // 2) FROM ct))::BIGINT AS fp,
              ((SELECT SUM(nj * (nj - 1) // 2) FROM am) - (SELECT SUM(n * (n - 1) // 2) FROM ct))::BIGINT AS fn,
              (SELECT total::BIGINT * (total::BIGINT - 1) // 2 FROM tot)::BIGINT AS allp),
prf AS (SELECT tp, fp, fn, (allp - tp - fp - fn)::BIGINT AS tn,
        tp::DOUBLE / (tp + fp) AS precision, tp::DOUBLE / (tp + fn) AS recall FROM xt)"""

ORACLES = {
    "cluster_sizes": "SELECT source AS cluster, count(*)::BIGINT AS size FROM documents GROUP BY 1",
    "contingency": f"WITH {_CT} SELECT pred, actual, n FROM ct",
    "nmi": f"""WITH {_CT} SELECT n, round(h_pred, 6) AS h_pred, round(h_actual, 6) AS h_actual,
  round(mi, 6) AS mi, round(nmi, 6) AS nmi FROM nm""",
    "pair_crosstab": f"WITH {_CT} SELECT tp, fp, fn, allp - tp - fp - fn AS tn FROM xt",
    "pair_prf": f"""WITH {_CT} SELECT tp, fp, fn, tn, round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(2 * precision * recall / (precision + recall), 6) AS f1 FROM prf""",
    "evaluate_clustering": f"""WITH {_CT} SELECT n, tp, fp, fn, tn, round(h_pred, 6) AS h_pred,
  round(h_actual, 6) AS h_actual, round(mi, 6) AS mi, round(nmi, 6) AS nmi,
  round(precision, 6) AS precision, round(recall, 6) AS recall,
  round(2 * precision * recall / (precision + recall), 6) AS f1 FROM nm, prf""",
}
