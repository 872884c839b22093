"""Evaluation of a clustering against a reference clustering.

A clustering is a DataFrame (id, cluster). Everything is derived from one
join on id and one ``cube(pred, actual)``: the cells of the contingency
table, its margins (cluster sizes) and the total in a single aggregation, so
the inputs are scanned and joined once. Pair counts use the
closed form over the contingency cells, never a join of all vertex pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _clust(df: DataFrame, id_col: str, cluster_col: str, name: str) -> DataFrame:
    return df.select(F.col(id_col).alias("id"), F.col(cluster_col).alias(name))


def cluster_sizes(clustering: DataFrame, id_col: str = "id", cluster_col: str = "cluster") -> DataFrame:
    """(cluster, size)."""
    return clustering.groupBy(F.col(cluster_col).alias("cluster")).agg(F.count(F.col(id_col)).alias("size"))


def contingency(
    pred: DataFrame, actual: DataFrame, id_col: str = "id", cluster_col: str = "cluster"
) -> DataFrame:
    """(pred, actual, n) over the ids present in both clusterings."""
    p = _clust(pred, id_col, cluster_col, "pred")
    a = _clust(actual, id_col, cluster_col, "actual")
    return p.join(a, "id").groupBy("pred", "actual").agg(F.count(F.lit(1)).alias("n"))


def _tagged_counts(table: DataFrame) -> DataFrame:
    """(kind, n): contingency cells, predicted-cluster sizes and actual-cluster
    sizes in one column, so every statistic is one aggregate (no joins)."""
    cells = table.select(F.lit("cell").alias("kind"), "n")
    pm = table.groupBy("pred").agg(F.sum("n").alias("n")).select(F.lit("pred").alias("kind"), "n")
    am = table.groupBy("actual").agg(F.sum("n").alias("n")).select(F.lit("actual").alias("kind"), "n")
    return cells.unionByName(pm).unionByName(am)


def _cube_counts(pred: DataFrame, actual: DataFrame, id_col: str, cluster_col: str) -> DataFrame:
    """(kind, n) straight from the joined rows: one ``cube(pred, actual)``
    gives the cells, both margins and the total in a single aggregation
    (one scan and one join of the two clusterings)."""
    p = _clust(pred, id_col, cluster_col, "pred")
    a = _clust(actual, id_col, cluster_col, "actual")
    g = F.grouping_id("pred", "actual")
    gid = F.col("gid")
    kinds = F.when(gid == 0, "cell").when(gid == 1, "pred").when(gid == 2, "actual").otherwise("total")
    return (
        p.join(a, "id")
        .cube("pred", "actual")
        .agg(F.count(F.lit(1)).alias("n"), g.alias("gid"))
        .select(kinds.alias("kind"), "n")
        .where(F.col("kind") != "total")
    )


def _sum_of(kind: str, expr: Column) -> Column:
    return F.sum(F.when(F.col("kind") == kind, expr))


def _entropy(h: Column, clusters: str) -> Column:
    """0 exactly for one cluster, and never below 0 by rounding."""
    return F.when(F.col(clusters) == 1, F.lit(0.0)).otherwise(F.greatest(h, F.lit(0.0)))


def _information(mi: Column) -> Column:
    """0 exactly if either side has one cluster, and never below 0 by rounding."""
    one = (F.col("k_pred") == 1) | (F.col("k_actual") == 1)
    return F.when(one, F.lit(0.0)).otherwise(F.greatest(mi, F.lit(0.0)))


def nmi_parts(table: DataFrame, tagged: DataFrame | None = None) -> DataFrame:
    """One row: n, h_pred, h_actual, mi, nmi (natural log; NMI uses the
    arithmetic mean of the two entropies and is null when both are 0).
    With S(x) = sum x ln x: H = ln N - S(margin)/N and
    MI = ln N + (S(cells) - S(pred) - S(actual)) / N."""
    nlogn = F.col("n") * F.log(F.col("n"))
    agg = (tagged if tagged is not None else _tagged_counts(table)).agg(
        _sum_of("cell", F.col("n")).cast("double").alias("total"),
        _sum_of("cell", nlogn).alias("s_cell"),
        _sum_of("pred", nlogn).alias("s_pred"),
        _sum_of("actual", nlogn).alias("s_actual"),
        _sum_of("pred", F.lit(1)).alias("k_pred"),
        _sum_of("actual", F.lit(1)).alias("k_actual"),
    )
    n, ln_n = F.col("total"), F.log(F.col("total"))
    h_pred = _entropy(ln_n - F.col("s_pred") / n, "k_pred")
    h_act = _entropy(ln_n - F.col("s_actual") / n, "k_actual")
    mi = _information(ln_n + (F.col("s_cell") - F.col("s_pred") - F.col("s_actual")) / n)
    mean_h = (h_pred + h_act) / 2
    return agg.select(
        n.cast("bigint").alias("n"),
        h_pred.alias("h_pred"),
        h_act.alias("h_actual"),
        mi.alias("mi"),
        F.when(mean_h > 0, mi / mean_h).alias("nmi"),
    )


def nmi(pred: DataFrame, actual: DataFrame, id_col: str = "id", cluster_col: str = "cluster") -> DataFrame:
    return nmi_parts(None, _cube_counts(pred, actual, id_col, cluster_col))


def _pairs(n: Column) -> Column:
    """C(n, 2) exactly: one of n and n - 1 is even, so both factors are whole."""
    n = n.cast("bigint")
    even, half = n % 2 == 0, F.shiftright(n, 1)
    a = F.when(even, half).otherwise(n).cast("decimal(19,0)")
    b = F.when(even, n - 1).otherwise(half).cast("decimal(19,0)")
    return (a * b).cast("decimal(38,0)")


def pair_crosstab_from(table: DataFrame, tagged: DataFrame | None = None) -> DataFrame:
    """One row: tp, fp, fn, tn (DECIMAL(38,0)) over all unordered pairs of ids.
    tp = sum C(n_ij, 2); tp + fp = sum C(n_i, 2) over predicted clusters;
    tp + fn = sum C(n_j, 2) over actual clusters; all pairs = C(N, 2)."""
    agg = (tagged if tagged is not None else _tagged_counts(table)).agg(
        F.coalesce(_sum_of("cell", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("tp"),
        F.coalesce(_sum_of("pred", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("pp"),
        F.coalesce(_sum_of("actual", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("ap"),
        F.coalesce(_sum_of("cell", F.col("n")), F.lit(0)).cast("bigint").alias("total"),
    )
    tp = F.col("tp")
    fp = F.col("pp") - tp
    fn = F.col("ap") - tp
    return agg.select(
        tp.alias("tp"),
        fp.cast("decimal(38,0)").alias("fp"),
        fn.cast("decimal(38,0)").alias("fn"),
        (_pairs(F.col("total")) - tp - fp - fn).cast("decimal(38,0)").alias("tn"),
    )


def pair_crosstab(pred: DataFrame, actual: DataFrame, id_col: str = "id", cluster_col: str = "cluster") -> DataFrame:
    return pair_crosstab_from(None, _cube_counts(pred, actual, id_col, cluster_col))


def pair_prf(crosstab: DataFrame, keep=()) -> DataFrame:
    """precision = tp/(tp+fp), recall = tp/(tp+fn), F1 their harmonic mean;
    null where a denominator is 0."""
    tp, fp, fn = (F.col(c).cast("double") for c in ("tp", "fp", "fn"))
    precision = F.when(tp + fp > 0, tp / (tp + fp))
    recall = F.when(tp + fn > 0, tp / (tp + fn))
    f1 = F.when(precision + recall > 0, 2 * precision * recall / (precision + recall))
    return crosstab.select(*keep, "tp", "fp", "fn", "tn", precision.alias("precision"), recall.alias("recall"), f1.alias("f1"))


def evaluate_clustering(pred: DataFrame, actual: DataFrame, id_col: str = "id", cluster_col: str = "cluster") -> DataFrame:
    """One row: NMI parts and the pair counts with precision/recall/F1, from
    a single contingency table."""
    nlogn = F.col("n") * F.log(F.col("n"))
    agg = _cube_counts(pred, actual, id_col, cluster_col).agg(
        _sum_of("cell", F.col("n")).cast("double").alias("total"),
        _sum_of("cell", nlogn).alias("s_cell"),
        _sum_of("pred", nlogn).alias("s_pred"),
        _sum_of("actual", nlogn).alias("s_actual"),
        _sum_of("pred", F.lit(1)).alias("k_pred"),
        _sum_of("actual", F.lit(1)).alias("k_actual"),
        F.coalesce(_sum_of("cell", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("tp"),
        F.coalesce(_sum_of("pred", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("pp"),
        F.coalesce(_sum_of("actual", _pairs(F.col("n"))), F.lit(0)).cast("decimal(38,0)").alias("ap"),
    )
    n, ln_n = F.col("total"), F.log(F.col("total"))
    h_pred = _entropy(ln_n - F.col("s_pred") / n, "k_pred")
    h_act = _entropy(ln_n - F.col("s_actual") / n, "k_actual")
    mi = _information(ln_n + (F.col("s_cell") - F.col("s_pred") - F.col("s_actual")) / n)
    mean_h = (h_pred + h_act) / 2
    tp, fp, fn = F.col("tp"), F.col("pp") - F.col("tp"), F.col("ap") - F.col("tp")
    tn = _pairs(n.cast("bigint")) - tp - fp - fn
    crosstab = agg.select(
        n.cast("bigint").alias("n"),
        h_pred.alias("h_pred"),
        h_act.alias("h_actual"),
        mi.alias("mi"),
        F.when(mean_h > 0, mi / mean_h).alias("nmi"),
        tp.alias("tp"),
        fp.cast("decimal(38,0)").alias("fp"),
        fn.cast("decimal(38,0)").alias("fn"),
        tn.cast("decimal(38,0)").alias("tn"),
    )
    return pair_prf(crosstab, keep=["n", "h_pred", "h_actual", "mi", "nmi"])
