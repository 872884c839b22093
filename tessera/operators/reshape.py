"""Reshaping: first n per class, tagged union, unpivot and pivot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_n_per_class(df: DataFrame, class_col: str, order_col: str, n: int) -> DataFrame:
    """The first ``n`` rows of every class by ``order_col`` (a sampling
    operator: the limit is the feature). Spark plans a per-partition group
    limit before the shuffle, so only n rows per class and partition move."""
    w = Window.partitionBy(class_col).orderBy(F.col(order_col).asc())
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= n).drop("_rn")


def tag_union(parts: dict[str, DataFrame], tag_col: str = "tag") -> DataFrame:
    """UNION ALL of several frames, each tagged with its name."""
    out = None
    for name, df in parts.items():
        tagged = df.withColumn(tag_col, F.lit(name))
        out = tagged if out is None else out.unionByName(tagged, allowMissingColumns=True)
    if out is None:
        raise ValueError("nothing to union")
    return out


def unpivot(df: DataFrame, ids: Sequence[str], values: Sequence[str], variable: str = "variable", value: str = "value") -> DataFrame:
    """Wide -> long: one row per (ids, variable)."""
    return df.unpivot(list(ids), list(values), variable, value)


def pivot(df: DataFrame, row_key: str, col_key: str, value: str, keys: Sequence | None = None) -> DataFrame:
    """Long -> wide with ``first(value)`` per cell. Passing ``keys`` avoids
    the extra job Spark runs to find the distinct column keys."""
    g = df.groupBy(row_key)
    g = g.pivot(col_key, list(keys)) if keys is not None else g.pivot(col_key)
    return g.agg(F.first(value))


def sequence_ids(
    df: DataFrame, key_col: str, order_cols: Sequence[str], bucket: Column, seq_col: str = "seq"
) -> DataFrame:
    """Number the rows of every key 1, 2, ... in ``order_cols`` order, the
    record number used to pivot a key/value log into records.

    ``bucket`` must grow with the order (e.g. the day of the first order
    column). Rows are numbered inside (key, bucket) windows and shifted by
    the row count of the key's earlier buckets, taken from a small table of
    per-bucket counts, so no key is ever sorted by one task."""
    b = df.withColumn("_bk", bucket)
    w = Window.partitionBy(key_col, "_bk").orderBy(*order_cols)
    numbered = b.withColumn("_rn", F.row_number().over(w))
    counts = b.groupBy(key_col, "_bk").agg(F.count(F.lit(1)).alias("_n"))
    cw = Window.partitionBy(key_col).orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(key_col).alias("_ok"), F.col("_bk").alias("_ob"), F.coalesce(F.sum("_n").over(cw), F.lit(0)).alias("_off")
    )
    same = F.col(key_col).eqNullSafe(F.col("_ok")) & F.col("_bk").eqNullSafe(F.col("_ob"))  # null keys count too
    return (
        numbered.join(offsets, same)
        .withColumn(seq_col, F.col("_off") + F.col("_rn"))
        .drop("_bk", "_rn", "_off", "_ok", "_ob")
    )
