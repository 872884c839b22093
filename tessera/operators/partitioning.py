"""Partitioning helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def dense_index(df: DataFrame, *order, name: str = "pos") -> DataFrame:
    """Add ``name``: the position 0, 1, ... of every row in a total order,
    without one task for all: ranges of the order, a position inside each, and
    the number of rows in the ranges before (one row per range)."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = cut_lineage(df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return (
        ranged.withColumn("_in", inside)
        .join(base, "_part")
        .withColumn(name, F.col("_base") + F.col("_in"))
        .drop("_part", "_in", "_base")
    )


def fan_out(df: DataFrame, key: str) -> DataFrame:
    """Hash-spread a table keyed by ``key`` before a fan-out join (a
    frontier times edges, candidate pairs times tokens). AQE packs small
    shuffle outputs into one or two partitions, which would leave the whole
    expansion to one task; an explicit count on the join key is kept by AQE.
    The count follows the cluster's cores (two tasks per core), not the
    shuffle-partition setting, so small inputs do not pay for hundreds of
    empty tasks per superstep while a large cluster still gets thousands."""
    n = max(df.sparkSession.sparkContext.defaultParallelism * 2, 2)
    return df.repartition(n, key)


# Counters of the frequency sketch: keys are counted by the hash class they fall
# into, so a counter is never below the number of rows of any of its keys.
COUNTERS = 1 << 16
# Rows that a task of a join may take of one key whatever the size of the table.
FEW_ROWS = 1 << 13


def hot_classes(large: DataFrame, on: list[str], parts: int | None = None, few_rows: int = FEW_ROWS) -> DataFrame:
    """(_class, _n): the hash classes of keys that hold more rows than a task's
    share of ``large`` (its rows over ``parts``, else the shuffle partitions, and
    ``few_rows`` at least), and the number of shares in them. One pass and one
    exchange of at most ``COUNTERS`` counters a task, which merge by addition;
    at most ``parts`` rows, as each holds a share."""
    parts = parts or int(large.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    counts = large.groupBy(_class(on).alias("_class")).agg(F.count(F.lit(1)).alias("_rows"))
    # A window over at most COUNTERS rows.
    share = F.greatest(F.lit(few_rows), F.ceil(F.sum("_rows").over(Window.partitionBy()) / F.lit(parts)))
    met = counts.withColumn("_share", share)
    return met.where(F.col("_rows") > F.col("_share")).select("_class", F.ceil(F.col("_rows") / F.col("_share")).cast("int").alias("_n"))


def _class(on: list[str]):
    return F.pmod(F.xxhash64(*on), F.lit(COUNTERS)).cast("int")


def split_join(
    small: DataFrame, large: DataFrame, on: list[str], large_id: str, parts: int | None = None, few_rows: int = FEW_ROWS
) -> DataFrame:
    """Inner equi-join on ``on`` whose hot keys are split by their size: the rows
    of ``large`` under a key in a hot class (``hot_classes``) get one of its n
    salts by their id, and the rows of ``small`` under it are repeated n times;
    all other rows join as they are. A key in every row of ``large`` takes as many
    tasks as it has shares. The joined rows are those of the plain join."""
    hot = hot_classes(large, on, parts, few_rows)
    n = F.coalesce("_n", F.lit(1))
    s = small.withColumn("_class", _class(on)).join(F.broadcast(hot), "_class", "left")
    s = s.withColumn("_salt", F.explode(F.sequence(F.lit(0), n - 1))).drop("_class", "_n")
    lg = large.withColumn("_class", _class(on)).join(F.broadcast(hot), "_class", "left")
    lg = lg.withColumn("_salt", F.pmod(F.xxhash64(F.col(large_id)), n).cast("int")).drop("_class", "_n")
    return s.join(lg, [*on, "_salt"]).drop("_salt")


def salted_join(
    small: DataFrame, large: DataFrame, on: list[str], large_id: str, salts: int
) -> DataFrame:
    """Inner equi-join on ``on`` that splits every key ``salts`` ways: each
    row of ``large`` gets one salt from a hash of its ``large_id`` column,
    each row of ``small`` is replicated once per salt. A key holding a third
    of ``large`` is then spread over ``salts`` tasks; the joined rows are
    exactly those of the plain join (each pair meets under one salt)."""
    if salts <= 1:
        return small.join(large, on)
    s = small.select("*", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    lg = large.withColumn("_salt", F.pmod(F.xxhash64(F.col(large_id)), F.lit(salts)).cast("int"))
    return s.join(lg, [*on, "_salt"]).drop("_salt")


def meet(small: DataFrame, large: DataFrame, on: list[str], large_id: str, salts: int | None) -> DataFrame:
    """``salted_join`` with a given number of salts, else ``split_join``."""
    return split_join(small, large, on, large_id) if salts is None else salted_join(small, large, on, large_id, salts)
