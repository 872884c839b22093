"""Filter interaction audit: what each filter of a chain removes, in every order.

The filters are judged once per document. A document's failures are a mask, and
all that follows depends on the mask alone, so the documents are counted per
(part, mask) before anything else; no document row is repeated per order.

*Removal steps.* The mask matrix has a row per mask and a column per filter: 0
where the mask fails the filter, infinity elsewhere. The position matrix has a
column per order: the step at which each filter runs, the inverse of the order's
permutation. Their min-plus product (sums combined by minimum) is the step at
which a document with the mask is removed in the order; infinity: kept.

*Scatter.* Each (mask, order) adds its weight to the counts of its removal step;
at later steps it is redundant wherever its mask fails the step's filter. The
product of masks, orders and steps is a fixed table (32 x 120 x 5 for five
filters), joined to the counted masks; its size depends on the filters only.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import words_of, written

# The failure conditions of the five filters, by letter. E (copies)
# needs the other documents and is judged by a join.
MIN_WORDS = 200
MIN_DISTINCT = 50
MAX_CAPITALS = 3
SYMBOLS = r"[#$%&*|]"
FILTERS = "ABCDE"
#: Bounds the table of masks, orders and steps (19,200 rows for five filters,
#: 276,480 for six), which is sent whole to every task.
MAX_FILTERS = 6


def min_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Min-plus product: out[i, j] = min over k of a[i, k] + b[k, j]."""
    return (a[:, :, None] + b[None, :, :]).min(axis=1)


def removal_steps(n_filters: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of the filters, and the (mask, order) matrix of the step at
    which a document is removed (``n_filters`` + 1: kept)."""
    orders = list(permutations(range(n_filters)))
    masks = np.arange(2**n_filters)[:, None] >> np.arange(n_filters) & 1
    cost = np.where(masks == 1, 0.0, np.inf)
    place = np.argsort(np.array(orders), axis=1).T + 1.0  # inverse permutations
    steps = min_plus(cost, place)
    return orders, np.where(np.isinf(steps), n_filters + 1, steps).astype(int)


def effects(spark, filters: str = FILTERS) -> DataFrame:
    """(mask, filter_order, step, filter, removed_here, kept_here, redundant_here,
    unique_here) with flags of 0 and 1, for every mask, order and step."""
    if not 1 <= len(filters) <= MAX_FILTERS:
        raise ValueError(f"1 to {MAX_FILTERS} filters")
    orders, steps = removal_steps(len(filters))
    names = ["".join(filters[f] for f in o) for o in orders]
    rows = [(m, names[j], j, int(steps[m, j])) for m in range(len(steps)) for j in range(len(orders))]
    table = spark.createDataFrame(rows, "mask int, filter_order string, j int, gone int")
    step = F.explode(F.sequence(F.lit(1), F.lit(len(filters)))).alias("step")
    table = table.select("mask", "filter_order", "gone", step)
    at = F.expr("substring(filter_order, step, 1)")
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(len(filters))]), F.instr(F.lit(filters), at))
    fails = F.col("mask").bitwiseAND(bit) != 0
    return table.select(
        "mask", "filter_order", "step", at.alias("filter"),
        (F.col("gone") == F.col("step")).cast("long").alias("removed_here"),
        (F.col("gone") > F.col("step")).cast("long").alias("kept_here"),
        (fails & (F.col("gone") < F.col("step"))).cast("long").alias("redundant_here"),
        (F.col("mask") == bit).cast("long").alias("unique_here"),
    )


def audit(judged: DataFrame, filters: str = FILTERS) -> DataFrame:
    """Counts of every (part, order, step) from ``judged(part, mask, good,
    toxic)``: bit i of ``mask`` is set where filter i fails, ``good`` and
    ``toxic`` are 0 or 1. Returns part, filter_order, step, kept, removed,
    redundant, unique_fails, good_lost, toxic_lost, shapley; every part of
    ``judged`` has all orders and steps. No rows give no rows."""
    spark = judged.sparkSession
    counted = judged.groupBy("part", "mask").agg(
        F.count(F.lit(1)).alias("n"), F.sum("good").alias("good"), F.sum("toxic").alias("toxic")
    )
    laid = counted.join(F.broadcast(effects(spark, filters)), "mask")
    weigh = lambda flag, weight="n": F.sum(F.col(flag) * F.col(weight))
    steps = laid.groupBy("part", "filter_order", "step", "filter").agg(
        weigh("kept_here").alias("kept"),
        weigh("removed_here").alias("removed"),
        weigh("redundant_here").alias("redundant"),
        weigh("unique_here").alias("unique_fails"),
        weigh("removed_here", "good").alias("good_lost"),
        weigh("removed_here", "toxic").alias("toxic_lost"),
    )
    steps = written(steps, "audit-steps")
    shapley = steps.groupBy("part", "filter").agg(F.sum("removed").alias("shapley"))
    return steps.join(shapley, ["part", "filter"]).select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley",
    )


def text_failures(text: Column) -> Column:
    """Mask of the filters A to D on a text (null: empty)."""
    text = F.coalesce(text, F.lit(""))
    words = words_of(text)
    n, distinct = F.size(words).cast("long"), F.size(F.array_distinct(words)).cast("long")
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", "")).cast("long")
    conditions = [
        n < MIN_WORDS,
        F.lit(100) * distinct < F.lit(MIN_DISTINCT) * n,
        F.lit(100) * capitals > F.lit(MAX_CAPITALS) * F.length(text).cast("long"),
        text.rlike(SYMBOLS),
    ]
    mask = F.lit(0)
    for i, c in enumerate(conditions):
        mask = mask + c.cast("int") * (1 << i)
    return mask


def judge(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", part: str = "lang"
) -> DataFrame:
    """(part, mask, good, toxic) of every row of ``docs``.

    E fails where an equal text (by SHA-256) has a smaller id anywhere in the
    table. The least id of each text is joined back on (text, id), a key that no
    group of copies makes hot; the rows it does not meet have a smaller copy.
    Repeated rows have equal ids and so are no copies of each other. A null id is
    smaller than none and has none smaller: it never fails E. Null part: the
    empty string. Of several label rows of an id, one that says so is enough;
    a null label, or none, is neither good nor toxic."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{part}`").cast("string"), F.lit("")).alias("part"),
        F.unhex(F.sha2(F.coalesce(F.col(f"`{text}`"), F.lit("")), 256)).alias("digest"),
        text_failures(F.col(f"`{text}`")).alias("mask"),
    )
    rows = written(rows, "audit-rows")
    first = rows.where("id is not null").groupBy("digest").agg(F.min("id").alias("id")).withColumn("first", F.lit(1))
    flags = labels.where(f"`{id_col}` is not null").groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(
        F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")
    )
    copy = F.col("id").isNotNull() & F.col("first").isNull()
    bit = 1 << FILTERS.index("E")
    return (
        rows.join(first, ["digest", "id"], "left")
        .join(flags, "id", "left")
        .select(
            "part",
            (F.col("mask") + copy.cast("int") * bit).alias("mask"),
            F.coalesce("good", F.lit(0)).alias("good"),
            F.coalesce("toxic", F.lit(0)).alias("toxic"),
        )
    )
