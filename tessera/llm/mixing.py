"""Mixing sources to target weights: capped water-filling, then seeded whole
and fractional repetitions.

``water_fill`` shares a budget of words between sources by weight. A source
whose share is above ``max_epochs`` times its size is clamped there and the
rest is shared again by weight among the others, until none is above. The
shares have the form ``least(cap, level * weight)``, so a round is one
aggregate over the source table and the loop only moves the scalar ``level``.

``mix_plan`` turns a source's target into repetitions of its documents:
``floor(target / size)`` whole repetitions of all, and one more of the
documents that come first in a seeded hash order, as long as they fit into the
words still missing; the gap that is left goes to the one document whose size
is nearest to it, if that brings the source nearer to its target. The running
sum is taken over 1,024 hash ranges of a source and then inside each range, so
no task holds a whole source. Reruns and other partitionings give the same plan.

Null text, empty text and texts of white space only have size 0 (repetitions
of them take no words); null sources are one source of their own, sorted last;
ties of the hash are ordered by id and size; repeated rows are separate
documents; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import WORD, document_key, global_rank, whole_row, written

RANGES = 1024
_RANGE_SHIFT = 50  # of 60 hash bits, the top ten name the range


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def sample_hash(id_col: Column, seed: int) -> Column:
    text = F.concat(F.lit(f"mix|{seed}|"), F.coalesce(id_col.cast("string"), F.lit("")))
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def water_fill(
    sources: DataFrame, budget: float, max_epochs: float = 3, size: str = "size", weight: str = "weight"
) -> DataFrame:
    """Add ``target`` to a table of sources (one row each, with its size and
    its weight): shares of ``budget`` by weight, none above ``max_epochs``
    times its size. If all are clamped, the budget can't be met and every
    target is its cap."""
    cap, w = F.col(size) * F.lit(max_epochs), F.col(weight)
    level, clamped = 0.0, -1
    while True:
        above = cap < F.lit(level) * w
        r = sources.agg(
            F.count(F.when(above, 1)).alias("n"),
            F.coalesce(F.sum(F.when(above, cap)), F.lit(0)).alias("taken"),
            F.sum(F.when(~above, w)).alias("open"),
        ).first()
        if r["n"] == clamped:
            break
        clamped = r["n"]
        if not r["open"]:
            level = float("inf")
            break
        level = (budget - r["taken"]) / r["open"]
    share = F.lit(level) * w if level != float("inf") else cap
    return sources.withColumn("target", F.least(cap.cast("double"), share.cast("double")))


def ranked_weights(sizes: DataFrame, source: str = "source", cycle: int = 3) -> DataFrame:
    """Weights 1, 2, .., cycle, 1, .. by code point order of the source, null last."""
    ranked = global_rank(
        sizes, F.col(source).isNull(), F.col(source).asc_nulls_last(), name="_pos"
    )
    return ranked.withColumn("weight", F.col("_pos") % cycle + 1).drop("_pos")


def mix_plan(
    sized: DataFrame,
    id_col: str = "doc_id",
    source: str = "source",
    size: str = "size",
    max_epochs: int = 3,
    seed: int = 0,
) -> DataFrame:
    """``sized`` with columns source_size, target (of the row's source), reps
    (repetitions the mix takes) and taken (their words); other columns stay, and
    those of the same names are replaced."""
    sized = sized.drop("source_size", "target", "reps", "taken")
    base = sized.withColumn("_h", sample_hash(F.col(id_col), seed)).withColumn(
        "_range", F.shiftright("_h", _RANGE_SHIFT)
    )
    ranges = written(
        base.groupBy(F.col(source).alias("_source"), "_range").agg(F.sum(size).alias("_words")),
        "mix-ranges",
    )
    sources = ranges.groupBy("_source").agg(F.sum("_words").alias("source_size"))
    sources = written(ranked_weights(sources, "_source"), "mix-sources")
    budget = sources.agg(F.sum("source_size")).first()[0] or 0
    filled = water_fill(sources, budget, max_epochs, "source_size")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0)
    filled = filled.withColumn("_whole", F.floor(ratio)).withColumn(
        "_need", F.col("target") - F.col("_whole") * F.col("source_size")
    )
    before = (
        Window.partitionBy("_source").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    )
    ranges = ranges.withColumn("_start", F.coalesce(F.sum("_words").over(before), F.lit(0)))
    keyed = filled.drop("weight").withColumnRenamed("_source", "_fs")
    ranges = ranges.join(keyed, F.col("_source").eqNullSafe(F.col("_fs"))).drop("_fs", "_words")
    ranges = ranges.withColumnRenamed("_range", "_r")
    rows = base.join(
        ranges, F.col(source).eqNullSafe(F.col("_source")) & (F.col("_range") == F.col("_r"))
    ).drop("_source", "_r")
    inside = (
        Window.partitionBy(source, "_range")
        .orderBy("_h", id_col, size)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("_upto", F.col("_start") + F.sum(size).over(inside))
    rows = written(rows.withColumn("_in", F.col("_upto") <= F.col("_need")), "mix-rows")
    # What is still missing, and the document that fills it best.
    gap = rows.groupBy(F.col(source).alias("_gs")).agg(
        (F.max("_need") - F.coalesce(F.max(F.when(F.col("_in"), F.col("_upto"))), F.lit(0))).alias("_gap")
    )
    mine = F.struct(F.abs(F.col("_gap") - F.col(size)).alias("off"), "_h", F.col(id_col).alias("id"), F.col(size).alias("size"))
    best = (
        rows.where(~F.col("_in"))
        .join(gap, F.col(source).eqNullSafe(F.col("_gs")))
        .where(F.col(size) < 2 * F.col("_gap"))
        .groupBy("_gs")
        .agg(F.min(mine).alias("_best"))
    )
    best = written(
        best.select(F.col("_gs").alias("_bs"), F.col("_best._h").alias("_bh"), "_best.id", "_best.size"), "mix-last"
    )
    last = best.select("_bs", "_bh", F.col("id").alias("_bid"), F.col("size").alias("_bsize"))
    fills = (
        F.col(source).eqNullSafe(F.col("_bs")) & (F.col("_h") == F.col("_bh"))
        & F.col(id_col).eqNullSafe(F.col("_bid")) & (F.col(size) == F.col("_bsize"))
    )
    twin = Window.partitionBy(source, "_h", id_col, size).orderBy("_upto")
    chosen = F.col("_bh").isNotNull() & ~F.col("_in") & (F.row_number().over(twin) == 1)
    extra = (F.col("_in") | chosen).cast("long")
    return (
        rows.join(last, fills, "left")
        .withColumn("reps", (F.col("_whole") + extra).cast("long"))
        .withColumn("taken", F.col("reps") * F.col(size))
        .drop("_h", "_range", "_start", "_whole", "_need", "_upto", "_in", "_bs", "_bh", "_bid", "_bsize")
    )


def mix(docs: DataFrame, id_col: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mixed collection: every row as often as its plan says, with the
    columns of ``docs``."""
    keyed = docs.select(
        whole_row(docs), *document_key(id_col, text), F.col(f"`{source}`").alias("src"),
        word_count(F.col(f"`{text}`")).alias("size"),
    )
    same = ["k_id", "k_tie", "src"]
    plan = mix_plan(written(keyed.select(*same, "size"), "mix-sized"), "k_id", "src", "size")
    # Rows that repeat share out what the plan gives to all of them.
    plan = plan.groupBy(*same).agg(F.sum("reps").alias("reps"), F.count(F.lit(1)).alias("rows"))
    on = (
        (F.col("d.k_id") == F.col("p.k_id")) & (F.col("d.k_tie") == F.col("p.k_tie"))
        & F.col("d.src").eqNullSafe(F.col("p.src"))
    )
    place = F.row_number().over(Window.partitionBy("d.k_id", "d.k_tie", "d.src").orderBy(F.lit(0)))
    times = F.floor(F.col("reps") / F.col("rows")) + F.when(place <= F.col("reps") % F.col("rows"), 1).otherwise(0)
    return (
        keyed.drop("size").alias("d")
        .join(plan.alias("p"), on)
        .select("d.row", times.cast("int").alias("times"))
        .where("times > 0")
        .select("row", F.explode(F.sequence(F.lit(1), F.col("times"))))
        .select("row.*")
    )
