"""Document fingerprints: a threshold-scaled sketch of word shingles.

Every distinct five-word shingle is hashed (md5) and kept if its hash lies
below a fixed fraction (3/8) of the hash space; where none does, the smallest
hash is kept, so a text with a word never has an empty sketch. The sketch of a
union is the union of the sketches cut by the same rule, so sketches merge, and

    containment(A in B) ~ |below A and below B| / |below A|

over the hashes below the threshold holds also between texts of very unequal
length. A smallest hash above it tells texts apart and no more: it is in no
larger sketch, so it does not count. ``likeness`` is the containment of the one
with fewer hashes below in the other; where it has none, 1 if the sketches are
equal and else 0.

Words are taken unchanged. A text of one to four words has one shingle of all
its words; a text without words (null, empty, white space) has an empty
sketch, which is alike (1) only to another empty one. Equal texts have equal
fingerprints; repeated shingles count once.

``with_next`` pairs each document with the next one in descending id order
(null ids come last, ties by text hash and text; after the last the first).
Documents are dealt to id ranges cut at quantiles, so one shuffle moves each
text once, and sketches are made after it; the first document of a range is also
sent to the range above it.
The table of ranges that is broadcast has four rows for each shuffle partition.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import words_of, written

WORDS = 5
DIGITS = 16  # hex digits kept of a shingle's hash
BELOW = "6"  # hashes whose first hex digit is below: 3/8 of all


def sketch(text: Column) -> Column:
    """Sorted array of the kept hashes (16 hex digits each)."""
    # One lambda over the words, so that they are extracted once for a text.
    return F.transform(F.array(words_of(text)), _hashes)[0]


def _hashes(words: Column) -> Column:
    n = F.greatest(F.size(words) - F.lit(WORDS - 1), F.lit(1))
    shingle = F.transform(
        F.sequence(F.lit(1), n),
        lambda i: F.substring(F.md5(F.concat_ws(" ", F.slice(words, i, F.lit(WORDS)))), 1, DIGITS),
    )
    return F.when(F.size(words) == 0, F.array().cast("array<string>")).otherwise(
        F.transform(F.array(shingle), _kept)[0]
    )


def _kept(hashes: Column) -> Column:
    low = F.filter(hashes, lambda h: h < F.lit(BELOW))
    return F.array_sort(
        F.array_distinct(F.array_append(low, F.array_min(hashes)))
    )


def merge(a: Column, b: Column) -> Column:
    """Sketch of the union of two texts' shingles."""
    both = F.array_sort(F.array_union(a, b))
    return F.filter(both, lambda h, i: (h < F.lit(BELOW)) | (i == 0))


def _below(a: Column) -> Column:
    return F.filter(a, lambda h: h < F.lit(BELOW))


def _shared(a: Column, b: Column, of: Column) -> Column:
    """Share of ``of`` hashes below the threshold that two sketches have in common."""
    both = F.size(F.array_intersect(_below(a), _below(b)))
    return F.when(of == 0, (a == b).cast("double")).otherwise(both / of)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of a's shingles that are in b; empty in empty is 1."""
    return _shared(a, b, F.size(_below(a)))


def likeness(a: Column, b: Column) -> Column:
    """Containment of the sketch with fewer hashes below the threshold, 0 to 1."""
    return _shared(a, b, F.least(F.size(_below(a)), F.size(_below(b))))


def id_ranges(docs: DataFrame, id_col: str, n: int) -> list[int]:
    """At most n-1 ascending cut points that deal the ids to about equal ranges."""
    if n < 2:
        return []
    shares = [i / n for i in range(1, n)]
    cuts = docs.agg(F.percentile_approx(F.col(id_col), shares, max(10_000, 4 * n)).alias("c")).first()["c"]
    return sorted(set(cuts or []))


def _cuts_above(cuts: list[int], id_col: Column) -> Column:
    """How many cuts are above an id, in two steps of about sqrt(n) comparisons."""
    if not cuts:
        return F.lit(0)
    down = cuts[::-1]
    step = math.isqrt(len(down)) + 1
    every = F.array(*[F.lit(c) for c in down])
    coarse = F.size(F.filter(F.array(*[F.lit(c) for c in down[step - 1 :: step]]), lambda c: c > id_col))
    at = coarse * step
    return at + F.size(F.filter(F.slice(every, at + 1, F.lit(step)), lambda c: c > id_col))


def with_next(
    docs: DataFrame, id_col: str, columns: list[str], derived: dict[str, Column] | None = None, n: int | None = None
) -> DataFrame:
    """Add the ``derived`` columns, and ``next_<c>`` for each of them and of
    ``columns``: its value in the next document in descending id order.
    ``columns`` holds the text column too; ``n`` is the number of ranges."""
    spark = docs.sparkSession
    derived = derived or {}
    n = n or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    cuts = id_ranges(docs, id_col, n)
    # Own columns have more underscores in front than any of the table's.
    pad = "_" * (max(len(c) - len(c.lstrip("_")) for c in docs.columns) + 1)
    in_range, guest, following_row, top, above, nth = (pad + x for x in ("range", "guest", "next", "top", "above", "n"))
    # Ranges count down with the id; null ids are the last range.
    number = F.when(F.col(id_col).isNull(), len(cuts) + 1).otherwise(_cuts_above(cuts, F.col(id_col)))
    dealt = docs.withColumn(in_range, number)
    tops = written(dealt.groupBy(in_range).agg(F.max(id_col).alias(top)), "sketch-ranges")
    ring = Window.orderBy(in_range)  # one row per range
    last = F.max(in_range).over(Window.partitionBy())
    tops = tops.select(
        F.col(in_range).alias(f"{pad}r"), top, F.coalesce(F.lag(in_range).over(ring), last).alias(above)
    )
    # The first document of each range also ends the range above it.
    first = Window.partitionBy(f"{pad}r").orderBy(*[F.col(c) for c in columns])
    heads = (
        dealt.join(F.broadcast(tops), (F.col(in_range) == F.col(f"{pad}r")) & F.col(id_col).eqNullSafe(F.col(top)))
        .withColumn(nth, F.row_number().over(first))
        .where(F.col(nth) == 1)
        .withColumn(in_range, F.col(above))
        .withColumn(guest, F.lit(True))
        .drop(f"{pad}r", top, above, nth)
    )
    both = dealt.withColumn(guest, F.lit(False)).unionByName(heads)
    both = both.repartition(in_range).withColumns(derived)  # derived after the shuffle
    every = [*columns, *derived]
    inside = Window.partitionBy(in_range).orderBy(
        guest, F.col(id_col).desc_nulls_last(), *[F.col(c) for c in columns]
    )
    following = both.withColumn(following_row, F.lead(F.struct(*every)).over(inside)).where(~F.col(guest))
    return following.select(
        *docs.columns, *derived, *[F.col(f"{following_row}.{c}").alias(f"next_{c}") for c in every]
    )
