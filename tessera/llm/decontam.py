"""Benchmark decontamination: SimHash of item-sized windows, a multi-index of
Hamming blocks, and exact weighted-shingle similarity.

1. *Windows.* Words are the lower-cased runs of letters and digits. A window is
   as long as a benchmark item. Only a window that shares a five-word shingle
   with an item can be similar to one, so windows are laid where a shared
   shingle puts them (shingle place in the text minus its place in the item);
   this leaves nothing out.
2. *SimHash.* Each window and each item gets a 64-bit fingerprint of its words,
   weighted by their lengths.
3. *Multi-index.* The bits are cut into ``radius + 1`` blocks. Two fingerprints
   within the radius agree in a whole block at least, so an equi-join on
   (size, block, value) finds all of them; pairs beyond the radius are dropped.
4. *Verification.* A pair is a match if its weighted Jaccard similarity over
   five-word shingles (multiset, weight: letters of the shingle) is 0.8 or
   more.

Items of one to four words have one shingle of all their words; items without
words match nothing. Null and empty texts have no windows. A document is a
distinct (id, text); repeated rows share their matches, repeated items are
matched each. All steps are DataFrame operations. The items' shingle hashes are
broadcast while there are at most ``max_broadcast`` of them (8 bytes each), else
they are joined by shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import document_key, settle, whole_row, written

SHINGLE = 5
RADIUS = 15
SIMILAR = 0.8
MAX_BROADCAST = 2_000_000
WORDS = r"[\p{L}\p{N}]+"
KEY = ["k_id", "k_tie"]


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORDS), F.lit(0))


def _shingle_hashes(w: Column, k: int) -> Column:
    """Hashes of the k-word shingles in order (none if there are fewer words)."""
    return F.when(
        F.size(w) >= k,
        F.transform(F.sequence(F.lit(1), F.size(w) - (k - 1)), lambda i: F.xxhash64(F.slice(w, i, F.lit(k)))),
    )


def _shingles(w: Column, k: Column) -> Column:
    """(h, weight) of the shingles of a window or an item."""
    return F.transform(
        F.sequence(F.lit(1), F.size(w) - k + 1),
        lambda i: F.transform(
            F.array(F.slice(w, i, k)),
            lambda s: F.struct(
                F.xxhash64(s).alias("h"), F.length(F.concat_ws("", s)).cast("long").alias("weight")
            ),
        )[0],
    )


def simhash(rows: DataFrame, keys: list[str], word: str = "word") -> DataFrame:
    """64-bit fingerprint ``fp`` of the words of each key, weighted by length."""
    h = F.xxhash64(F.col(word), F.lit("simhash"))
    votes = [
        F.sum(F.when(F.getbit(F.col("_h"), F.lit(b)) == 1, F.col("_w")).otherwise(-F.col("_w"))).alias(f"_{b}")
        for b in range(64)
    ]
    summed = rows.select(*keys, h.alias("_h"), F.length(word).alias("_w")).groupBy(*keys).agg(*votes)
    bits = F.lit(0).cast("long")
    for b in range(64):
        one = 1 << b if b < 63 else -(1 << 63)
        bits = bits.bitwiseOR(F.when(F.col(f"_{b}") > 0, F.lit(one).cast("long")).otherwise(F.lit(0).cast("long")))
    return summed.select(*keys, bits.alias("fp"))


def blocks(fp: Column, radius: int) -> Column:
    """Values of the radius + 1 blocks of a fingerprint."""
    edges = [round(i * 64 / (radius + 1)) for i in range(radius + 2)]
    return F.array(
        *[
            F.shiftrightunsigned(fp, lo).bitwiseAND(F.lit((1 << (hi - lo)) - 1 if hi - lo < 64 else -1).cast("long"))
            for lo, hi in zip(edges[:-1], edges[1:], strict=True)
        ]
    )


def _items(benchmark: DataFrame, id_col: str, text: str) -> DataFrame:
    return (
        benchmark.select(F.col(id_col).alias("item_id"), words(F.col(text)).alias("w"))
        .withColumn("n", F.size("w"))
        .where("n > 0")
        .withColumn("k", F.least(F.col("n"), F.lit(SHINGLE)))
    )


def matches(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    item_col: str = "item_id",
    item_text: str = "text",
    radius: int = RADIUS,
    similar: float = SIMILAR,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """(k_id, k_tie, item_id, similarity, start, n): the best window of each
    document for each item it contains."""
    items = written(_items(benchmark, item_col, item_text), "decontam-items")
    places = written(
        items.select("n", "k", F.posexplode(_shingles(F.col("w"), F.col("k"))).alias("at", "s"))
        .select("n", "k", "at", F.xxhash64("k", "s.h").alias("a"))
        .distinct(),
        "decontam-places",
    )
    sizes = sorted(r["k"] for r in items.select("k").distinct().collect())  # five values at most
    anchors = places.select("a").distinct()
    if anchors.count() <= max_broadcast:
        anchors = F.broadcast(anchors)
    keyed = docs.select(*document_key(id_col, text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    one_text = F.transform(
        F.array(words(F.col("text"))),
        lambda w: F.struct(
            F.size(w).alias("size"),
            F.array(*[F.struct(F.lit(k).alias("k"), _shingle_hashes(w, k).alias("hs")) for k in sizes]).alias("by_k"),
        ),
    )[0]
    if not sizes:
        empty = "k_id long, k_tie int, item_id long, similarity double, start int, n int"
        return docs.sparkSession.createDataFrame([], empty)
    hits = (
        keyed.select(*KEY, one_text.alias("t"))
        .select(*KEY, "t.size", F.explode("t.by_k").alias("b"))
        .select(*KEY, "size", "b.k", F.posexplode("b.hs").alias("pos", "h"))
        .select(*KEY, "size", "pos", F.xxhash64("k", "h").alias("a"))
        .join(anchors, "a", "left_semi")
    )
    start = F.greatest(F.least(F.col("pos") - F.col("at"), F.col("size") - F.col("n")), F.lit(0))
    laid = written(
        hits.join(places, "a")
        .select(*KEY, "n", start.alias("start"))
        .distinct()
        .groupBy(*KEY)
        .agg(F.collect_list(F.struct("n", "start")).alias("windows")),
        "decontam-laid",
    )
    settle(docs.sparkSession)
    wkey = [*KEY, "n", "start"]
    cut = F.transform(
        F.array(words(F.col("text"))),
        lambda w: F.transform(
            F.col("windows"),
            lambda x: F.struct(
                x["n"].alias("n"), x["start"].alias("start"), F.slice(w, x["start"] + 1, x["n"]).alias("w")
            ),
        ),
    )[0]
    windows = written(
        keyed.dropDuplicates(KEY).join(laid, KEY).select(*KEY, F.explode(cut).alias("c")).select(*KEY, "c.*"),
        "decontam-windows",
    )
    settle(docs.sparkSession)
    win_fp = simhash(windows.select(*wkey, F.explode("w").alias("word")), wkey)
    item_fp = simhash(items.select("item_id", "n", F.explode("w").alias("word")), ["item_id", "n"])
    left = win_fp.select(*wkey, "fp", F.posexplode(blocks(F.col("fp"), radius)).alias("block", "value"))
    right = item_fp.select(
        "item_id", F.col("n"), F.col("fp").alias("item_fp"),
        F.posexplode(blocks(F.col("fp"), radius)).alias("block", "value"),
    )
    near = (
        left.join(right, ["n", "block", "value"])
        .where(F.bit_count(F.col("fp").bitwiseXOR(F.col("item_fp"))) <= radius)
        .select(*wkey, "item_id")
        .distinct()
    )
    near = written(near, "decontam-near")
    k = F.least(F.col("n"), F.lit(SHINGLE))
    # A window cut short by the end of its text may have fewer words than a shingle.
    whole = F.size("w") >= k
    win_sh = (
        windows.where(whole).select(*wkey, F.explode(_shingles(F.col("w"), k)).alias("s"))
        .groupBy(*wkey, F.col("s.h").alias("h")).agg(F.sum("s.weight").alias("a"))
    )
    item_sh = (
        items.select("item_id", F.explode(_shingles(F.col("w"), F.col("k"))).alias("s"))
        .groupBy("item_id", F.col("s.h").alias("h")).agg(F.sum("s.weight").alias("b"))
    )
    win_all = win_sh.groupBy(*wkey).agg(F.sum("a").alias("all_a"))
    item_all = item_sh.groupBy("item_id").agg(F.sum("b").alias("all_b"))
    shared = (
        near.join(win_sh, wkey).join(item_sh, ["item_id", "h"])
        .groupBy(*wkey, "item_id").agg(F.sum(F.least("a", "b")).alias("both"))
    )
    sim = F.col("both") / (F.col("all_a") + F.col("all_b") - F.col("both"))
    return (
        shared.join(win_all, wkey)
        .join(item_all, "item_id")
        .withColumn("similarity", sim)
        .where(F.col("similarity") >= similar)
        .groupBy(*KEY, "item_id")
        .agg(F.min(F.struct(-F.col("similarity"), "start", "n")).alias("best"))
        .select(*KEY, "item_id", (-F.col("best.col1")).alias("similarity"), "best.start", "best.n")
    )


def decontaminate(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text: str = "text", **options
) -> DataFrame:
    """Rows of ``docs`` that contain no benchmark item."""
    found = written(matches(docs, benchmark, id_col, text, **options).select(*KEY).distinct(), "decontam-found")
    keyed = docs.select(whole_row(docs), *document_key(id_col, text))
    return keyed.join(found, KEY, "left_anti").select("row.*")
