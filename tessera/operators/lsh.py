"""Random-hyperplane LSH over token bags.

A hyperplane assigns every token a sign; plane ``i`` of band ``b`` takes bit
``i`` of ``md5("seed|b|token")`` (bits 0-31 from the first 8 hex digits,
32-63 from the next 8): set = +1, clear = -1. A vector's projection is
sum(count * sign) and its signature bit ``i`` is set when the projection is
strictly positive. Signatures are two 32-bit halves ``sig_lo`` / ``sig_hi``.

Plan: the projection is summed over token *occurrences* straight from the
text rows, in arrays inside the task (``planes``: a token of a batch is hashed
once), then over rows of the same id. A document is one input row, so the
shuffle moves one row per (doc, band), not the bag. Buckets are never
materialised as lists: a bucket probe is an equi-join on
(band, sig_lo, sig_hi), whose skewed keys AQE splits at run time.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.hashing import h60
from tessera.functions.text import tokens
from tessera.operators.partitioning import dense_index, meet
from tessera.operators.blocks import bucket_cosines, masked_cosines, vectors, vocabulary
from tessera.operators.classify import majority_vote
from tessera.operators.graph.core import Loop
from tessera.operators.planes import projections
from tessera.operators.similarity import arc, candidate_distance

MAX_PLANES = 64


def _check(planes: int, bands: int) -> None:
    if not 0 <= planes <= MAX_PLANES:
        raise ValueError("planes must be in 0..64")
    if bands < 1:
        raise ValueError("bands must be >= 1")


def _bit(lo: Column, hi: Column, i: int) -> Column:
    word, j = (lo, i) if i < 32 else (hi, i - 32)
    return F.shiftright(word, j).bitwiseAND(F.lit(1))


def _sig_half(proj_cols: Sequence[str], lo_plane: int, hi_plane: int) -> Column:
    terms = [
        F.when(F.col(proj_cols[i]) > 0, F.lit(1 << (i - lo_plane))).otherwise(F.lit(0)).cast("bigint")
        for i in range(lo_plane, min(hi_plane, len(proj_cols)))
    ]
    if not terms:
        return F.lit(0).cast("bigint")
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def lsh_signature(
    docs: DataFrame,
    planes: int = 16,
    bands: int = 4,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """(doc_id, band, sig_lo, sig_hi) for every document with a token;
    exactly ``bands`` independent tables of ``planes`` planes each."""
    _check(planes, bands)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.filter(tokens(F.col(text_col)), lambda t: t != "").alias("tokens"))
    if planes == 0:  # one bucket per band: every non-empty vector collides
        some = rows.where(F.size("tokens") > 0).select("doc_id").distinct()
        return some.select(
            "doc_id", F.explode(F.sequence(F.lit(0), F.lit(bands - 1))).alias("band"),
            F.lit(0).cast("bigint").alias("sig_lo"), F.lit(0).cast("bigint").alias("sig_hi"),
        )
    sums = T.StructType(
        [rows.schema["doc_id"], T.StructField("band", T.IntegerType())]
        + [T.StructField(f"p{i}", T.LongType()) for i in range(planes)]
    )
    proj = rows.mapInArrow(projections(planes, bands, seed), sums).groupBy("doc_id", "band")
    proj = proj.agg(*[F.sum(f"p{i}").alias(f"p{i}") for i in range(planes)])
    names = [f"p{i}" for i in range(planes)]
    return proj.select(
        "doc_id", "band", _sig_half(names, 0, 32).alias("sig_lo"), _sig_half(names, 32, 64).alias("sig_hi")
    )


def mask_signature(sig: DataFrame, n: int) -> DataFrame:
    """Keep the first ``n`` planes of a signature (a table of fewer planes)."""
    lo_mask = (1 << min(n, 32)) - 1
    hi_mask = (1 << max(n - 32, 0)) - 1
    return sig.withColumn("sig_lo", F.col("sig_lo").bitwiseAND(F.lit(lo_mask))).withColumn(
        "sig_hi", F.col("sig_hi").bitwiseAND(F.lit(hi_mask))
    )


def lsh_candidates(
    query_sig: DataFrame,
    model_sig: DataFrame,
    keys: Sequence[str] = (),
    salts: int | None = None,
    bands: int | None = None,
    kept: Sequence[str] = (),
) -> DataFrame:
    """(keys..., q_id, m_id, kept..., hits): model vectors sharing a bucket with the
    query in ``hits`` bands (a hit in several bands counts several times).
    The bucket join splits hot buckets by their size: near-duplicate documents or few planes make
    crowded buckets, and every candidate is kept (no cap).

    With the number of ``bands`` of the signatures, a document carries its
    buckets of all bands: a pair is made in the first band where it meets and
    its hits are counted there, so pairs are neither exchanged nor grouped.
    ``kept`` are columns of the model side, a row each for those of a vector."""
    on = [*keys, "band", "sig_lo", "sig_hi"]
    if bands is None:
        q = query_sig.select(*on, F.col("doc_id").alias("q_id"))
        m = model_sig.select(*on, *kept, F.col("doc_id").alias("m_id"))
        return meet(q, m, on, "m_id", salts).groupBy(*keys, "q_id", "m_id", *kept).agg(F.count(F.lit(1)).alias("hits"))
    if bands == 1:
        q = query_sig.select(*on, F.col("doc_id").alias("q_id"))
        m = model_sig.select(*on, *kept, F.col("doc_id").alias("m_id"))
        return meet(q, m, on, "m_id", salts).select(*keys, "q_id", "m_id", *kept, F.lit(1).cast("bigint").alias("hits"))

    def side(sig: DataFrame, name: str, extra: Sequence[str] = ()) -> DataFrame:
        at = [F.max(F.when(F.col("band") == i, F.struct("sig_lo", "sig_hi"))).alias(f"{name}{i}") for i in range(bands)]
        rows = sig.groupBy(*keys, F.col("doc_id").alias(f"{name}_id")).agg(*at)
        if extra:
            rows = rows.join(sig.select(*keys, F.col("doc_id").alias(f"{name}_id"), *extra).distinct(), [*keys, f"{name}_id"])
        every = F.array(*[F.struct(F.lit(i).alias("band"), F.col(f"{name}{i}.sig_lo"), F.col(f"{name}{i}.sig_hi")) for i in range(bands)])
        cols = [*keys, f"{name}_id", *extra, *[f"{name}{i}" for i in range(bands)]]
        return rows.select(*cols, F.explode(every).alias("b")).select(*cols, "b.band", "b.sig_lo", "b.sig_hi").where("sig_lo IS NOT NULL")

    same = [F.coalesce(F.col(f"q{i}") == F.col(f"m{i}"), F.lit(False)) for i in range(bands)]
    earlier = [same[i] & (F.col("band") > i) for i in range(bands - 1)]
    hits = functools.reduce(lambda x, y: x + y, [c.cast("bigint") for c in same])
    met = meet(side(query_sig, "q"), side(model_sig, "m", kept), on, "m_id", salts)
    return met.where(~functools.reduce(lambda x, y: x | y, earlier)).select(*keys, "q_id", "m_id", *kept, hits.alias("hits"))


def nearest_candidates(
    query_sig: DataFrame,
    model_sig: DataFrame,
    query_bag: DataFrame,
    model_bag: DataFrame,
    keys: Sequence[str] = (),
    id_col: str = "doc_id",
) -> DataFrame:
    """(keys..., q_id, m_id, distance): of the candidates of every query, the
    nearest of each bucket (of equally near ones the least id; others that near
    may come too). A vector travels once for every band, and again for every
    further cell of a crowded bucket; candidates are scored where they meet,
    all of them, and no row per candidate leaves the task."""
    vocab = vocabulary(query_bag, model_bag)
    found = bucket_cosines(
        query_sig, model_sig, vectors(query_bag, id_col, vocab, "q_id"), vectors(model_bag, id_col, vocab, "m_id"),
        [*keys, "band", "sig_lo", "sig_hi"], list(keys),
    )
    return found.select(*keys, "q_id", "m_id", arc(F.col("cos")).alias("distance"))


def bucket_sizes(model_sig: DataFrame) -> DataFrame:
    """(band, sig_lo, sig_hi, size): to inspect bucket skew."""
    return model_sig.groupBy("band", "sig_lo", "sig_hi").agg(F.count(F.lit(1)).alias("size"))


def lsh_vote(candidates: DataFrame, model_labels: DataFrame | None) -> DataFrame:
    """(q_id, predicted, votes): majority over all bucket hits with
    multiplicity, no distances; a tie gives null. Without ``model_labels``
    the candidates have their ``label``."""
    return majority_vote(candidates, model_labels, weight_col="hits")


def fallback_pool(model_ids: DataFrame, seed: int = 0) -> DataFrame:
    """(pos, m_id): all model ids in seeded hash order, numbered 0.. for
    seeded picks."""
    keyed = model_ids.select("m_id", h60(F.col("m_id"), "pool", seed).alias("hk"))
    return dense_index(keyed, "hk", "m_id").select("pos", "m_id")


def lsh_nearest(
    query_bag: DataFrame,
    model_bag: DataFrame,
    query_sig: DataFrame,
    model_sig: DataFrame,
    keys: Sequence[str] = (),
    seed: int = 0,
    best: DataFrame | None = None,
) -> DataFrame:
    """(keys..., q_id, distance, fallback): the smallest distance to a model
    vector in the query's buckets; when the buckets are empty, the distance
    to one vector of the whole model, picked by a seeded hash of the query id.

    Distances come from scoring the candidates inside their buckets
    (``nearest_candidates``); ``best`` (keys..., q_id, distance) has them for the
    queries with candidates if they are known."""
    if best is None:
        scored = nearest_candidates(query_sig, model_sig, query_bag, model_bag, keys)
        best = scored.groupBy(*keys, "q_id").agg(F.min("distance").alias("distance"))
    # every (keys, q_id) with a signature, i.e. every non-empty query
    qk = query_sig.select(*keys, F.col("doc_id").alias("q_id")).distinct()
    missing = qk.join(best, [*keys, "q_id"], "left_anti")
    pool = fallback_pool(model_sig.select(F.col("doc_id").alias("m_id")).distinct(), seed)
    n_pool = pool.count()
    if n_pool == 0:
        return best.withColumn("fallback", F.lit(False))
    picks = missing.withColumn("pos", F.pmod(h60(F.col("q_id"), "pick", seed), F.lit(n_pool))).join(
        pool, "pos"
    )
    # Only the bags of picked vectors are looked into.
    picked = model_bag.join(picks.select(F.col("m_id").alias("doc_id")).distinct(), "doc_id", "left_semi")
    fb = candidate_distance(picks.select("q_id", "m_id").distinct(), query_bag, picked)
    fb_rows = picks.join(fb, ["q_id", "m_id"]).select(*keys, "q_id", "distance")
    return best.withColumn("fallback", F.lit(False)).unionByName(fb_rows.withColumn("fallback", F.lit(True)))


def lsh_classify(
    candidates: DataFrame, query_bag: DataFrame, model_bag: DataFrame, model_labels: DataFrame
) -> DataFrame:
    """(q_id, m_id, distance, predicted): label of the nearest candidate over
    all bands (ties by model id); no candidate -> no row. Candidates that come
    with their ``distance`` (``nearest_candidates``) are not scored again."""
    dist = candidates if "distance" in candidates.columns else candidate_distance(candidates.select("q_id", "m_id"), query_bag, model_bag)
    return (
        dist.where(F.col("distance").isNotNull()).join(model_labels, "m_id")
        .groupBy("q_id")
        .agg(F.min_by(F.struct("m_id", "distance", "label"), F.struct("distance", "m_id")).alias("b"))
        .select("q_id", F.col("b.m_id").alias("m_id"), F.col("b.distance").alias("distance"), F.col("b.label").alias("predicted"))
    )


def plane_sweep(
    query_docs: DataFrame,
    model_docs: DataFrame,
    query_bag: DataFrame,
    model_bag: DataFrame,
    plane_counts: Sequence[int] = (1, 2, 4, 8, 16, 32, 64),
    seed: int = 0,
) -> DataFrame:
    """(num_hyperplanes, queries, mean_abs_err, fallbacks): mean |approx -
    exact| nearest distance of every query, for each plane count, in one job:
    64 planes are hashed once and masked to the first n. Blocks of queries meet
    blocks of the model; a product gives the nearest of all vectors and of those
    in the bucket for each plane count, so no table has a row per pair."""
    top = max(plane_counts)
    owner = Loop()
    # The signatures feed several jobs (products, pool, queries without candidates).
    qs = owner.keep(lsh_signature(query_docs, top, 1, seed))
    ms = owner.keep(lsh_signature(model_docs, top, 1, seed))
    n = F.col("num_hyperplanes")
    qk = qs.select(F.explode(F.array(*[F.lit(c) for c in plane_counts])).alias("num_hyperplanes"), "doc_id", "band")
    vocab = vocabulary(query_bag, model_bag)
    sig = F.col("sig_lo").bitwiseOR(F.shiftleft("sig_hi", 32)).alias("sig")
    q, m = (
        vectors(bag, "doc_id", vocab, name).join(sigs.select(F.col("doc_id").alias(name), sig), name)
        for bag, sigs, name in ((query_bag, qs, "q_id"), (model_bag, ms, "m_id"))
    )
    # A mask of no plane is the exact search.
    masks = [0, *((1 << c) - 1 for c in plane_counts)]
    met = masked_cosines(q, m, masks).groupBy("mask", "q_id").agg(arc(F.max("cos")).alias("distance"))
    met = owner.keep(met)
    count = F.element_at(F.array(*[F.lit(c) for c in (0, *plane_counts)]), F.col("mask") + 1).alias("num_hyperplanes")
    best = met.where("mask > 0").select(count, "q_id", "distance")
    exact = met.where("mask = 0").select("q_id", F.col("distance").alias("exact"))
    approx = lsh_nearest(query_bag, model_bag, qk, ms, keys=["num_hyperplanes"], seed=seed, best=best)
    out = (
        approx.join(exact, "q_id")
        .groupBy(n)
        .agg(
            F.count(F.lit(1)).alias("queries"),
            F.avg(F.abs(F.col("distance") - F.col("exact"))).alias("mean_abs_err"),
            F.count_if(F.col("fallback")).alias("fallbacks"),
        )
    )
    return owner.finish(out)
