"""Centrality measures as iterative DataFrame jobs.

Every superstep is a join of the (persisted, src-partitioned) edge table
with the current vertex state followed by a ``groupBy`` on the receiving
vertex; partial aggregation absorbs hub skew. State is persisted, cut by a
reliable checkpoint every few steps, and the previous state unpersisted.

All-sources measures (closeness, betweenness) go through the vertices in
batches, and only one sum per vertex outlives a batch. No table has a row per
(source, vertex) pair of the whole graph. Where a task can hold the arcs it goes
through whole batches (``searches``); above that the values of a batch stand side
by side in the rows of a vertex, and every level is a superstep.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.hashing import h60
from tessera.operators.graph import searches
from tessera.operators.partitioning import dense_index, fan_out
from tessera.operators.graph.core import (
    Loop,
    in_degree,
    laid_out,
    out_degree,
    simple_edges,
    top_n,
    vertices_of,
)
from tessera.session import cut_lineage


def _spread(df: DataFrame, key: str = "s") -> DataFrame:
    return fan_out(df, key)


def _ids(vertices: DataFrame | None, edges: DataFrame) -> DataFrame:
    return vertices.select("id") if vertices is not None else vertices_of(edges)


# ---- PageRank ----------------------------------------------------------------


def pagerank(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    reset: float = 0.15,
    max_iter: int = 20,
    tol: float | None = None,
    checkpoint_every: int = 3,
    dangling: str = "keep",
) -> DataFrame:
    """(id, rank), unnormalised: rank' = reset + (1 - reset) * sum over
    in-edges of rank(src) / outdeg(src), starting from 1.0. With
    ``dangling="keep"`` the rank held by vertices without out-edges is not
    redistributed; ``"spread"`` hands it to every vertex evenly (one scalar
    per superstep), so the ranks keep summing to n. With ``tol`` the loop
    stops once the largest change is at most ``tol`` (one scalar action per
    superstep; an error if ``max_iter`` supersteps don't get there); else it
    runs ``max_iter`` supersteps."""
    if dangling not in ("keep", "spread"):
        raise ValueError("dangling must be 'keep' or 'spread'")
    loop = Loop(checkpoint_every)
    with laid_out(edges) as parts:
        w = loop.keep(_shares(edges).repartition(parts, "src"), now=True)
        v = _ids(vertices, edges).select("id", F.lit(1.0).alias("rank"), F.lit(1.0).alias("was"))
        ranks = loop.keep(v.repartition(parts, "id"), now=True)
        sinks = None
        if dangling == "spread":
            n = ranks.count()
            sinks = loop.keep(ranks.select("id").join(w.select(F.col("src").alias("id")).distinct(), "id", "left_anti"))
        for _ in range(max_iter):
            extra = 0.0
            if sinks is not None:
                mass = ranks.join(sinks, "id").agg(F.sum("rank")).first()[0] or 0.0
                extra = mass / n
            ranks = loop.step(_rank_step(ranks, w, reset, extra), partition_by=(parts, "id"))
            if tol is not None:
                delta = ranks.agg(F.max(F.abs(F.col("rank") - F.col("was")))).first()[0]
                if delta is None or delta <= tol:
                    break
        else:
            if tol is not None:
                loop.release()
                raise RuntimeError(f"PageRank did not reach tol={tol} in {max_iter} supersteps")
        return loop.finish(ranks.select("id", "rank"))


def pageranks(
    edges: DataFrame, vertices: DataFrame | None, resets: Sequence[float], max_iter: int = 20, checkpoint_every: int = 3
) -> DataFrame:
    """(id, rank0, rank1, ...): ``pagerank`` after ``max_iter`` supersteps for
    each of ``resets``, side by side, so a superstep moves them all at once."""
    loop = Loop(checkpoint_every)
    cols = [f"rank{i}" for i in range(len(resets))]
    with laid_out(edges) as parts:
        w = loop.keep(_shares(edges).repartition(parts, "src"), now=True)
        v = _ids(vertices, edges).select("id", *[F.lit(1.0).alias(c) for c in cols])
        ranks = loop.keep(v.repartition(parts, "id"), now=True)
        for _ in range(max_iter):
            sent = w.join(ranks.withColumnRenamed("id", "src"), "src").groupBy(F.col("dst").alias("id"))
            sums = sent.agg(*[F.sum(F.col(c) * F.col("w")).alias(f"s_{c}") for c in cols])
            new = [
                (F.lit(r) + F.lit(1.0 - r) * F.coalesce(F.col(f"s_{c}"), F.lit(0.0))).alias(c) for r, c in zip(resets, cols)
            ]
            ranks = loop.step(ranks.join(sums, "id", "left").select("id", *new), partition_by=(parts, "id"))
        return loop.finish(ranks)


def _shares(edges: DataFrame) -> DataFrame:
    """(src, dst, w): the part of a vertex's rank that an edge carries."""
    return edges.join(out_degree(edges).withColumnRenamed("id", "src"), "src").select(
        "src", "dst", (F.lit(1.0) / F.col("out_degree")).alias("w")
    )


def _rank_step(ranks: DataFrame, w: DataFrame, reset: float, extra: float) -> DataFrame:
    """(id, rank, was) after one superstep; one exchange, of the summed shares."""
    shares = (
        w.join(ranks.select(F.col("id").alias("src"), "rank"), "src")
        .groupBy(F.col("dst").alias("id"))
        .agg(F.sum(F.col("rank") * F.col("w")).alias("s"))
    )
    new = F.lit(reset) + F.lit(1.0 - reset) * (F.coalesce(F.col("s"), F.lit(0.0)) + F.lit(extra))
    return ranks.join(shares, "id", "left").select("id", new.alias("rank"), F.col("rank").alias("was"))


# ---- HITS ----------------------------------------------------------------------


def hits(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    max_iter: int = 1000,
    tol: float | None = 1e-6,
    checkpoint_every: int = 3,
) -> DataFrame:
    """(id, hub, authority), each summing to 1. Authority = sum of hub
    scores over in-edges, hub = sum of authority over out-edges, both
    normalised every step (scaling is linear, so the hubs may be summed from
    unscaled authorities); stop when no score moves more than ``tol`` (an error
    if ``max_iter`` steps don't get there) or, without a tolerance, after
    ``max_iter`` steps. The edges lie twice, by source and by target, the scores
    by id: a half step has one exchange."""
    loop = Loop(checkpoint_every)
    with laid_out(edges) as parts:
        by_src = loop.keep(edges.select("src", "dst").repartition(parts, "src"), now=True)
        by_dst = loop.keep(by_src.repartition(parts, "dst"), now=True)
        zero = F.lit(0.0)
        start = _ids(vertices, edges).select("id", F.lit(1.0).alias("hub"), zero.alias("authority"))
        state = loop.keep(start.repartition(parts, "id"), now=True)
        hub_sum = auth_sum = 1.0
        for it in range(1, max_iter + 1):
            scaled = state.select(
                "id", (F.col("hub") / F.lit(hub_sum)).alias("hub"), (F.col("authority") / F.lit(auth_sum)).alias("authority_was")
            )
            half = loop.step(_hits_half(scaled, by_src, "hub", "authority"), partition_by=(parts, "id"))
            half = half.withColumnRenamed("hub", "hub_was")
            state = loop.step(_hits_half(half, by_dst, "authority", "hub"), partition_by=(parts, "id"))
            # With a fixed number of steps, scores are scaled now and then and at the end.
            if tol is None and it % checkpoint_every and it < max_iter:
                hub_sum = auth_sum = 1.0
                continue
            hub_sum, auth_sum = (x or 1.0 for x in state.agg(F.sum("hub"), F.sum("authority")).first())
            if tol is not None and it > 1:
                moved = F.greatest(
                    F.abs(F.col("hub") / F.lit(hub_sum) - F.col("hub_was")),
                    F.abs(F.col("authority") / F.lit(auth_sum) - F.col("authority_was")),
                )
                delta = state.agg(F.max(moved)).first()[0]
                if delta is None or delta <= tol:
                    break
        else:
            if tol is not None and max_iter:
                loop.release()
                raise RuntimeError(f"HITS did not reach tol={tol} in {max_iter} steps")
        return loop.finish(
            state.select(
                "id", (F.col("hub") / F.lit(hub_sum)).alias("hub"), (F.col("authority") / F.lit(auth_sum)).alias("authority")
            )
        )


def _hits_half(state: DataFrame, links: DataFrame, of: str, to: str) -> DataFrame:
    """``state`` with the column ``to``: the sum of ``of`` over the links, which
    lie by the vertex that sends it; one exchange, of the sums."""
    sender, receiver = links.columns if to == "authority" else reversed(links.columns)
    sent = state.select(F.col("id").alias(sender), F.col(of).alias("sent"))
    sums = links.join(sent, sender).groupBy(F.col(receiver).alias("id")).agg(F.sum("sent").alias("sums"))
    return state.join(sums, "id", "left").select(*state.columns, F.coalesce("sums", F.lit(0.0)).alias(to))


# ---- breadth-first search from many sources ------------------------------------


def bfs_levels(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    sources: DataFrame | None = None,
    with_paths: bool = False,
    max_depth: int | None = None,
    checkpoint_every: int = 2,
    owner: Loop | None = None,
) -> DataFrame:
    """(s, v, dist[, sigma]) for every v reachable from source s (dist 0 for
    v = s); sigma = number of shortest s-v paths.

    One level per superstep: the frontier joined to the out-edges, and one
    ``groupBy(s, v)`` over those candidates together with the pairs already
    reached (a tagged union instead of a second, anti-join shuffle).
    Cached levels belong to ``owner`` (the caller releases them once its
    result is checkpointed)."""
    owner = owner or Loop(checkpoint_every)
    e = owner.keep(simple_edges(edges))
    ids = _ids(vertices, edges)
    src = sources.select("id") if sources is not None else ids
    cols = ["s", "v", "dist"] + (["sigma"] if with_paths else [])
    frontier = src.select(
        F.col("id").alias("s"), F.col("id").alias("v"), F.lit(0).alias("dist"),
        *([F.lit(1.0).alias("sigma")] if with_paths else []),
    )
    frontier = owner.keep(frontier)
    levels = [frontier]
    seen = frontier.select("s", "v")
    d = 0
    while max_depth is None or d < max_depth:
        d += 1
        step = _spread(frontier, "v").join(e.withColumnRenamed("src", "v"), "v").select(
            "s", F.col("dst").alias("v"), (F.col("sigma") if with_paths else F.lit(0.0)).alias("sg"),
            F.lit(0).alias("old"),
        )
        mixed = step.unionByName(seen.select("s", "v", F.lit(0.0).alias("sg"), F.lit(1).alias("old")))
        nxt = (
            mixed.groupBy("s", "v")
            .agg(F.sum("sg").alias("sigma"), F.max("old").alias("old"))
            .where(F.col("old") == 0)
            .withColumn("dist", F.lit(d))
            .select(*cols)
        )
        nxt = owner.keep(nxt) if d % checkpoint_every else cut_lineage(nxt)
        if nxt.limit(1).count() == 0:
            break
        levels.append(nxt)
        seen = seen.unionByName(nxt.select("s", "v"))
        seen = cut_lineage(seen) if d % checkpoint_every == 0 else owner.keep(seen)
        frontier = nxt
    out = levels[0]
    for lv in levels[1:]:
        out = out.unionByName(lv)
    return out


# Bits of a long, longs of a row: targets that one pass of the reach search holds.
LANE = 64
MAX_LANES = 32
# Sources whose path counts stand side by side in a row, and sources of one pass.
SIDE = 32
BATCH = 2048


def reach_sums(
    edges: DataFrame, ids: DataFrame, batch: int = BATCH, checkpoint_every: int = 3, held: int = searches.REACH_HELD
) -> DataFrame:
    """(id, total, reached): the sum of distances from every vertex to all it
    reaches, and their number.

    Targets are taken in batches; a vertex holds one bit per target of the batch
    (64 to a long): reached before, and reached in the last step. In a step a
    vertex takes the OR of its successors' last bits; bits that are new at step d
    add d each. Up to ``held`` vertices and arcs, a task goes through all steps of
    its batches (``searches.reach_totals``). Above that a step is a superstep that
    moves one row per edge, whatever the batch, sums stay with the vertex, and
    the state is V rows of ``batch`` bits. Edges lie partitioned by the join key
    and the state by its id with the same count, so a step has one exchange (the
    partly OR-ed messages); the state is dropped after each batch."""
    if batch < 1:
        raise ValueError("batch must be >= 1")
    owner = Loop()
    e = owner.keep(simple_edges(edges), now=True)
    ranked = owner.keep(dense_index(ids.select("id").distinct(), F.col("id")))
    n = ranked.count()
    if n + e.count() > held:
        with laid_out(edges) as parts:
            out = _reach_sums(e, ids, batch, checkpoint_every, parts)
        owner.release()
        return out
    arcs = owner.keep(searches.numbered(e, ranked), now=True)
    sums = searches.reach_totals(arcs, n, batch).groupBy("pos").agg(
        F.sum("total").alias("total"), F.sum("reached").alias("reached")
    )
    zero = F.lit(0).cast("long")
    return owner.finish(ranked.join(sums, "pos", "left").select(
        "id", F.coalesce("total", zero).alias("total"), F.coalesce("reached", zero).alias("reached")
    ))


def _reach_sums(edges: DataFrame, ids: DataFrame, batch: int, checkpoint_every: int, n: int) -> DataFrame:
    owner = Loop()
    e = owner.keep(edges.repartition(n, "dst"), now=True)
    ranked = owner.keep(dense_index(ids.select("id").distinct(), F.col("id")).repartition(n, "id"))
    count = ranked.count()
    lanes = max(1, min(-(-min(batch, count) // LANE), MAX_LANES))
    batch = min(batch, lanes * LANE)
    front, seen = [f"f{i}" for i in range(lanes)], [f"s{i}" for i in range(lanes)]
    sums = None
    for lo in range(0, count, batch):
        loop = Loop(checkpoint_every)
        at = F.col("pos") - lo
        bit = F.when((at >= 0) & (at < batch), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(LANE)).cast("int")))
        own = [F.coalesce(F.when(F.floor(at / LANE) == i, bit), F.lit(0).cast("long")) for i in range(lanes)]
        zero = F.lit(0).cast("long")
        state = loop.step(
            ranked.select(
                "id", *[c.alias(f) for c, f in zip(own, front)], *[c.alias(s) for c, s in zip(own, seen)],
                zero.alias("total"), zero.alias("reached"), F.lit(0).cast("long").alias("d"),
            ),
            partition_by=(n, "id"),
        )
        while True:
            state = loop.step(_reach_step(state, e, front, seen), partition_by=(n, "id"))
            if state.where(_any_bit(front)).isEmpty():
                break
        part = state.select("id", "total", "reached")
        if sums is not None:
            part = part.unionByName(sums).groupBy("id").agg(F.sum("total").alias("total"), F.sum("reached").alias("reached"))
        sums = loop.finish(part)
    owner.release()
    if sums is None:
        return ids.select("id", F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("reached")).limit(0)
    return sums


def _any_bit(cols: list[str]):
    return functools.reduce(lambda x, y: x.bitwiseOR(y), [F.col(c) for c in cols]) != 0


def _reach_step(state: DataFrame, e: DataFrame, front: list[str], seen: list[str]) -> DataFrame:
    """State after the next step: bits of the successors that are new here. The
    step's number is a column, so that all steps share their compiled code."""
    moving = state.where(_any_bit(front)).select(F.col("id").alias("dst"), *front)
    msgs = e.join(moving, "dst").groupBy("src").agg(*[F.bit_or(c).alias(f"m_{c}") for c in front])
    met = state.join(msgs.withColumnRenamed("src", "id"), "id", "left")
    new = {f: F.coalesce(f"m_{f}", F.lit(0).cast("long")).bitwiseAND(F.bitwise_not(s)) for f, s in zip(front, seen)}
    met = met.select(
        "id", *[c.alias(f) for f, c in new.items()], *seen, "total", "reached", (F.col("d") + 1).alias("d")
    )
    bits = functools.reduce(lambda x, y: x + y, [F.bit_count(f).cast("long") for f in front])
    return met.select(
        "id", *front, *[F.col(s).bitwiseOR(F.col(f)).alias(s) for f, s in zip(front, seen)],
        (F.col("total") + F.col("d") * bits).alias("total"), (F.col("reached") + bits).alias("reached"), "d",
    )


def closeness(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    sources: DataFrame | None = None,
    wf_improved: bool = False,
    batch: int = BATCH,
) -> DataFrame:
    """(id, closeness) = 1 / sum of distances from the vertex to every
    vertex it reaches (not corrected for the number reached); 0 when it
    reaches none. Edges are followed in their direction. ``wf_improved``
    multiplies by r / (n - 1), r = vertices reached (Wasserman-Faust), so a
    vertex reaching few others no longer scores highest. All sources: batches
    of targets (``reach_sums``); some ``sources``: a search from those."""
    owner = Loop()
    edges = owner.hold(edges)
    ids = owner.keep(_ids(vertices, edges))
    if sources is None:
        tot = reach_sums(edges, ids, batch)
    else:
        lv = bfs_levels(edges, ids, sources, owner=owner)
        tot = lv.groupBy(F.col("s").alias("id")).agg(
            F.sum("dist").alias("total"), (F.count(F.lit(1)) - 1).alias("reached")
        )
    score = F.when(F.col("total") > 0, 1.0 / F.col("total")).otherwise(F.lit(0.0))
    if wf_improved:
        n = ids.count()
        score = score * F.col("reached") / F.lit(float(max(n - 1, 1)))
    return owner.finish(tot.select("id", score.alias("closeness")))


def kpp(closeness_df: DataFrame, n_vertices: int) -> DataFrame:
    """(id, kpp) = closeness / (n - 1); n counted once by the caller."""
    if n_vertices < 2:
        return closeness_df.select("id", F.lit(0.0).alias("kpp"))
    return closeness_df.select("id", (F.col("closeness") / F.lit(float(n_vertices - 1))).alias("kpp"))


def betweenness(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    directed: bool = False,
    normalized: bool = True,
    sources: DataFrame | None = None,
    sample: int | None = None,
    seed: int = 0,
    batch: int = BATCH,
    held: int = searches.HELD,
) -> DataFrame:
    """(id, betweenness) by Brandes' dependency accumulation on the simple
    graph (no loops, no duplicate edges; undirected = both directions).
    ``sources`` restricts the sources (ids); ``sample=n`` takes the n
    vertices with the smallest seeded hash as sources and scales the sums by
    V / n, an unbiased estimate. Undirected sums are halved; normalised scores
    divide by (n-1)(n-2) (directed) or (n-1)(n-2)/2 (undirected).

    Sources are taken in batches. Up to ``held`` vertices and arcs, a task goes
    through all levels of its batches (``searches.dependency_sums``). Above that
    the path counts of 32 sources stand side by side in a row (block, vertex), so
    an edge moves them all at once, and the state of a batch, at most V rows for
    every 32 of its sources, is dropped once its dependencies are added to one
    sum per vertex."""
    if batch < 1:
        raise ValueError("batch must be >= 1")
    owner = Loop()
    edges = owner.hold(edges)
    e = owner.keep(simple_edges(edges, directed=directed), now=True)
    ids = owner.keep(_ids(vertices, edges))
    n = ids.count()
    factor = 1.0
    if sample is not None:
        keyed = ids.select("id", h60(F.col("id"), "bc-source", seed).alias("hk"))
        sources = keyed.orderBy("hk", "id").limit(sample).select("id")
        factor = n / max(min(sample, n), 1)
    chosen = (sources if sources is not None else ids).select("id").distinct()
    # Sources come first in the numbering.
    ends = vertices_of(e, ids).select("id", F.lit(1).alias("other"))
    nodes = owner.keep(
        chosen.select("id", F.lit(0).alias("other")).unionByName(ends).groupBy("id").agg(F.min("other").alias("other")), now=True
    )
    n_nodes, n_arcs, n_sources = nodes.count(), e.count(), nodes.where("other = 0").count()
    if n_nodes + n_arcs <= held:
        ranked = owner.keep(dense_index(nodes, F.col("other"), F.col("id")))
        arcs = owner.keep(searches.numbered(e, ranked), now=True)
        parts = searches.dependency_sums(arcs, n_nodes, n_sources, n_arcs, batch, not directed)
        sums = parts.groupBy("pos").agg(F.sum("b").alias("b")).join(ranked, "pos").select("id", "b")
    else:
        sums = _dependencies_by_levels(e, chosen, directed, batch)
    if sums is None:
        bc = ids.select("id", F.lit(0.0).alias("betweenness"))
    else:
        bc = ids.select("id").join(sums, "id", "left").select("id", F.coalesce("b", F.lit(0.0)).alias("betweenness"))
    scale = factor
    if not directed:
        scale *= 0.5
    if normalized and n > 2:
        scale *= (2.0 if not directed else 1.0) / ((n - 1) * (n - 2))
    return owner.finish(bc.select("id", (F.col("betweenness") * F.lit(scale)).alias("betweenness")))


def _dependencies_by_levels(edges: DataFrame, chosen: DataFrame, directed: bool, batch: int) -> DataFrame | None:
    """(id, b): dependencies on the chosen sources, a superstep a level; None without sources."""
    owner = Loop()
    n_parts = int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    e = owner.keep(edges.repartition(n_parts, "src"))
    rev = e
    if directed:
        rev = owner.keep(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")).repartition(n_parts, "src"))
    ranked = owner.keep(dense_index(chosen, F.col("id")))
    sums = None
    for lo in range(0, ranked.count(), batch):
        part = _dependencies(ranked.where((F.col("pos") >= lo) & (F.col("pos") < lo + batch)), lo, e, rev)
        if sums is not None:
            part = part.unionByName(sums).groupBy("id").agg(F.sum("b").alias("b"))
        sums = cut_lineage(part)
    owner.release()
    return sums


def _dependencies(sources: DataFrame, lo: int, e: DataFrame, rev: DataFrame) -> DataFrame:
    """(id, b): dependencies of all vertices on a batch of sources, summed.

    Forward: a level has a row (blk, v, g0..g31, seen) where any of the block's
    sources is at that distance from v, with their numbers of shortest paths and
    0 for the others; ``seen`` are the bits of those reached so far. Backward:
    delta(s,v) = paths(s,v) * sum over successors w one level deeper of
    (1 + delta(s,w)) / paths(s,w). Every level is cut from its past: plans that
    use the level before twice would double with each level."""
    paths, deltas = [f"g{i}" for i in range(SIDE)], [f"d{i}" for i in range(SIDE)]
    at = F.col("pos") - lo
    lane = F.pmod(at, F.lit(SIDE)).cast("int")
    first = sources.select(
        F.floor(at / SIDE).cast("int").alias("blk"), F.col("id").alias("v"),
        *[F.when(lane == i, 1.0).otherwise(0.0).alias(c) for i, c in enumerate(paths)],
        F.call_function("shiftleft", F.lit(1).cast("long"), lane).alias("seen"),
    )
    levels = [cut_lineage(first)]
    known = levels[0].select("blk", "v", "seen")
    while True:
        step = e.join(levels[-1].select("blk", F.col("v").alias("src"), *paths), "src")
        sums = step.groupBy("blk", F.col("dst").alias("v")).agg(*[F.sum(c).alias(c) for c in paths])
        met = sums.join(known, ["blk", "v"], "left").withColumn("was", F.coalesce("seen", F.lit(0).cast("long")))
        fresh = {c: F.when(F.col("was").bitwiseAND(F.lit(1 << i)) == 0, F.col(c)).otherwise(0.0) for i, c in enumerate(paths)}
        met = met.select("blk", "v", "was", *[x.alias(c) for c, x in fresh.items()])
        bits = [F.when(F.col(c) > 0, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, c in enumerate(paths)]
        new = functools.reduce(lambda x, y: x.bitwiseOR(y), bits)
        level = met.withColumn("new", new).where("new <> 0").select(
            "blk", "v", *paths, F.col("was").bitwiseOR(F.col("new")).alias("seen")
        )
        level = cut_lineage(level)
        if level.isEmpty():
            break
        levels.append(level)
        # The last row of a vertex has all its bits; those of the levels before are fewer.
        known = known.unionByName(level.select("blk", "v", "seen")).groupBy("blk", "v").agg(F.bit_or("seen").alias("seen"))
        known = cut_lineage(known)
    total, below = None, None
    for d in range(len(levels) - 1, 0, -1):
        here = levels[d].select("blk", "v", *paths)
        if below is None:
            cur = here.select("*", *[F.lit(0.0).alias(c) for c in deltas])
        else:
            cur = here.join(_back(below, rev, paths, deltas), ["blk", "v"], "left").select(
                "blk", "v", *paths, *[(F.col(p) * F.coalesce(f"c_{p}", F.lit(0.0))).alias(c) for p, c in zip(paths, deltas)]
            )
        below = cut_lineage(cur)
        both = functools.reduce(lambda x, y: x + y, [F.col(c) for c in deltas])
        part = below.groupBy(F.col("v").alias("id")).agg(F.sum(both).alias("b"))
        total = part if total is None else total.unionByName(part)
    if total is None:
        return sources.select("id", F.lit(0.0).alias("b"))
    return total.groupBy("id").agg(F.sum("b").alias("b"))


def _back(below: DataFrame, rev: DataFrame, paths: list[str], deltas: list[str]) -> DataFrame:
    """(blk, v, c_g0..): sums over successors of (1 + delta) / paths, side by side."""
    share = [F.when(F.col(p) > 0, (1.0 + F.col(c)) / F.col(p)).otherwise(0.0).alias(p) for p, c in zip(paths, deltas)]
    step = rev.join(below.select("blk", F.col("v").alias("src"), *share), "src")
    return step.groupBy("blk", F.col("dst").alias("v")).agg(*[F.sum(p).alias(f"c_{p}") for p in paths])


def significant(x, digits: int):
    """A double rounded to significant digits."""
    return F.format_string(f"%.{digits - 1}e", x).cast("double")


# ---- report ----------------------------------------------------------------------


def measure_report(
    edges: DataFrame,
    n: int = 5,
    resets: Sequence[float] = (0.05, 0.15, 0.3),
    pagerank_iter: int = 20,
    hits_iter: int = 1000,
    hits_tol: float | None = 1e-6,
    tie_digits: int = 12,
    pagerank_tol: float | None = None,
    only: Sequence[str] | None = None,
) -> DataFrame:
    """(measure, position, id, score): top n of every measure. Scores equal
    to ``tie_digits`` significant digits are ties, broken by the smaller id,
    so the order does not depend on floating-point summation order (symmetric
    vertices get equal scores only up to the last bits) nor on the size of
    the scores, which shrink as the graph grows. ``pagerank_tol`` and ``hits_tol``
    run those measures to a tolerance; ``only`` names the measures to report."""
    owner = Loop()
    edges = owner.hold(edges)
    ids = owner.keep(vertices_of(edges))
    nv = ids.count()
    made: dict[str, DataFrame] = {}

    def once(name: str, make) -> DataFrame:
        if name not in made:
            made[name] = make()
        return made[name]

    def close() -> DataFrame:
        return once("closeness", lambda: closeness(edges, ids))

    def both() -> DataFrame:
        return once("hits", lambda: hits(edges, ids, max_iter=hits_iter, tol=hits_tol))

    measures = {
        "in_degree": (lambda: in_degree(edges), "in_degree"),
        "out_degree": (lambda: out_degree(edges), "out_degree"),
        "betweenness": (lambda: betweenness(edges, ids), "betweenness"),
        "closeness": (close, "closeness"),
        "kpp": (lambda: kpp(close(), nv), "kpp"),
        "hub": (lambda: both().select("id", "hub"), "hub"),
        "authority": (lambda: both().select("id", "authority"), "authority"),
    }

    def side_by_side(i: int) -> DataFrame:
        return once("pageranks", lambda: pageranks(edges, ids, resets, pagerank_iter)).select("id", f"rank{i}")

    for i, r in enumerate(resets):
        if pagerank_tol is None:
            measures[f"pagerank_{r}"] = (functools.partial(side_by_side, i), f"rank{i}")
        else:  # Each stops by itself.
            rank = functools.partial(pagerank, edges, ids, reset=r, max_iter=pagerank_iter, tol=pagerank_tol)
            measures[f"pagerank_{r}"] = (rank, "rank")
    if only is not None:
        measures = {m: measures[m] for m in only}
    out = None
    for name, (make, col) in measures.items():
        ranked = make().select(
            "id", F.col(col).cast("double").alias("score"), significant(F.col(col).cast("double"), tie_digits).alias("key")
        )
        t = top_n(ranked, "key", n)
        t = t.withColumn("position", F.row_number().over(Window.orderBy(F.col("key").desc(), "id")))
        t = t.select(F.lit(name).alias("measure"), "position", "id", "score")
        out = t if out is None else out.unionByName(t)
    return owner.finish(out)
