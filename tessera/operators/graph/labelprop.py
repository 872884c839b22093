"""Label propagation community detection and the clustering dispatcher.

Every edge carries labels both ways, with multiplicity (a reciprocal pair
counts twice). A receiving vertex adopts the most frequent label among its
messages; ties go to the smallest label. One superstep is: links into the
active receivers joined with the labelled senders, ``groupBy(dst, label)``
counts (partial aggregation absorbs hubs), the best label per receiver, and
a left join back to the vertices.

Partitioned propagation hashes vertices into ``partitions`` slices and lets
one slice update per superstep. Superstep i = 1..steps*P runs with
iteration = i div P and active slice = i mod P (so slice 0 first acts at
iteration 1, the others at iteration 0, and every slice acts ``steps``
times); messages use the labels before the superstep. A labelled vertex
accepts a new label with probability ``accept(iteration)`` (a seeded hash
test), an unlabelled one always; in sweep mode only unlabelled vertices
update.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.hashing import h32
from tessera.operators.graph.core import Loop, in_degree, laid_out, out_degree, top_n, vertices_of

TWO32 = 1 << 32


def always_accept(iteration: int) -> float:
    return 1.0


def sustain_decay(transition: int, end: int) -> Callable[[int], float]:
    """1 up to ``transition``, then linear down to 0 at ``end``."""

    def f(iteration: int) -> float:
        if iteration <= transition:
            return 1.0
        if iteration >= end:
            return 0.0
        return (end - iteration) / float(end - transition)

    return f


def annealing(iterations: int, decay_iterations: int = 0) -> tuple[Callable[[int], float], int]:
    """(acceptance curve, total steps) for ``iterations`` plain steps
    followed by ``decay_iterations`` steps of falling acceptance."""
    if decay_iterations <= 0:
        return always_accept, iterations
    return sustain_decay(iterations, iterations + decay_iterations), iterations + decay_iterations


def slice_of(id_col: Column, partitions: int, seed: int = 0, iteration: int | None = None) -> Column:
    """Slice 0..P-1 from an unsigned 32-bit seeded hash, in equal ranges."""
    salts = ("slice", seed) if iteration is None else ("slice", seed, iteration)
    return F.shiftright(h32(id_col, *salts) * F.lit(partitions), 32).cast("int")


def random_clusters(vertices: DataFrame, partitions: int, seed: int = 0) -> DataFrame:
    """(id, cluster): the random baseline, a seeded hash into P clusters."""
    return vertices.select("id", slice_of(F.col("id"), partitions, seed).cast("bigint").alias("cluster"))


def links_of(edges: DataFrame) -> DataFrame:
    """(src, dst): every edge in both directions, multiplicity kept."""
    e = edges.select("src", "dst")
    return e.unionAll(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))


def _superstep(
    labels: DataFrame,
    links: DataFrame,
    active: Column | None,
    accept_p: float,
    seed: int,
    iteration: int,
    sweep: bool,
) -> DataFrame:
    into = links if active is None else links.where(active)
    msgs = into.join(
        labels.where(F.col("label").isNotNull()).select(F.col("id").alias("src"), F.col("label").alias("msg")), "src"
    )
    best = (
        msgs.groupBy("dst", "msg")
        .agg(F.count(F.lit(1)).alias("n"))
        .groupBy(F.col("dst").alias("id"))
        .agg(F.max(F.struct(F.col("n"), (-F.col("msg")).alias("neg"))).alias("b"))
        .select("id", (-F.col("b.neg")).alias("new"))
    )
    cur = F.col("label")
    take = F.col("new").isNotNull()
    if sweep:
        take = take & cur.isNull()
    if accept_p < 1.0:
        u = h32(F.col("id"), "accept", seed, iteration)
        take = take & (cur.isNull() | (u < F.lit(int(accept_p * TWO32))))
    return labels.join(best, "id", "left").select("id", F.when(take, F.col("new")).otherwise(cur).alias("label"))


def propagate(
    labels: DataFrame,
    edges: DataFrame,
    steps: int,
    partitions: int = 1,
    seed: int = 0,
    reshuffle: bool = False,
    accept: Callable[[int], float] = always_accept,
    sweep: bool = False,
    checkpoint_every: int = 3,
) -> DataFrame:
    """Run ``steps * partitions`` supersteps on (id, label) with nullable
    labels and return the new (id, label). Links lie by sender and labels by
    id, so a superstep exchanges only counted messages: per (receiver, label),
    which keeps a hub's many labels apart, and then its best of each task."""
    if steps < 1:
        raise ValueError("steps must be > 0")
    if partitions < 1:
        raise ValueError("partitions must be >= 1")
    loop = Loop(checkpoint_every)
    with laid_out(edges) as parts:
        links = loop.keep(links_of(edges).repartition(parts, "src"), now=True)
        start = labels.select("id", F.col("label").cast("bigint").alias("label"))
        lab = loop.keep(start.repartition(parts, "id"), now=True)
        for i in range(1, steps * partitions + 1):
            iteration, active_slice = divmod(i, partitions)
            active = None
            if partitions > 1:
                it = iteration if reshuffle else None
                active = slice_of(F.col("dst"), partitions, seed, it) == F.lit(active_slice)
            new = _superstep(lab, links, active, accept(iteration), seed, iteration, sweep)
            lab = loop.step(new, partition_by=(parts, "id"))
        return loop.finish(lab)


def label_propagation(
    edges: DataFrame,
    vertices: DataFrame | None = None,
    steps: int = 5,
    partitions: int = 1,
    seed: int = 0,
    reshuffle: bool = False,
    decay_steps: int = 0,
) -> DataFrame:
    """(id, cluster). Every vertex starts with its own id. partitions = 1 and
    decay_steps = 0 is plain synchronous propagation; partitions > 1 is the
    sliced variant; decay_steps > 0 anneals the acceptance."""
    ids = vertices.select("id") if vertices is not None else vertices_of(edges)
    accept, total = annealing(steps, decay_steps)
    lab = propagate(
        ids.select("id", F.col("id").alias("label")), edges, total, partitions, seed, reshuffle, accept
    )
    return lab.select("id", F.coalesce(F.col("label"), F.lit(-1)).alias("cluster"))


def seeded_propagation(
    edges: DataFrame,
    seeds: DataFrame,
    vertices: DataFrame | None = None,
    steps: int = 5,
    partitions: int = 1,
    seed: int = 0,
    sweep_steps: int | None = None,
    reshuffle: bool = False,
    decay_steps: int = 0,
) -> DataFrame:
    """(id, cluster): only ``seeds`` (ids) start labelled (with their own
    id); propagate, with falling acceptance in the last ``decay_steps``, then
    a sweep pass of ``sweep_steps`` (else ``steps``) fills only vertices still
    unlabelled; vertices never reached get -1."""
    accept, total = annealing(steps, decay_steps)
    ids = vertices.select("id") if vertices is not None else vertices_of(edges)
    flagged = ids.join(seeds.select("id").distinct().withColumn("is_seed", F.lit(True)), "id", "left")
    lab = flagged.select("id", F.when(F.col("is_seed"), F.col("id")).alias("label"))
    lab = propagate(lab, edges, total, partitions, seed, reshuffle, accept)
    lab = propagate(lab, edges, sweep_steps or steps, partitions, seed, reshuffle, sweep=True)
    return lab.select("id", F.coalesce(F.col("label"), F.lit(-1)).alias("cluster"))


def central_vertices(edges: DataFrame, centrality: str = "outdeg", n: int = 10) -> DataFrame:
    """(id): the top ``n`` vertices by hubs, auths, outdeg or indeg."""
    if centrality in ("outdeg", "indeg"):
        m = out_degree(edges) if centrality == "outdeg" else in_degree(edges)
        col = "out_degree" if centrality == "outdeg" else "in_degree"
        return top_n(m, col, n).select("id")
    if centrality in ("hubs", "auths"):
        from tessera.operators.graph.centrality import hits, significant

        col = "hub" if centrality == "hubs" else "authority"
        # Equal to nine digits is a tie, whatever the order of the sums was.
        h = hits(edges).select("id", significant(F.col(col), 9).alias(col))
        return top_n(h, col, n).select("id")
    raise ValueError(f"unknown centrality {centrality!r}")


def cluster(edges: DataFrame, algorithm: str, vertices: DataFrame | None = None, **opts) -> DataFrame:
    """(id, cluster) by name: random, scc, cc, lpa, plpa (partitioned),
    annealed, authorities."""
    from tessera.operators.graph.components import strong_components, weak_components

    ids = vertices.select("id") if vertices is not None else vertices_of(edges)
    seed = opts.get("seed", 0)
    if algorithm == "random":
        return random_clusters(ids, opts.get("partitions", 1), seed)
    if algorithm == "scc":
        return strong_components(edges, ids).select("id", F.col("component").alias("cluster"))
    if algorithm == "cc":
        return weak_components(edges, ids).select("id", F.col("component").alias("cluster"))
    steps = opts.get("steps", 5)
    if algorithm == "lpa":
        return label_propagation(edges, ids, steps)
    if algorithm == "plpa":
        return label_propagation(edges, ids, steps, opts.get("partitions", 1), seed, opts.get("reshuffle", False))
    if algorithm == "annealed":
        return label_propagation(
            edges, ids, steps, opts.get("partitions", 1), seed, opts.get("reshuffle", False), opts.get("decay_steps", 0)
        )
    if algorithm == "authorities":
        seeds = central_vertices(edges, opts.get("centrality", "hubs"), opts.get("n", 10))
        return seeded_propagation(
            edges, seeds, ids, steps, opts.get("partitions", 1), seed, reshuffle=opts.get("reshuffle", False),
            decay_steps=opts.get("decay_steps", 0),
        )
    raise ValueError(f"unknown algorithm {algorithm!r}")
