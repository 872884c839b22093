"""Weakly and strongly connected components; a component is labelled by the
smallest vertex id in it."""

from __future__ import annotations

import itertools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph.core import Loop, simple_edges, vertices_of
from tessera.session import cut_lineage


def star_components(pairs: DataFrame, max_iter: int | None = None) -> DataFrame:
    """(id, component) of every id in ``pairs(src, dst)``: the least id of its
    component, by alternating large and small stars on a shrinking edge table.

    Large star: every edge u > v becomes u - (least id next to v). Small star:
    the smaller neighbours of a vertex are tied to the least of them. Distances
    about halve, so long paths need about log2(length) rounds. A vertex whose
    only neighbour is smaller is a leaf: it takes that neighbour's component
    later and leaves the table, so finished parts are not touched again and the
    loop ends when no edge is left. Ids are of any one orderable type. The hot
    keys (the centre of a large component) are join keys only, which AQE's skew
    join splits; aggregates are partial before the shuffle."""
    loop = Loop(1)
    ends = pairs.where(F.col("src") != F.col("dst"))
    alone = pairs.where(F.col("src") == F.col("dst")).select(F.col("src").alias("id"))
    e = loop.step(ends.select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    leaves = []
    for _ in _rounds(max_iter, "weak components"):
        if e.isEmpty():
            break
        both = e.select("u", "v").unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"), F.count(F.lit(1)).alias("n"))
        low = cut_lineage(low.withColumn("leaf", (F.col("n") == 1) & (F.col("m") < F.col("u"))))
        leaves.append(low.where("leaf").select(F.col("u").alias("id"), F.col("m").alias("up")))
        inner = low.where(~F.col("leaf")).select("u")
        nearest = low.select(F.col("u").alias("v"), F.least("u", "m").alias("m"))
        large = e.join(inner, "u", "left_semi").join(nearest, "v").select("u", F.col("m").alias("v")).distinct()
        large = loop.keep(large)
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        tied = large.join(least, "u").where(F.col("v") != F.col("m")).select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = loop.step(tied.unionByName(least.select("u", F.col("m").alias("v"))).distinct())
        loop.drop_kept()
    found = None
    for t in reversed(leaves):
        if found is None:
            up = t.select("id", F.col("up").alias("component"))
        else:
            over = found.select(F.col("id").alias("up"), "component")
            up = t.join(over, "up", "left").select("id", F.coalesce("component", "up").alias("component"))
        found = cut_lineage(up if found is None else found.unionByName(up))
    roots = alone.unionByName(ends.select(F.least("src", "dst").alias("id"))).distinct()
    roots = roots.select("id", F.col("id").alias("component"))
    if found is not None:
        roots = roots.join(found.select("id"), "id", "left_anti").unionByName(found)
    return loop.finish(roots)


def weak_components(
    edges: DataFrame, vertices: DataFrame | None = None, max_iter: int | None = None
) -> DataFrame:
    """(id, component) by ``star_components``; with ``vertices``, those without
    an edge are components of their own. Runs to the end; with ``max_iter`` it
    is an error not to reach it."""
    found = star_components(edges.select("src", "dst"), max_iter)
    if vertices is None:
        return found
    rest = vertices.select("id").join(found.select("id"), "id", "left_anti")
    return found.unionByName(rest.select("id", F.col("id").alias("component")))


def _rounds(limit: int | None, what: str):
    """Round numbers; an error if a loop with a limit uses all of them up."""
    yield from itertools.count() if limit is None else range(limit)
    raise RuntimeError(f"{what}: not finished after {limit} rounds")


def _min_colour(e: DataFrame, ids: DataFrame, max_iter: int | None, checkpoint_every: int) -> DataFrame:
    """(id, colour) = smallest id that reaches the vertex along ``e``."""
    loop = Loop(checkpoint_every)
    col = loop.step(ids.select("id", F.col("id").alias("colour")))
    for _ in _rounds(max_iter, "colouring"):
        nb = (
            e.join(col.withColumnRenamed("id", "src"), "src")
            .groupBy(F.col("dst").alias("id"))
            .agg(F.min("colour").alias("m"))
        )
        new = col.join(nb, "id", "left").select("id", F.least("colour", F.coalesce("m", "colour")).alias("colour"))
        old, col = col, loop.step(new)
        if col.alias("n").join(old.alias("o"), "id").where(F.col("n.colour") != F.col("o.colour")).limit(1).count() == 0:
            break
    return col


def _shortcuts(links: DataFrame) -> DataFrame:
    """(id, a, b): for chain vertices ``links(id, prev, next)``, the first vertex
    before and after the chain that is none of them. Both pointers double in
    each round, so a chain takes log2 of its length. The chains have ends."""
    loop = Loop(1)
    inner = loop.keep(links.select("id"))
    marks = [inner.select(F.col("id").alias(c), F.lit(True).alias(f"in_{c}")) for c in ("a", "b")]
    ptr = loop.step(links.select("id", F.col("prev").alias("a"), F.col("next").alias("b")))
    while True:
        open_ = ptr.join(marks[0], "a", "left").join(marks[1], "b", "left")
        if open_.where("in_a or in_b").isEmpty():
            return loop.finish(ptr)
        over_a = ptr.select(F.col("id").alias("a"), F.col("a").alias("aa"))
        over_b = ptr.select(F.col("id").alias("b"), F.col("b").alias("bb"))
        hop = ptr.join(over_a, "a", "left").join(over_b, "b", "left")
        ptr = loop.step(hop.select("id", F.coalesce("aa", "a").alias("a"), F.coalesce("bb", "b").alias("b")))


def _contract(e: DataFrame, remaining: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """One round of trimming and chain contraction: (single, chained, edges,
    remaining). ``single``: vertices without an edge in or out, components of
    their own. ``chained(id, a, b)``: vertices with one edge in and one out, on a
    chain from a to b; they are in the component of a and b if that is one, and
    else alone. The smallest of its neighbours is kept, so that no cycle is
    contracted whole; a chain in any order of ids loses most of its vertices."""
    outs = e.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("n_out"), F.min("dst").alias("next"))
    ins = e.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("n_in"), F.min("src").alias("prev"))
    core = cut_lineage(outs.join(ins, "id"))
    single = remaining.join(core.select("id"), "id", "left_anti")
    low = F.col("id") < F.least("prev", "next")
    links = cut_lineage(core.where((F.col("n_in") == 1) & (F.col("n_out") == 1) & ~low).select("id", "prev", "next"))
    chained = _shortcuts(links)
    left = cut_lineage(core.select("id").join(links.select("id"), "id", "left_anti"))
    ends = chained.select(F.col("a").alias("src"), F.col("b").alias("dst"))
    both = e.select("src", "dst").unionByName(ends).where("src <> dst")
    for c in ("src", "dst"):
        both = both.join(left.select(F.col("id").alias(c)), c, "left_semi")
    return single, chained, cut_lineage(both.select("src", "dst").distinct()), left


def _by_colour(
    e: DataFrame, remaining: DataFrame, max_iter: int | None, checkpoint_every: int
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(component rows, edges, remaining) after one round of colours: every
    colour's pivot is the vertex of that id, and the vertices of the colour that
    reach it (a backward search) are its component."""
    owner = Loop(checkpoint_every)
    col = owner.keep(_min_colour(e, remaining, max_iter, checkpoint_every))
    # only edges inside one colour can lie on a cycle
    ec = owner.keep(
        e.join(col.select(F.col("id").alias("src"), F.col("colour").alias("cs")), "src")
        .join(col.select(F.col("id").alias("dst"), F.col("colour").alias("cd")), "dst")
        .where(F.col("cs") == F.col("cd"))
        .select("src", "dst", F.col("cs").alias("colour"))
    )
    loop = Loop(checkpoint_every)
    comp = loop.step(col.where(F.col("id") == F.col("colour")).select("id", F.col("colour").alias("component")))
    frontier = comp
    for _ in _rounds(max_iter, "backward search"):
        nxt = (
            ec.join(frontier.select(F.col("id").alias("dst"), F.col("component").alias("colour")), ["dst", "colour"])
            .select(F.col("src").alias("id"), F.col("colour").alias("component"))
            .distinct()
            .join(comp, "id", "left_anti")
        )
        nxt = loop.keep(nxt)
        if nxt.isEmpty():
            break
        comp = loop.step(comp.unionByName(nxt))
        frontier = nxt
    comp = loop.finish(comp)
    left = cut_lineage(remaining.join(comp, "id", "left_anti"))
    rest = ec.select("src", "dst")
    for c in ("src", "dst"):
        rest = rest.join(comp.select(F.col("id").alias(c)), c, "left_anti")
    rest = cut_lineage(rest.select("src", "dst"))
    owner.release()
    return comp, rest, left


def strong_components(
    edges: DataFrame, vertices: DataFrame | None = None, max_rounds: int | None = None, max_iter: int | None = None,
    checkpoint_every: int = 2,
) -> DataFrame:
    """(id, component), the least id of the component. Rounds of trimming and
    chain contraction (``_contract``) go on while they take away a tenth of the
    vertices; else a round of colours takes the component of each colour's pivot
    and drops the edges between colours. Contracted vertices are put back in
    reverse order. Runs until no vertex is left; with ``max_rounds`` it is an
    error to use up those."""
    ids = cut_lineage(vertices.select("id") if vertices is not None else vertices_of(edges))
    e, remaining = cut_lineage(simple_edges(edges)), ids
    found, stack = [], []
    size = remaining.count()
    for _ in _rounds(max_rounds, "strong components"):
        if size == 0:
            break
        single, chained, e, remaining = _contract(e, remaining)
        found.append(cut_lineage(single.select("id", F.col("id").alias("component"))))
        stack.append(chained)
        before, size = size, remaining.count()
        if size and size > 0.9 * before:
            comp, e, remaining = _by_colour(e, remaining, max_iter, checkpoint_every)
            found.append(comp)
            size = remaining.count()
    out = None
    for part in found:
        out = part if out is None else out.unionByName(part)
    if out is None:
        return ids.select("id", F.col("id").alias("component")).limit(0)
    out = cut_lineage(out)
    for chained in reversed(stack):
        if chained.isEmpty():
            continue
        of = [out.select(F.col("id").alias(c), F.col("component").alias(f"c_{c}")) for c in ("a", "b")]
        back = chained.join(of[0], "a").join(of[1], "b")
        back = back.select("id", F.when(F.col("c_a") == F.col("c_b"), F.col("c_a")).otherwise(F.col("id")).alias("component"))
        out = cut_lineage(out.unionByName(back))
    least = out.groupBy("component").agg(F.min("id").alias("least"))
    return cut_lineage(out.join(least, "component").select("id", F.col("least").alias("component")))
