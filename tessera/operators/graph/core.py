"""Graphs as two DataFrames: ``vertices(id)`` and ``edges(src, dst)``.

Also the loop helpers every iterative graph job uses: persist the state,
cut lineage with a reliable checkpoint every few supersteps, unpersist the
previous state, and take one scalar per superstep as the stop value.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import cut_lineage


def vertices_of(edges: DataFrame, extra: DataFrame | None = None) -> DataFrame:
    """Distinct endpoint ids (plus ``extra`` ids, e.g. isolated vertices)."""
    v = edges.select(F.col("src").alias("id")).unionByName(edges.select(F.col("dst").alias("id")))
    if extra is not None:
        v = v.unionByName(extra.select("id"))
    return v.distinct()


def sequential_pairs(
    events: DataFrame,
    key_col: str = "event_type",
    order_cols: Sequence[str] = ("ts", "event_id"),
    node_col: str = "user_id",
    bucket_seconds: int = 3600,
) -> DataFrame:
    """(src, dst): every node followed by the next node of the same key in
    (ts, event_id) order, i.e. ``lead(node) OVER (PARTITION BY key ORDER
    BY ts, event_id)``, without one task per key: rows are windowed per
    (key, time bucket) and the last row of a bucket is linked to the first
    row of the next non-empty bucket through a small table of bucket heads
    (one row per key and bucket). Rows without a time come last, by the
    other order columns."""
    ts = order_cols[0]
    b = events.select(
        F.col(key_col).alias("k"),
        *[F.col(c) for c in order_cols],
        F.col(node_col).alias("node"),
        F.floor(F.unix_timestamp(F.col(ts).cast("timestamp")) / bucket_seconds).alias("bk"),
    )
    w = Window.partitionBy("k", "bk").orderBy(*[F.col(c).asc_nulls_last() for c in order_cols])
    inner = b.select("k", "bk", F.col("node").alias("src"), F.lead("node").over(w).alias("dst"))
    order_struct = F.struct(*[F.col(c) for c in order_cols])
    heads = b.groupBy("k", "bk").agg(
        F.min_by("node", order_struct).alias("first"), F.max_by("node", order_struct).alias("last")
    )
    hw = Window.partitionBy("k").orderBy(F.col("bk").asc_nulls_last())
    links = heads.select(F.col("last").alias("src"), F.lead("first").over(hw).alias("dst"))
    return inner.where(F.col("dst").isNotNull()).select("src", "dst").unionByName(
        links.where(F.col("dst").isNotNull())
    )


def user_graph(events: DataFrame) -> DataFrame:
    """Directed user graph of the events table: distinct (src, dst) pairs of
    consecutive users per event type; self loops kept."""
    return sequential_pairs(events).distinct()


def simple_edges(edges: DataFrame, directed: bool = True) -> DataFrame:
    """No self loops, no duplicates; undirected = both directions."""
    e = edges.where(F.col("src") != F.col("dst")).select("src", "dst")
    if not directed:
        e = e.unionByName(e.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return e.distinct()


def graph_counts(edges: DataFrame, vertices: DataFrame | None = None) -> DataFrame:
    """One row: vertices, edges (one aggregate over a tagged union)."""
    v = vertices if vertices is not None else vertices_of(edges)
    tagged = v.select(F.lit(1).alias("is_v")).unionByName(edges.select(F.lit(0).alias("is_v")))
    return tagged.agg(
        F.sum("is_v").cast("bigint").alias("vertices"), F.sum(1 - F.col("is_v")).cast("bigint").alias("edges")
    )


def in_degree(edges: DataFrame) -> DataFrame:
    """(id, in_degree); vertices without in-edges are absent."""
    return edges.groupBy(F.col("dst").alias("id")).agg(F.count(F.lit(1)).alias("in_degree"))


def out_degree(edges: DataFrame) -> DataFrame:
    return edges.groupBy(F.col("src").alias("id")).agg(F.count(F.lit(1)).alias("out_degree"))


def top_n(measure: DataFrame, score_col: str, n: int = 5, id_col: str = "id") -> DataFrame:
    """The n highest scores, ties by smaller id (a bounded top-k)."""
    return measure.orderBy(F.col(score_col).desc(), F.col(id_col).asc()).limit(n)


@contextmanager
def laid_out(df: DataFrame):
    """For loops whose edges and state are partitioned by the join keys, with
    ``shuffle.partitions`` parts each: gives that number and keeps AQE from
    merging small parts, which would make every superstep lay the state out
    anew. What was set before comes back."""
    conf, name = df.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.enabled"
    before = conf.get(name)
    conf.set(name, "false")
    try:
        yield int(conf.get("spark.sql.shuffle.partitions"))
    finally:
        conf.set(name, before)


class Loop:
    """State holder for iterative jobs: ``step(df)`` persists the new state,
    checkpoints it reliably every ``every`` steps, and unpersists states
    older than the previous one (the previous one stays for delta tests).
    ``keep(df)`` persists loop-invariant inputs (edges, vertex ids);
    ``finish(result)`` checkpoints the result eagerly and releases
    everything the job cached, so cached data never outlives the job."""

    def __init__(self, every: int = 3):
        self.every = max(1, every)
        self.i = 0
        self.kept: list[DataFrame] = []
        self.extra: list[DataFrame] = []

    def step(self, df: DataFrame, partition_by: tuple | None = None) -> DataFrame:
        """``partition_by`` (count, columns...) lays the state out again after
        a checkpoint, which forgets how it was partitioned, and runs the step at
        once: how a cached table lies is known to plans only after that."""
        self.i += 1
        if self.i % self.every == 0:
            out = cut_lineage(df)
            if partition_by:
                out = out.repartition(*partition_by).persist(StorageLevel.MEMORY_AND_DISK)
        else:
            out = df.persist(StorageLevel.MEMORY_AND_DISK)
        if partition_by:
            out.count()
        self.kept.append(out)
        while len(self.kept) > 2:
            self.kept.pop(0).unpersist()
        return out

    def keep(self, df: DataFrame, now: bool = False) -> DataFrame:
        out = df.persist(StorageLevel.MEMORY_AND_DISK)
        if now:
            out.count()
        self.extra.append(out)
        return out

    def hold(self, df: DataFrame) -> DataFrame:
        """``keep``, unless the caller has it cached already (and would lose it)."""
        level = df.storageLevel
        return df if level.useMemory or level.useDisk else self.keep(df)

    def drop_kept(self) -> None:
        """Unpersist what ``keep`` holds: inputs of one superstep only."""
        for d in self.extra:
            d.unpersist()
        self.extra = []

    def release(self) -> None:
        for d in self.kept + self.extra:
            d.unpersist()
        self.kept, self.extra = [], []

    def finish(self, result: DataFrame) -> DataFrame:
        out = cut_lineage(result)
        self.release()
        return out


def iterate_messages(
    vertices: DataFrame,
    edges: DataFrame,
    send,
    merge,
    update,
    max_iter: int | None = None,
    state=None,
    next_state=None,
    checkpoint_every: int = 3,
) -> DataFrame:
    """User-level message passing over DataFrames.

    ``vertices`` is (id, attr...). Each superstep:
    messages = ``send(triplets, state)``, a DataFrame (dst, msg...) built
    from (src, dst, src_*, dst_* columns); ``merge(messages)`` groups them
    by ``dst`` into one row per receiver; ``update(vertices, merged, state)``
    returns the new vertices (receivers without a message keep their
    attributes by a left join). Stops when no message is sent, or after
    ``max_iter`` supersteps if the caller sets that many. ``next_state(state)`` advances a driver value that
    the callbacks turn into literals.
    """
    loop = Loop(checkpoint_every)
    edges = loop.keep(edges)
    v = loop.step(vertices)
    for _ in itertools.count() if max_iter is None else range(max_iter):
        src = v.select([F.col(c).alias(f"src_{c}") if c != "id" else F.col("id").alias("src") for c in v.columns])
        dst = v.select([F.col(c).alias(f"dst_{c}") if c != "id" else F.col("id").alias("dst") for c in v.columns])
        triplets = edges.join(src, "src").join(dst, "dst")
        merged = loop.keep(merge(send(triplets, state)))
        if merged.limit(1).count() == 0:
            break
        v = loop.step(update(v, merged, state))
        if next_state is not None:
            state = next_state(state)
    return loop.finish(v)


def message_loop(
    vertices: DataFrame,
    edges: DataFrame,
    send: Callable[[object], Column],
    merge: Column,
    update: Callable[[object], dict[str, Column]],
    max_iter: int | None = None,
    state=None,
    next_state: Callable[[object], object] | None = None,
    checkpoint_every: int = 3,
) -> DataFrame:
    """Message passing by Column expressions over ``vertices(id, attr...)`` and
    ``edges(src, dst)``.

    In a superstep every edge sends ``send(state)`` to its ``dst``; null is no
    message. The expression may name ``src``, ``dst`` and the ends' attributes
    ``src_<attr>`` and ``dst_<attr>``; only the ends whose attributes it names
    are joined, with those attributes alone. ``merge`` is an aggregate over the
    column ``msg``. ``update(state)`` gives new values of attributes from the
    vertex's columns and the merged ``msg`` (null where none came). ``state`` is
    a driver value, as an iteration number or a slice, that ``next_state``
    advances. Stops when no message is sent, or after ``max_iter`` supersteps.
    Edges lie by ``src`` and vertices by ``id``."""
    loop = Loop(checkpoint_every)
    with laid_out(edges) as parts:
        e = loop.keep(edges.select("src", "dst").repartition(parts, "src"), now=True)
        v = loop.keep(vertices.repartition(parts, "id"), now=True)
        for _ in itertools.count() if max_iter is None else range(max_iter):
            merged = sent(v, e, send(state)).groupBy("id").agg(merge.alias("msg")).persist(StorageLevel.MEMORY_AND_DISK)
            if merged.isEmpty():
                merged.unpersist()
                break
            new = update(state)
            met = v.join(merged, "id", "left")
            v = loop.step(met.select("id", *[new.get(c, F.col(c)).alias(c) for c in v.columns if c != "id"]), (parts, "id"))
            merged.unpersist()
            if next_state is not None:
                state = next_state(state)
        return loop.finish(v)


def sent(v: DataFrame, e: DataFrame, message: Column) -> DataFrame:
    """(id, msg): the messages of one superstep of ``message_loop``."""
    named = set(re.findall(r"\b(?:src|dst)_\w+", str(message)))
    triplets = e
    for side in ("src", "dst"):
        attrs = [c for c in v.columns if f"{side}_{c}" in named]
        if attrs:
            end = v.select(F.col("id").alias(side), *[F.col(c).alias(f"{side}_{c}") for c in attrs])
            triplets = triplets.join(end, side)
    return triplets.select(F.col("dst").alias("id"), message.alias("msg")).where("msg is not null")
