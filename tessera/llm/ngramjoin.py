"""Similarity self-join of word n-gram sets by chosen paths.

Finds all pairs of documents whose sets of five-word shingles have a Jaccard
similarity of 0.8 or more, and reports one row per document: its class (the
least id of all documents connected by such links) and its number of links.

1. *Classes of equal sets* are found by a 128-bit hash of the set; one
   representative goes on. Each gets 64 minhashes: two sets agree in each with
   a probability equal to their similarity.
2. *Chosen paths.* A run splits all sets by the minhash at a coordinate that the
   run chooses; every bucket that is still large chooses coordinates of its own
   (one, and a second in a quarter of the cases: 1/0.8 expected) and is split
   again. Buckets of at most ``bucket`` sets are compared by brute force on
   their minhashes, generously (estimate 0.58 and more), and give a spanning
   forest of the candidate pairs. A pair of similarity 0.8 shares a bucket of a
   given run with probability 0.8 per split, so the number of runs follows from
   the target recall: the least for which 1 - (1 - 0.8^d)^runs reaches it at
   d = ``SPLITS`` splits.
   Near copies never part, however often they are split. So before a large bucket
   is split, one of its sets stands for it: the sets whose estimate with that one
   reaches the similarity are tied to it as candidates and leave the bucket, and
   only the rest and the head go on. A group of near copies is gone in a step or
   two, and its rows grow with its size. Each run and bucket has a head of its own.
   Buckets that do not get small in ``depth`` splits are dealt out in blocks,
   each pair of blocks being one group, so none is dropped.
3. *Verification.* The sets of each candidate component are brought together
   once, in blocks of ``block`` sets, and the exact similarity of all pairs
   in it is counted. Pairs are counted where they are found and never written:
   a task returns a number of links per document and a spanning forest.

A document is a distinct (id, text). Texts of one to four words have one
shingle of all their words; texts without words have no links and are a class
of their own. Null ids are kept and sorted last. Repeated rows are one document.
Work in a group of near copies grows with the square of its size, in blocks
spread over the cluster; rows do not.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import (
    Batches,
    document_key,
    mix64,
    run_hashes,
    settle,
    small_batches,
    sorted_groups,
    spread_rows,
    text_bytes,
    whole_row,
    word_hashes,
    written,
)

SHINGLE = 5
COORDINATES = 64
RECALL = 0.99998
SPLITS = 3
BUCKET = 1024
DEPTH = 12
BLOCK = 1024
SIMILAR = 0.8
CANDIDATE = 0.58
KEY = ["k_id", "k_tie"]

_rng = np.random.Generator(np.random.PCG64(8086))
_MULT = _rng.integers(1, 2**63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 2**63, COORDINATES, dtype=np.uint64)


# --- shingle sets and minhashes ---------------------------------------------


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each row, end to end, and offsets."""
    h, _, _, rows_at = word_hashes(*text_bytes(column))
    n_words = np.diff(rows_at)
    counts = np.maximum(n_words - (SHINGLE - 1), 0)
    row, pos = spread_rows(counts)
    full = run_hashes(h, SHINGLE, 3)[rows_at[:-1][row] + pos] if len(row) else np.zeros(0, np.uint64)
    few = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    short = []
    for i in few:
        x = n_words[i : i + 1].astype(np.uint64)
        for at in range(rows_at[i], rows_at[i + 1]):
            x = mix64(x * np.uint64(31) + h[at : at + 1])
        short.append(x[0])
    row = np.concatenate([row, few])
    full = np.concatenate([full, np.array(short, np.uint64)])
    order = np.lexsort((full, row))
    row, full = row[order], full[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (full[1:] != full[:-1])
    row, full = row[new], full[new]
    return full, np.searchsorted(row, np.arange(len(column) + 1))


def minhashes(sets: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """COORDINATES minhashes (32 bits) of each non-empty set."""
    out = np.zeros((len(offsets) - 1, COORDINATES), np.uint32)
    filled = offsets[:-1] < offsets[1:]
    if filled.any():
        at = offsets[:-1][filled]
        for c in range(COORDINATES):
            z = sets * _MULT[c] + _ADD[c]
            z = (z ^ (z >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
            out[filled, c] = np.minimum.reduceat(z >> np.uint64(32), at).astype(np.uint32)
    return out


def _signatures(batches: Batches) -> Batches:
    for b in small_batches(batches, 2, 1 << 18):
        sets, off = shingle_sets(b.column(2))
        sig = minhashes(sets, off)
        filled = off[:-1] < off[1:]
        k1, k2 = np.zeros(len(filled), np.uint64), np.zeros(len(filled), np.uint64)
        if filled.any():
            k1[filled] = np.add.reduceat(mix64(sets + np.uint64(0x1234567)), off[:-1][filled])
            k2[filled] = np.add.reduceat(mix64(sets ^ np.uint64(0xABCDEF987654321)), off[:-1][filled])
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                b.column(1),
                pa.array(np.diff(off).astype(np.int32)),
                pa.array(k1.view(np.int64)),
                pa.array(k2.view(np.int64)),
                pa.array([r.tobytes() for r in sig], pa.binary()),
            ],
            ["k_id", "k_tie", "size", "s1", "s2", "sig"],
        )


# --- paths ------------------------------------------------------------------


def _coordinate(node, salt: int):
    return F.pmod(F.xxhash64(node, F.lit(salt)), F.lit(COORDINATES)).cast("int")


def _minhash(at):
    """The minhash at a coordinate, from the packed signature."""
    return F.substring(F.col("sig"), at * 4 + 1, 4)


def runs_for(recall: float, similar: float = SIMILAR, splits: int = SPLITS) -> int:
    """Runs that find a pair of the least similarity with the target recall, if
    its buckets are split ``splits`` times."""
    if not 0 < recall < 1:
        raise ValueError("recall: between 0 and 1")
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - similar**splits) - 1e-9))


def _heads(rows: DataFrame) -> DataFrame:
    """Rows (k_id, k_tie, node, sig) with the head of their bucket, h_id, h_tie
    and h_sig: the set of the least hash."""
    pick = F.xxhash64("node", *KEY)
    head = F.min_by(F.struct(*KEY, "sig"), F.struct(pick, *KEY)).alias("h")
    heads = rows.groupBy("node").agg(head).select(
        "node", F.col("h.k_id").alias("h_id"), F.col("h.k_tie").alias("h_tie"), F.col("h.sig").alias("h_sig")
    )
    return rows.join(heads, "node")


def _alike(least: float):
    """Adds whether a set is like the head of its bucket."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            if b.num_rows == 0:
                continue
            names = b.schema.names
            x, y = (
                np.frombuffer(b"".join(b.column(names.index(c)).to_pylist()), np.uint32).reshape(b.num_rows, -1)
                for c in ("sig", "h_sig")
            )
            keep = [i for i, c in enumerate(names) if c not in ("sig", "h_sig")]
            alike = pa.array((x == y).mean(axis=1) >= least)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), alike], [*(names[i] for i in keep), "alike"])

    return run


def _buckets(reps: DataFrame, runs: int, bucket: int, depth: int, similar: float = SIMILAR) -> tuple[DataFrame, DataFrame]:
    """(k_id, k_tie, node, a, b): small buckets with two sets and more, and block
    pairs of those that stay large; and the candidate pairs (a_id, a_tie, b_id,
    b_tie) of the sets that were tied to a head."""
    run = F.explode(F.sequence(F.lit(0), F.lit(runs - 1)))
    rows = reps.select(*KEY, "sig", run.alias("run"))
    # Runs start at different coordinates.
    rows = rows.select(
        *KEY, F.xxhash64("run", _minhash(F.pmod(F.col("run") * 37, F.lit(COORDINATES)))).alias("node")
    )
    found = tied = None
    for level in range(depth + 1):
        sizes = rows.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
        sizes = written(sizes, "join-sizes")
        here = written(rows.join(sizes, "node"), "join-members")
        small = here.where(F.col("members") <= bucket).select(*KEY, "node", F.lit(0).alias("a"), F.lit(0).alias("b"))
        found = small if found is None else found.unionByName(small)
        large = here.where(F.col("members") > bucket)
        if large.isEmpty():
            break
        headed = _heads(large.join(reps, KEY).select(*KEY, "node", "sig"))
        headed = written(
            headed.mapInArrow(_alike(similar), "node long, k_id long, k_tie int, h_id long, h_tie int, alike boolean"),
            "join-headed",
        )
        head = F.struct("h_id", "h_tie") == F.struct(*KEY)
        to_head = headed.where(F.col("alike") & ~head).select(
            F.col("k_id").alias("a_id"), F.col("k_tie").alias("a_tie"), F.col("h_id").alias("b_id"), F.col("h_tie").alias("b_tie")
        )
        tied = to_head if tied is None else tied.unionByName(to_head)
        left = headed.where(~F.col("alike") | head).select(*KEY, "node")
        if level == depth:
            sizes = left.groupBy("node").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
            last = left.join(sizes, "node")
            found = found.unionByName(_block_pairs(last, ["node"], "members", bucket).select(*KEY, "node", "a", "b"))
            break
        node = F.col("node")
        again = F.pmod(F.xxhash64("node", F.lit("twice")), F.lit(4)) == 0
        picks = F.when(again, F.array(_coordinate(node, 1), _coordinate(node, 2))).otherwise(
            F.array(_coordinate(node, 1))
        )
        rows = left.join(reps, KEY).select(*KEY, "sig", "node", F.explode(picks).alias("at")).select(
            *KEY, F.xxhash64("node", "at", _minhash(F.col("at"))).alias("node")
        )
    if tied is None:
        tied = found.sparkSession.createDataFrame([], EDGE_SCHEMA)
    return found, tied


def _block_pairs(rows: DataFrame, group: list[str], members: str, block: int) -> DataFrame:
    """Deal each group's rows to blocks of about ``block`` rows and repeat each
    for all pairs (a, b) of blocks that it takes part in; ``own`` is its block."""
    n = F.ceil(F.col(members) / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64(*KEY, F.lit("block")), n).cast("int")
    return (
        rows.withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), n - 1)))
        .withColumn("a", F.least("own", "other"))
        .withColumn("b", F.greatest("own", "other"))
        .drop("other")
    )


class _Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def link(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        roots = np.array([self.root(i) for i in range(len(self.up))])
        child = np.flatnonzero(roots != np.arange(len(roots)))
        return child, roots[child]


EDGE_SCHEMA = "a_id long, a_tie int, b_id long, b_tie int"


def _edge_batch(ids: np.ndarray, ties: np.ndarray, forest: _Forest) -> pa.RecordBatch:
    x, y = forest.edges()
    return pa.RecordBatch.from_arrays(
        [pa.array(ids[x]), pa.array(ties[x]), pa.array(ids[y]), pa.array(ties[y])],
        ["a_id", "a_tie", "b_id", "b_tie"],
    )


def _candidates(least: float):
    def run(batches: Batches) -> Batches:
        for t in sorted_groups(batches, ["node", "a", "b"]):
            if t.num_rows < 2:
                continue
            sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint32).reshape(t.num_rows, -1)
            forest = _Forest(len(sig))
            for i in range(1, len(sig)):
                alike = (sig[:i] == sig[i]).mean(axis=1) >= least
                for j in np.flatnonzero(alike):
                    forest.link(i, int(j))
            ids, ties = np.asarray(t.column("k_id")), np.asarray(t.column("k_tie"))
            out = _edge_batch(ids, ties, forest)
            if out.num_rows:
                yield out

    return run


# --- components -------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(k_id, k_tie, r_id, r_tie): each vertex of an edge and the least vertex of
    its component, by alternating large and small stars to the fixed point."""
    a, b = F.struct(F.col("a_id").alias("id"), F.col("a_tie").alias("tie")), F.struct(
        F.col("b_id").alias("id"), F.col("b_tie").alias("tie")
    )
    pairs = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u != v").distinct()
    pairs = written(pairs, "join-pairs")
    state = None
    while True:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = written(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "join-low")
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = written(large.where("u != v").distinct(), "join-large")
        low = written(large.groupBy("u").agg(F.min("v").alias("m")), "join-low")
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(low.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        pairs = written(small, "join-small")
        now = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    member = pairs.select("u", "v").unionByName(pairs.select(F.col("v").alias("u"), "v").distinct())
    return member.select(
        F.col("u.id").alias("k_id"), F.col("u.tie").alias("k_tie"), F.col("v.id").alias("r_id"), F.col("v.tie").alias("r_tie")
    )


# --- exact links ------------------------------------------------------------


def _intersections(x: list[np.ndarray]) -> np.ndarray:
    """Sizes of all pairwise intersections, by column blocks of the incidence matrix."""
    lens = np.array([len(s) for s in x])
    flat = np.concatenate(x) if len(x) else np.zeros(0, np.uint64)
    row = np.repeat(np.arange(len(x)), lens)
    shared, at, counts = np.unique(flat, return_inverse=True, return_counts=True)
    keep = counts[at] > 1
    column = np.cumsum(counts > 1) - 1
    row, col = row[keep], column[at[keep]]
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = 4096
    out = np.zeros((len(x), len(x)), np.float32)
    for lo in range(0, int((counts > 1).sum()), width):
        s, e = np.searchsorted(col, [lo, lo + width])
        m = np.zeros((len(x), width), np.float32)
        m[row[s:e], col[s:e] - lo] = 1
        out += m @ m.T
    return out


LINK_SCHEMA = "a_id long, a_tie int, b_id long, b_tie int, links long"


def _links(similar: float):
    """For each group: links of its sets (a_id, a_tie, null, null, links) and a
    spanning forest of the linked ones (links null)."""

    def run(batches: Batches) -> Batches:
        for t in sorted_groups(batches, ["r_id", "r_tie", "a", "b"]):
            sets = [np.frombuffer(s, np.uint64) for s in t.column("shingles").to_pylist()]
            n = len(sets)
            if n < 2:
                continue
            lens = np.array([len(s) for s in sets], float)
            own, copies = np.asarray(t.column("own")), np.asarray(t.column("copies"))
            if n == 2:
                both = np.zeros((2, 2))
                both[0, 1] = both[1, 0] = len(np.intersect1d(*sets, assume_unique=True))
            else:
                both = _intersections(sets).astype(float)
            linked = both >= similar * (lens[:, None] + lens[None, :] - both) - 1e-9
            np.fill_diagonal(linked, False)
            if t.column("a")[0] != t.column("b")[0]:
                linked &= own[:, None] != own[None, :]  # pairs inside a block are counted with it
            links = linked.astype(np.int64) @ copies.astype(np.int64)
            forest = _Forest(n)
            for i, j in zip(*np.nonzero(np.triu(linked)), strict=True):
                forest.link(int(i), int(j))
            ids, ties = np.asarray(t.column("k_id")), np.asarray(t.column("k_tie"))
            some = np.flatnonzero(links)
            none = pa.nulls(len(some), pa.int64())
            names = ["a_id", "a_tie", "b_id", "b_tie", "links"]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[some]), pa.array(ties[some]), none, pa.nulls(len(some), pa.int32()), pa.array(links[some])],
                names,
            )
            e = _edge_batch(ids, ties, forest)
            yield pa.RecordBatch.from_arrays([*e.columns, pa.nulls(e.num_rows, pa.int64())], names)

    return run


def _packed_sets(batches: Batches) -> Batches:
    for b in small_batches(batches, -1):
        sets, off = shingle_sets(b.column(b.num_columns - 1))
        packed = [sets[s:e].tobytes() for s, e in zip(off[:-1], off[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [*b.columns[:-1], pa.array(packed, pa.binary())], [*b.schema.names[:-1], "shingles"]
        )


def similarity_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    similar: float = SIMILAR,
    recall: float = RECALL,
    bucket: int = BUCKET,
    depth: int = DEPTH,
    block: int = BLOCK,
) -> DataFrame:
    """(k_id, k_tie, c_id, c_tie, n_links) of every distinct document: the
    least document of its class and the number of documents linked to it."""
    spark = docs.sparkSession
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    keyed = docs.select(*document_key(id_col, text), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))
    sigs = written(
        keyed.mapInArrow(_signatures, "k_id long, k_tie int, size int, s1 long, s2 long, sig binary"),
        "join-signatures",
    )
    # Equal sets: the least document stands for all of them.
    sets = written(
        sigs.where("size > 0").select(*KEY, "s1", "s2").distinct()
        .groupBy("s1", "s2")
        .agg(F.min(F.struct(*KEY)).alias("rep"), F.count(F.lit(1)).alias("copies")),
        "join-sets",
    )
    members = sigs.where("size > 0").select(*KEY, "s1", "s2").distinct().join(sets, ["s1", "s2"])
    members = members.select(*KEY, F.col("rep.k_id").alias("p_id"), F.col("rep.k_tie").alias("p_tie"), "copies")
    heads = sets.select("rep.*", "copies")
    reps = written(sigs.select(*KEY, "sig").dropDuplicates(KEY).join(heads, KEY), "join-reps")

    buckets, tied = _buckets(reps.select(*KEY, "sig"), runs_for(recall, similar), bucket, depth, similar)
    near = (
        buckets.join(reps.select(*KEY, "sig"), KEY)
        .repartition(n_tasks, "node", "a", "b")
        .sortWithinPartitions("node", "a", "b", *KEY)
        .mapInArrow(_candidates(CANDIDATE), EDGE_SCHEMA)
    )
    near = written(near.unionByName(tied).distinct(), "join-near")
    settle(spark)
    comp = components(near)
    sizes = written(comp.groupBy("r_id", "r_tie").agg(F.count(F.lit(1)).alias("members")), "join-components")
    comp = written(comp.join(sizes, ["r_id", "r_tie"]).join(reps.select(*KEY, "copies"), KEY), "join-component-members")
    # Merged at every size: near copies are too many to broadcast on large inputs.
    texts = keyed.join(comp.hint("merge"), KEY).dropDuplicates(KEY)
    packed = texts.select(*KEY, "r_id", "r_tie", "members", "copies", "text").mapInArrow(
        _packed_sets,
        "k_id long, k_tie int, r_id long, r_tie int, members long, copies long, shingles binary",
    )
    packed = written(packed, "join-shingles")
    settle(spark)
    groups = _block_pairs(packed, ["r_id", "r_tie"], "members", block)
    counted = written(
        groups.repartition(n_tasks, "r_id", "r_tie", "a", "b")
        .sortWithinPartitions("r_id", "r_tie", "a", "b", *KEY)
        .mapInArrow(_links(similar), LINK_SCHEMA),
        "join-links",
    )
    links = counted.where("links is not null").groupBy(
        F.col("a_id").alias("p_id"), F.col("a_tie").alias("p_tie")
    ).agg(F.sum("links").alias("links"))
    roots = components(counted.where("links is null").select("a_id", "a_tie", "b_id", "b_tie"))
    roots = roots.select(F.col("k_id").alias("p_id"), F.col("k_tie").alias("p_tie"), "r_id", "r_tie")
    out = members.join(links, ["p_id", "p_tie"], "left").join(roots, ["p_id", "p_tie"], "left").select(
        *KEY,
        F.coalesce("r_id", "p_id").alias("c_id"),
        F.coalesce("r_tie", "p_tie").alias("c_tie"),
        (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
    )
    alone = sigs.where("size = 0").select(*KEY).distinct().select(
        *KEY, F.col("k_id").alias("c_id"), F.col("k_tie").alias("c_tie"), F.lit(0).cast("long").alias("n_links")
    )
    return written(out.unionByName(alone), "join-classes")


def one_of_each_class(docs: DataFrame, id_col: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Rows of ``docs`` with the least document of every class only; of
    repeated rows one."""
    classes = similarity_classes(docs, id_col, text, **options)
    first = classes.where("k_id = c_id and k_tie = c_tie").select(*KEY)
    keyed = docs.select(whole_row(docs), *document_key(id_col, text)).dropDuplicates(KEY)
    return keyed.join(first, KEY, "left_semi").select("row.*")
