"""Repeated passages by De Bruijn compaction.

The edges of the graph are the k-word windows (k = 20) of all documents; equal
windows are one edge. Long runs of edges repeat together, so the graph is never
written out edge by edge:

1. *Stretches.* In each text consecutive edges that share a minimizer (the
   least hash of their 5-word shingles) form a stretch, a path without a
   branch inside the document. Equal edges share the minimizer, so a minimizer
   that is found at one place only holds no repeated edge and is left after
   one count.
2. *Compaction.* Equal stretches (content hash of all their words) are one
   node with its occurrences; the first occurrence in source order stands for
   all. Only where different stretches share a minimizer (at the ends of a
   repeated passage) are edges looked at singly, once per distinct stretch.
3. *Coordinates.* Every later occurrence is traced back to the coordinates of
   the first one by joins; neighbouring stretches whose source has the same
   displacement compact into one long span. Node and edge keys are 128 bits
   of hash (two content hashes, or a window hash under its minimizer).

A document is a distinct (id, text); a window is earlier if its document has
the smaller id (null last; then by text hash) or, in one document, if it
starts earlier. Null, empty and short texts (under k words) have no windows
and lose nothing. Repeated rows are one document and get equal results.
Memory in a task is bounded by an Arrow batch and by the longest document.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import (
    Batches,
    document_key,
    mix64,
    release,
    run_hashes,
    settle,
    small_batches,
    spread_rows,
    text_bytes,
    word_hashes,
    written,
)

K = 20
SHINGLE = 5


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of ``width`` values from each position on, by doubling."""
    out, size = x, 1
    while size < width:
        step = min(size, width - size)
        nxt = np.full_like(out, np.iinfo(np.uint64).max)
        nxt[: len(out) - step] = out[step:]
        out, size = np.minimum(out, nxt), size + step
    return out


def _windows(column: pa.Array, k: int):
    """Of every window of a batch: row, position in its text, position in the
    batch, minimizer; and the hashes of the batch's words and shingles."""
    h, _, _, rows_at = word_hashes(*text_bytes(column))
    counts = np.maximum(np.diff(rows_at) - (k - 1), 0)
    row, pos = spread_rows(counts)
    at = rows_at[:-1][row] + pos
    shingles = run_hashes(h, SHINGLE, 1) if len(at) else h
    m = _least(shingles, k - SHINGLE + 1)[at] if len(at) else np.zeros(0, np.uint64)
    return row, pos, at, m, h, shingles


def _stretch_starts(row: np.ndarray, m: np.ndarray) -> np.ndarray:
    first = np.ones(len(row), dtype=bool)
    first[1:] = (row[1:] != row[:-1]) | (m[1:] != m[:-1])
    return np.flatnonzero(first)


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _places(k: int):
    """Document and minimizer, once for every shingle position that is the
    minimizer of a window: also repeats inside one stretch count."""

    def run(batches: Batches) -> Batches:
        for b in small_batches(batches, 2):
            row, _, at, m, _, shingles = _windows(b.column(2), k)
            if len(at) == 0:
                continue
            most = np.zeros_like(shingles)  # the largest minimizer of the windows over a shingle
            most[at] = m
            owner = np.zeros(len(shingles), np.int64)
            owner[at] = row
            size, width = 1, k - SHINGLE + 1
            while size < width:
                step = min(size, width - size)
                most[step:] = np.maximum(most[step:], most[:-step])
                owner[step:] = np.maximum(owner[step:], owner[:-step])
                size += step
            place = np.flatnonzero((most == shingles) & (most > 0))
            yield pa.RecordBatch.from_arrays(
                [b.column(0).take(owner[place]), b.column(1).take(owner[place]), _long(shingles[place])],
                ["k_id", "k_tie", "m"],
            )

    return run


def _stretches(k: int):
    """Stretches of the minimizers listed for each document, with the hashes
    of their windows."""

    def run(batches: Batches) -> Batches:
        for b in small_batches(batches, 2):
            row, pos, at, m, h, _ = _windows(b.column(2), k)
            s = _stretch_starts(row, m)
            if len(s) == 0:
                continue
            # (row, minimizer) pairs that are listed
            marks = b.column(3)
            listed = np.asarray(marks.flatten()).view(np.uint64)
            owner = np.repeat(np.arange(len(marks)), np.diff(np.asarray(marks.offsets)))
            wanted = np.unique(mix64(listed + np.uint64(1)) ^ mix64(owner.astype(np.uint64)))
            have = mix64(m[s] + np.uint64(1)) ^ mix64(row[s].astype(np.uint64))
            keep = np.isin(have, wanted)
            if not keep.any():
                continue
            ends = np.append(s[1:], len(row))
            lens = ends - s
            w = run_hashes(h, k, 2)[at]
            _, within = spread_rows(lens)
            h1 = np.add.reduceat(mix64(w + np.uint64(0x51ED27)) * (2 * within + 1).astype(np.uint64), s)
            h2 = np.add.reduceat(mix64(w ^ mix64(within.astype(np.uint64) + np.uint64(7))), s)
            s, lens, h1, h2 = s[keep], lens[keep], h1[keep], h2[keep]
            which, off = spread_rows(lens)
            flat = w[s[which] + off]
            # stretches that meet one of their own edges again
            seen = np.sort(mix64(flat ^ mix64(which.astype(np.uint64))))
            again = np.unique(seen[1:][seen[1:] == seen[:-1]])
            loops = np.zeros(len(s), dtype=bool)
            loops[which[np.isin(mix64(flat ^ mix64(which.astype(np.uint64))), again)]] = True
            lists = pa.ListArray.from_arrays(
                pa.array(np.concatenate([[0], np.cumsum(lens)]).astype(np.int32)), _long(flat)
            )
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0).take(row[s]),
                    b.column(1).take(row[s]),
                    pa.array(pos[s].astype(np.int32)),
                    pa.array(lens.astype(np.int32)),
                    _long(m[s]),
                    _long(mix64(h1)),
                    _long(mix64(h2)),
                    pa.array(loops),
                    lists,
                ],
                ["k_id", "k_tie", "start", "n", "m", "h1", "h2", "loops", "edges"],
            )

    return run


def later_windows(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Runs of windows that occur earlier: (k_id, k_tie, start, n, src_id,
    src_tie, src_start): n windows from word ``start`` on equal those from
    word ``src_start`` of the source document on. ``feeds`` are the scratch
    tables it reads."""
    spark = docs.sparkSession
    keyed = docs.select(*document_key(id_col, text), F.coalesce(F.col(text), F.lit("")).alias("text"))
    places = written(keyed.mapInArrow(_places(k), "k_id long, k_tie int, m long"), "repeats-places")
    repeated = written(
        places.groupBy("m").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("m"),
        "repeats-minimizers",
    )
    settle(spark)
    marked = written(
        places.join(repeated, "m", "left_semi").groupBy("k_id", "k_tie").agg(F.collect_set("m").alias("ms")),
        "repeats-marks",
    )
    release(places, repeated)
    settle(spark)
    parts = written(
        keyed.join(marked, ["k_id", "k_tie"])
        .select("k_id", "k_tie", "text", "ms")
        .mapInArrow(
            _stretches(k),
            "k_id long, k_tie int, start int, n int, m long, h1 long, h2 long, loops boolean, edges array<long>",
        ),
        "repeats-stretches",
    )
    release(marked)
    settle(spark)
    here = F.struct("k_id", "k_tie", "start")
    nodes = written(
        parts.groupBy("m", "h1", "h2").agg(F.min(here).alias("first"), F.max("loops").alias("loops")),
        "repeats-nodes",
    )
    # Nodes with edges that may be in others: those that share a minimizer or loop.
    shared = written(
        nodes.groupBy("m")
        .agg(F.count(F.lit(1)).alias("c"), F.max("loops").alias("l"))
        .where("c > 1 or l")
        .select("m", F.lit(True).alias("open")),
        "repeats-open",
    )
    all_nodes, nodes = nodes, nodes.drop("loops").join(shared, "m", "left")
    is_first = here == F.col("first")
    traced = written(
        parts.drop("loops")
        .join(nodes, ["m", "h1", "h2"])
        .where(~is_first | F.coalesce(F.col("open"), F.lit(False)))
        .withColumn("edges", F.when(is_first, F.col("edges")))
        .drop("h1", "h2", "open"),
        "repeats-traced",
    )
    release(parts, all_nodes, shared)
    settle(spark)
    # Whole stretches: every occurrence but the first.
    source = [
        F.col("first.k_id").alias("src_id"), F.col("first.k_tie").alias("src_tie"), F.col("first.start").alias("src_start"),
    ]
    whole = traced.where(~is_first).select("k_id", "k_tie", "start", "n", *source)
    # Single edges: those of the first occurrences.
    edges = traced.where(is_first).select("m", "k_id", "k_tie", "start", F.posexplode("edges").alias("i", "w"))
    edges = edges.select("m", "w", "k_id", "k_tie", (F.col("start") + F.col("i")).alias("start"))
    firsts = written(
        edges.groupBy("m", "w")
        .agg(F.min(here).alias("first"), F.count(F.lit(1)).alias("c"))
        .where("c > 1")
        .drop("c"),
        "repeats-first-edges",
    )
    single = edges.join(firsts, ["m", "w"]).where(here != F.col("first"))
    single = single.select("k_id", "k_tie", "start", F.lit(1).alias("n"), *source)
    out = whole.unionByName(single)
    out.feeds = [traced, firsts]
    return out


def repeated_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K) -> DataFrame:
    """Compacted paths: neighbouring runs with one source and displacement are
    one span (k_id, k_tie, start, n, src_id, src_tie, src_start) of n windows,
    that is n + k - 1 words."""
    order = Window.partitionBy("k_id", "k_tie").orderBy("start", "n")
    shift = F.col("start") - F.col("src_start")
    same = (
        (F.lag("src_id").over(order) == F.col("src_id"))
        & (F.lag("src_tie").over(order) == F.col("src_tie"))
        & (F.lag(shift).over(order) == shift)
        & (F.lag(F.col("start") + F.col("n")).over(order) >= F.col("start"))
    )
    later = later_windows(docs, id_col, text, k)
    runs = later.dropDuplicates(["k_id", "k_tie", "start", "n"])
    path = F.sum(F.when(same, 0).otherwise(1)).over(order)
    out = (
        runs.withColumn("_path", path)
        .groupBy("k_id", "k_tie", "_path")
        .agg(
            F.min("start").alias("start"),
            (F.max(F.col("start") + F.col("n")) - F.min("start")).alias("n"),
            F.first("src_id").alias("src_id"),
            F.first("src_tie").alias("src_tie"),
            F.min("src_start").alias("src_start"),
        )
        .drop("_path")
    )
    out.feeds = later.feeds
    return out


def _kept(k: int):
    def run(batches: Batches) -> Batches:
        for b in small_batches(batches, 1):
            body, offsets = text_bytes(b.column(1))
            _, starts, ends, rows_at = word_hashes(body, offsets)
            raw, spans = body.tobytes(), b.column(2).to_pylist()
            n_words, removed, digest, kept_text = [], [], [], []
            for i, runs in enumerate(spans):
                lo, hi = int(rows_at[i]), int(rows_at[i + 1])
                keep = np.ones(hi - lo, dtype=bool)
                for r in runs or ():
                    keep[r["start"] : r["start"] + r["n"] + k - 1] = False
                left = b" ".join(
                    raw[s:e] for s, e in zip(starts[lo:hi][keep].tolist(), ends[lo:hi][keep].tolist(), strict=True)
                )
                n_words.append(hi - lo)
                removed.append(int((~keep).sum()))
                digest.append(hashlib.sha256(left).hexdigest())
                kept_text.append(left.decode())
            yield pa.RecordBatch.from_arrays(
                [
                    b.column(0),
                    pa.array(n_words, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(digest, pa.string()),
                    pa.array(kept_text, pa.string()),
                ],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"],
            )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", k: int = K, with_text: bool = True
) -> DataFrame:
    """Each document without the words of its repeated windows: doc_id,
    n_words, n_removed, kept_sha256 and, if asked for, the kept text."""
    paths = repeated_spans(docs, id_col, text, k)
    spans = written(
        paths.groupBy("k_id", "k_tie")
        .agg(F.collect_list(F.struct("start", "n")).alias("spans")),
        "repeats-spans",
    )
    release(*paths.feeds)
    settle(docs.sparkSession)
    keyed = docs.select(
        F.col(id_col).cast("long").alias("doc_id"),
        *document_key(id_col, text),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    out = (
        keyed.join(spans, ["k_id", "k_tie"], "left")
        .select("doc_id", "text", "spans")
        .mapInArrow(
            _kept(k),
            "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string",
        )
    )
    return out if with_text else out.drop("kept")
