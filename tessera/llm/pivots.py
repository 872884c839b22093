"""SimHash near-duplicates by pivot distance tables.

*Fingerprint.* XXH64 (seed 42) of every 4-word shingle of the lower-cased text,
repeats included; a bit of the fingerprint is 1 if it is set in over half of the
hashes. Two fingerprints are linked if at most ``radius`` bits differ.

*Table.* For every distinct fingerprint the Hamming distances to ``PIVOTS``
reference fingerprints are taken once, apart for each of ``radius`` + 1 parts of
the bits. Distances are additive over the parts and obey the triangle
inequality, so a pair within the radius

* has a part without a differing bit, and there the same distance to every
  pivot (largest coordinate difference 0): the packed distances of a part are an
  equi-join key, and only fingerprints that share one are looked at;
* differs by at most the radius in every whole distance: other pairs are
  discarded by their largest coordinate difference, pivot by pivot.

Survivors are verified bit by bit. No pair is lost at any size.

*Groups.* A bucket is searched from one fingerprint after the other for those not
reached yet, so a dense group costs about its size, and it returns a star for
each component found in it, never pairs. A bucket of more than ``bucket``
fingerprints is dealt again by the bits that it does not share, in ``radius`` + 1
new parts: the same argument holds for them. Each dealing makes ``radius`` + 1 rows
of one, for rows of large buckets only. Fingerprints are distinct, so a bucket with
f free bits has at most 2^f, and dealing ends.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.graph.components import star_components

from .common import Batches, MapFn, mix64, small_batches, sorted_groups, text_bytes, written

SHINGLE = 4
SEED = 42
RADIUS = 4
BITS = 64
PIVOTS = 16
BUCKET = 4096
#: Bytes of text taken at once, and hashes turned into bits at once.
WINDOW = 1 << 20
HASHES = 1 << 15

#: The reference fingerprints: any will do, these are drawn once.
REFERENCES = np.random.Generator(np.random.PCG64(64)).integers(0, 2**64, PIVOTS, dtype=np.uint64)

_BLANK = re.compile(rb"[\x20\x09-\x0D]")


# --- fingerprints -------------------------------------------------------------


def _windows(text: bytes) -> Iterator[list[bytes]]:
    """Words of a text, in windows that overlap by the words of a shingle less one."""
    held: list[bytes] = []
    at = 0
    while at < len(text):
        cut = _BLANK.search(text, at + WINDOW)
        end = cut.start() if cut else len(text)
        words = held + text[at:end].split()
        at = end
        if at >= len(text) or len(words) >= SHINGLE:
            yield words
            words = words[-(SHINGLE - 1) :]
        held = words


def shingle_hashes(text: bytes) -> Iterator[list[int]]:
    """Hashes of the shingles of a text, in bounded lists."""
    first = True
    for words in _windows(text.lower()):
        if len(words) < SHINGLE:
            if first and words:
                yield [xxhash.xxh64_intdigest(b" ".join(words), SEED)]
            continue
        first = False
        line = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        spans = zip(starts[: len(words) - SHINGLE + 1].tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)
        yield [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans]


class _Counts:
    """Bit counts of rows, from hashes that come in bounded lists."""

    def __init__(self, rows: int):
        self.ones, self.n = np.zeros((rows, BITS), np.int64), np.zeros(rows, np.int64)
        self.hashes: list[int] = []
        self.at: list[tuple[int, int]] = []

    def add(self, row: int, hashes: list[int]) -> None:
        for lo in range(0, len(hashes), HASHES):
            part = hashes[lo : lo + HASHES]
            self.at.append((row, len(self.hashes)))
            self.hashes += part
            self.n[row] += len(part)
            if len(self.hashes) >= HASHES:
                self.flush()

    def flush(self) -> None:
        if self.hashes:
            h = np.array(self.hashes, np.uint64)
            bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            rows, starts = zip(*self.at, strict=True)
            np.add.at(self.ones, list(rows), np.add.reduceat(bits, list(starts), axis=0, dtype=np.uint32))
            self.hashes, self.at = [], []

    def fingerprints(self) -> np.ndarray:
        self.flush()
        most = (self.ones * 2 > self.n[:, None]).astype(np.uint8)
        return np.packbits(most, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def text_fingerprints(column: pa.Array) -> np.ndarray:
    """Fingerprint of each text (null or without words: 0)."""
    body, offsets = text_bytes(column)
    counts = _Counts(len(column))
    for i in range(len(column)):
        for hashes in shingle_hashes(body[offsets[i] : offsets[i + 1]].tobytes()):
            counts.add(i, hashes)
    return counts.fingerprints()


def _fingerprint_rows(batches: Batches) -> Batches:
    for b in small_batches(batches, 1):
        fp = text_fingerprints(b.column(1)).view(np.int64)
        yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp)], ["doc_id", "fingerprint"])


# --- buckets ------------------------------------------------------------------


def split_bits(bits: list[int], ways: int) -> list[list[int]]:
    """Bits dealt to ``ways`` parts of about equal size, none empty."""
    return [p for p in (bits[i::ways] for i in range(ways)) if p]


@lru_cache(maxsize=4096)
def free_bits(path: str, ways: int) -> tuple[int, ...]:
    """Bits that the buckets of a path do not share: one part was taken away
    for each digit of the path."""
    bits = list(range(BITS))
    for digit in path:
        taken = set(split_bits(bits, ways)[int(digit)])
        bits = [b for b in bits if b not in taken]
    return tuple(bits)


def part_distances(fp: np.ndarray, bits: list[int]) -> np.ndarray:
    """Distances of a part of at most 15 bits to the pivots, four bits each."""
    mask = np.uint64(sum(1 << b for b in bits))
    key = np.zeros(len(fp), np.uint64)
    for p, pivot in enumerate(REFERENCES):
        key |= np.bitwise_count((fp ^ pivot) & mask).astype(np.uint64) << np.uint64(4 * p)
    return key


def _dealt(ways: int) -> MapFn:
    """Rows (fp, path, node) dealt by parts of the free bits of their path: a
    row for each part, with the number of bits that are free after it."""

    def run(batches: Batches) -> Batches:
        for b in batches:
            paths, at = np.unique(np.array(b.column(1).to_pylist(), dtype=object).astype(str), return_inverse=True)
            fps, nodes = np.asarray(b.column(0)).view(np.uint64), np.asarray(b.column(2)).view(np.uint64)
            for k, path in enumerate(paths.tolist()):
                fp, node = fps[at == k], nodes[at == k]
                bits = list(free_bits(path, ways))
                for i, part in enumerate(split_bits(bits, ways)):
                    to = mix64(node * np.uint64(2 * ways + 1) + mix64(part_distances(fp, part) + np.uint64(i + 1)))
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(fp.view(np.int64)),
                            pa.array([f"{path}{i}"] * len(fp)),
                            pa.array(to.view(np.int64)),
                            pa.array(np.full(len(fp), len(bits) - len(part), np.int32)),
                        ],
                        ["fp", "path", "node", "free"],
                    )

    return run


def buckets(fps: DataFrame, radius: int, bucket: int) -> DataFrame:
    """(fp, path, node): buckets of distinct fingerprints, of at most ``bucket``
    or 2^free of them, whichever is more."""
    rows = fps.select("fp", F.lit("").alias("path"), F.lit(0).cast("long").alias("node"))
    found = None
    while True:
        rows = written(rows.mapInArrow(_dealt(radius + 1), "fp long, path string, node long, free int"), "pivot-rows")
        large = rows.where(F.pow(F.lit(2.0), F.col("free")) > bucket).groupBy("path", "node")
        large = large.agg(F.count(F.lit(1)).alias("members")).where(F.col("members") > bucket)
        large = written(large.select("path", "node"), "pivot-large")
        if large.isEmpty():
            small = rows.select("fp", "path", "node")
            return small if found is None else found.unionByName(small)
        small = rows.join(large, ["path", "node"], "left_anti").select("fp", "path", "node")
        found = small if found is None else found.unionByName(small)
        rows = rows.join(large, ["path", "node"], "left_semi").select("fp", "path", "node")


# --- search in a bucket ---------------------------------------------------------


def distance_table(fp: np.ndarray) -> np.ndarray:
    """(pivot, fingerprint) Hamming distances."""
    return np.bitwise_count(fp[None, :] ^ REFERENCES[:, None]).astype(np.int8)


def linked(table: np.ndarray, fp: np.ndarray, x: np.ndarray, y: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (i, j) of rows x and y within the radius: discarded by the largest
    coordinate difference over the pivots, the rest verified."""
    i, j = np.nonzero(np.abs(table[0, x][:, None] - table[0, y][None, :]) <= radius)
    i, j = x[i], y[j]
    for row in table[1:]:
        left = np.abs(row[i] - row[j]) <= radius
        i, j = i[left], j[left]
        if not len(i):
            return i, j
    near = np.bitwise_count(fp[i] ^ fp[j]) <= radius
    return i[near], j[near]


def stars(fp: np.ndarray, radius: int, chunk: int = 64) -> tuple[np.ndarray, np.ndarray]:
    """(centre, member) for every component of more than one fingerprint."""
    table = distance_table(fp)
    if len(fp) <= 4 * chunk:
        rows = np.arange(len(fp))
        i, j = linked(table, fp, rows, rows, radius)
        some = np.unique(i[i != j])  # rows with a partner
    else:
        some = np.arange(len(fp))
    centres, members = [], []
    left = some
    while len(left):
        seed, left = left[:1], left[1:]
        front = seed
        while len(front) and len(left):
            here, front = front[:chunk], front[chunk:]
            _, j = linked(table, fp, here, left, radius)
            if len(j):
                new = np.unique(j)
                left = left[~np.isin(left, new, assume_unique=True)]
                front = np.concatenate([front, new])
                centres.append(np.repeat(seed, len(new)))
                members.append(new)
    if not members:
        none = np.zeros(0, fp.dtype)
        return none, none
    return fp[np.concatenate(centres)], fp[np.concatenate(members)]


def _bucket_stars(radius: int) -> MapFn:
    def run(batches: Batches) -> Batches:
        for t in sorted_groups(batches, ["node"]):
            if t.num_rows < 2:
                continue
            fp = np.asarray(t.column("fp")).view(np.uint64)
            a, b = stars(fp, radius)
            if len(a):
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["src", "dst"])

    return run


def near_components(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", radius: int = RADIUS, bucket: int = BUCKET
) -> DataFrame:
    """(doc_id, fingerprint long, component_id) of every row: the smallest id that
    is reachable over links, the row's own included.

    Null and empty texts have fingerprint 0 and are linked like any other; texts
    of one to three words have one shingle. Rows with a null id take part and get
    the smallest id of their component; where none has an id it is null. Equal
    texts, repeated rows and ties share a fingerprint and a component. An empty
    table gives an empty result."""
    spark = docs.sparkSession
    n_tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    prints = written(rows.mapInArrow(_fingerprint_rows, "doc_id long, fingerprint long"), "pivot-prints")
    fps = prints.groupBy(F.col("fingerprint").alias("fp")).agg(F.min("doc_id").alias("least"))
    fps = written(fps, "pivot-fingerprints")
    found = (
        buckets(fps, radius, bucket)
        .select("fp", "node")
        .repartition(n_tasks, "node")
        .sortWithinPartitions("node")
        .mapInArrow(_bucket_stars(radius), "src long, dst long")
    )
    comp = star_components(written(found.distinct(), "pivot-stars"))
    member = fps.join(comp.withColumnRenamed("id", "fp"), "fp").select("fp", "least", "component")
    member = written(member, "pivot-members")
    low = member.groupBy("component").agg(F.min("least").alias("component_id"))
    joined = member.join(low, "component").select("fp", "component_id")
    alone = fps.join(joined.select("fp"), "fp", "left_anti").select("fp", F.col("least").alias("component_id"))
    of = joined.unionByName(alone)
    return prints.join(of, prints["fingerprint"] == of["fp"]).select("doc_id", "fingerprint", "component_id")
