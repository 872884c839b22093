"""Vector code compression: product codes found through memoised grid cells.

A vector of integers is cut into equal consecutive parts, and each part gets
the index of the nearest entry of its position's codebook (squared Euclidean
distance, ties to the lower index).

*Cells.* The components of a part, divided by the cell width and floored, name a
box of the grid. For a box and an entry the least and the greatest distance from
any point of the box to the entry follow component by component. An entry whose
least distance is over the smallest greatest distance of all entries is
dominated across the box: it is nearest to no point in it. So is one that is
farther than some other entry all over the box, by the greatest difference of
the two distances. The entries that are left are a bit mask, kept in a cache by the cell's hash; parts that fall into a
known cell look it up and are compared exactly with those entries only. Ties
cannot be lost, as an entry that ties with the nearest is not dominated.

*Spark.* Integers are written once. Each round is a scan of them by ``mapInArrow``
with the current codebooks (entries x vector length integers) in the task; a
partition returns one row of sums and counts per (part, entry), so what is
shuffled and brought back does not grow with the table. Caches belong to a task
and a codebook, hold at most ``CACHE`` cells, and start again when full: results
do not depend on them.

The masks are exact for any cell width. Wide cells are few and hit often; narrow
ones prune more. ``CELL`` was measured on the test vectors (see the README).
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Batches, MapFn, mix64, written

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
CELL = 768
CACHE = 1 << 16
SLICE = 1 << 13
#: Integer components must stay below, for distances and sums that fit a long.
LIMIT = 1 << 26


def integer_vectors(rows: DataFrame, id_col: str, vector: str, label: str, parts: int, scale: int) -> DataFrame:
    """(vec_id, label, v) of the vectors that can be coded, v = floor(scale * x)
    of every component. Not coded: null vectors, those with a null or non-finite
    component or one out of ``LIMIT``, and those whose length is not the table's
    (the least id's) or no positive multiple of ``parts``."""
    x = F.col(f"`{vector}`").cast("array<double>")
    whole = F.forall(x, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < LIMIT / scale))
    v = F.transform(x, lambda c: F.floor(c * F.lit(float(scale))).cast("long"))
    fit = rows.where(F.col(f"`{vector}`").isNotNull() & whole & (F.size(x) > 0) & (F.size(x) % parts == 0))
    out = written(
        fit.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{label}`").alias("label"), v.alias("v")),
        "codes-integers",
    )
    first = out.orderBy(F.col("vec_id").asc_nulls_last(), "v").select(F.size("v")).first()
    return out.where(F.size("v") == (first[0] if first else 0))


def first_books(vectors: DataFrame, parts: int, entries: int) -> np.ndarray:
    """(part, entry, position) integers: the parts of the least ids' vectors
    (equal ids by vector); fewer entries where there are fewer vectors."""
    least = vectors.orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).select("v").collect()
    if not least:
        return np.zeros((parts, 0, 0), np.int64)
    rows = np.array([r.v for r in least], np.int64)
    return rows.reshape(len(rows), parts, -1).transpose(1, 0, 2).copy()


class CellCache:
    """Masks of the entries of one part's codebook that are not dominated
    across a cell, found by the cell's hash; a hash that another cell holds is
    no hit."""

    def __init__(self, book: np.ndarray, cell: int, limit: int = CACHE):
        self.book, self.cell, self.limit = book, cell, limit
        self.evaluated = self.hits = 0
        self._clear()

    def _clear(self) -> None:
        self.hashes = np.zeros(0, np.uint64)
        self.cells = np.zeros((0, self.book.shape[1]), np.int32)
        self.known = np.zeros(0, np.int64)

    def masks(self, hashes: np.ndarray, cells: np.ndarray) -> np.ndarray:
        """One mask for each of the given cells; ``hashes`` ascend."""
        at = np.searchsorted(self.hashes, hashes)
        hit = at < len(self.hashes)
        hit[hit] = (self.hashes[at[hit]] == hashes[hit]) & (self.cells[at[hit]] == cells[hit]).all(axis=1)
        out = np.empty(len(cells), np.int64)
        out[hit] = self.known[at[hit]]
        self.hits += int(hit.sum())
        new = np.flatnonzero(~hit)
        for lo in range(0, len(new), 1024):
            out[new[lo : lo + 1024]] = self._undominated(cells[new[lo : lo + 1024]])
        if len(self.known) + len(new) > self.limit:
            self._clear()
        to = np.searchsorted(self.hashes, hashes[new])
        self.hashes = np.insert(self.hashes, to, hashes[new])
        self.cells = np.insert(self.cells, to, cells[new], axis=0)
        self.known = np.insert(self.known, to, out[new])
        return out

    def _undominated(self, cells: np.ndarray) -> np.ndarray:
        low = (cells.astype(np.int64) * self.cell)[:, None, :]
        high = low + (self.cell - 1)
        below, above = low - self.book, self.book - high
        near = np.maximum(np.maximum(below, above), 0)
        far = np.maximum(np.abs(below), np.abs(above))
        least, most = (near * near).sum(axis=2), (far * far).sum(axis=2)
        left = least <= most.min(axis=1, keepdims=True)
        # d(x, f) - d(x, e) is linear in x, so each component is greatest at an end.
        at_low, at_high = below * below, above * above
        for f in range(self.book.shape[0]):
            worst = np.maximum(at_low[:, f, None] - at_low, at_high[:, f, None] - at_high).sum(axis=2)
            left &= worst >= 0
        return (left.astype(np.int64) << np.arange(self.book.shape[0])).sum(axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index, squared distance) of the nearest entry of each row of ``x``."""
        cells = np.floor_divide(x, self.cell)
        hashes = mix64(_weights(x.shape[1]) @ cells.T.astype(np.uint64))
        distinct, first, at = np.unique(hashes, return_index=True, return_inverse=True)
        masks = self.masks(distinct, cells[first])[at]
        odd = np.flatnonzero((cells != cells[first][at]).any(axis=1))  # two cells of one hash: all entries
        masks[odd] = (1 << len(self.book)) - 1
        best = np.full(len(x), np.iinfo(np.int64).max)
        index = np.zeros(len(x), np.int64)
        for e in range(len(self.book)):
            rows = np.flatnonzero(masks >> e & 1)
            self.evaluated += len(rows)
            off = x[rows] - self.book[e]
            d = np.einsum("ij,ij->i", off, off)
            closer = d < best[rows]
            best[rows[closer]] = d[closer]
            index[rows[closer]] = e
        return index, best


def _weights(width: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(width)).integers(1, 2**63, width, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _parts_of(batch: pa.RecordBatch, column: int, parts: int) -> np.ndarray:
    """(row, part, position) integers of a slice."""
    values = batch.column(column).flatten()
    return np.asarray(values).reshape(batch.num_rows, parts, -1)


def _slices(batches: Batches) -> Batches:
    for b in batches:
        for lo in range(0, b.num_rows, SLICE):
            yield b.slice(lo, SLICE)


def _sums(books: np.ndarray, cell: int) -> MapFn:
    """Sums and counts per (part, entry) of a partition."""
    parts, entries, width = books.shape

    def run(batches: Batches) -> Batches:
        caches = [CellCache(b, cell) for b in books]
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for b in _slices(batches):
            x = _parts_of(b, 0, parts)
            for p in range(parts):
                index, _ = caches[p].nearest(x[:, p])
                for e in range(entries):
                    total[p, e] += x[index == e, p].sum(axis=0)
                count[p] += np.bincount(index, minlength=entries)
        p, e = np.nonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(p), pa.array(e), pa.array(count[p, e]), pa.array(total[p, e].tolist(), pa.list_(pa.int64()))],
            ["part", "entry", "n", "sums"],
        )

    return run


def _codes(books: np.ndarray, cell: int) -> MapFn:
    """(..., code, error) for (..., v)."""
    parts = len(books)

    def run(batches: Batches) -> Batches:
        caches = [CellCache(b, cell) for b in books]
        for b in _slices(batches):
            x = _parts_of(b, b.num_columns - 1, parts)
            index, error = np.zeros((len(x), parts), np.uint8), np.zeros(len(x), np.int64)
            for p in range(parts):
                index[:, p], d = caches[p].nearest(x[:, p])
                error += d
            code = [r.tobytes().hex() for r in index]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(code, pa.string()), pa.array(error)], [*b.schema.names[:-1], "code", "error"]
            )

    return run


def refine(vectors: DataFrame, books: np.ndarray, cell: int = CELL) -> np.ndarray:
    """Codebooks after one round: every entry becomes the floored mean of the
    parts nearest to it; unused entries stay."""
    schema = "part long, entry long, n long, sums array<long>"
    width = books.shape[2]
    found = vectors.select("v").mapInArrow(_sums(books, cell), schema)
    sums = [F.sum(F.col("sums")[i].cast("decimal(38,0)")).alias(f"s{i}") for i in range(width)]
    out = books.copy()
    # One row per part and entry: bounded by the codebooks.
    for r in found.groupBy("part", "entry").agg(F.sum("n").alias("n"), *sums).collect():
        out[r.part, r.entry] = [int(r[f"s{i}"]) // r.n for i in range(width)]
    return out


def encode(
    rows: DataFrame,
    id_col: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: int = SCALE,
    cell: int = CELL,
) -> DataFrame:
    """(vec_id, label, code, error, label_error, codebooks_sha256) of every
    vector that can be coded (see ``integer_vectors``): its entries' indexes in
    part order, two hex digits each; the squared distances to them; the errors
    summed over its label (null labels together); the digest of the codebooks.

    Repeated rows are coded and counted as often as they stand there. A null id
    is kept and sorts last. An empty table gives an empty result."""
    if not 1 <= entries <= 63:
        raise ValueError("1 to 63 entries")
    vectors = integer_vectors(rows, id_col, vector, label, parts, scale)
    books = first_books(vectors, parts, entries)
    schema = f"vec_id long, label {rows.schema[label].dataType.simpleString()}, code string, error long"
    if books.shape[1] == 0:
        empty = rows.sparkSession.createDataFrame([], schema)
        return empty.select("*", F.col("error").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    for _ in range(rounds):
        books = refine(vectors, books, cell)
    digest = hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()
    coded = written(vectors.select("vec_id", "label", "v").mapInArrow(_codes(books, cell), schema), "codes")
    per_label = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    return coded.join(per_label, F.col("label").eqNullSafe(F.col("of"))).select(
        "vec_id", "label", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256")
    )
