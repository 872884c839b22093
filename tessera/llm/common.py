"""Helpers shared by the text-collection operators.

``WORD`` is the word pattern of all of them: runs of anything but ASCII white
space. Intermediate tables are written as Parquet into the session's shared
checkpoint folder (never a machine-local one), so a lost executor costs a
re-read and not a re-computation.
"""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

WORD = r"[^\x20\x09-\x0D]+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def words_of(text: Column) -> Column:
    """Array of the words of a text; null text has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a step into the shared scratch folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.scratch = path
    return back


def release(*tables: DataFrame) -> None:
    """Delete scratch tables that no later step reads."""
    for t in tables:
        spark = t.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(t.scratch)
        path.getFileSystem(spark._jsc.sc().hadoopConfiguration()).delete(path, True)


def settle(spark: SparkSession) -> None:
    """Drop references to finished steps, so that Spark's context cleaner can
    delete their shuffle files before the next large step writes its own."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


#: Document keys from here on stand for null ids; no id may reach it.
NULL_FROM = 2**63 - 2**60


def document_key(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    """(k_id, k_tie): a document is a distinct (id, text). Documents without an
    id sort last, each with a key of 92 bits of its text's hashes, so different
    texts do not fall together. Repeated rows share a key, so a document is never
    its own copy. An id of ``NULL_FROM`` or more is an error."""
    own, text = F.col(f"`{id_col}`").cast("long"), F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    unnamed = F.lit(NULL_FROM) + F.shiftrightunsigned(F.xxhash64(text), 4)
    too_large = F.raise_error(F.lit(f"document ids must be below {NULL_FROM}")).cast("long")
    return [
        F.when(own.isNull(), unnamed).when(own < NULL_FROM, own).otherwise(too_large).alias("k_id"),
        F.hash(text).alias("k_tie"),
    ]


def id_of(key: str | Column) -> Column:
    """The id of a document key: null for documents without one."""
    k = F.col(key) if isinstance(key, str) else key
    return F.when(k < NULL_FROM, k)


def whole_row(df: DataFrame) -> Column:
    """All columns as one struct ``row``, out of the way of an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("row")


def global_rank(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """Dense 0-based position of every row in a total order without a single
    task: range partitions, a rank inside each, and the sum of the partitions
    before it (one row per partition)."""
    spark = df.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    parts = written(
        df.repartitionByRange(n, *order).withColumn("_part", F.spark_partition_id()), "ranked"
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    base = (
        parts.groupBy("_part")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    )
    inside = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return (
        parts.withColumn("_row", inside - 1)
        .join(base, "_part")
        .withColumn(name, F.col("_base") + F.col("_row"))
        .drop("_part", "_row", "_base")
    )


_kept: dict[str, dict] = {}


def worker_cache(owner: str) -> dict:
    """What a Python worker keeps from task to task, for one operator at a time:
    when another one asks, the last one's is dropped."""
    if owner not in _kept:
        _kept.clear()
        gc.collect()
        _kept[owner] = {}
    return _kept[owner]


# --- numpy word hashing -----------------------------------------------------

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_rng = np.random.Generator(np.random.PCG64(20240607))
_BYTE = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_R1 = np.uint64(0x9E3779B97F4A7C15)
_R2 = np.uint64(0xD6E8FEB86659FD93)
_STEP = 1 << 12


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_LOW, _HIGH = _powers(_R1, _STEP), _powers(_R2, _STEP)


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit integers."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a whole Arrow string column and the n+1 offsets of its
    rows in them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("")
    if len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    body = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return body[off[0] : off[-1]], off - off[0]


def small_batches(batches: Iterator[pa.RecordBatch], column: int, limit: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Slices with about ``limit`` bytes of text each, so that the arrays made
    from them stay small; a longer text is a slice of its own."""
    for b in batches:
        if b.num_rows == 0:
            continue
        _, offsets = text_bytes(b.column(column))
        part = offsets[:-1] // limit
        cuts = [0, *(np.flatnonzero(part[1:] != part[:-1]) + 1).tolist(), b.num_rows]
        for s, e in zip(cuts[:-1], cuts[1:], strict=True):
            yield b.slice(s, e - s)


def word_hashes(body: np.ndarray, offsets: np.ndarray):
    """(hash, start byte, end byte) of every word, and the n+1 offsets of the
    rows in words. Vectorised over all texts of a batch."""
    n_rows = len(offsets) - 1
    if len(body) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(n_rows + 1, np.int64)
    inside = ~_SPACE[body]
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edge = offsets[:-1][offsets[:-1] < offsets[1:]]
    first[edge] = inside[edge]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    tail = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    last[tail] = inside[tail]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    if len(starts) == 0:
        z = np.zeros(0, np.int64)
        return np.zeros(0, np.uint64), z, z, np.zeros(n_rows + 1, np.int64)
    lens = ends - starts
    total = int(lens.sum())
    shift = np.cumsum(lens) - lens
    within = np.arange(total) - np.repeat(shift, lens)
    letters = _BYTE[body[inside]] * _LOW[within % _STEP]
    if int(lens.max()) > _STEP:
        letters = letters * _HIGH[(within // _STEP) % _STEP]
    h = mix64(np.add.reduceat(letters, shift) + lens.astype(np.uint64))
    return h, starts, ends, np.searchsorted(starts, offsets)


def run_hashes(h: np.ndarray, k: int, seed: int) -> np.ndarray:
    """Hash of the k words starting at each position (the last k-1 positions
    are not meaningful), by doubling: O(log k) passes."""
    q = np.uint64((0xA0761D6478BD642F ^ (seed * 0x9E3779B97F4A7C15)) & (2**64 - 1) | 1)

    def power(n: int) -> np.uint64:
        return np.uint64(pow(int(q), n, 2**64))

    def shifted(x: np.ndarray, by: int) -> np.ndarray:
        out = np.zeros_like(x)
        if by < len(x):
            out[: len(x) - by] = x[by:]
        return out

    with np.errstate(over="ignore"):
        block, size, out, have = h, 1, None, 0
        while True:
            if k & size:
                out = block if out is None else out + power(have) * shifted(block, have)
                have += size
            if size * 2 > k:
                return mix64(out)
            block = block + power(size) * shifted(block, size)
            size *= 2


def spread_rows(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and position in the row for rows of the given lengths."""
    rows = np.repeat(np.arange(len(counts)), counts)
    return rows, np.arange(len(rows)) - np.repeat(np.cumsum(counts) - counts, counts)


def sorted_groups(
    batches: Iterator[pa.RecordBatch], keys: list[str]
) -> Iterator[pa.Table]:
    """Groups of a partition that is sorted by ``keys``; holds one group and
    one batch at a time."""
    held: list[pa.RecordBatch] = []
    held_key = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        cols = [np.asarray(batch.column(batch.schema.get_field_index(k))) for k in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for c in cols:
            change[1:] |= c[1:] != c[:-1]
        cuts = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            key = tuple(c[a] for c in cols)
            if held and key != held_key:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            held_key = key
    if held:
        yield pa.Table.from_batches(held)


def binary_rows(data: bytes, ends: np.ndarray) -> pa.Array:
    """Arrow binary column over one buffer cut at the given ends."""
    off = np.concatenate([[0], ends]).astype(np.int64)
    return pa.Array.from_buffers(
        pa.large_binary(), len(ends), [None, pa.py_buffer(off), pa.py_buffer(data)]
    ).cast(pa.binary())


Batches = Iterator[pa.RecordBatch]
MapFn = Callable[[Batches], Batches]
