"""Projections on random hyperplanes (numpy, inside tasks)."""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle

# Workers get these functions by value: they need not find the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Occurrences whose signs stand side by side at a time.
OCCURRENCES = 1 << 17


def signs(words: list[bytes], salt: bytes, planes: int) -> np.ndarray:
    """(word, plane) bits of the md5 of each salted word: plane i < 32 is bit i of
    its first four bytes, plane 32 + i of the next four."""
    raw = b"".join([hashlib.md5(salt + w).digest()[:8] for w in words])
    halves = np.frombuffer(raw, ">u4").astype("<u4").view(np.uint8).reshape(len(words), 8)
    return np.unpackbits(halves, axis=1, bitorder="little")[:, :planes]


def projections(planes: int, bands: int, seed: int):
    """For rows (doc_id, tokens), a row (doc_id, band, p0..) for each band of
    those with a token: occurrences above a plane less those below it."""

    def run(batches):
        for b in batches:
            lists = b.column(1)
            ends = np.asarray(lists.offsets).astype(np.int64)
            ends -= ends[0]
            coded = lists.flatten().cast(pa.binary()).dictionary_encode()
            words, at = coded.dictionary.to_pylist(), np.asarray(coded.indices)
            some = np.flatnonzero(np.diff(ends))
            ids = b.column(0).take(pa.array(some))
            for band in range(bands if len(some) else 0):
                bits = signs(words, f"{seed}|{band}|".encode(), planes)
                above = np.zeros((len(some), planes), np.int64)
                first, last = ends[some], ends[some + 1]
                lo = 0
                while lo < len(some):
                    hi = max(lo + 1, int(np.searchsorted(last, first[lo] + OCCURRENCES, "right")))
                    for s in range(first[lo], last[hi - 1], OCCURRENCES):  # more than one for a long text only
                        e = min(s + OCCURRENCES, last[hi - 1])
                        starts = np.maximum(first[lo:hi], s) - s
                        above[lo:hi] += np.add.reduceat(bits[at[s:e]], starts, axis=0, dtype=np.int64)
                    lo = hi
                sums = 2 * above - (last - first)[:, None]
                cols = [pa.array(np.ascontiguousarray(sums[:, i])) for i in range(planes)]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(np.full(len(some), band, np.int32)), *cols], ["doc_id", "band", *[f"p{i}" for i in range(planes)]]
                )

    return run
