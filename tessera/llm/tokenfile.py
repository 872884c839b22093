"""Token ids of documents in bit-plane shuffled binary files.

Documents are range-partitioned and sorted by id, tokenized, and each range
writes *segments*: the ids of consecutive whole documents (about a million ids;
a longer document is a segment of its own). A segment's ids are cut into
blocks of 65,536, each block of unsigned 32-bit ids is transposed into its byte
planes (four) or bit planes (32), and every plane is compressed with zstandard:
the upper planes are almost constant and cost next to nothing. The chunk index
of a segment names each block's number of ids and the byte lengths of its
planes, so any block can be read alone.

The files are a Parquet table of segments (range, segment, first id in the
range, document ids and lengths, chunk index, body), written through Spark, so
they can lie in any store that Spark writes to and a lost task is repeated
whole. Reading needs no shuffle: a segment holds whole documents, and the ids
before a range are a running sum over one row per range.

Order: ascending id, null ids last, ties by text hash. Null and empty texts
have no ids of their own (only the end id). Where the tokenizer drops white space
and never joins across it, words are tokenized one by one and remembered: a text's
ids are those of its words in order. Other tokenizers are given whole texts.
"""

from __future__ import annotations

import json
import zlib
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import scratch_path

from .common import Batches, worker_cache

BLOCK = 1 << 16
SEGMENT = 1 << 20
LEVEL = 3
REMEMBERED = 64 << 20  # bytes of words and ids in one generation of a worker's memory; two are kept
ENTRY = 160  # bytes that a word takes besides its own and those of its ids
LONG = 12  # bytes; longer words seldom come again and are not remembered

SEGMENT_SCHEMA = (
    "shard int, segment int, first_id long, doc_ids array<long>, lengths array<long>, planes int,"
    " blocks array<struct<n:int,sizes:array<int>>>, body binary"
)


# --- blocks -----------------------------------------------------------------


def split_planes(ids: np.ndarray, planes: int) -> list[bytes]:
    """Byte planes (4) or bit planes (32) of unsigned 32-bit ids."""
    raw = ids.astype("<u4").view(np.uint8).reshape(-1, 4)
    if planes == 4:
        return [np.ascontiguousarray(raw[:, i]).tobytes() for i in range(4)]
    if planes == 32:
        bits = np.unpackbits(raw, axis=1, bitorder="little")
        return [np.packbits(np.ascontiguousarray(bits[:, i]), bitorder="little").tobytes() for i in range(32)]
    raise ValueError("planes: 4 (bytes) or 32 (bits)")


def join_planes(parts: list[bytes], n: int) -> np.ndarray:
    """Inverse of ``split_planes``."""
    if len(parts) == 4:
        raw = np.stack([np.frombuffer(p, np.uint8) for p in parts], axis=1)
    else:
        bits = np.stack(
            [np.unpackbits(np.frombuffer(p, np.uint8), count=n, bitorder="little") for p in parts], axis=1
        )
        raw = np.packbits(bits, axis=1, bitorder="little")
    return np.ascontiguousarray(raw).view("<u4").reshape(-1)


def pack(ids: np.ndarray, planes: int = 4, block: int = BLOCK) -> tuple[list[dict], bytes]:
    """Chunk index and body of a run of ids."""
    press = zstandard.ZstdCompressor(level=LEVEL)
    index, body = [], []
    for at in range(0, len(ids), block):
        part = ids[at : at + block]
        cells = [press.compress(p) for p in split_planes(part, planes)]
        index.append({"n": len(part), "sizes": [len(c) for c in cells]})
        body.extend(cells)
    return index, b"".join(body)


def unpack(index: list[dict], body: bytes) -> np.ndarray:
    """Ids of a run from its chunk index and body."""
    open_ = zstandard.ZstdDecompressor()
    out, at = [np.zeros(0, np.uint32)], 0
    for b in index:
        cells = []
        for size in b["sizes"]:
            cells.append(open_.decompress(body[at : at + size]))
            at += size
        out.append(join_planes(cells, b["n"]))
    return np.concatenate(out)


# --- tokenizing -------------------------------------------------------------

def _drops_blanks(tokenizer, steps: dict) -> bool:
    """Whether words can be encoded one by one: the first step of the
    pre-tokenizer keeps only matches, or splits at white space, and neither blanks
    alone nor those before or after a word or mark leave a trace."""
    first = (steps.get("pretokenizers") or [steps])[0]
    matches = first.get("type") == "Split" and first.get("behavior") == "Removed" and first.get("invert")
    if not matches and first.get("type") not in ("Whitespace", "WhitespaceSplit", "BertPreTokenizer"):
        return False

    def pieces(text: str) -> list[str]:
        return [x for x, _ in tokenizer.pre_tokenizer.pre_tokenize_str(text)]

    words = ["a", "B7", "é", "'s", "...", "x-y", "日本"]
    for blank in (" ", "\t", "\n", "\x0b", "\x0c", "\r", " \n "):
        apart = [p for w in words for p in pieces(w)]
        if pieces(blank) or pieces(blank + blank.join(words) + blank) != apart:
            return False
    return True


class _Words:
    """A tokenizer's ids of single words, remembered by a worker in two
    generations: when the young one is full the old one is dropped, so words
    that come again stay and the bytes held are bounded."""

    def __init__(self, path: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        form = json.loads(self.tokenizer.to_str())
        normal = form.get("normalizer") or {}
        self.folds = any(n.get("type") == "Lowercase" for n in [normal, *normal.get("normalizers", [])])
        self.special = [a.content.lower().encode() for a in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = not _drops_blanks(self.tokenizer, form.get("pre_tokenizer") or {})
        # With a mark at word ends, words of letters can be encoded in one run
        # and parted at the marked ids.
        self.marked = None
        if end := form["model"].get("end_of_word_suffix"):
            vocab = self.tokenizer.get_vocab()
            self.marked = np.zeros(max(vocab.values()) + 1, bool)
            self.marked[[i for w, i in vocab.items() if w.endswith(end)]] = True
        self.met: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}
        self.held = 0

    def _run(self, words: list[str]) -> list[bytes] | None:
        """Ids of words of small letters by one run, if they can be told apart."""
        ids = np.array(self.tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0].ids, "<u4")
        ends = (np.flatnonzero(self.marked[ids]) + 1) * 4
        if len(ends) != len(words) or ends[-1] != len(ids) * 4:
            return None
        raw, ends = ids.tobytes(), ends.tolist()
        return [raw[s:e] for s, e in zip([0, *ends[:-1]], ends, strict=True)]

    def learn(self, words: list[bytes]) -> None:
        plain, other = [], []
        for raw in words:
            w = raw.decode()
            letters = self.marked is not None and w.isalpha() and w.islower() and is_normalized("NFC", w)
            (plain if letters else other).append((raw, w))
        found = self._run([w for _, w in plain]) if plain else []
        if found is None:
            other, plain, found = other + plain, [], []
        self.met.update(zip((r for r, _ in plain), found, strict=True))
        done = self.tokenizer.encode_batch_fast([w for _, w in other], add_special_tokens=False) if other else []
        self.met.update((r, np.array(e.ids, "<u4").tobytes()) for (r, _), e in zip(other, done, strict=True))

    def encode(self, raw: bytes) -> np.ndarray:
        if self.whole:
            return np.array(self.tokenizer.encode(raw.decode(), add_special_tokens=False).ids, "<u4")
        if self.folds:  # it lower-cases all but its own added tokens
            low = raw.lower()
            raw = raw if any(x in low for x in self.special) else low
        words = raw.split()  # ASCII white space only: no tokenizer joins across it
        met, old = self.met, self.old
        new = set(words).difference(met)
        if old:
            met.update([(w, old[w]) for w in new if w in old])
            new = new.difference(met)
        if new:
            self.learn(list(new))
        out = np.frombuffer(b"".join([met[w] for w in words]), "<u4")
        for w in new:
            if len(w) > LONG:
                del met[w]
            else:
                self.held += ENTRY + len(w) + len(met[w])
        if self.held > REMEMBERED:
            self.met, self.old, self.held = {}, met, 0
        return out


def encode(text: bytes | str | None, path: str) -> np.ndarray:
    """Ids of a whole text, without special tokens."""
    loaded = worker_cache("tokens")
    if path not in loaded:
        loaded[path] = _Words(path)
    return loaded[path].encode(text.encode() if isinstance(text, str) else text or b"")


def _encoder(path: str, end_id: int, planes: int, segment: int):
    def run(batches: Batches) -> Batches:
        from pyspark import TaskContext

        shard = TaskContext.get().partitionId()
        docs, parts, size, number, first = [], [], 0, 0, 0
        tail = np.asarray([end_id], "<u4")

        def flush():
            ids = np.concatenate(parts)
            index, body = pack(ids, planes)
            row = {
                "shard": shard, "segment": number, "first_id": first, "doc_ids": list(docs),
                "lengths": lengths[:], "planes": planes, "blocks": index, "body": body,
            }
            return pa.RecordBatch.from_pylist([row], schema=_ARROW)

        lengths: list[int] = []
        for b in batches:
            texts = b.column(1).cast(pa.large_binary())
            for doc, text in zip(b.column(0).to_pylist(), texts, strict=True):
                ids = encode(text.as_py(), path)
                if size and size + len(ids) + 1 > segment:
                    yield flush()
                    first, number = first + size, number + 1
                    docs.clear(), parts.clear(), lengths.clear()
                    size = 0
                docs.append(doc)
                lengths.append(len(ids) + 1)
                parts += [ids, tail]
                size += len(ids) + 1
        if docs:
            yield flush()

    return run


_ARROW = pa.schema(
    [
        ("shard", pa.int32()),
        ("segment", pa.int32()),
        ("first_id", pa.int64()),
        ("doc_ids", pa.list_(pa.int64())),
        ("lengths", pa.list_(pa.int64())),
        ("planes", pa.int32()),
        ("blocks", pa.list_(pa.struct([("n", pa.int32()), ("sizes", pa.list_(pa.int32()))]))),
        ("body", pa.binary()),
    ]
)


def write_tokens(
    docs: DataFrame,
    tokenizer: str,
    path: str | None = None,
    id_col: str = "doc_id",
    text: str = "text",
    end_id: int = 2,
    planes: int = 4,
    segment: int = SEGMENT,
) -> str:
    """Tokenize every document and write the files; returns their folder."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_id").asc_nulls_last(), F.xxhash64("_text")]
    (
        docs.select(F.col(id_col).cast("long").alias("_id"), F.col(text).alias("_text"))
        .repartitionByRange(n, *order)
        .sortWithinPartitions(*order)
        .mapInArrow(_encoder(tokenizer, end_id, planes, segment), SEGMENT_SCHEMA)
        .write.parquet(path)
    )
    return path


def _decoder(batches: Batches) -> Batches:
    for b in batches:
        for i in range(b.num_rows):
            row = {name: b.column(k)[i].as_py() for k, name in enumerate(b.schema.names)}
            ids = unpack(row["blocks"], row["body"]).astype("<u4")
            ends = np.cumsum(row["lengths"])
            begins = ends - row["lengths"]
            crc = [zlib.crc32(ids[s:e].tobytes()) for s, e in zip(begins, ends, strict=True)]
            n = len(ends)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["shard"]] * n, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(begins + row["first_id"], pa.int64()),
                    pa.array(row["lengths"], pa.int64()),
                    pa.array(crc, pa.int64()),
                    pa.array([ids[s:e].astype(np.int64) for s, e in zip(begins, ends, strict=True)],
                             pa.list_(pa.int64())),
                ],
                ["shard", "doc_id", "_at", "n_tokens", "ids_crc32", "ids"],
            )


def _digester(batches: Batches) -> Batches:
    for b in _decoder(batches):
        yield b.select(["shard", "doc_id", "_at", "n_tokens", "ids_crc32"])


def read_tokens(spark: SparkSession, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 and,
    if asked for, the ids of every document in the files."""
    segments = spark.read.schema(SEGMENT_SCHEMA).parquet(path)
    schema = "shard int, doc_id long, _at long, n_tokens long, ids_crc32 long"
    # Each range's last segment knows its number of ids; a row per range.
    sizes = segments.select(
        "shard", (F.col("first_id") + F.aggregate("lengths", F.lit(0).cast("long"), lambda a, x: a + x)).alias("n")
    )
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        sizes.groupBy("shard")
        .agg(F.max("n").alias("n"))
        .select(F.col("shard"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    )
    rows = (
        segments.mapInArrow(_decoder, schema + ", ids array<long>")
        if with_ids
        else segments.mapInArrow(_digester, schema)
    )
    # One row per range of the writer: as many as shuffle partitions.
    return (
        rows.join(F.broadcast(bases), "shard")
        .withColumn("start", F.col("_at") + F.col("_base"))
        .select("doc_id", "start", "n_tokens", "ids_crc32", *(["ids"] if with_ids else []))
    )
