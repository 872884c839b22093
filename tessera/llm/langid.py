"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +-1 in ``DIM`` dimensions (drawn from its
code point, so all workers agree without sharing a table). A trigram is bound
as ``shift2(v(a)) * shift1(v(b)) * v(c)``, a text is the bundle (sum) of its
trigrams, a language's prototype the bundle of all its training texts; a
document gets the language of the highest cosine. The mean of the normalised
prototypes, which is what all languages have in common, is taken from both
sides before the cosine, which parts close languages better.

Texts are lower-cased, runs of anything but letters are one word break, and
breaks take part in trigrams. The bundle is linear, so a batch counts its
distinct trigrams first and only those are bound.

Training reads all labelled rows it is given: every task adds up its own texts
per language (exact integers) and two rounds of partial sums meet in one row
per language. A model is a few vectors per language; ``max_langs`` bounds it.

Null texts and texts without a letter are ``und`` with score 0; ties go to the
first language by name; null languages are not learned; with nothing to learn
from everything is ``und``. Repeated rows are learned as often as they occur.
The score is the cosine, cut to 0..1.

``alike`` tells whether a text is like any learned language at all, by the
cosines without that centring. The cosine of a text with nothing in common
with a prototype is noise of standard deviation ``1 / sqrt(dim)`` whatever the
text's length, so the limit follows from ``dim`` and the number of languages
(``noise_limit``). A trigram's products with the prototypes are kept instead of
its vector, so that many dimensions cost little.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Batches, mix64, small_batches, worker_cache, written

DIM = 512
UNKNOWN = "und"
PARTS = 64
SLICE = 1 << 21  # bytes of text that a task holds as trigrams at a time
BOUND = 1 << 12  # trigrams bound at a time
KNOWN_TRIGRAMS = 60_000  # bound trigrams that a worker keeps (DIM bytes each)
LIKE_DIM = 8192  # dimensions of the profiles that ``alike`` is given
CHANCE = 1e-3  # bound on the share of texts unlike all languages that pass as alike


def _letter_table() -> np.ndarray:
    """Letter number (its code point) or 0 for every code point."""
    table = np.zeros(0x110000, dtype=np.int64)
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000 and chr(c).isalpha()]
    table[points] = points
    return table


def _state() -> dict:
    return worker_cache("langid")


def _letters() -> np.ndarray:
    state = _state()
    if "letters" not in state:
        state["letters"] = _letter_table()
    return state["letters"]


def trigrams(text: str) -> np.ndarray:
    """Codes of all trigrams of letters and word breaks (0); empty without a letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "replace"), "<u4")
    ids = _letters()[points]
    ids = np.concatenate([[0], ids, [0]])
    ids = ids[np.append(True, (ids[1:] != 0) | (ids[:-1] != 0))]
    if not ids.any():
        return np.zeros(0, np.int64)
    return (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]


def letter_vectors(ids: np.ndarray, dim: int = DIM) -> np.ndarray:
    """+-1 vectors of letters (rows), from the letters' numbers alone."""
    words = -(-dim // 64)
    seeds = mix64(ids.astype(np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15) + np.arange(1, words + 1, dtype=np.uint64))
    bits = np.unpackbits(mix64(seeds).view(np.uint8).reshape(len(ids), -1), axis=1)[:, :dim]
    return bits.astype(np.int8) * 2 - 1


def bound(codes: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Vectors of distinct trigrams, one row each."""
    parts = [codes >> 42, (codes >> 21) & 0x1FFFFF, codes & 0x1FFFFF]
    letters, at = np.unique(np.concatenate(parts), return_inverse=True)
    v = letter_vectors(letters, dim)
    a, b, c = at[: len(codes)], at[len(codes) : 2 * len(codes)], at[2 * len(codes) :]
    return np.roll(v, 2, axis=1)[a] * np.roll(v, 1, axis=1)[b] * v[c]


def bundle(codes: np.ndarray, counts: np.ndarray, dim: int = DIM) -> np.ndarray:
    """Sum of trigram vectors times counts, exact."""
    out = np.zeros(dim, np.int64)
    step = max(1, BOUND * DIM // dim)
    for at in range(0, len(codes), step):
        part = slice(at, at + step)
        out += (counts[part].astype(np.float64) @ bound(codes[part], dim).astype(np.float64)).astype(np.int64)
    return out


class _Known:
    """Bound trigrams a worker has met; starts anew when full."""

    def __init__(self, dim: int):
        self.dim, self.most = dim, KNOWN_TRIGRAMS
        self.codes = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, dim), np.int8)

    def made(self, codes: np.ndarray) -> np.ndarray:
        return bound(codes, self.dim)

    def rows(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of sorted distinct trigrams."""
        at = np.searchsorted(self.codes, codes)
        hit = np.zeros(len(codes), bool)
        if len(self.codes):
            hit = self.codes[np.minimum(at, len(self.codes) - 1)] == codes
        if not hit.all():
            new = codes[~hit]
            if len(self.codes) + len(new) > self.most:
                self.codes, self.vectors = self.codes[:0], self.vectors[:0]
                new = codes
            merged = np.concatenate([self.codes, new])
            order = np.argsort(merged, kind="stable")
            self.vectors = np.concatenate([self.vectors, self.made(new)])[order]
            self.codes = merged[order]
            at = np.searchsorted(self.codes, codes)
        return self.vectors[at]


def _partial(dim: int):
    """Per task: language and the sum of its texts' trigrams, part by part."""

    def run(batches: Batches) -> Batches:
        sums: dict[str, np.ndarray] = {}
        for b in small_batches(batches, 1, SLICE):  # eight bytes are held for each of its letters
            held: dict[str, list[np.ndarray]] = {}
            for lang, text in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                codes = trigrams(text.as_py())
                if len(codes):
                    held.setdefault(lang, []).append(codes)
            for lang, parts in held.items():
                v = bundle(*np.unique(np.concatenate(parts), return_counts=True), dim)
                sums[lang] = sums.get(lang, 0) + v
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tobytes() for v in sums.values()], pa.binary())],
                ["lang", "v"],
            )

    return run


def _summed(key: tuple, rows: pa.Table) -> pa.Table:
    total = sum(np.frombuffer(v.as_py(), np.int64) for v in rows.column("v"))
    return pa.table({"lang": pa.array([key[0].as_py()]), "v": pa.array([total.tobytes()], pa.binary())})


def train(labelled: DataFrame, lang: str = "lang", text: str = "text", dim: int = DIM) -> DataFrame:
    """One row per language: lang and its prototype (int64 sums, as bytes)."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).alias("lang"), F.col(text).alias("text")
    )
    parts = rows.mapInArrow(_partial(dim), "lang string, v binary")
    parts = parts.withColumn("part", F.pmod(F.xxhash64("v"), F.lit(PARTS)))
    once = parts.groupBy("lang", "part").applyInArrow(_summed, "lang string, v binary")
    return written(once.groupBy("lang").applyInArrow(_summed, "lang string, v binary"), "langid-model")


def _centred(model: list[tuple[str, bytes]]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Names, unit prototypes without their mean, and that mean."""
    names = [n for n, _ in sorted(model)]
    p = np.array([np.frombuffer(v, np.int64) for _, v in sorted(model)], dtype=np.float64)
    norms = np.linalg.norm(p, axis=1, keepdims=True)
    p = p / np.where(norms == 0, 1, norms)
    mean = p.mean(axis=0) if len(p) > 1 else np.zeros(p.shape[1])
    p = p - mean
    norms = np.linalg.norm(p, axis=1, keepdims=True)
    return names, p / np.where(norms == 0, 1, norms), mean


def _judge(model: list[tuple[str, bytes]], dim: int) -> Callable[[pa.Array], pa.Array]:
    """(lang_pred, score) of every text of an Arrow column."""
    names, profiles, mean = _centred(model) if model else ([], None, None)
    known = _state().setdefault(f"known{dim}", _Known(dim))

    def run(texts: pa.Array) -> pa.Array:
        langs, scores = [], []
        for x in texts:
            codes = trigrams(x.as_py() or "") if names else ()
            if len(codes) == 0:
                langs.append(UNKNOWN)
                scores.append(0.0)
                continue
            codes, counts = np.unique(codes, return_counts=True)
            v = (counts.astype(np.float32) @ known.rows(codes).astype(np.float32)).astype(np.float64)
            v = v / max(np.linalg.norm(v), 1e-12) - mean
            cos = profiles @ (v / max(np.linalg.norm(v), 1e-12))
            best = int(np.argmax(np.round(cos, 9)))
            langs.append(names[best])
            scores.append(float(min(max(cos[best], 0.0), 1.0)))
        return pa.StructArray.from_arrays(
            [pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"]
        )

    return run


def predicted(
    model: DataFrame, text: str | Column = "text", dim: int = DIM, max_langs: int = 1000
) -> Column:
    """Struct (lang_pred, score) of a text column. Only the text goes to
    Python; the other columns of the row stay where they are. The model is
    read once by the driver: at most ``max_langs`` vectors, else an error."""
    rows = model.limit(max_langs + 1).collect()
    if len(rows) > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs")
    vectors = [(r["lang"], bytes(r["v"])) for r in rows]

    @F.arrow_udf("lang_pred string, score double")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        judge = _judge(vectors, dim)
        for texts in batches:
            yield judge(texts)

    return judged(text)


def predict(
    docs: DataFrame, model: DataFrame, keep: list[Column], text: str = "text", dim: int = DIM, max_langs: int = 1000
) -> DataFrame:
    """``keep`` columns, lang_pred and score of every row."""
    judged = docs.select(F.struct(*keep).alias("row"), predicted(model, text, dim, max_langs).alias("judged"))
    return judged.select("row.*", "judged.*")


def noise_limit(langs: int, dim: int) -> float:
    """Cosine that a text unlike all languages exceeds with any of them in at
    most ``CHANCE`` of cases (tail bound of the normal distribution)."""
    return math.sqrt(2 * math.log(max(langs, 1) / CHANCE) / dim)


class _Products(_Known):
    """Products of trigrams a worker has met with unit prototypes, one column per language."""

    def __init__(self, profiles: np.ndarray):
        self.profiles = profiles
        self.most = max(1, KNOWN_TRIGRAMS * DIM // (4 * len(profiles)))
        self.step = max(1, BOUND * DIM // profiles.shape[1])
        self.codes = np.zeros(0, np.int64)
        self.vectors = np.zeros((0, len(profiles)), np.float32)

    def made(self, codes: np.ndarray) -> np.ndarray:
        parts = [codes[at : at + self.step] for at in range(0, len(codes), self.step)]
        dim = self.profiles.shape[1]
        return np.concatenate([bound(x, dim).astype(np.float32) @ self.profiles.T for x in parts])


def _likeness(model: list[tuple[str, bytes]], dim: int) -> Callable[[str | None], float]:
    """Highest cosine of a text with any prototype; -1 without a letter or language.
    The length of a text's bundle is its expected one, of distinct trigrams."""
    if not model:
        return lambda text: -1.0
    p = np.array([np.frombuffer(v, np.int64) for _, v in sorted(model)], dtype=np.float64)
    norms = np.linalg.norm(p, axis=1, keepdims=True)
    p = (p / np.where(norms == 0, 1, norms)).astype(np.float32)
    key = "products", hashlib.sha256(p.tobytes()).digest()
    state = _state()
    if state.get("products", (None,))[0] != key:
        state["products"] = key, _Products(p)
    products = state["products"][1]

    def run(text: str | None) -> float:
        codes = trigrams(text or "")
        if len(codes) == 0:
            return -1.0
        codes, counts = np.unique(codes, return_counts=True)
        counts = counts.astype(np.float64)
        return float((counts @ products.rows(codes)).max() / math.sqrt(dim * (counts @ counts)))

    return run


def alike(model: DataFrame, text: str | Column = "text", dim: int = LIKE_DIM, max_langs: int = 1000) -> Column:
    """Whether a text column is like any language of a model of ``dim``
    dimensions, beyond chance. The model is read as in ``predicted``."""
    rows = model.limit(max_langs + 1).collect()
    if len(rows) > max_langs:
        raise ValueError(f"more than {max_langs} languages; raise max_langs")
    vectors = [(r["lang"], bytes(r["v"])) for r in rows]
    limit = noise_limit(len(vectors), dim)

    @F.arrow_udf("boolean")
    def judged(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        like = _likeness(vectors, dim)
        for texts in batches:
            yield pa.array([like(x.as_py()) > limit for x in texts], pa.bool_())

    return judged(text)


def held_out(id_col: Column) -> Column:
    """crc32 of the id's text mod 3 is 1 (null id: of the empty text)."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit(""))), F.lit(3)) == 1
