"""Quality classifier by co-training two views of a document.

View one is the text: shares of character classes, word shapes, repetition,
and 256 hashed words. View two is the page's metadata: source, language,
length and layout (lines and their lengths). A logistic classifier for each
view learns from a bounded sample of labelled documents. In every round both
are calibrated (Platt scaling on logits of labelled rows by models that have
not seen them) and score every unlabelled document of the collection; each
hands its most confident ones of a class, with its label, to the *other*
view's training set, if it is sure of them and, on the labelled rows that it is
as sure of, is right more often than the other. So a view that knows less does
not teach. Last, the calibrated views are weighed against each other on the
same unseen logits, and the sum scores all documents.

Parameters: ``max_labelled`` documents (picked by hash of the id), ``rounds``,
``sure`` (least calibrated probability) and ``take``: a view hands over at most
``take`` * sqrt(n) of n different unlabelled documents a round, so the rows that
the driver fits grow with the input, but slower. Features, candidates and
scores are computed by Spark tasks over all documents; equal ones count once in
the exchange.

Labels: a document's label is the majority of its non-null labels, a tie is 0.
Null and empty texts have all-zero text features and are scored like others;
null sources and languages are values of their own, documents without id are
unlabelled. With labels of one class only, every score is that class; without
labels it is a half. Repeated rows are scored alike, an empty table gives no rows.
"""

from __future__ import annotations

import zlib
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import Batches, release, small_batches, text_bytes, word_hashes, written

HASHED = 256
SHAPES = 24
META = 32 + 16 + 6
FLOAT = "<f2"  # features are kept and learned in half precision
FOLDS = 5
STEPS = 64  # of a logit, in the counts that find the most confident rows
_SENTENCE_END = np.frombuffer(b".,;:!?", np.uint8)


def _class_shares(body: np.ndarray) -> np.ndarray:
    """Log-scaled shares of character classes."""
    hist = np.bincount(body, minlength=256).astype(np.float64)
    total = max(hist.sum(), 1.0)
    lower, upper = hist[97:123].sum(), hist[65:91].sum()
    groups = [
        lower, upper, hist[48:58].sum(), hist[128:].sum(), hist[32], hist[10], hist[46] + hist[44],
        hist[33], hist[63], hist[35:39].sum(), hist[42], hist[124], hist[64], hist[91] + hist[93] + hist[123] + hist[125],
        hist[60] + hist[62],
    ]
    out = np.log1p(1000 * np.array(groups) / total)
    return np.append(out, upper / max(lower + upper, 1.0) * 5)


def text_features(column: pa.Array) -> np.ndarray:
    """Rows of the text view for an Arrow column of texts."""
    body, offsets = text_bytes(column)
    h, starts, ends, rows_at = word_hashes(body, offsets)
    out = np.zeros((len(column), SHAPES + HASHED))
    lens = ends - starts
    for i in range(len(column)):
        lo, hi = rows_at[i], rows_at[i + 1]
        if lo == hi:
            continue
        words, size = h[lo:hi], lens[lo:hi]
        n = len(words)
        _, counts = np.unique(words, return_counts=True)
        same = words[1:] == words[:-1]
        last = body[ends[lo:hi] - 1]
        alnum = (last >= 128) | ((last >= 97) & (last <= 122)) | ((last >= 65) & (last <= 90))
        out[i, :16] = _class_shares(body[offsets[i] : offsets[i + 1]])
        out[i, 16:SHAPES] = [
            size.mean() / 5, min(size.std() / 5, 5), (size <= 3).mean() * 3, (size == 1).mean() * 10,
            len(counts) / n * 3, counts.max() / n * 5, same.mean() * 10 if n > 1 else 0,
            (~alnum & ~np.isin(last, _SENTENCE_END)).mean() * 5,
        ]
        bag = np.bincount((words % np.uint64(HASHED)).astype(np.int64), minlength=HASHED)
        out[i, SHAPES:] = bag / np.sqrt((bag.astype(float) ** 2).sum()) * 2
    return out


def _slot(value: str | None, n: int) -> int:
    return 0 if value is None else 1 + zlib.crc32(value.encode()) % (n - 1)


def meta_features(source: pa.Array, lang: pa.Array, column: pa.Array) -> np.ndarray:
    """Rows of the metadata view: source, language, length, layout."""
    body, offsets = text_bytes(column)
    out = np.zeros((len(column), META))
    breaks = np.append(0, np.cumsum(body == 10))
    lines = breaks[offsets[1:]] - breaks[offsets[:-1]] + 1
    size = np.diff(offsets)
    for i, (s, g) in enumerate(zip(source.to_pylist(), lang.to_pylist(), strict=True)):
        out[i, _slot(s, 32)] = 1
        out[i, 32 + _slot(g, 16)] = 1
    out[:, 48] = np.log1p(size) / 5
    out[:, 49] = np.log1p(lines) / 3
    out[:, 50] = np.log1p(size / lines) / 3
    out[:, 51] = size < 200
    out[:, 52] = lines == 1
    out[:, 53] = (np.log1p(size) / 5) ** 2
    return out


@dataclass
class Logistic:
    """L2-regularised logistic regression by Newton steps."""

    l2: float = 1.0
    w: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def fit(self, x: np.ndarray, y: np.ndarray, steps: int = 12) -> Logistic:
        x = np.hstack([x, np.ones((len(x), 1))])
        w = np.zeros(x.shape[1])
        penalty = np.full(x.shape[1], self.l2)
        penalty[-1] = 1e-6
        for _ in range(steps):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            r = np.maximum(p * (1 - p), 1e-6)
            step = np.linalg.solve((x * r[:, None]).T @ x + np.diag(penalty), x.T @ (p - y) + penalty * w)
            w -= step
            if np.abs(step).max() < 1e-6:
                break
        self.w = w
        return self

    def logit(self, x: np.ndarray) -> np.ndarray:
        return x @ self.w[:-1] + self.w[-1]


def _probability(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _platt(z: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Slope (none below 0) and offset for logits, with smoothed targets and
    little weight on slope 1, so that few rows give no infinite slope."""
    ones = y.sum()
    target = np.where(y == 1, (ones + 1) / (ones + 2), 1 / (len(y) - ones + 2))
    x, prior = np.stack([z, np.ones_like(z)], axis=1), np.array([1.0, 0.0])
    w = prior.copy()
    for _ in range(30):
        p = _probability(x @ w)
        r = np.maximum(p * (1 - p), 1e-6)
        step = np.linalg.solve((x * r[:, None]).T @ x + 0.01 * np.eye(2), x.T @ (p - target) + 0.01 * (w - prior))
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    w[0] = max(w[0], 0.0)
    return w


@dataclass
class View:
    """A view's labelled rows, what it was taught, its classifier and calibration."""

    x: np.ndarray
    y: np.ndarray
    l2: float = 5.0
    extra_x: np.ndarray | None = None
    extra_y: np.ndarray | None = None
    model: Logistic | None = None
    platt: np.ndarray | None = None
    unseen: np.ndarray | None = None  # calibrated logits of labelled rows by models without them

    def learn(self, x: np.ndarray, y: np.ndarray) -> None:
        self.extra_x = x if self.extra_x is None else np.vstack([self.extra_x, x])
        self.extra_y = y if self.extra_y is None else np.append(self.extra_y, y)

    def _with_extra(self, rows: np.ndarray) -> Logistic:
        x, y = self.x[rows], self.y[rows]
        if self.extra_x is not None:
            x, y = np.vstack([x, self.extra_x]), np.append(y, self.extra_y)
        return Logistic(self.l2).fit(x, y)

    def fit(self) -> None:
        fold = np.arange(len(self.y)) % FOLDS
        z = np.zeros(len(self.y))
        for f in range(FOLDS):
            rest = fold != f
            if rest.any() and not rest.all() and self.y[rest].min() < self.y[rest].max():
                z[~rest] = self._with_extra(rest).logit(self.x[~rest])
        self.model = self._with_extra(np.ones(len(self.y), bool))
        self.platt = _platt(z, self.y)
        self.unseen = self.platt[0] * z + self.platt[1]

    def logit(self, x: np.ndarray) -> np.ndarray:
        return self.platt[0] * self.model.logit(x) + self.platt[1]


@dataclass
class CoTrained:
    """Both views' classifiers, calibrated, and their joint weights."""

    text: View | None
    meta: View | None
    joint: np.ndarray  # weight of the text view, of the metadata view, offset
    taught: tuple[int, int] = (0, 0)  # pseudo-labelled rows the text view, the metadata view got
    constant: float | None = None

    def scores(self, xt: np.ndarray, xm: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Calibrated probabilities of the text view, the metadata view, both."""
        if self.constant is not None:
            c = np.full(len(xt), self.constant)
            return c, c, c
        a, b = self.text.logit(xt), self.meta.logit(xm)
        return tuple(_probability(z) for z in (a, b, self.joint[0] * a + self.joint[1] * b + self.joint[2]))


def _teaches(teacher: View, student: View, positive: bool, limit: float) -> bool:
    """Whether, on the labelled rows that the teacher is sure are of a class,
    it is right more often than the student."""
    sure = teacher.unseen >= limit if positive else teacher.unseen <= -limit
    right = (teacher.y[sure] == 1) == positive
    other = (student.unseen[sure] >= 0) == (teacher.y[sure] == 1)
    return right.sum() > other.sum()


def _matrix(rows: list, name: str) -> np.ndarray:
    return np.stack([np.frombuffer(bytes(r[name]), FLOAT) for r in rows]).astype(float)


def _confident(pool: DataFrame, views: dict[str, View], wants: list, gone: np.ndarray) -> list:
    """Rows (want, t, m) of the pool: of every want (view, class, logit limit, n)
    the n most confident ones not in ``gone``. A count per step of the logits
    finds the step where n are reached; only rows from there on are ordered."""
    models = {v: (x.model.w, x.platt) for v, x in views.items()}

    def run(batches: Batches) -> Batches:
        for b in batches:
            free = ~np.isin(b.column(0).to_numpy(), gone)
            z = []
            for i, v in enumerate(models, 1):
                w, (slope, offset) = models[v]
                x = np.frombuffer(b"".join(b.column(i).to_pylist()), FLOAT).reshape(b.num_rows, -1).astype(float)
                z.append(np.clip(slope * (x @ w[:-1] + w[-1]) + offset, -30, 30))
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(q, pa.float64()) for q in z]], ["key", "t", "m", "z_t", "z_m"]
            ).filter(pa.array(free))

    scored = pool.select("key", "t", "m").mapInArrow(run, "key long, t binary, m binary, z_t double, z_m double")
    sign = [F.col(f"z_{v}") if positive else -F.col(f"z_{v}") for v, positive, _, _ in wants]
    steps = [F.when(s >= want[2], F.floor(s * STEPS)) for s, want in zip(sign, wants, strict=True)]
    counts = (
        scored.select(F.posexplode(F.array(*steps)).alias("want", "step")).where("step IS NOT NULL")
        .groupBy("want", "step").count().collect()
    )
    least = []
    for i, want in enumerate(wants):
        total, edge = 0, None
        for step, n in sorted(((r["step"], r["count"]) for r in counts if r["want"] == i), reverse=True):
            edge, total = step, total + n
            if total >= want[3]:
                break
        least.append(edge)
    tags = [
        F.when(step >= edge, F.struct(F.lit(i).alias("want"), s.alias("z")))
        for i, (s, step, edge) in enumerate(zip(sign, steps, least, strict=True)) if edge is not None
    ]
    if not tags:
        return []
    order = Window.partitionBy("want").orderBy(F.col("z").desc(), "key")
    limit = F.element_at(F.array(*[F.lit(want[3]) for want in wants]), F.col("want") + 1)
    return (
        scored.select("key", "t", "m", F.explode(F.array_compact(F.array(*tags))).alias("w")).select("key", "t", "m", "w.*")
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= max(w[3] for w in wants))
        .where(F.col("rank") <= limit).select("want", "key", "t", "m").orderBy("want", "key").collect()
    )


def co_train(
    xt: np.ndarray, xm: np.ndarray, y: np.ndarray, pool: DataFrame, rounds: int = 4, take: float = 2.5, sure: float = 0.9
) -> CoTrained:
    """Fit on labelled rows (views xt, xm, label y) and a table of unlabelled
    ones (key, t, m: both views' features as bytes)."""
    if len(y) == 0 or y.min() == y.max():
        return CoTrained(None, None, np.zeros(3), constant=float(y[0]) if len(y) else 0.5)
    views = {"t": View(xt, y), "m": View(xm, y)}
    share, limit = y.mean(), float(np.log(sure / (1 - sure)))
    most = int(np.ceil(take * np.sqrt(pool.count()))) if rounds else 0
    gone = np.zeros(0, np.int64)
    for round_ in range(rounds + 1):
        for v in views.values():
            v.fit()
        if round_ == rounds:
            break
        wants = [
            (teacher, positive, limit, max(1, round(most * (share if positive else 1 - share))))
            for teacher, student in (("t", "m"), ("m", "t"))
            for positive in (False, True)
            if _teaches(views[teacher], views[student], positive, limit)
        ]
        rows = _confident(pool, views, wants, gone) if wants and most else []
        if not rows:
            break
        for i, (teacher, positive, _, _) in enumerate(wants):
            student = "m" if teacher == "t" else "t"
            mine = [r for r in rows if r["want"] == i]
            if mine:
                views[student].learn(_matrix(mine, student), np.full(len(mine), float(positive)))
        gone = np.union1d(gone, np.array([r["key"] for r in rows], np.int64))
    joint = Logistic(1.0).fit(np.stack([views["t"].unseen, views["m"].unseen], axis=1), y).w
    joint[:2] = np.maximum(joint[:2], 0)
    taught = tuple(0 if v.extra_y is None else len(v.extra_y) for v in views.values())
    return CoTrained(views["t"], views["m"], joint, taught)


def _views(batches: Batches) -> Batches:
    for b in small_batches(batches, 3):
        t = text_features(b.column(3)).astype(FLOAT)
        m = meta_features(b.column(1), b.column(2), b.column(3)).astype(FLOAT)
        yield pa.RecordBatch.from_arrays(
            [
                b.column(0),
                pa.array([r.tobytes() for r in t], pa.binary()),
                pa.array([r.tobytes() for r in m], pa.binary()),
            ],
            ["doc_id", "t", "m"],
        )


def _scored(model: CoTrained):
    def run(batches: Batches) -> Batches:
        for b in small_batches(batches, 3):
            pt, pm, both = model.scores(
                text_features(b.column(3)).astype(FLOAT).astype(float),
                meta_features(b.column(1), b.column(2), b.column(3)).astype(FLOAT).astype(float),
            )
            yield pa.RecordBatch.from_arrays(
                [b.column(0), *[pa.array(x, pa.float64()) for x in (pt, pm, both)], pa.array(both >= 0.5)],
                ["doc_id", "p_text", "p_meta", "score", "keep"],
            )

    return run


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), "source", "lang", F.coalesce("text", F.lit("")).alias("text")
    )


def train(
    docs: DataFrame, labels: DataFrame, label: str = "quality", max_labelled: int = 6_000, rounds: int = 4,
    take: float = 2.5, sure: float = 0.9,
) -> CoTrained:
    """Co-train on a sample of the labelled documents and on all others."""
    truth = (
        labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg((F.avg(label) > 0.5).cast("int").alias("y"))
    )
    features = _plain(docs).mapInArrow(_views, "doc_id long, t binary, m binary")
    rows = written(
        features.join(truth, "doc_id", "left").withColumn("key", F.xxhash64("t", "m")), "quality-features"
    )
    order = F.xxhash64("doc_id", F.lit("quality")), F.col("doc_id")
    known = rows.where("y IS NOT NULL")
    picked = known.select("doc_id").distinct().orderBy(*order).limit(max_labelled)
    picked = written(picked, "quality-sample")
    # At most max_labelled ids are broadcast, and as many rows collected.
    sample = (
        known.join(F.broadcast(picked), "doc_id").groupBy("doc_id")
        .agg(F.min(F.struct("t", "m")).alias("x"), F.first("y").alias("y")).select("doc_id", "x.*", "y")
        .orderBy(*order).collect()
    )
    pool = written(rows.where("y IS NULL").select("key", "t", "m").dropDuplicates(["key"]), "quality-pool")
    release(rows, picked)
    y = np.array([r["y"] for r in sample], dtype=float)
    views = [_matrix(sample, v) if sample else np.zeros((0, 1)) for v in ("t", "m")]
    model = co_train(*views, y, pool, rounds, take, sure)
    release(pool)
    return model


def score(docs: DataFrame, model: CoTrained) -> DataFrame:
    """doc_id, p_text, p_meta, score (calibrated probability of good quality)
    and keep (score of a half or more) of every document."""
    return _plain(docs).mapInArrow(
        _scored(model), "doc_id long, p_text double, p_meta double, score double, keep boolean"
    )
