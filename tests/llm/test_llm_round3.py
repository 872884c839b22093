"""Vector codes, filter audit and pivot tables against brute force."""

import hashlib
import math
import random
from itertools import permutations

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import audit, common, decontam, gridcodes, mixing, ngramjoin, pivots, queries, sketch, tokenfile, urlfilter

VECTORS = "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT, code STRING"
DOCS = "doc_id BIGINT, text STRING, lang STRING, mask INT, `a.b` STRING"
LABELS = "doc_id BIGINT, quality INT, toxic INT"


# --- vector codes ---------------------------------------------------------------


def brute_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * np.float32(x).item()) for x in v], g) for i, v, g in rows]
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(kept[0][1]) // parts
    cut = [[v[p * w : p * w + w] for p in range(parts)] for _, v, _ in kept]
    books = [[c[p] for c in cut[:entries]] for p in range(parts)]

    def near(p, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), k) for k, e in enumerate(books[p]))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for c in cut:
                groups.setdefault(near(p, c[p])[1], []).append(c[p])
            for k, xs in groups.items():
                books[p][k] = [sum(col) // len(xs) for col in zip(*xs)]
    found = [[near(p, c[p]) for p in range(parts)] for c in cut]
    sha = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in f) for f in found]
    label = {}
    for (_, _, g), e in zip(kept, errors):
        label[g] = label.get(g, 0) + e
    return sorted(
        (str(i), "".join(f"{k:02x}" for _, k in f), e, label[g], sha) for (i, _, g), f, e in zip(kept, found, errors)
    )


@pytest.mark.parametrize("cell", [1, 300, 768, 1 << 20])
def test_vector_codes_match_brute_force(spark, cell):
    rng = random.Random(cell)
    good = [(i, [rng.gauss(0, 0.2) for _ in range(16)], rng.choice([1, 2, None])) for i in range(40, 100)]
    good += [(i, good[i % 3][1], 7) for i in range(3, 33)]  # a third are copies
    good += [good[0], (None, [0.0] * 16, None), (34, [rng.choice([-1.0, 0.0, 0.25]) for _ in range(16)], 1)]
    bad = [(1, None, 1), (2, [float("nan")] + [0.0] * 15, 1), (0, [float("inf")] + [0.0] * 15, None), (200, [], 2),
           (201, [0.5] * 8, 2), (202, [1e30] + [0.0] * 15, 2), (203, [None] + [0.0] * 15, 2)]
    df = spark.createDataFrame([(*r, "theirs") for r in good + bad], VECTORS).repartition(5)
    got = gridcodes.encode(df, cell=cell).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == brute_codes(good)


def test_vector_codes_of_few_and_no_vectors(spark):
    few = [(5, [0.1] * 8, 1), (3, [0.2] * 8, None)]
    df = spark.createDataFrame([(*r, "") for r in few], VECTORS)
    got = gridcodes.encode(df).collect()
    assert sorted((str(r.vec_id), r.code, r.error, r.label_error, r.codebooks_sha256) for r in got) == brute_codes(few)
    none = gridcodes.encode(df.limit(0))
    assert none.count() == 0 and none.columns[:4] == ["vec_id", "label", "code", "error"]


def test_cells_keep_every_nearest_entry():
    rng = np.random.default_rng(4)
    book = rng.integers(-900, 900, (16, 8))
    cache = gridcodes.CellCache(book, 400, limit=50)
    for _ in range(5):
        x = rng.integers(-1500, 1500, (700, 8))
        index, d = cache.nearest(x)
        want = ((x[:, None, :] - book[None]) ** 2).sum(axis=2)
        assert (d == want.min(axis=1)).all() and (index == want.argmin(axis=1)).all()
        assert len(cache.known) <= 750
    assert cache.evaluated < 5 * 700 * 16 * 0.6
    x = np.repeat(x[:3], 5, axis=0)
    cache.nearest(x)
    assert cache.hits


def test_cells_of_equal_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(gridcodes, "mix64", lambda h: h & np.uint64(1))
    rng = np.random.default_rng(5)
    book, x = rng.integers(-900, 900, (16, 8)), rng.integers(-1500, 1500, (300, 8))
    cache = gridcodes.CellCache(book, 400)
    for rows in (x[:200], x[100:]):
        index, _ = cache.nearest(rows)
        assert (index == ((rows[:, None, :] - book[None]) ** 2).sum(axis=2).argmin(axis=1)).all()


# --- filter audit ---------------------------------------------------------------


def brute_audit(rows, labels):
    first = {}
    for i, t, _ in rows:
        if i is not None:
            first[t or ""] = min(i, first.get(t or "", i))
    flags = {}
    for i, q, x in labels:
        a, b = flags.get(i, (0, 0))
        flags[i] = max(a, int(q == 1)), max(b, int(x == 1))
    judged = []
    for i, t, lang in rows:
        t = t or ""
        w = [x for x in t.encode().split()]
        fails = {
            f
            for f, bad in zip("ABCDE", (
                len(w) < 200, 100 * len(set(w)) < 50 * len(w), 100 * sum("A" <= c <= "Z" for c in t) > 3 * len(t),
                any(c in "#$%&*|" for c in t), i is not None and first[t] < i,
            ))
            if bad
        }
        judged.append((lang or "", fails, *(flags.get(i, (0, 0)) if i is not None else (0, 0))))
    out = {}
    for part in {j[0] for j in judged}:
        own = [j for j in judged if j[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [j for j in left if f in j[1]]
                left = [j for j in left if f not in j[1]]
                shapley[f] += len(gone)
                out[part, "".join(order), step] = [
                    len(left), len(gone), sum(f in j[1] for j in own) - len(gone), sum(j[1] == {f} for j in own),
                    sum(j[2] for j in gone), sum(j[3] for j in gone),
                ]
        for (p, order, step), v in out.items():
            if p == part:
                v.append(shapley[order[step - 1]])
    return out


def test_audit_matches_brute_force(spark):
    rng = random.Random(2)
    vocab = [f"w{i}" for i in range(400)]
    rows = []
    for i in range(120):
        t = " ".join(rng.choices(vocab if rng.random() < 0.6 else vocab[:60], k=rng.choice([3, 199, 200, 260])))
        t = t.upper() if rng.random() < 0.2 else t
        rows.append((i, t + rng.choice(["", " #1", "\t$"]), rng.choice(["en", "de", None, ""])))
    rows += [(500 + i, rows[i % 3][1], "en") for i in range(60)]  # copies
    rows += [(700, None, None), (701, "", "de"), (None, rows[0][1], "en"), (None, None, None), rows[5], rows[5], (-4, rows[1][1], "xx")]
    rows += [(800, "É" * 5 + "   Ω" + " a" * 300, "en"), (801, "Q" * 100_000, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 600, 2)] + [(None, 1, 1), (4, 1, 0), (4, 0, 1)]
    docs = spark.createDataFrame([(*r, 9, "own") for r in rows], DOCS).repartition(4)
    got = audit.audit(audit.judge(docs, spark.createDataFrame(labels, LABELS))).collect()
    found = {
        (r.part, r.filter_order, r.step): [r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley]
        for r in got
    }
    assert len(found) == len(got) and found == brute_audit(rows, labels)
    assert audit.audit(audit.judge(docs.limit(0), spark.createDataFrame(labels, LABELS))).count() == 0
    assert audit.audit(audit.judge(docs, spark.createDataFrame([], LABELS))).count() == len(got)


def test_min_plus_gives_removal_steps():
    orders, steps = audit.removal_steps(4)
    for m in range(16):
        for j, order in enumerate(orders):
            want = next((s for s, f in enumerate(order, 1) if m >> f & 1), 5)
            assert steps[m, j] == want


# --- pivot tables ---------------------------------------------------------------


def brute_fingerprint(text):
    w = (text or "").encode().lower().split()
    shingles = [b" ".join(w[k : k + 4]) for k in range(max(1, len(w) - 3))] if w else []
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(prints):
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 4:
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return [root(i) for i in range(len(prints))]


def test_fingerprints_match_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    texts = [" ".join(rng.choices([f"W{i}é" for i in range(50)], k=k)) for k in (0, 1, 3, 4, 5, 80, 3000)]
    texts += [None, " \t\n", "A b C\x0bD\x0ce", "x" * 300 + " y z w v", "ÀÉ Ab " * 40, " lead  and\r\ntrail "]
    for window in (1 << 20, 16):
        monkeypatch.setattr(pivots, "WINDOW", window)
        monkeypatch.setattr(pivots, "HASHES", 1 << 15 if window > 16 else 7)
        assert pivots.text_fingerprints(pa.array(texts)).tolist() == [brute_fingerprint(t) for t in texts]
    one = spark.createDataFrame([("some words of text",)], "t STRING").select(F.xxhash64("t")).first()[0]
    assert one % 2**64 == xxhash.xxh64_intdigest(b"some words of text", 42)


def planted(rng, n, groups):
    """Random fingerprints and chains and balls of near ones."""
    out = [rng.getrandbits(64) for _ in range(n)]
    for size, flips in groups:
        x = rng.getrandbits(64)
        for _ in range(size):
            out.append(x)
            y = x
            for b in rng.sample(range(64), flips):
                y ^= 1 << b
            x = y if rng.random() < 0.5 else x
            out.append(y)
    return list(dict.fromkeys(out))


@pytest.mark.parametrize("bucket", [60, 150, 4096])
def test_no_link_is_lost(spark, bucket):
    rng = random.Random(bucket)
    prints = planted(rng, 300, [(40, 4), (30, 5), (25, 1), (60, 2), (20, 3), (150, 4)])
    df = spark.createDataFrame([(x - 2**64 if x >= 2**63 else x,) for x in prints], "fp BIGINT")
    rows = pivots.buckets(df, 4, bucket).collect()
    groups = {}
    for r in rows:
        groups.setdefault((r.path, r.node), []).append(r.fp)
    pairs = []
    for g in groups.values():
        a, b = pivots.stars(np.array(g, np.int64).view(np.uint64), 4)
        assert len(a) < len(g)
        pairs += zip(a.tolist(), b.tolist())
    at = {x: i for i, x in enumerate(prints)}
    up = list(range(len(prints)))

    def root(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = sorted((root(at[a]), root(at[b])))
        up[b] = a
    assert [root(i) for i in range(len(prints))] == brute_components(prints)


def test_stars_of_a_large_dense_bucket():
    rng = random.Random(11)
    prints = planted(rng, 200, [(400, 2), (300, 4), (100, 9)])
    a, b = pivots.stars(np.array(prints, np.uint64), 4)
    up = {x: x for x in prints}
    for x, y in zip(a.tolist(), b.tolist()):
        up[y] = x
    want = brute_components(prints)
    assert len({up[x] for x in prints}) == len(set(want))
    group = dict(zip(prints, want))
    assert all(group[x] == group[up[x]] for x in prints)


def test_near_components(spark):
    rng = random.Random(9)
    vocab = [f"w{i}" for i in range(500)]
    base = " ".join(rng.choices(vocab, k=900))
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 90)))) for i in range(10, 60)]
    for i in range(40):
        w = base.split()
        w[rng.randrange(len(w))] = "new"
        rows.append((100 + i, " ".join(w)))
    rows += [(7, base), (None, base), (300, None), (301, ""), (None, " \n"), (5, rows[0][1]), rows[3], rows[3]]
    schema = "doc_id BIGINT, text STRING, fingerprint STRING, `x.y` INT"
    df = spark.createDataFrame([(*r, "theirs", 1) for r in rows], schema).repartition(3)
    got = pivots.near_components(df).collect()
    prints = [brute_fingerprint(t) for _, t in rows]
    comp = brute_components(prints)
    least = {}
    for (i, _), c in zip(rows, comp):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    want = sorted((str(i), p, least.get(c)) for (i, _), p, c in zip(rows, prints, comp))
    assert sorted((str(r.doc_id), r.fingerprint % 2**64, r.component_id) for r in got) == want
    assert pivots.near_components(df.limit(0)).count() == 0
    unnamed = pivots.near_components(df.where("doc_id is null")).collect()
    assert len(unnamed) == 2 and all(r.component_id is None for r in unnamed)


def test_query_over_the_given_table(spark):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    prints = [brute_fingerprint(r.text) for r in docs]
    comp = brute_components(prints)
    least = {}
    for r, c in zip(docs, comp):
        least[c] = min(r.doc_id, least.get(c, r.doc_id))
    want = {r.doc_id: (f"{p:016x}", least[c]) for r, p, c in zip(docs, prints, comp)}
    assert {r.doc_id: (r.fingerprint, r.component_id) for r in queries.op13_simhash(spark, sf).collect()} == want


# --- chosen paths -----------------------------------------------------------------


def test_runs_follow_from_the_target_recall(spark):
    assert ngramjoin.runs_for(0.99998) == 16 and ngramjoin.runs_for(0.5, splits=1) == 1
    assert [ngramjoin.runs_for(r) for r in (0.9, 0.99, 0.999)] == sorted(ngramjoin.runs_for(r) for r in (0.9, 0.99, 0.999))
    # Planted pairs of the least similarity, amid sets that make every bucket split.
    rng = random.Random(12)
    rows = []
    for i in range(150):
        words = [f"v{rng.randrange(10**6)}" for _ in range(94)]  # 90 shingles
        other = words[:-10] + [f"v{rng.randrange(10**6)}" for _ in range(10)]  # 80 of 100 are shared
        rows += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(other))]
    df = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    got = {r.k_id: (r.c_id, r.n_links) for r in ngramjoin.similarity_classes(df, bucket=4).collect()}
    assert sum(got[2 * i + 1] == (2 * i, 1) for i in range(150)) == 150


def test_near_copies_do_not_multiply_path_rows(spark):
    rng = random.Random(13)
    base = [f"w{rng.randrange(400)}" for _ in range(300)]
    rows = []
    for i in range(400):
        words = list(base)
        words[rng.randrange(300)] = f"x{i}"
        rows.append((i, " ".join(words)))
    rows += [(1000 + i, " ".join(f"w{rng.randrange(400)}" for _ in range(60))) for i in range(50)]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    sigs = docs.selectExpr("doc_id k_id", "0 k_tie", "text").mapInArrow(
        ngramjoin._signatures, "k_id long, k_tie int, size int, s1 long, s2 long, sig binary"
    )
    found, tied = ngramjoin._buckets(common.written(sigs.select("k_id", "k_tie", "sig"), "t"), 16, 32, 12)
    assert found.count() + tied.count() < 16 * 450 * 1.5
    got = ngramjoin.similarity_classes(docs, bucket=32, block=64).collect()
    assert {r.c_id for r in got if r.k_id < 400} == {0}
    assert all(r.n_links == 399 for r in got if r.k_id < 400)


# --- rows are kept whole -----------------------------------------------------------


CLASH = "k_id STRING, k_tie STRING, `a.b` INT, doc_id BIGINT, text STRING, source STRING, _range INT, size INT, times INT, `row` INT"


def test_documents_without_id_are_told_apart(spark):
    texts = spark.range(400_000).select(F.concat(F.lit("text number "), "id").alias("text"))
    twins = texts.groupBy(F.hash("text")).agg(F.collect_list("text").alias("same")).where(F.size("same") > 1).first().same[:2]
    rows = [(None, t) for t in twins] + [(None, twins[0]), (4, twins[0]), (4, twins[1])]
    docs = spark.createDataFrame(rows, "doc_id BIGINT, text STRING")
    keys = docs.select(*common.document_key()).distinct().collect()
    assert len({tuple(k) for k in keys}) == 3  # an id with two texts of one hash is one document
    kept = ngramjoin.one_of_each_class(docs.where("doc_id is null")).collect()
    assert sorted(r.text for r in kept) == sorted(twins)
    with pytest.raises(Exception, match="document ids must be below"):
        spark.createDataFrame([(2**63 - 5, "x")], "doc_id BIGINT, text STRING").select(*common.document_key()).collect()


def test_columns_of_any_name_are_kept(spark):
    rng = random.Random(3)
    text = lambda: " ".join(f"w{rng.randrange(300)}" for _ in range(40))
    copy = text()
    rows = [("mine", "own", 7, i, text(), rng.choice(["a", "b"]), 1, 2, 3, 4) for i in range(20)]
    rows += [("mine", "own", 7, i, copy, "a", 1, 2, 3, 4) for i in (50, 51)]
    docs = spark.createDataFrame(rows, CLASH)
    bench = spark.createDataFrame([(1, rows[3][4])], "item_id BIGINT, text STRING")
    for out, ids in (
        (ngramjoin.one_of_each_class(docs), {*range(20), 50}),
        (decontam.decontaminate(docs, bench), {*range(20), 50, 51} - {3}),
    ):
        assert out.columns == docs.columns
        assert {tuple(r) for r in out.collect()} == {r for r in rows if r[3] in ids}
    mixed = mixing.mix(docs)
    assert mixed.columns == docs.columns and {tuple(r) for r in mixed.collect()} <= set(rows)
    after = sketch.with_next(docs.drop("a.b"), "doc_id", ["text"], {"sk": sketch.sketch(F.col("text"))}).collect()
    assert len(after) == len(rows) and all(r._range == 1 and r.k_id == "mine" for r in after)


# --- URL filter ---------------------------------------------------------------------


def test_trees_learn_given_labels_beyond_the_sample(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").select("url")
    labelled = urlfilter.labelled_by_rules(pages, queries.RULES).distinct()
    held = F.pmod(F.xxhash64("url", F.lit("held out")), F.lit(4)) == 0
    train, test = labelled.where(~held), labelled.where(held)
    model = urlfilter.train(train)
    got = model.score(test).select("label", "p_block").collect()
    assert {r.label for r in got} == {0.0, 1.0} and len(got) > 50
    share = max(sum(r.label for r in got), sum(1 - r.label for r in got)) / len(got)
    right = sum((r.p_block >= 0.5) == (r.label == 1) for r in got) / len(got)
    assert right >= 0.9 and right > share + 0.1


def test_copies_of_a_url_count_once(spark):
    one = [("http://a.net/x", 1.0)] * 500
    rows = one + [(f"http://h{i}.net/p{i}", 1.0) for i in range(40)] + [(f"http://h{i}.org/p{i}", 0.0) for i in range(40)]
    df = spark.createDataFrame(rows, "url STRING, label DOUBLE")
    model = urlfilter.train(df, max_rows=60)
    assert sum(r.f_seen for r in model.suffixes.collect()) == 60
    got = model.score(spark.createDataFrame([("http://new.net/q",), ("http://new.org/q",), (None,)], "url STRING")).collect()
    assert len(got) == 3 and all(0 <= r.p_block <= 1 for r in got)
    assert urlfilter.judge(df.limit(0).withColumn("page_id", F.lit(1)), model, queries.RULES, ["page_id"]).count() == 0


# --- tokenizers ---------------------------------------------------------------------


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_tokenizers_own(name, monkeypatch):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    rng = random.Random(6)
    texts = ["", " ", "two  blanks\n\nand lines\t.", " lead, trail ", "Ünï çode  déjà", "a" * 400]
    texts += [" ".join(f"word{rng.randrange(900)}" for _ in range(rng.randrange(80))) for _ in range(60)]
    monkeypatch.setattr(tokenfile, "REMEMBERED", 4000)  # both generations are used up again and again
    common.worker_cache("other")
    for t in texts * 2:
        assert tokenfile.encode(t, path).tolist() == plain.encode(t, add_special_tokens=False).ids
    kept = common.worker_cache("tokens")[path]
    assert sum(len(k) + len(v) + tokenfile.ENTRY for k, v in [*kept.met.items(), *kept.old.items()]) < 4 * 4000 + 100_000
